"""Contents of named raw files, read in the tasks.

The names are a table, stored in files of bounded length; each of those is a partition of
the scan, whose task opens the raw files it names. So no list of names passes the driver,
and no file that is not named is opened.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "docketlake_pending"
#: Files that a task reads at most.
NAMES = 256


def _place(uri: str):
    """(file system, path) of a path as Spark writes it; percent signs stand for themselves in plain paths."""
    from pyarrow import fs

    if not re.match("[a-z][a-z0-9+.-]*:", uri):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


@dataclass
class _Names(InputPartition):
    file: str


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[_Names]:
        from pyarrow import fs

        system, path = _place(self.folder)
        found = system.get_file_info(fs.FileSelector(path))
        return [_Names(f.base_name) for f in found if f.base_name.endswith(".parquet")]

    def read(self, partition: _Names) -> Iterator[tuple[str, bytes]]:
        from pyarrow import parquet

        system, path = _place(f"{self.folder}/{partition.file}")
        with system.open_input_file(path) as f:
            names = parquet.read_table(f)
        for name, uri in zip(names["path"].to_pylist(), names["file"].to_pylist()):
            where, raw = _place(uri)
            try:
                with where.open_input_stream(raw, compression=None) as stream:
                    content = stream.read()
            except FileNotFoundError:   # gone since it was listed
                continue
            yield name, content


class PendingFiles(DataSource):
    """``option("names", folder)``: a Parquet table (path, file), ``file`` being where to read."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path STRING, content BINARY"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["names"])


def read_pending(spark: SparkSession, names: DataFrame, folder: str, at_most: int = NAMES) -> DataFrame:
    """(path, content) of the files that ``names`` (path, file) lists; the list is kept in ``folder``."""
    names.select("path", "file").write.option("maxRecordsPerFile", at_most).parquet(folder)
    spark.dataSource.register(PendingFiles)
    return spark.read.format(FORMAT).option("names", folder).load()
