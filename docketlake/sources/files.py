"""Raw files, digest texts and nested records on storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketlake.functions import urls
from docketlake.schemas import DIGEST

RAW_GLOB = "*.{pdf,txt,htm,html}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(jvm_path))


def _fs_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def marks(spark: SparkSession, path: str) -> list[str]:
    """Names of the marks set below a path."""
    fs, p = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless one is there; tells whether this call wrote it."""
    fs, p = _fs_path(spark, path)
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of a stored table and all below it."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def plain_folders(spark: SparkSession, source: str, target: str, name: str, suffixes: list[str] | None = None) -> None:
    """Give partition folders (``year=1999``) plain names (``1999``) below ``target``.

    With ``suffixes`` the files of the n-th folder get the n-th of them, over and over.
    """
    fs, p = _fs_path(spark, target)
    fs.mkdirs(p)
    folders = [f for f in marks(spark, source) if f.startswith(f"{name}=")]
    for n, folder in enumerate(folders):
        plain = f"{target}/{folder[len(name) + 1:]}"
        fs.rename(_fs_path(spark, f"{source}/{folder}")[1], _fs_path(spark, plain)[1])
        for file in marks(spark, plain) if suffixes else []:
            stem = file.rsplit(".", 1)[0]
            fs.rename(_fs_path(spark, f"{plain}/{file}")[1], _fs_path(spark, f"{plain}/{stem}{suffixes[n % len(suffixes)]}")[1])


def raw_files(spark: SparkSession, root: str, year: int | None = None) -> DataFrame:
    """Digest files below ``root/YYYY``: path (from ``root`` on), size, year folder, content, full name.

    One level of folders, case-sensitive suffixes; a missing folder is empty. The
    content of a file is only read by a plan that uses the column.
    """
    folder = root if year is None else f"{root}/{year}"
    pattern = f"{root}/*/{RAW_GLOB}" if year is None else f"{root}/{year}/{RAW_GLOB}"
    if not path_exists(spark, folder):
        return spark.createDataFrame(
            [], "path STRING, length BIGINT, year_dir STRING, content BINARY, file STRING")
    files = spark.read.format("binaryFile").option("ignoreMissingFiles", True).load(pattern)
    path = F.concat(F.lit(f"{root}/"), F.regexp_extract("path", r"([^/]*/[^/]*)$", 1))
    return files.select(path.alias("path"), "length", urls.year_folder(F.col("path")).alias("year_dir"),
                        "content", F.col("_metadata.file_path").alias("file"))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly per-row work on a scan that is small for the cluster.

    The splits of a small scan are cut finer than a file's row groups, so most of
    them are empty. From one full split per core on, a scan is left as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * split else df


def balanced(df: DataFrame, *partition_by: str) -> DataFrame:
    """Few large files per partition folder; a hot folder is split over many tasks."""
    return df.hint("rebalance", *partition_by)


def write_texts(texts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store digest texts as one table, partitioned by year."""
    balanced(texts, "year").write.mode(mode).partitionBy("year").parquet(path)


def read_texts(spark: SparkSession, path: str, year: int | None = None,
               schema: str | None = None) -> DataFrame:
    """Digest texts; a year reads that year's folder only."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if year is None else df.where(F.col("year") == year)


def write_extractions(records: DataFrame, path: str, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Store nested records, partitioned by year.

    Parquet by default, so that a look at the dates reads only the dates; ``json``
    writes one record per line, nulls included.
    """
    writer = balanced(records, "year").write.mode(mode).partitionBy("year")
    if fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.parquet(path)


def read_extractions(spark: SparkSession, path: str, year: int | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """Nested records with the schema of a digest.

    ``parquet`` and ``json`` (one record per line) read what
    :func:`write_extractions` wrote; ``files`` reads one JSON object per file from
    plain year folders (``1999/x.json``). ``out_path`` names the text that a parquet
    record was made from. A JSON record that cannot be read keeps
    its text in ``_corrupt``; ``_path`` names the file a record came from.
    """
    if fmt == "files":
        source = f"{path}/{'*' if year is None else year}"
    else:
        source = path if year is None else f"{path}/year={year}"
    reader = spark.read.schema(f"{DIGEST}, " + ("out_path STRING" if fmt == "parquet" else "_corrupt STRING"))
    if fmt != "files":
        reader = reader.option("basePath", path)
    if fmt == "parquet":
        df = reader.parquet(source)
    else:
        df = (
            reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
            .option("multiLine", fmt == "files").json(source)
        )
    return df.withColumn("_path", F.col("_metadata.file_path"))


def load_order() -> tuple[Column, Column]:
    """Year folder and file name of a record read by :func:`read_extractions`."""
    return (F.regexp_extract("_path", r"([^/]*)/[^/]*$", 1).alias("year_dir"),
            F.regexp_extract("_path", r"([^/]*)$", 1).alias("file_name"))
