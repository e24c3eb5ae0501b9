"""What the operators share: reading tables, staging results, columns with Python inside."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketlake.operators.keys import apart
from docketlake.session import configure, drop_scratch, scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query of this package; ``sql`` is the same result in DuckDB's SQL."""
    def add(run):
        QUERIES[key] = lambda spark, sf_dir: run(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[key] = sql
        return run

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns; further ones of the caller can then clash with nothing."""
    return docs.select(*(docs[c] for c in columns))


def per_key(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Aggregates per key, to be joined back to the rows of that key.

    Grouped apart, so that adaptive execution can split the rows of a hot key in that join.
    """
    return df.groupBy(key, apart(key)).agg(*aggregates).drop("_apart")


class Staging:
    """Tables written below the shared folder, so that a lost executor costs no recomputation.

    Everything is removed at the end of the ``with`` block except what :meth:`keep` wrote:
    that table backs the DataFrame which the operator returns.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, []

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *_) -> None:
        drop_scratch(self.spark, *self.paths)

    def save(self, df: DataFrame, *folders: str) -> DataFrame:
        """``folders``: columns whose values get folders of their own."""
        path = scratch_path(self.spark, self.name)
        self.paths.append(path)
        return self._write(df, path, *folders)

    def keep(self, df: DataFrame) -> DataFrame:
        return self._write(df, scratch_path(self.spark, f"{self.name}-result"))

    def drop(self) -> None:
        """Remove what was staged so far; nothing may read it any more."""
        drop_scratch(self.spark, *self.paths)
        self.paths = []

    def _write(self, df: DataFrame, path: str, *folders: str) -> DataFrame:
        (df.write.partitionBy(*folders) if folders else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def text_udf(make, returns: str):
    """A column function of one column from ``make() -> (list of values -> Arrow array)``.

    ``make`` runs once per task, so tables and automata are built there. Nulls arrive
    as empty texts.
    """
    def run(batches):
        work = make()
        for texts in batches:
            yield work(["" if t is None else t for t in texts.to_pylist()])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
