"""The stored tables: plain Parquet that Spark writes, partition by partition.

Manifest and parse results are partitioned by year, and a change writes the years it
covers anew. What belongs together (texts and results of a parse run) is first staged
whole, then marked ready, then put in place by Spark's dynamic partition overwrite; a run
that dies after the mark is finished by the next one, and one that dies before leaves
nothing. So run one stage that writes a base at a time.

The four enforcement tables have a folder per load, and below it one per year. A load
writes them, the days it covers and its rejects, and last its row of ``loads``, which
makes all of it visible: a load that dies is never seen, and one that is run again under
its name writes the same folders. A load that replaces years hides what earlier loads
hold of them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from docketlake.operators import load as L
from docketlake.schemas import ENFORCEMENT_TABLES
from docketlake.sources.files import balanced, create_file, drop_folder, marks, path_exists

COUNTS = ["loaded", "skipped_existing", "no_actions", "errors", "total_actions", "failed", "repeated_dates"]
LOADS = (
    "number BIGINT, load STRING, replaced_years ARRAY<INT>, "
    + ", ".join(f"{c} BIGINT" for c in COUNTS) + ", last_ids MAP<STRING, BIGINT>, loaded_at TIMESTAMP_NTZ"
)
DAYS = "year INT, days BINARY, load STRING"
REJECTS = "file STRING, digest_date DATE, reason STRING, rejected_at TIMESTAMP_NTZ, load STRING"

#: The file that marks a staged folder as whole: the columns each table is partitioned by.
READY = "ready.json"
OVERTAKEN = "another load was committed meanwhile; run this one again"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, or an empty one with its schema where nothing is stored."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def tables_present(spark: SparkSession, base: str, required: list[str]) -> bool:
    return all(path_exists(spark, f"{base}/{t}") for t in required)


# --- tables that change by partition -------------------------------------------

def publish(spark: SparkSession, base: str, tables: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """Store new partitions of several tables (name: rows and the columns they are partitioned by).

    The partitions that the rows cover are replaced, all others stay. The rows may be
    computed from the tables themselves. Either all of the tables change or, until
    :func:`finish_published` has run, a reader may see some of them.
    """
    folder = f"{base}/_staged/{uuid.uuid4().hex}"
    for name, (df, by) in tables.items():
        balanced(df, *by).write.parquet(f"{folder}/{name}")
    create_file(spark, f"{folder}/{READY}", json.dumps({name: by for name, (_, by) in tables.items()}))
    _put_in_place(spark, base, folder)


def _put_in_place(spark: SparkSession, base: str, folder: str) -> None:
    """Replace partitions by what is staged whole, drop the rest; doing it again changes nothing."""
    ready = f"{folder}/{READY}"
    # Empty, if the run died while it wrote the mark.
    mark = spark.read.option("wholetext", True).text(ready).first() if path_exists(spark, ready) else None
    for name, by in json.loads(mark.value).items() if mark else ():
        put_partitions(spark.read.parquet(f"{folder}/{name}"), f"{base}/{name}", by)
    drop_folder(spark, folder)


def put_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write the partitions that ``df`` covers in place of the stored ones."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def finish_published(spark: SparkSession, base: str) -> None:
    """Put in place what a run that died had staged whole; drop what it had not."""
    for name in marks(spark, f"{base}/_staged"):
        _put_in_place(spark, base, f"{base}/_staged/{name}")


# --- loads -----------------------------------------------------------------------

def loads(spark: SparkSession, base: str) -> DataFrame:
    """One row per committed load."""
    return read_or_empty(spark, f"{base}/loads", LOADS)


def last_load(spark: SparkSession, base: str) -> int:
    """Number of the last committed load, 0 if there is none."""
    return loads(spark, base).agg(F.max("number")).first()[0] or 0


def last_ids(spark: SparkSession, base: str) -> dict[str, int]:
    """Highest id given out in each table: from the rows of ``loads``, not from the tables."""
    highest = loads(spark, base).agg(*[F.max(F.col("last_ids")[t]).alias(t) for t in ENFORCEMENT_TABLES]).first()
    return {t: highest[t] or 0 for t in ENFORCEMENT_TABLES}


def visible(spark: SparkSession, base: str, rows: DataFrame) -> DataFrame:
    """The rows (``load``, ``year``) of committed loads that no later load has replaced."""
    log = loads(spark, base)
    since = (log.select(F.explode("replaced_years").alias("year"), "number")
             .groupBy("year").agg(F.max("number").alias("_since")))
    numbers = log.select("load", F.col("number").alias("_number"))
    return (
        rows.join(numbers, "load").join(F.broadcast(since), "year", "left")   # one row per year
        .where(F.col("_since").isNull() | (F.col("_number") >= F.col("_since")))
        .select(*rows.columns)
    )


def enforcement_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The four tables as the committed loads left them."""
    return {
        name: visible(spark, base, read_or_empty(spark, f"{base}/{name}", f"{schema}, load STRING, year INT"))
        for name, schema in ENFORCEMENT_TABLES.items()
    }


def loaded_days(spark: SparkSession, base: str) -> DataFrame:
    """(year, days): the days that are loaded, one bitmap per year, without a look at the actions."""
    return L.joined_days(visible(spark, base, read_or_empty(spark, f"{base}/loaded_days", DAYS)))


def rejects(spark: SparkSession, base: str) -> DataFrame:
    """Digests that committed loads could not take, and why."""
    stored = read_or_empty(spark, f"{base}/load_rejects", REJECTS)
    return stored.join(loads(spark, base).select("load"), "load", "left_semi")


def _reject_rows(rejected: DataFrame) -> DataFrame:
    """``file``: the file of the record, else the text it was made from, where known."""
    named = [F.col(c) for c in ("_path", "out_path") if c in rejected.columns]
    return rejected.select(
        F.coalesce(*named, F.lit(None).cast("string")).alias("file"), "digest_date", F.col("fault").alias("reason"),
        F.current_timestamp().cast("timestamp_ntz").alias("rejected_at"))


def write_load(spark: SparkSession, base: str, load: str, tables: dict[str, DataFrame], days: DataFrame,
               rejected: DataFrame, first: dict[str, int], rows: dict[str, int]) -> int:
    """Write the folders of a load (tables with a ``year`` column); the number of distinct days.

    What the load promises is checked by metrics gathered while its tables are written:
    ``rows`` of each table with the ids from ``first`` on, no null where none may be, and
    children of the load's own actions only. A load that breaks one is refused.
    """
    action_ids = (first["enforcement_actions"], first["enforcement_actions"] + rows["enforcement_actions"] - 1)
    faults = []
    for name in ["respondents", "violations", "sanctions", "enforcement_actions"]:
        seen = Observation()
        metrics = L.integrity_metrics(name, tables[name].columns, first[name], action_ids)
        # Above the exchange: below one that turns out empty the metrics would go with it.
        balanced(tables[name], "year").observe(seen, *metrics).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("year").parquet(f"{base}/{name}/load={load}")
        faults += L.integrity_faults(name, seen.get, rows[name])
    if faults:
        raise ValueError("load refused: " + "; ".join(faults))
    seen = Observation()
    days.observe(seen, F.coalesce(F.sum(F.bitmap_count("days")), F.lit(0)).alias("days")).write.mode(
        "overwrite").parquet(f"{base}/loaded_days/load={load}")
    _reject_rows(rejected).write.mode("overwrite").parquet(f"{base}/load_rejects/load={load}")
    return seen.get["days"]


def commit_load(spark: SparkSession, base: str, after: int, row: dict) -> None:
    """Store a load's row of ``loads``; refused if another came after number ``after``."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    names = [f.split()[0] for f in LOADS.replace("MAP<STRING, BIGINT>", "MAP").split(", ")]
    number = after + 1
    values = {**row, "number": number, "loaded_at": now}
    df = spark.createDataFrame([tuple(values[n] for n in names)], LOADS).drop("number").coalesce(1)
    try:
        if last_load(spark, base) != after:
            raise RuntimeError(OVERTAKEN)
        df.write.mode("errorifexists").parquet(f"{base}/loads/number={number}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise RuntimeError(OVERTAKEN) from e
