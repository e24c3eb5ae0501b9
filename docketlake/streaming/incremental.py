"""Load records as their files arrive.

The file source remembers which files it has handed out, and a batch's load has the
name of its stream and number: one that is replayed after a failure loads nothing, and
keeps no reject, twice.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketlake.plans.stages import load_records
from docketlake.schemas import DIGEST
from docketlake.session import configure


def load_new_files(spark: SparkSession, source: str, base: str, checkpoint: str, fmt: str = "json"):
    """Load every file of records below ``source`` not seen before, then stop.

    ``fmt``: ``json`` (one record per line) or ``parquet``, as the extraction stage
    stores them. Returns the streaming query. ``checkpoint`` must be a folder the
    cluster shares.
    """
    configure(spark)
    reader = spark.readStream.option("recursiveFileLookup", True)
    if fmt == "parquet":
        arriving = reader.schema(f"{DIGEST}, out_path STRING").parquet(source)
    else:
        arriving = reader.schema(f"{DIGEST}, _corrupt STRING").option(
            "columnNameOfCorruptRecord", "_corrupt").json(source)

    stream = f"s{zlib.crc32(checkpoint.encode()):08x}"

    def load(batch: DataFrame, number: int) -> None:
        keyed = batch.withColumn("record_hash", F.xxhash64("actions", "extraction_notes"))
        load_records(batch.sparkSession, base, keyed, ["digest_date", "record_hash"], run=f"{stream}-{number}")

    return (
        arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
