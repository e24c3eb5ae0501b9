"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings that the results, or the tasks' survival, depend on.
REQUIRED = {
    # DATE/TIMESTAMP arithmetic must not depend on the machine's time zone.
    "spark.sql.session.timeZone": "UTC",
    # A JSON answer that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Replacing a year must leave the other years of the table alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Digest texts can be hundreds of KB: an Arrow batch must not hold 10,000 of them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}

# Settings for the plan shape; a cluster may override any of them.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording a stack trace for every Column makes large expressions slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a given session."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docketlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**REQUIRED, **TUNING}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, as the session names it.

    Only a local master may fall back to a folder below its warehouse.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/docketlake/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables once what was made of them is stored."""
    root = f"{shared_dir(spark)}/docketlake/"
    for path in paths:
        if not path.startswith(root):
            raise ValueError(f"not a scratch path: {path}")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
