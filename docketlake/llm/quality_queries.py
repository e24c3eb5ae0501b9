"""Registered query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docketlake.llm.common import query, read
from docketlake.llm.quality import fit_quality, held_out, quality_score

#: Score from which a document is predicted to be good.
GOOD = 0.3


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    return docs.select("doc_id", held_out("doc_id").alias("held_out"),
                       quality_score("text", model).alias("score")).withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int"))
