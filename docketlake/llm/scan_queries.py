"""Registered queries of the scans for secrets and licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketlake.llm.common import query, read
from docketlake.llm.licenses import license_scan
from docketlake.llm.secrets import secret_spans


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op8_secrets")
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", secret_spans("text").alias("found"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("found", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"),
        count("novel").alias("n_novel"),
    )


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(spark, sf_dir, "documents").select("doc_id", license_scan("text").alias("r"))
    return found.select(
        "doc_id", "r.n_words", "r.n_base", "r.first_word", "r.last_word",
        F.array_join("r.base_labels", ",").alias("base_labels"),
        F.array_join("r.labels", ",").alias("labels"), "r.score",
        F.transform("r.spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"])).alias("spans"),
    )
