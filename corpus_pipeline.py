"""A corpus made ready for training: five stages over ``documents``.

Every stage takes what its predecessor kept and, but for the last, returns the columns of
``documents``. Each is written as Parquet below the session's shared folder and read again.

1. quality: the classifier, fitted on labelled rows of ``labels``, drops texts below 0.3.
2. near_dedup: one document of each group of equal or near-equal texts stays, the smallest id.
3. decontaminate: texts that hold a verified item of ``benchmark`` go.
4. redact: the values of secrets are replaced by a mark; ``n_chars`` follows.
5. encode: byte-pair identifiers, their number, and whether they decode to the text.

Null texts count as empty and stay unless a stage's rule drops them. Rows are judged by their
own text, whatever their id: rows that share an id, or have none, stay side by side where their
texts differ, and rows that repeat id and text are one. Columns besides those of ``documents`` pass through stages 1, 3 and 4 unread.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docketlake.llm.common import read
from docketlake.llm.decontamination import contaminated
from docketlake.llm.near_duplicates import near_duplicates
from docketlake.llm.quality import fit_quality, quality_score
from docketlake.llm.secrets import redacted
from docketlake.llm.transducer import round_trip
from docketlake.operators.keys import missing_from
from docketlake.session import configure, drop_scratch, scratch_path

#: Score from which a document stays.
GOOD = 0.3
VOCABULARY = "byte_bpe_50k.json"

#: No SQL: hashing, training and merging can't be written in it.
ORACLE_SQL = None


def _with_row_ids(docs: DataFrame) -> DataFrame:
    """Adds ``_row``: the id where it names one text, for further texts of an id one beyond all ids.

    Such rows and those without an id get a hash of id and text above 2**62; nearly always
    there are none, and nothing is joined.
    """
    text = F.xxhash64("doc_id", "text", F.octet_length("text"))
    beyond = F.lit(1 << 62) + F.shiftrightunsigned(text, 2)
    own = F.when(F.col("doc_id").isNull(), beyond).otherwise(F.col("doc_id"))
    several = (docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(text).alias("_low"), F.max(text).alias("_high"))
               .where("_low <> _high").select(F.col("doc_id").alias("_several"), "_low"))
    if several.isEmpty():
        return docs.withColumn("_row", own)
    joined = docs.join(several, docs["doc_id"] == several["_several"], "left")
    return joined.withColumn("_row", F.when(text != F.col("_low"), beyond).otherwise(own)).drop("_several", "_low")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality_score(docs["text"], model) >= GOOD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _with_row_ids(docs)
    groups = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), k=5, share=80)
    kept = missing_from(rows, groups.where(~F.col("kept")).select(F.col("doc_id").alias("_row")), "_row")
    one = kept.groupBy("_row").agg(F.min(F.struct(*docs.columns)).alias("_kept"))
    return one.select("_kept.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Known by their texts, so that a row without an id, or with another's, is judged as well.
    texts = docs.withColumn("_text", F.xxhash64("text", F.octet_length("text")))
    hits = contaminated(texts.select(F.col("_text").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    return missing_from(texts, hits.select(F.col("doc_id").alias("_text")), "_text").select(docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = redacted(docs["text"])
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), text)).withColumn(
        "n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    both = docs.select("doc_id", "lang", "source", "text", round_trip("text", path).alias("r"))
    return both.select(
        "doc_id", "lang", "source", F.size("r.ids").cast("bigint").alias("n_tokens"), F.col("r.ids").alias("ids"),
        (F.col("r.back") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("redact", redact), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs, before = read(configure(spark), sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_scratch(spark, before)
        before = path
    return docs
