"""Registered queries of the operators on tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docketlake.llm.alignment import aligned
from docketlake.llm.common import query, read, whole
from docketlake.llm.token_counts import token_count
from docketlake.llm.transducer import round_trip

#: Tokens that fit into one training sequence.
LIMIT = 2048


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.octet_length(whole("text")).cast("bigint").alias("n_bytes"),
        token_count("text", public_tokenizers.path("word_bpe_49k.json")).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > LIMIT)


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    both = read(spark, sf_dir, "documents").select("doc_id", round_trip("text", path).alias("r"))
    return both.select(
        "doc_id",
        F.size("r.ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("r.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("r.back", 256).alias("decoded_sha256"),
    )


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                   public_tokenizers.path("piece_bpe_32k.model"))
