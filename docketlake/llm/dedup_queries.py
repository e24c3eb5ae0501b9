"""Registered queries of the operators on repeated content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketlake.llm.chunks import repeated_spans
from docketlake.llm.common import query, read
from docketlake.llm.decontamination import contaminated
from docketlake.llm.fingerprints import fingerprints
from docketlake.llm.near_duplicates import near_duplicates
from docketlake.llm.sharding import balanced_shards


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read(spark, sf_dir, "documents"))


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


@query("op4_shards")
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(read(spark, sf_dir, "documents"))


#: Whole sets of hashed shingles; a pair is looked for by the first fifth of its sorted shingles, in which alike sets meet.
NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE
    WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [hash(array_to_string(w, ' '))]
    ELSE list_transform(range(1, len(w) - 2), lambda i: hash(w[i], w[i + 1], w[i + 2], w[i + 3])) END)) AS s
  FROM words),
classes AS (SELECT s, len(s) AS n, min(doc_id) AS id FROM sets WHERE len(s) > 0 GROUP BY s),
heads AS (SELECT id, unnest(s[1:n - CAST(ceil(n * 8 / 10) AS BIGINT) + 1]) AS h FROM classes),
pairs AS (SELECT DISTINCT x.id AS a, y.id AS b FROM heads x JOIN heads y ON x.h = y.h AND x.id < y.id),
shared AS (
  SELECT a, b, x.n + y.n AS n, len(list_intersect(x.s, y.s)) AS common
  FROM pairs JOIN classes x ON x.id = a JOIN classes y ON y.id = b),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 80 * (n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id, id AS r FROM classes UNION SELECT edges.b, reach.r FROM reach JOIN edges ON edges.a = reach.id),
found AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component, doc_id) AS component_id,
  coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN classes ON classes.s = sets.s LEFT JOIN found ON found.id = classes.id
"""


@query("op5_near_duplicates", NEAR_SQL)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), k=4, share=80)


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
