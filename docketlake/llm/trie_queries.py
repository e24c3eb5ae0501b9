"""Registered query of the conversation trie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docketlake.llm.common import Staging, query, read
from docketlake.llm.prefix_trie import ordered_turns, prefix_trie, with_family_start

#: Conversations of a family, and the number that first turns shared within one stay below.
FAMILY, MOST = 20, 4

SQL = r"""WITH ids AS (
  SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), shared AS (                                  -- CRC-32 of the decimal id, bit by bit, mod 4
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384))
  ), 4294967295) % 4 AS h
  FROM ids
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT s.conv_id, 0 AS own, t.pos, t.t FROM shared s JOIN turns t ON t.conv_id = s.base AND t.pos <= s.h
  UNION ALL
  SELECT s.conv_id, 1, t.pos, t.t FROM shared s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h
), paths AS (
  SELECT i.conv_id, coalesce(list(r.t ORDER BY r.own, r.pos) FILTER (r.t IS NOT NULL), []) AS path
  FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY i.conv_id
), members AS (
  SELECT conv_id, d AS depth, path[1:d] AS prefix, path[1:d - 1] AS above, path[d] AS last, d = len(path) AS ends
  FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT depth, prefix, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * any_value(len(regexp_extract_all(last.text, '[^\x20\x09-\x0D]+'))) END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY depth, prefix
), placed AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.above = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.above
), totals AS (                                  -- a node's smallest member passes all that are above the node
  SELECT m.depth, m.prefix, sum((p.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(p.saved)::BIGINT AS saved_tokens
  FROM placed p JOIN members m ON m.conv_id = p.conv_id AND m.depth <= p.depth GROUP BY m.depth, m.prefix
)
SELECT p.conv_id, p.depth, p.parent_conv_id, p.n_convs, p.n_children, t.n_leaves, t.saved_tokens, p.ends_sha256
FROM placed p JOIN totals t ON t.depth = p.depth AND t.prefix = p.prefix
"""


@query("op11_prefix_trie", SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Staging(spark, "trie") as staging:
        turns = ordered_turns(read(spark, sf_dir, "conversations"), staging)
        return prefix_trie(*with_family_start(turns, FAMILY, MOST, staging), staging)
