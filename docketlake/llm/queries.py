"""All queries of this package and their SQL, where SQL can express them."""

from docketlake.llm import (  # noqa: F401  (importing registers the queries)
    dedup_queries, line_queries, quality_queries, scan_queries, tokens_queries, trie_queries,
)
from docketlake.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
