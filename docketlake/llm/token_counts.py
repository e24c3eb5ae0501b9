"""Token counts without tokens: byte-pair merging on a heap and a linked list.

The pairs of neighbouring symbols of a word wait in a heap by rank; the lowest is popped
and merged in a doubly linked list, and its two new neighbour pairs are pushed. An entry
whose pair has changed meanwhile is stale and skipped. The count is the number of initial
symbols minus the number of merges; no identifier is looked up or emitted.

Letters newer than Unicode 16 may be split otherwise than an older library splits them.
Each row is counted on its own, without any shuffle. Null texts count as empty (0 tokens),
extra columns are not read, repeated rows are each counted.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import Column

from docketlake.llm.common import text_udf
from docketlake.llm.merging import Merges
from docketlake.llm.tokenizer_files import Vocabulary, byte_symbols

# Fixed: how the vocabulary file splits normalised text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words whose counts a task remembers; the memory is emptied when full.
REMEMBERED = 400_000


def counter(vocabulary: Vocabulary):
    """``text -> number of tokens``, special strings inside a text counting one each."""
    end, shown = vocabulary.word_end, byte_symbols()
    merges = Merges([*shown, *(s + end for s in shown)] if end else shown, vocabulary.merges)
    ends = len(shown) if end else 0     # a word's last symbol has a number of its own
    split = regex.compile(WORDS).findall
    special = "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))
    parts = regex.compile(special).split if special else None
    known: dict[str, int] = {}

    def one(word: str) -> int:
        symbols = list(word.encode("utf-8"))
        symbols[-1] += ends
        return len(symbols) - merges.merge(symbols)

    def plain(text: str) -> int:
        # Lower case is taken letter by letter: a final sigma is no special case.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        total = 0
        for word in split(text):
            n = known.get(word)
            if n is None:
                n = one(word)
                if len(word) <= 40:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = n
            total += n
        return total

    def count(text: str) -> int:
        pieces = parts(text) if parts and "<|" in text else [text]
        return len(pieces) - 1 + sum(map(plain, pieces))

    return count


def token_count(text: str | Column, path: str) -> Column:
    """Tokens of each whole text by the vocabulary file at ``path``."""
    def make():
        count = counter(Vocabulary(path))
        return lambda texts: pa.array([count(t) for t in texts], pa.int64())

    return text_udf(make, "bigint")(text)
