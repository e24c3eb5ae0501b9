"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

How far may what follows change a token? A change to the right reaches further left only
through a merge (u, v) whose v starts where the change started; it then starts at u. The
next such merge has a later rank, and its v begins with u. :func:`sufficient_lookahead`
adds up the longest such chain in one pass over the merge list. So tokens that end that
many bytes before the end of what was read are stable: they are emitted, and only the rest
stays in memory. Cutting at a token boundary leaves the encoding of the rest unchanged.

Decoding maps identifiers to bytes in blocks and runs an incremental UTF-8 automaton over
them; it holds the at most three bytes of an unfinished character between blocks.

Rows are handled one by one, without a shuffle. Null and empty texts give no identifiers,
no identifiers give the empty text.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column

from docketlake.llm.common import text_udf
from docketlake.llm.merging import Merges
from docketlake.llm.tokenizer_files import Vocabulary, byte_symbols

# Fixed: how byte-level vocabularies of this family split a text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose identifiers a task remembers; the memory is emptied when full.
REMEMBERED = 400_000
#: Identifiers decoded at a time.
BLOCK = 4096


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Bytes to the right of a token after which nothing can change it any more."""
    reach: dict[str, int] = {}          # by left part u: longest chain that starts at u
    starts: dict[str, tuple[str, ...]] = {}   # tokens that a token begins with, itself last
    longest = 0
    for u, v in merges:
        if any(len(x) > 1 and x not in starts for x in (u, v)):
            raise ValueError("a merge is listed before the ones that make its parts")
        chain = len(u) + max(reach.get(x, 0) for x in starts.get(v, (v,)))
        reach[u] = max(chain, reach.get(u, 0))
        longest = max(longest, chain)
        starts[u + v] = (*starts.get(u, (u,)), u + v)
    return longest


class Transducer:
    """Reads symbols of one word in any portions, returns tokens as soon as they are stable."""

    def __init__(self, merges: Merges, lookahead: int):
        self.merges, self.lookahead, self.held = merges, lookahead, []
        self.limit = 3 * lookahead + 256

    def feed(self, symbols: list[int]) -> Iterator[int]:
        for at in range(0, len(symbols), self.limit):
            self.held += symbols[at: at + self.limit]
            if len(self.held) > self.limit:
                yield from self._stable(len(self.held) - self.lookahead)

    def finish(self) -> list[int]:
        tokens, self.held = self._merged(), []
        return tokens

    def _stable(self, until: int) -> Iterator[int]:
        done, sizes = 0, self.merges.sizes
        for token in self._merged():
            if done + sizes[token] > until:
                break
            done += sizes[token]
            yield token
        self.held = self.held[done:]

    def _merged(self) -> list[int]:
        symbols = self.held.copy()
        self.merges.merge(symbols)
        return [s for s in symbols if s >= 0]


def encoder(vocabulary: Vocabulary, lookahead: int | None = None):
    """``text -> list of identifiers``, special strings inside a text taken as such."""
    merges = Merges(byte_symbols(), vocabulary.merges)
    machine = Transducer(merges, lookahead or sufficient_lookahead(vocabulary.merges))
    id_of = [vocabulary.ids[s] for s in merges.numbers]
    words = regex.compile(WORDS).findall
    special = vocabulary.special
    marks = "|".join(map(regex.escape, sorted(special, key=len, reverse=True)))
    parts = regex.compile(f"({marks})").split if marks else None
    known: dict[str, tuple[int, ...]] = {}

    def one(word: str) -> tuple[int, ...]:
        data = word.encode("utf-8")
        out = list(machine.feed(list(data))) if len(data) > machine.limit else machine.held.extend(data) or []
        return tuple([id_of[s] for s in out + machine.finish()])

    def plain(text: str, out: list[int]) -> None:
        for word in words(text):
            found = known.get(word)
            if found is None:
                found = one(word)
                if len(word) <= 40:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = found
            out += found

    def encode(text: str) -> list[int]:
        out: list[int] = []
        for piece in parts(text) if parts and "<|" in text else [text]:
            if piece in special:
                out.append(special[piece])
            else:
                plain(piece, out)
        return out

    return encode


def decoder(vocabulary: Vocabulary):
    """``identifiers -> text``; malformed bytes become U+FFFD, unknown identifiers nothing."""
    byte_of = {c: b for b, c in enumerate(byte_symbols())}
    table = [b""] * (1 + max([*vocabulary.ids.values(), *vocabulary.special.values()]))
    for token, i in {**vocabulary.ids, **vocabulary.special}.items():
        known = all(c in byte_of for c in token)
        table[i] = bytes(byte_of[c] for c in token) if known else token.encode("utf-8")
    size, machine = len(table), codecs.getincrementaldecoder("utf-8")

    def decode(ids: list[int]) -> str:
        state, out = machine("replace"), []
        for at in range(0, len(ids), BLOCK):
            part = b"".join([table[i] if 0 <= i < size else b"" for i in ids[at: at + BLOCK]])
            out.append(state.decode(part))
        out.append(state.decode(b"", final=True))
        return "".join(out)

    return decode


def _id_lists(rows: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate([np.array(r, np.int32) for r in rows]) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _prepared(path: str) -> tuple[str, int]:
    """The file and its lookahead, which is computed once for all tasks."""
    return path, sufficient_lookahead(Vocabulary(path).merges)


def encode_bpe(text: str | Column, path: str) -> Column:
    """Identifiers of each whole text as ``array<int>``."""
    path, lookahead = _prepared(path)

    def make():
        encode = encoder(Vocabulary(path), lookahead)
        return lambda texts: _id_lists([encode(t) for t in texts])

    return text_udf(make, "array<int>")(text)


def round_trip(text: str | Column, path: str) -> Column:
    """``struct<ids, back>``: identifiers of each whole text, and the text decoded from them."""
    path, lookahead = _prepared(path)

    def make():
        vocabulary = Vocabulary(path)
        encode, decode = encoder(vocabulary, lookahead), decoder(vocabulary)

        def work(texts: list[str]) -> pa.Array:
            rows = [encode(t) for t in texts]
            return pa.StructArray.from_arrays(
                [_id_lists(rows), pa.array([decode(r) for r in rows], pa.string())], ["ids", "back"])

        return work

    return text_udf(make, "struct<ids:array<int>,back:string>")(text)


def decode_bpe(ids: str | Column, path: str) -> Column:
    """The text that an array of identifiers stands for."""
    def make():
        decode = decoder(Vocabulary(path))
        return lambda rows: pa.array([decode(r) if r else "" for r in rows], pa.string())

    return text_udf(make, "string")(ids)
