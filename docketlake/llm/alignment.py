"""Alignment of two tokenizers over a corpus, each distinct text taken once.

Texts are shuffled whole, so copies meet and are counted; each distinct text is then tokenised
twice and aligned once. A (byte-level BPE) takes a space and the text, B (sentencepiece) the
text, to which it adds the space itself. Byte offsets where a token of either ends cut the
tokens into groups; tokens have at least one byte, so each group ends with one token of A and
one of B, which are linked. The links of a pair of ids are counted over all documents, a
text's weighted by its copies.

Texts are aligned in blocks of bounded size. A block numbers its distinct pairs, and its texts
keep numbers: only a block's distinct pairs are shuffled to be counted, come back with their
counts as one column each, and meet the block's texts again. Measures are joined to documents
by 128 bits of the text's hash, the documents being the side that adaptive execution can split.

A null text counts as empty. Texts that are empty, or whose tokens of A or B don't spell the
space and the text byte for byte, have no tokens: zeros and no groups. Repeated rows and ids
count each; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docketlake.llm.common import Staging, pick, whole
from docketlake.llm.tokenizer_files import byte_symbols

#: Bytes of text from which a block is full; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of text that are handed to the tokenizers at once, about.
CALL_BYTES = 1 << 20
TEXT = ["k1", "k2"]
TOKENISED = ("block bigint, k1 bigint, k2 bigint, n_a bigint, n_b bigint, n_links bigint, groups_sha256 string, "
             "at array<int>, pairs array<bigint>, weights array<bigint>")
# Fixed: how byte-level vocabularies split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beyond these the two libraries for byte-level vocabularies may know different letters.
LATIN = re.compile("[^\x00-\u024f]")
MEASURES = ("k1 bigint, k2 bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
            "count_sum bigint, groups_sha256 string")


class Aligner:
    """Tokenises texts by both vocabularies and aligns the tokens by their bytes."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        self.a_bytes = _byte_level(a_path)
        self.fast = _ranked(a_path, self.a_bytes)
        self.b_bytes = [_piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        #: An id's text with what follows it, by what: another of its side, the other side, a new group.
        sides = ((self.a_bytes, ",|"), (self.b_bytes, ",;"))
        self.written = [f"{i}{after}" for table, marks in sides for after in marks for i in range(len(table))]

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        for text, ids in zip(texts, self.b.encode(texts, num_threads=1)):
            if self.fast and not LATIN.search(text):
                yield self.fast.encode_ordinary(f" {text}"), ids
            else:
                yield self.a.encode(f" {text}", add_special_tokens=False).ids, ids

    def align(self, text: str, a: list[int], b: list[int]) -> tuple | None:
        """(links as pairs of ids, groups written out), or None where either side spells another text."""
        data = b" " + text.encode("utf-8")
        if (b"".join(map(self.a_bytes.__getitem__, a)) != data
                or b"".join(map(self.b_bytes.__getitem__, b)) != data):
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.zeros(len(data) + 1, bool)
        ends[a_end] = True
        b_last = ends[b_end]
        ends[:] = False
        ends[b_end] = True
        a_last = ends[a_end]
        # Groups alternate: a token stands after all of A and B in earlier groups, B's also after A's of its own.
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        a_upto, b_upto = np.flatnonzero(a_last) + 1, np.append(0, np.flatnonzero(b_last) + 1)
        order = np.empty(len(a) + len(b), np.int64)
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        order[np.arange(len(a)) + b_upto[a_group]] = a + a_last * n_a
        order[np.arange(len(b)) + a_upto[b_group]] = b + 2 * n_a + b_last * n_b
        groups = "".join(map(self.written.__getitem__, order.tolist()))[:-1]
        return a[a_last] * n_b + b[b_last], groups


def _byte_level(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary; of added tokens, their own text."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    byte = {symbol: i for i, symbol in enumerate(byte_symbols())}
    vocabulary = file["model"]["vocab"].items()
    entries = {i: bytes(byte[c] for c in token) for token, i in vocabulary if set(token) <= byte.keys()}
    entries |= {t["id"]: t["content"].encode("utf-8") for t in file["added_tokens"]}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


def _ranked(path: str, entries: list[bytes]):
    """The vocabulary for a quicker library, None if its merges don't rank as its ids do."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split, vocab = file["model"], file["pre_tokenizer"] or {}, file["model"]["vocab"]
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if (file["normalizer"] or model.get("dropout") or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or merged != sorted(set(merged))):
        return None
    special = {t["id"] for t in file["added_tokens"]}
    ranks = {token: i for i, token in enumerate(entries) if i not in special}
    return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _piece(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode("utf-8")


def _block(number: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """The texts of a block, then one row with its distinct pairs and their links."""
    links = [r[-1] for r in rows]
    numbers, pairs = pd.factorize(np.concatenate(links))
    ends = np.cumsum([0, *map(len, links)])
    copies = np.repeat(np.array([r[2] for r in rows], np.float64), np.diff(ends))
    weights = np.bincount(numbers, copies, len(pairs)).astype(np.int64)   # exact below 2**53
    long = pa.int64()
    k1, k2, _, n_a, n_b, digests, _ = zip(*rows)
    schema = pa.schema([("block", long), ("k1", long), ("k2", long), ("n_a", long), ("n_b", long), ("n_links", long),
                        ("groups_sha256", pa.string()), ("at", pa.list_(pa.int32())),
                        ("pairs", pa.list_(long)), ("weights", pa.list_(long))])
    columns = [pa.array([number] * len(rows), long), pa.array(k1, long), pa.array(k2, long), pa.array(n_a, long),
               pa.array(n_b, long), pa.array(map(len, links), long), pa.array(digests, pa.string()),
               pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32())),
               *(pa.nulls(len(rows), pa.list_(long)) for _ in range(2))]
    yield pa.RecordBatch.from_arrays(columns, schema=schema)
    if len(pairs):
        last = [pa.array([number], long), *(pa.nulls(1, t) for t in schema.types[1:8]),
                *(pa.ListArray.from_arrays([0, len(pairs)], pa.array(x, long)) for x in (pairs, weights))]
        yield pa.RecordBatch.from_arrays(last, schema=schema)


def _tokenised(a_path: str, b_path: str):
    """Batches of (k1, k2, text, copies) -> the blocks of :data:`TOKENISED`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        number, rows, held = TaskContext.get().partitionId() << 32, [], 0
        nothing = np.zeros(0, np.int64)
        for some in _calls(batches):
            for (k1, k2, text, copies), (a, b) in zip(some, aligner.tokens([r[2] for r in some])):
                found = aligner.align(text, a, b) if text else None
                if found is None:
                    rows.append((k1, k2, copies, 0, 0, "", nothing))
                else:
                    digest = hashlib.sha256(found[1].encode()).hexdigest()
                    rows.append((k1, k2, copies, len(a), len(b), digest, found[0]))
                held += len(text)
                if held >= BLOCK_BYTES:
                    yield from _block(number, rows)
                    number, rows, held = number + 1, [], 0
        if rows:
            yield from _block(number, rows)

    return run


def _calls(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows in lists of about CALL_BYTES of text."""
    for batch in batches:
        some, held = [], 0
        for row in zip(*(batch[c].to_pylist() for c in ("k1", "k2", "text", "copies"))):
            some.append(row)
            held += len(row[2])
            if held >= CALL_BYTES:
                yield some
                some, held = [], 0
        if some:
            yield some


def _measured(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """A block's texts with the sums over their links of counts and of best pairs."""
    order = np.argsort(pairs["pos"].to_numpy())
    counts, best = pairs["n"].to_numpy()[order], pairs["best"].to_numpy()[order].astype(np.int64)
    at = texts["at"].combine_chunks()
    numbers, ends = at.flatten().to_numpy(), np.cumsum(np.append(0, at.value_lengths().to_numpy()))

    def sums(per_pair: np.ndarray) -> pa.Array:
        running = np.append(0, np.cumsum(per_pair[numbers] if len(numbers) else np.zeros(0, np.int64)))
        return pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64())

    same = {c: texts[c] for c in (*TEXT, "n_a", "n_b", "n_links", "groups_sha256")}
    return pa.table({**same, "n_groups": texts["n_links"], "n_best": sums(best), "count_sum": sums(counts)}).select(
        [c.split()[0] for c in MEASURES.split(", ")])


def _names(text: str) -> list:
    return [F.xxhash64(F.lit(i), F.col(text)).alias(k) for i, k in enumerate(TEXT, 1)]


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row.

    ``n_best`` counts the links whose pair is linked as often as any of its B id, ``count_sum``
    sums over the links how often their pair is linked, both over the whole corpus.
    """
    from sentencepiece import SentencePieceProcessor

    ids_b = SentencePieceProcessor(model_file=b_path).get_piece_size()
    texts = pick(docs, "doc_id", "text").select("doc_id", whole("text").alias("text"))
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies")).select(*_names("text"), "text", "copies")
    with Staging(docs.sparkSession, "alignment") as staging:
        tokenised = staging.save(distinct.mapInArrow(_tokenised(a_path, b_path), TOKENISED))
        seen = (tokenised.where(F.col("pairs").isNotNull())
                .select("block", F.posexplode(F.arrays_zip("pairs", "weights")).alias("pos", "p"))
                .select("block", "pos", F.col("p.pairs").alias("pair"), F.col("p.weights").alias("weight")))
        counts = staging.save(seen.groupBy("pair").agg(F.sum("weight").alias("n"))
                              .withColumn("b", F.col("pair") % ids_b))
        most = counts.groupBy("b").agg(F.max("n").alias("most"))
        judged = counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
        found = seen.join(judged, "pair").select(F.col("block").alias("of_block"), "pos", "n", "best")
        rows = tokenised.where(F.col("k1").isNotNull()).drop("pairs", "weights")
        both = rows.groupBy("block").cogroup(found.groupBy("of_block"))
        measures = staging.keep(both.applyInArrow(_measured, MEASURES))
    return (texts.select("doc_id", *_names("text")).join(measures, TEXT)
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
