"""Substring dedup: content-defined chunks by a gear hash, deduplicated by digest.

A gear hash rolls over the bytes of a text; a chunk ends where its top bits are zero. The
hash sees the last 32 bytes only, so after an insertion the cuts fall where they fell
before, and equal passages have equal chunks wherever they stand. A digest that occurs at
two places is repeated; its first place (smallest id, then position) stays. Neighbouring
repeated chunks of a text form a span. It is extended to both sides as far as the text equals
that around the first place, in whole characters, and spans of at least :data:`LEAST` bytes
are then reported. So short common lines are left alone, and a passage is found to its ends
where it holds at least one whole chunk; the README gives the share that holds none.

Chunks are cut row by row. Only distinct digests of each task are shuffled to find the
repeated ones; the chunks are joined to those, and to first places, in joins that adaptive
execution can split. So the places of a passage that a third of all texts share are spread
over many tasks. To extend, the bytes around each distinct place are cut from the texts once and
joined to the spans; spans that use all of them are tried again with more. Rows that repeat
both id and text are one place; around ids with several texts nothing is extended. Null and
empty texts have no chunks. Rows without an id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from docketlake.llm.common import Staging, per_key, pick
from docketlake.llm.shingles import mix

#: A cut needs this many zero bits: chunks have 2**BITS + SMALLEST bytes on average.
BITS = 5
SMALLEST, LARGEST = 16, 512
#: Bytes of the shortest span that is reported.
LEAST = 100
#: Bytes on either side that spans are first extended by, and the factor for those that need more.
AROUND, MORE = 192, 16
#: Distinct digests that a task holds before it passes them on.
HELD = 400_000


def cutter():
    """``bytes -> ends of its chunks``."""
    gear = np.random.default_rng(7).integers(0, 2**32, 256, np.uint32)
    top = np.uint32(32 - BITS)

    def cuts(data: bytes) -> list[int]:
        n = len(data)
        # h[i] = sum of gear[byte i-j] << j over the last 32 bytes, by doubling.
        h = gear[np.frombuffer(data, np.uint8)]
        for step in (1, 2, 4, 8, 16):
            shifted = h[:-step] << np.uint32(step)
            h[step:] += shifted
        out, last = [], 0
        for end in (np.flatnonzero((h >> top) == 0) + 1).tolist():
            if end - last >= SMALLEST:
                while end - last > LARGEST:
                    last += LARGEST
                    out.append(last)
                out.append(end)
                last = end
        while n - last > LARGEST:
            last += LARGEST
            out.append(last)
        if last < n:
            out.append(n)
        return out

    return cuts


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per batch: digest, id, start, end of every chunk."""
    cuts, digest = cutter(), xxhash.xxh3_64_intdigest
    for batch in batches:
        digests, rows, starts, ends = [], [], [], []
        for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
            data = text.encode("utf-8")
            found = cuts(data)
            begun = [0, *found[:-1]]
            digests += [digest(data[s:e]) for s, e in zip(begun, found)]
            rows.append(np.full(len(found), i, np.int64))
            starts += begun
            ends += found
        if digests:
            yield (np.array(digests, np.uint64).view(np.int64), np.concatenate(rows),
                   np.array(starts, np.int64), np.array(ends, np.int64))


def _digest_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct digests of a portion of a task's chunks; ``low`` and ``high`` differ if places do."""
    held: list[tuple[np.ndarray, ...]] = []

    def summed() -> pa.RecordBatch:
        digests, ids, starts, _ = (np.concatenate(x) for x in zip(*held))
        place = (mix(ids.view(np.uint64)) + starts.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        order = np.lexsort((place, digests))
        digests, place = digests[order], place[order]
        first = np.flatnonzero(np.concatenate([[True], digests[1:] != digests[:-1]]))
        last = np.append(first[1:], len(digests)) - 1
        return pa.RecordBatch.from_pydict({
            "digest": digests[first], "low": place[first], "high": place[last]})

    size = 0
    for part in _chunk_batches(batches):
        held.append(part)
        size += len(part[0])
        if size >= HELD:
            yield summed()
            held, size = [], 0
    if held:
        yield summed()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for digests, ids, starts, ends in _chunk_batches(batches):
        yield pa.RecordBatch.from_pydict({
            "digest": digests, "id": ids, "at": (starts << 20 | (ends - starts))})


def _same(own: bytes, other: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(own), len(other))
    if own[:n] == other[:n]:
        return n
    return int(np.argmax(np.frombuffer(own, np.uint8, n) != np.frombuffer(other, np.uint8, n)))


def _extension(own: tuple[bytes, bytes], first: tuple[bytes, bytes], inside: tuple[int, int], width: int,
               room: int | None) -> tuple[int, int, bool]:
    """Bytes to add on the left and on the right, and whether more than ``width`` may be the same.

    ``room`` bounds the sum, so that a span doesn't grow into its first place in the same text.
    Where a character isn't the same as a whole, ``inside`` of its bytes are taken off again.
    """
    left, right = _same(own[0][::-1], first[0][::-1]), _same(own[1], first[1])
    if room is not None:
        left = min(left, room)
        right = min(right, room - left)
    if (left == width or right == width) and (room is None or left + right < room):
        return left, right, True
    while left and own[0][-left] & 0xC0 == 0x80:
        left -= 1
    while 0 < right < len(own[1]) and own[1][right] & 0xC0 == 0x80:
        right -= 1
    return left or -inside[0], right or -inside[1], False


def _inside(data: bytes, start: int, end: int) -> tuple[int, int]:
    """Bytes from ``start`` to the next character, and from the last character to ``end``."""
    after, before = start, end
    while after < len(data) and data[after] & 0xC0 == 0x80:
        after += 1
    while before < len(data) and data[before] & 0xC0 == 0x80:
        before -= 1
    return after - start, end - before


def _around(width: int):
    """Bytes before and after each of a text's places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, starts, ends, befores, afters, insides = [], [], [], [], [], []
            for i, text, places in zip(*(batch[c].to_pylist() for c in ("id", "text", "places"))):
                data = text.encode("utf-8")
                for p in places:
                    ids.append(i)
                    starts.append(p["start"])
                    ends.append(p["end"])
                    befores.append(data[max(0, p["start"] - width): p["start"]])
                    afters.append(data[p["end"]: p["end"] + width])
                    insides.append(_inside(data, p["start"], p["end"]))
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64()),
                "before": pa.array(befores, pa.binary()), "after": pa.array(afters, pa.binary()),
                "in_start": pa.array([x for x, _ in insides], pa.int64()), "in_end": pa.array([x for _, x in insides], pa.int64())})

    return run


def _extend(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.drop_columns(["before", "after", "in_start", "in_end", "first_before", "first_after"])
            found = []
            for r in batch.to_pylist():
                room = (max(0, r["start"] - r["first_end"]) if r["id"] == r["first_id"] else None)
                # A side inside the run needs no bytes.
                for side, column in (("to_left", "before"), ("to_right", "after")):
                    if not r[side]:
                        r[column], r["in_start" if side == "to_left" else "in_end"] = b"", 0
                found.append(_extension((r["before"], r["after"]), (r["first_before"], r["first_after"]),
                                        (r["in_start"], r["in_end"]), width, room))
            left, right, more = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.array(more, pa.bool_())],
                names=[*rows.schema.names, "left", "right", "more"])

    return run


def _extended(pieces: DataFrame, texts: DataFrame, staging: Staging) -> DataFrame:
    """``pieces`` with the bytes that they share with their first place on the left and the right."""
    done, width = None, AROUND
    first = ("first_id", "first_start", "first_end")
    while True:
        places = pieces.select("id", "start", "end").unionByName(
            pieces.select(*(F.col(c).alias(c.removeprefix("first_")) for c in first))).distinct()
        wanted = staging.save(places.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("places")))
        cut = (texts.join(wanted, "id")
               .mapInArrow(_around(width), "id bigint, start bigint, end bigint, before binary, after binary, "
                                           "in_start bigint, in_end bigint"))
        one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.lit(b"")).alias(c)
        near = staging.save(cut.groupBy("id", "start", "end").agg(
            one("before"), one("after"), F.max("in_start").alias("in_start"), F.max("in_end").alias("in_end")))
        theirs = near.select(*(F.col(c.removeprefix("first_")).alias(c) for c in (*first, "first_before", "first_after")))
        columns = pieces.columns
        both = (pieces.join(near, ["id", "start", "end"]).join(theirs, list(first))
                .select(*columns, "before", "after", "in_start", "in_end", "first_before", "first_after"))
        schema = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
        out = staging.save(both.mapInArrow(_extend(width), f"{schema}, left bigint, right bigint, more boolean"))
        now = out.where(~F.col("more")).drop("more")
        done = now if done is None else done.unionByName(now)
        pieces = out.where("more").select(*columns)
        if not pieces.head(1):
            return done
        width *= MORE


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, start_byte, end_byte, first_doc_id, first_start_byte) of repeated passages.

    One row per span that another place has first; offsets count UTF-8 bytes. The first
    place named is that of the span's first byte. Spans of a text don't overlap.
    """
    spark = docs.sparkSession
    texts = (pick(docs, "doc_id", "text").toDF("id", "text")
             .where(F.col("id").isNotNull() & (F.octet_length("text") > 0)))
    with Staging(spark, "chunks") as staging:
        repeated = (per_key(texts.mapInArrow(_digest_counts, "digest bigint, low bigint, high bigint"), "digest",
                            F.min("low").alias("low"), F.max("high").alias("high"))
                    .where("low != high").select("digest"))
        found = staging.save(texts.mapInArrow(_chunks, "digest bigint, id bigint, at bigint")
                             .join(repeated, "digest", "left_semi"))
        first = per_key(found, "digest", F.min(F.struct("id", "at")).alias("first"))
        later = (found.join(first, "digest")
                 .where((F.col("id") != F.col("first.id")) | (F.col("at") != F.col("first.at")))
                 .select("id", F.shiftright("at", 20).alias("start"),
                         (F.shiftright("at", 20) + F.col("at").bitwiseAND((1 << 20) - 1)).alias("end"),
                         F.col("first.id").alias("first_id"), F.shiftright("first.at", 20).alias("first_start"))
                 .distinct())
        in_text = Window.partitionBy("id").orderBy("start", "end")
        apart = F.col("first_start") - F.col("start")
        new = F.coalesce(F.lag("end").over(in_text) != F.col("start"), F.lit(True))
        # A run may have its chunks from several first places: a piece has one, at one distance.
        turn = new | (F.lag("first_id").over(in_text) != F.col("first_id")) | (F.lag(apart).over(in_text) != apart)
        runs = (later.withColumns({"new": new.cast("int"), "turn": turn.cast("int")})
                .withColumns({"run": F.sum("new").over(in_text), "piece": F.sum("turn").over(in_text)}))
        pieces = (runs.groupBy("id", "run", "piece")
                  .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first_id").alias("first_id"),
                       F.min("first_start").alias("first_start"))
                  .withColumn("first_end", F.col("first_start") + F.col("end") - F.col("start")))
        # At either end a run grows by its last piece, and by the one before where that is short.
        of_run = Window.partitionBy("id", "run")
        edge = lambda to, gap: ((F.col("piece") == to("piece").over(of_run)) |
                                   ((F.abs(F.col("piece") - to("piece").over(of_run)) == 1) & (gap < AROUND)))
        pieces = staging.save(
            pieces.withColumns({"to_left": edge(F.min, F.col("start") - F.min("start").over(of_run)),
                                "to_right": edge(F.max, F.max("end").over(of_run) - F.col("end"))})
            .where("to_left or to_right"))
        start, end = F.col("start") - F.col("left"), F.col("end") + F.col("right")
        spans = (_extended(pieces, texts, staging).groupBy("id", "run")
                 .agg(F.min(start).alias("start_byte"), F.max(end).alias("end_byte"),
                      F.min_by(F.struct("first_id", (F.col("first_start") - F.col("left")).alias("first_start")),
                               F.struct(start, F.col("start"))).alias("f"))
                 .where(F.col("end_byte") - F.col("start_byte") >= least))
        # Neighbouring spans may have grown into each other.
        ahead = Window.partitionBy("id").orderBy("start_byte", "end_byte")
        over = F.max("end_byte").over(ahead.rowsBetween(Window.unboundedPreceding, -1)) > F.col("start_byte")
        joined = (spans.withColumn("new", F.coalesce((~over).cast("int"), F.lit(1)))
                  .withColumn("span", F.sum("new").over(ahead)).groupBy("id", "span")
                  .agg(F.min("start_byte").alias("start_byte"), F.max("end_byte").alias("end_byte"),
                       F.min_by("f", "start_byte").alias("f")))
        return staging.keep(
            joined.select(F.col("id").alias("doc_id"), "start_byte", "end_byte",
                          F.col("f.first_id").alias("first_doc_id"), F.col("f.first_start").alias("first_start_byte")))


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the spans cut from ``text``; texts without spans stay as they are."""
    cuts = spans.groupBy(F.col("doc_id").alias("_cut_id")).agg(
        F.sort_array(F.collect_set(F.struct("start_byte", "end_byte"))).alias("_cuts"))
    joined = docs.join(cuts, docs["doc_id"] == cuts["_cut_id"], "left")
    return joined.withColumn("text", _cut("text", "_cuts")).select(*docs.columns)


def _cut(text: str, cuts: str) -> Column:
    """The pieces of the text between the cuts, as bytes; a cut inside a character is widened."""
    def run(batches):
        for texts, found in batches:
            yield pa.array([_cut_one(t, c) for t, c in zip(texts.to_pylist(), found.to_pylist())], pa.string())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")(text, cuts)


def _cut_one(text: str | None, cuts: list[dict] | None) -> str | None:
    if text is None or not cuts:
        return text
    data, out, at = text.encode("utf-8"), [], 0
    for c in cuts:
        out.append(data[at: c["start_byte"]])
        at = c["end_byte"]
    return b"".join([*out, data[at:]]).decode("utf-8", "ignore")
