"""Document fingerprints by I-Match, over columns only.

Terms are hashed into :data:`SLOTS` slots. A first pass counts in how many documents each
slot occurs; the lexicon is the slots whose document frequency lies in a band, that is,
whose inverse document frequency does. A document's fingerprint hashes, for many random
subsets of the lexicon, its sorted distinct terms in that subset. The subsets come at five
densities, each a quarter of the one before, so that short and long documents both have
subsets in which a few of their terms fall. The likeness of two fingerprints is the share
of equal hashes among the subsets in which either has terms.

The lexicon is bounded whatever the corpus: slots with a frequency of at least ``LEAST`` of
all documents number at most (distinct terms per document) / LEAST, and as a bit map it has
SLOTS bits, 128 KB. Hash collisions add at most (terms per document) / SLOTS to a slot's
share, far less than LEAST.

Equal texts have equal fingerprints. Null texts count as empty; a text without terms in
the lexicon has the empty fingerprint, like only to other empty ones (likeness 1). In a
corpus of fewer than 1 / LEAST documents every term is frequent enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docketlake.llm.common import pick, whole

SLOTS = 1 << 20
#: Band of the document frequency, as shares of all documents.
LEAST, MOST = 0.002, 0.2
#: Subsets at each density, and densities (1/4, 1/16, ... of the lexicon).
LANES, LEVELS = 8, 5
#: Rows that are put in order together, about, and most ranges that the ids are cut into.
#: Beyond that many, ranges hold more rows, which are sorted on disk.
ROWS_TOGETHER, MOST_RANGES = 10_000, 4096


def term_hashes(text: str | Column) -> Column:
    """Distinct hashes of a text's terms: lower-cased runs of letters and digits."""
    terms = F.split(F.lower(whole(text)), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(terms, lambda t: t != ""), lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> Column:
    """The lexicon as a constant array of 64-bit words, SLOTS bits altogether."""
    slots = F.array_distinct(F.transform(term_hashes("text"), lambda h: _slot(h)))
    total = docs.count()
    words = (
        docs.select(F.explode(slots).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
        .where((F.col("n") >= least * total) & (F.col("n") <= max(1, most * total)))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits"))
    )
    bits = [0] * (SLOTS >> 6)
    for row in words.collect():      # at most SLOTS / 64 rows
        bits[row["word"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")


def _slot(h: Column) -> Column:
    return h.bitwiseAND(SLOTS - 1).cast("int")


def subset_hashes(text: str | Column, bits: Column) -> Column:
    """Hashes of a text's terms in every subset; null where it has none there."""
    inside = F.filter(term_hashes(text), lambda h: _bit(bits, _slot(h)) == 1)
    pool = F.sort_array(inside)
    levels = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)),
                         lambda level: F.filter(pool, lambda h: _low_zero(h, level)))
    return F.flatten(F.transform(levels, lambda terms: F.transform(
        F.sequence(F.lit(0), F.lit(LANES - 1)), lambda lane: _hash_of(F.filter(
            terms, lambda h: F.xxhash64(h, lane).bitwiseAND(3) == 0)))))


def _bit(bits: Column, slot: Column) -> Column:
    return F.call_function("bit_get", F.get(bits, F.shiftright(slot, 6)), slot.bitwiseAND(63))


def _low_zero(h: Column, level: Column) -> Column:
    """Whether the bits 24.. of a hash leave it in the pool of a density."""
    mask = F.get(F.array(*(F.lit((4 ** i - 1) << 24).cast("bigint") for i in range(LEVELS))), level)
    return h.bitwiseAND(mask) == 0


def _hash_of(terms: Column) -> Column:
    return F.when(F.size(terms) > 0, F.xxhash64(terms))


def fingerprint(hashes: Column) -> Column:
    """Text form: 8 hexadecimal digits per subset, a dash where it has no terms."""
    short = lambda h: F.lower(F.lpad(F.hex(h.bitwiseAND(0xFFFFFFFF)), 8, "0"))
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(short(h), F.lit("-"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets in which either has terms; 1 if neither has any."""
    either = F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda p: p["x"].isNotNull() | p["y"].isNotNull())
    same = F.size(F.filter(either, lambda p: p["x"] == p["y"]))
    return F.when(F.size(either) == 0, 1.0).otherwise(same / F.size(either))


def _bounds(docs: DataFrame, together: int) -> list[int]:
    """Ids that cut the table into ranges of about ``together`` rows, the largest id last."""
    n, low, high = docs.agg(F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    if not n:
        return []
    parts = min(MOST_RANGES, max(1, -(-n // together)))
    shares = [i / parts for i in range(1, parts)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else []
    return sorted({*cuts, high})


def with_next(docs: DataFrame, together: int = ROWS_TOGETHER) -> tuple[DataFrame, Window]:
    """Rows with ``next_text``, the text of the next row by descending id (after the last, the first).

    Rows are dealt out by ranges of ids. The largest of each range is dealt to the range
    above it too (``ghost``), where it comes last and is the next of that range's last row.
    """
    bounds = _bounds(docs, together)
    if not bounds:
        bounds = [0]
    array = F.array(*(F.lit(b).cast("bigint") for b in bounds))
    n = len(bounds)
    at = F.coalesce(F.size(F.filter(array, lambda b: b < F.col("doc_id"))), F.lit(0))
    above = F.when(F.col("doc_id") == array[at], F.when(at < n - 1, at + 1).otherwise(F.lit(0)))
    dealt = docs.select("doc_id", "text", F.explode(F.array(
        F.struct(at.alias("part"), F.lit(False).alias("ghost")),
        F.struct(above.alias("part"), F.lit(True).alias("ghost")))).alias("_p")).where("_p.part IS NOT NULL").select(
        "doc_id", "text", "_p.*")
    order = Window.partitionBy("part").orderBy(F.col("ghost"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return dealt.withColumn("next_text", F.lead("text").over(order)), order


def fingerprints(docs: DataFrame, together: int = ROWS_TOGETHER) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last third replaced by the start of the next document, by
    descending id. Rows without an id come after all others.
    """
    docs = pick(docs, "doc_id", "text").select("doc_id", whole("text").alias("text"))
    bits = lexicon(docs)
    rows, order = with_next(docs, together)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))
    made = rows.select("doc_id", "part", "ghost", "text", n.cast("bigint").alias("n_chars"), edited.alias("edited"))
    hashed = made.select(
        "doc_id", "part", "ghost", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        subset_hashes("text", bits).alias("own"), subset_hashes("edited", bits).alias("other"))
    nearby = hashed.withColumn("following", F.lead("own").over(order)).where(~F.col("ghost"))
    return nearby.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.coalesce("following", "own")).alias("near_next"))
