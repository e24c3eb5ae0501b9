"""Benchmark decontamination: BM25 over test items, searched with block-max WAND.

The index holds the test items; every passage of every training text is a query. Terms are
pairs of neighbouring words, which common words alone seldom make up. BM25 impacts are divided by the item's score for its own words, so a score is the share of an
item (by weight) that a passage has, and one threshold fits all items. Postings are cut
into blocks with their largest impact. A passage is first bounded by the largest impact of
its terms; only where the bound reaches the threshold do the cursors move, and they skip
blocks that cannot reach it. All items above the threshold are retrieved, not the top k.

Retrieved items are verified on the words themselves: the item is split into question and
answer (after its last question mark, else its last fifth), and both must share most
of their word trigrams with the passage.

Training texts are handled row by row without a shuffle. Items are dealt by a hash of their
id to blocks of about :data:`INDEX_WORDS` words, each block against all texts, so no index
outgrows a task. Counts of terms and the mean length are those of all items, and passages
go by the item's length class (8 to 15 words, 16 to 31, ...), so what is found depends
neither on the blocks nor on how long other items are. Passages of a class are twice as
long as its longest item and overlap by half, so that every run of words as long as an item
lies whole in one; of several passages the best counts, of equal ones the first. Items
with fewer than :data:`FEWEST` words share too few trigrams to be judged by a share: they
are found where all their words stand together in a text, by a look-up of runs of words. Null
and empty texts, items without text and repeated rows are allowed; a repeated row is
searched again and its result repeated, a repeated item is indexed once. Rows without an id
are searched like others, items without one take no part.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docketlake.llm.common import pick, text_udf
from docketlake.llm.licenses import words_of

K1, B = 1.2, 0.75
#: Share of an item's own score from which it is retrieved.
THRESHOLD = 0.5
#: Share of the trigrams of question and of answer that a passage must have.
QUESTION, ANSWER = 0.6, 0.5
#: Words of the shortest item that is searched by its share; shorter ones must occur as a whole.
FEWEST = 8
#: Postings in a block.
BLOCK = 32
#: Words of the items in one index, about.
INDEX_WORDS = 2_000_000

HITS = "array<struct<item_id:bigint,start_word:int,score:double,question:double,answer:double>>"


def _split(words: list[bytes], text: str) -> int:
    """Number of words that belong to the question."""
    mark = text.rfind("?")
    asked = len(words_of(text[: mark + 1])) if mark >= 0 else 0
    return asked if 0 < asked < len(words) else max(1, len(words) - max(3, len(words) // 5))


def terms_of(words: list[bytes]) -> list[bytes]:
    """Pairs of neighbouring words."""
    return [a + b" " + b for a, b in zip(words, words[1:])]


def _trigrams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(3, len(words))
    return set(zip(*(words[i:] for i in range(n)))) if n else set()


@dataclass
class Posting:
    """Items of a term, ascending, their impacts, and per block the last item and the maximum."""

    items: list[int]
    impacts: list[float]
    last: list[int]
    most: list[float]
    bound: float


@dataclass
class LengthClass:
    """Postings of the items of similar length, and the bound of every term, 0 where it has none."""

    longest: int
    postings: dict[int, Posting]
    bounds: np.ndarray


class Index:
    """BM25 index of (item_id, text) pairs; ``frequency``, ``total``, ``mean`` may come from more items."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[bytes, int] | None = None,
                 total: int | None = None, mean: float | None = None):
        kept = sorted({(i, t) for i, t in items if t})
        self.texts = [(i, w, _split(w, t)) for i, t in kept if len(w := words_of(t)) >= FEWEST]
        self.short: dict[int, dict[tuple[bytes, ...], list[int]]] = {}
        for i, t in kept:
            if 0 < len(w := words_of(t)) < FEWEST:
                self.short.setdefault(len(w), {}).setdefault(tuple(w), []).append(i)
        self.ids = [i for i, _, _ in self.texts]
        self.grams = [(_trigrams(w[:q]), _trigrams(w[max(0, q - 2):])) for _, w, q in self.texts]
        n = len(self.texts) if total is None else total
        counts = [self._counts(terms_of(w)) for _, w, _ in self.texts]
        if frequency is None:
            frequency = {}
            for c in counts:
                for w in c:
                    frequency[w] = frequency.get(w, 0) + 1
        if mean is None:
            mean = sum(len(w) for _, w, _ in self.texts) / max(1, len(self.texts))
        by_class: dict[int, dict[bytes, list[tuple[int, float]]]] = {}
        for k, c in enumerate(counts):
            size = len(self.texts[k][1])
            scale = K1 * (1 - B + B * size / mean)
            raw = {w: math.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5)) * f * (K1 + 1) / (f + scale)
                   for w, f in c.items()}
            own = math.fsum(raw.values())
            lists = by_class.setdefault(size.bit_length(), {})
            for w, v in raw.items():
                lists.setdefault(w, []).append((k, v / own))
        terms = sorted({t for lists in by_class.values() for t in lists})
        pairs = [tuple(t.split(b" ")) for t in terms]
        self.words = {w: i for i, w in enumerate(sorted({w for p in pairs for w in p}))}
        self.base = len(self.words) + 1
        keys = np.array([self.words[a] * self.base + self.words[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(-1))
        number = {terms[i]: at for at, i in enumerate(order.tolist())}
        self.classes = [self._class(bits, {number[t]: found for t, found in lists.items()})
                        for bits, lists in sorted(by_class.items())]

    def _class(self, bits: int, lists: dict[int, list[tuple[int, float]]]) -> LengthClass:
        bounds = np.zeros(len(self.keys))                       # the last: unknown terms
        postings = {t: self._posting(found) for t, found in lists.items()}
        for t, p in postings.items():
            bounds[t] = p.bound
        return LengthClass((1 << bits) - 1, postings, bounds)

    @staticmethod
    def _counts(words: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for w in words:
            out[w] = out.get(w, 0) + 1
        return out

    @staticmethod
    def _posting(found: list[tuple[int, float]]) -> Posting:
        items, impacts = [k for k, _ in found], [v for _, v in found]
        cuts = range(0, len(items), BLOCK)
        return Posting(items, impacts, [items[min(c + BLOCK, len(items)) - 1] for c in cuts],
                       [max(impacts[c: c + BLOCK]) for c in cuts], max(impacts))

    def above(self, postings: dict[int, Posting], terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose share reaches ``threshold`` for these terms, by block-max WAND.

        Bounds are sums in another order than scores, so they may fall short by a rounding error.
        """
        lists = [postings[t] for t in terms]
        end, enough = len(self.texts), threshold - 1e-9
        cursors = [[p.items[0], 0, p] for p in lists]
        out: list[tuple[int, float]] = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[2].bound
                if bound >= enough:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # What the blocks that hold the pivot item allow, and where the first of them ends.
            allowed, until = 0.0, end
            for c in cursors[: pivot + 1]:
                b = bisect.bisect_left(c[2].last, item)
                if b < len(c[2].last):
                    allowed += c[2].most[b]
                    until = min(until, c[2].last[b] + 1)
            if allowed < enough:
                if pivot + 1 < len(cursors):
                    until = min(until, cursors[pivot + 1][0])
                target = max(until, item + 1)
            elif cursors[0][0] == item:
                score = math.fsum(c[2].impacts[c[1]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    out.append((item, score))
                target = item + 1
            else:
                target = item
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    c[1] = bisect.bisect_left(c[2].items, target, c[1])
                    c[0] = c[2].items[c[1]] if c[1] < len(c[2].items) else end
            cursors = [c for c in cursors if c[0] < end]
        return out

    def _terms(self, words: list[bytes]) -> np.ndarray:
        """Number of the term that starts at each word but the last; the last number: unknown."""
        unknown = len(self.keys) - 1
        get, none = self.words.get, self.base - 1
        numbers = np.fromiter((get(w, none) for w in words), np.int64, len(words))
        out = np.full(len(words) - 1, unknown, np.int64)
        both = np.flatnonzero((numbers[:-1] != none) & (numbers[1:] != none))
        keys = numbers[both] * self.base + numbers[both + 1]
        place = np.searchsorted(self.keys[:-1], keys)
        out[both] = np.where(self.keys[place] == keys, place, unknown)
        return out

    def search(self, text: str, threshold: float = THRESHOLD) -> list[dict]:
        """Verified items of one text, each with its best passage."""
        words = words_of(text)
        found = self._whole(words)
        if len(words) >= FEWEST and self.classes:
            terms = self._terms(words)
            for c in self.classes:
                found += self._shares(c, words, terms, threshold)
        return sorted(found, key=lambda h: (h["item_id"], h["start_word"], h["score"]))

    def _whole(self, words: list[bytes]) -> list[dict]:
        """Short items that occur word by word, each with its first place."""
        best: dict[int, dict] = {}
        for n, items in self.short.items():
            for at, run in enumerate(zip(*(words[i:] for i in range(n)))):
                for i in items.get(run, ()):
                    best.setdefault(i, {"item_id": i, "start_word": at, "score": 1.0, "question": 1.0, "answer": 1.0})
        return list(best.values())

    def _shares(self, c: LengthClass, words: list[bytes], terms: np.ndarray, threshold: float) -> list[dict]:
        """Verified items of a length class, each with its best passage."""
        step = c.longest
        sums = np.concatenate([[0.0], np.cumsum(c.bounds[terms])])
        starts = np.arange(0, max(1, len(terms) - step), step)
        ends = np.minimum(starts + 2 * step, len(terms))
        best: dict[int, dict] = {}
        for at in np.flatnonzero(sums[ends] - sums[starts] >= threshold - 1e-9).tolist():
            s, e = int(starts[at]), int(ends[at])
            known = {t for t in terms[s:e].tolist() if t in c.postings}
            if c.bounds[list(known)].sum() < threshold - 1e-9:
                continue
            grams = None
            for k, score in self.above(c.postings, known, threshold):
                if grams is None:
                    grams = _trigrams(words[s: e + 1])
                asked, answered = (len(g & grams) / max(1, len(g)) for g in self.grams[k])
                if asked >= QUESTION and answered >= ANSWER and score > best.get(k, {"score": 0.0})["score"]:
                    best[k] = {"item_id": self.ids[k], "start_word": s, "score": min(1.0, score),
                               "question": asked, "answer": answered}
        return [best[k] for k in sorted(best)]


def _hits(text: str | Column, items: list[tuple[int, str]], frequency: dict[bytes, int], total: int,
          mean: float, threshold: float) -> Column:
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start_word", pa.int32()), ("score", pa.float64()),
                               ("question", pa.float64()), ("answer", pa.float64())]))

    def make():
        index = Index(items, frequency, total, mean)
        return lambda texts: pa.array([index.search(t, threshold) for t in texts], kind)

    return text_udf(make, HITS)(text)


def _terms_and_size(text: str) -> dict:
    words = words_of(text)
    terms = sorted({w.decode("utf-8") for w in terms_of(words)}) if len(words) >= FEWEST else []
    return {"terms": terms, "size": len(words)}


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 index_words: int = INDEX_WORDS) -> DataFrame:
    """(doc_id, item_id, start_word, score, question, answer): verified items per text.

    ``index_words`` is about how many words one index holds; the driver holds those of one
    block at a time and each block reads the texts once.
    """
    texts = pick(docs, "doc_id", "text").where(F.col("text").isNotNull())
    items = (pick(benchmark, "item_id", "text").toDF("_id", "_item")
             .where(F.col("_id").isNotNull() & F.col("_item").isNotNull()).distinct())
    kind = pa.struct([("terms", pa.list_(pa.string())), ("size", pa.int64())])
    parts = text_udf(lambda: lambda ts: pa.array([_terms_and_size(t) for t in ts], kind),
                     "struct<terms:array<string>,size:bigint>")
    terms = items.select("_id", parts("_item").alias("p")).select("_id", "p.*")
    long = F.col("size") >= FEWEST
    found = terms.agg(F.sum("size").alias("words"), F.count(F.when(long, 1)).alias("n"),
                      F.sum(F.when(long, F.col("size"))).alias("long")).first()
    counts = terms.select(F.explode("terms").alias("_term")).groupBy("_term").agg(F.count("*").alias("n"))
    blocks = max(1, math.ceil((found["words"] or 0) / index_words))
    mean = (found["long"] or 0) / max(1, found["n"])
    block_of = F.pmod(F.xxhash64("_id"), F.lit(blocks))
    out = None
    for block in range(blocks):
        mine = terms.where(block_of == block).select(F.explode("terms").alias("_term")).distinct()
        frequency = {r["_term"].encode("utf-8"): r["n"] for r in counts.join(mine, "_term", "left_semi").collect()}
        rows = [(r["_id"], r["_item"]) for r in items.where(block_of == block).collect()]
        hits = _hits("text", rows, frequency, found["n"], mean, threshold)
        one = texts.select("doc_id", F.explode(hits).alias("_hit"))
        out = one if out is None else out.unionByName(one)
    return out.select("doc_id", "_hit.*")
