"""Quality classifier: naive Bayes log-count ratios feeding a linear support vector machine.

A text becomes the set of its hashed n-grams (presence, not counts): lower-cased words, one to
three neighbouring word shapes, whether a word follows itself, and how varied the words are. Each n-gram is scaled by the log ratio of its
smoothed counts in the two classes; on the scaled vectors, of unit length, a linear model
with squared hinge loss is fitted by dual coordinate descent. A logistic curve, fitted on
rows kept apart from the coordinate descent, turns its margin into a score.

The classifier is fitted on a bounded sample, :data:`FIT_ROWS` labelled rows chosen by a
hash of their id, so the sample is the same wherever and however often it is drawn. Scoring
covers every whole text, row by row, without a shuffle. Null and empty texts are scored like
any other (no n-grams: the intercept alone). A row without a label, or with an unknown one,
is not learnt from; where one class is absent, every score is the share of class 1, or 1
where there is no label at all.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docketlake.llm.common import pick, text_udf

#: Labelled rows that the classifier is fitted on, at most.
FIT_ROWS = 12_000
#: Hashed n-grams.
DIMENSIONS = 1 << 18
#: Passes of the coordinate descent over the rows, at most.
PASSES = 20
REMEMBERED = 200_000

_SHAPE = ((re.compile(r"[^\W\d_]+"), lambda m: "Ww" if m[0][:1].isupper() and m[0][1:].islower() else
           "W" if m[0].isupper() else "w" if m[0].islower() else "x"), (re.compile(r"\d+"), lambda m: "0"))


def shape_of(word: str) -> str:
    """Letters by their case, digit runs as 0, punctuation as it is."""
    for pattern, put in _SHAPE:
        word = pattern.sub(put, word)
    return word[:12]


def ngrams(dimensions: int = DIMENSIONS) -> Callable[[str], np.ndarray]:
    """``text -> sorted distinct n-gram numbers``."""
    known: dict[str, tuple[int, int]] = {}
    mask = np.uint64(dimensions - 1)

    def look_up(word: str) -> tuple[int, int]:
        found = known.get(word)
        if found is None:
            plain = word.lower().strip(".,;:!?\"'()")
            found = (zlib.crc32(plain.encode("utf-8", "replace")),
                     zlib.crc32(shape_of(word).encode("utf-8", "replace"), 7))
            if len(known) >= REMEMBERED:
                known.clear()
            if len(word) <= 40:
                known[word] = found
        return found

    def numbers(text: str) -> np.ndarray:
        pairs = list(map(look_up, text.split()))
        if not pairs:
            return np.empty(0, np.int32)
        words, shapes = np.array(pairs, np.uint64).T
        grams = [words, shapes * np.uint64(0x9E3779B1)]
        for n, factor in ((2, 0x85EBCA77C2B2AE63), (3, 0xC2B2AE3D27D4EB4F)):
            if len(shapes) >= n:
                gram = shapes[: len(shapes) - n + 1].copy()
                for i in range(1, n):
                    gram = gram * np.uint64(1000003) + shapes[i: len(shapes) - n + 1 + i]
                grams.append(gram * np.uint64(factor))
        # How varied the words are, in eighths, and whether a word follows itself.
        variety = len(np.unique(words)) * 8 // len(words)
        again = bool(len(words) > 1 and (words[1:] == words[:-1]).any())
        grams.append(np.array([0xA000 + variety, 0xB000 + again], np.uint64) * np.uint64(0x27D4EB2F165667C5))
        mixed = np.concatenate(grams)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique((mixed >> np.uint64(32)) & mask).astype(np.int32)

    return numbers


@dataclass
class QualityModel:
    """Weight of each n-gram before its row is scaled to unit length, and the logistic curve."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, grams: np.ndarray) -> float:
        if not len(grams):
            return self.bias
        r = self.ratios[grams]
        norm = float(np.sqrt(r @ r)) or 1.0
        return float(r @ self.weights[grams]) / norm + self.bias

    def score(self, grams: np.ndarray) -> float:
        z = self.slope * self.margin(grams) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, dimensions: int) -> np.ndarray:
    counts = [np.ones(dimensions), np.ones(dimensions)]
    for grams, y in zip(rows, labels):
        counts[int(y)][grams] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray,
                            cost: np.ndarray, dimensions: int, passes: int = PASSES,
                            tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model with squared hinge loss (``cost`` per row)."""
    w, bias = np.zeros(dimensions), 0.0
    alpha, half = np.zeros(len(rows)), 1 / (2 * cost)
    diagonal = np.array([v @ v for v in values]) + 1 + half
    order = np.random.default_rng(0)
    for _ in range(passes):
        worst = 0.0
        for i in order.permutation(len(rows)):
            grams, x, y = rows[i], values[i], signs[i]
            gradient = y * (w[grams] @ x + bias) - 1 + half[i] * alpha[i]
            if alpha[i] == 0 and gradient >= 0:
                continue
            worst = max(worst, abs(gradient))
            new = max(alpha[i] - gradient / diagonal[i], 0.0)
            step = (new - alpha[i]) * y
            w[grams] += step * x
            bias += step
            alpha[i] = new
        if worst < tolerance:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with targets drawn in from 0 and 1."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -30, 30)))
        gradient = x @ (p - target) + 1e-3 * theta
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta = theta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, dimensions: int = DIMENSIONS) -> QualityModel:
    """Fit on n-gram numbers and 0/1 labels; every fifth row goes to the logistic curve only."""
    labels = np.asarray(labels, np.int64)
    zero = np.zeros(dimensions, np.float32)
    share = float(labels.mean()) if len(labels) else 1.0
    if len(set(labels.tolist())) < 2:
        return QualityModel(zero, zero, 0.0, 0.0, 40.0 if share > 0.5 else -40.0)
    apart = np.arange(len(rows)) % 5 == 4
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart = np.zeros(len(rows), bool)
    used = np.flatnonzero(~apart)
    ratios = log_count_ratios([rows[i] for i in used], labels[used], dimensions)
    values = []
    for i in used:
        r = ratios[rows[i]]
        values.append(r / (np.sqrt(r @ r) or 1.0))
    y = labels[used]
    cost = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, bias = dual_coordinate_descent([rows[i] for i in used], values, 2.0 * y - 1, cost, dimensions)
    model = QualityModel(w.astype(np.float32), ratios.astype(np.float32), bias, 1.0, 0.0)
    kept = np.flatnonzero(apart) if apart.any() else used
    margins = np.array([model.margin(rows[i]) for i in kept])
    model.slope, model.offset = logistic_curve(margins, labels[kept])
    return model


def held_out(doc_id: str | Column) -> Column:
    """The fifth of the rows whose labels are never learnt from."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS,
                label: str = "quality") -> QualityModel:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out fifth.

    Only the chosen ids (bounded by ``fit_rows``) are broadcast, and only n-gram numbers of
    those rows reach the driver.
    """
    chosen = (
        pick(labels, "doc_id", label).toDF("_id", "_label")
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id").agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    )

    def make():
        numbers = ngrams()
        return lambda texts: pa.array([numbers(t) for t in texts], pa.list_(pa.int32()))

    rows = (
        pick(docs, "doc_id", "text").toDF("_id", "_text").join(F.broadcast(chosen), "_id")
        .groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
        .select("_id", "_label", text_udf(make, "array<int>")("_text").alias("_grams"))
        .toArrow()
    )
    rows = rows.sort_by("_id").combine_chunks()
    grams = rows["_grams"].combine_chunks()
    ends, flat = grams.offsets.to_numpy(), grams.values.to_numpy(zero_copy_only=False)
    return fit([flat[a:b] for a, b in zip(ends, ends[1:])], rows["_label"].to_numpy())


def quality_score(text: str | Column, model: QualityModel) -> Column:
    """Score of each whole text, 0 to 1; higher means that class 1 is likelier."""
    def make():
        numbers = ngrams()
        return lambda texts: pa.array([model.score(numbers(t)) for t in texts], pa.float64())

    return text_udf(make, "double")(text)
