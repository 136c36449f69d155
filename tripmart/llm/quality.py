"""Quality classifier by positive-unlabelled learning.

Only texts marked good are trusted; the rest of the training data is web text without labels, a mixture
of good and bad. With the share of good text in it (the class prior), the risk of a classifier can be
written without any negative example, and it is kept from going below zero, where it would overfit:

    prior * loss(good, +1) + max(0, loss(web, -1) - prior * loss(good, -1))

The prior is estimated from the same two samples. A first classifier is trained on one half of them with a prior of one
half and scores the other half. Above any threshold the web has at least ``prior`` times the share of good text there,
so the smallest ratio of the two shares, with allowance for chance, is the estimate (``class_prior``).

The score is a logistic function of measures of form (``MEASURES``), their squares and products. They are
taken over whole texts; language, source and ids are no inputs. The parameters are fitted on the driver
from at most ``SAMPLE`` trusted and ``SAMPLE`` web texts, chosen by hash, which bounds the work at any size.

NULL texts count as empty; an empty text has a score like any other. Ids that are NULL are never held out
and never have a label. Of several labels of one id the lowest counts. Without trusted texts nothing can be
learned, and every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.words import buffers, chunks, spans, word_hashes

SAMPLE = 8_000
THRESHOLD = 0.7
ROUNDS = 600

MEASURES = (
    "log words", "log bytes per word", "upper-case share", "digit share", "symbol share", "sentence mark share",
    "line break share", "share of words with symbols", "share of words in upper case", "share of repeated neighbours",
    "share of distinct words", "share of words that end a clause", "longest word", "share of one-symbol words",
)

_KIND = np.zeros((5, 256), bool)
_KIND[0, 65:91] = True  # upper case
_KIND[1, 48:58] = True  # digits
_KIND[2, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:?'\"()-"]] = True  # symbols
_KIND[3, list(b".,;:?")] = True  # marks of clauses
_KIND[4, [10]] = True


def measures(texts: pa.Array) -> np.ndarray:
    """A row of ``MEASURES`` for each text."""
    data, offsets = buffers(texts)
    begins, ends, first = spans(data, offsets)
    n = len(texts)
    words = np.maximum(np.diff(first), 1)
    size = np.maximum(np.diff(offsets), 1)

    def counted(flags: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
        np.cumsum(flags, out=total[1:])
        return total[ends] - total[begins]

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return counted(flags, bounds[:-1], bounds[1:])

    def per_word(flags: np.ndarray) -> np.ndarray:
        return counted(flags, begins, ends)

    upper, digit, symbol, mark, line = (kind[data] for kind in _KIND)
    length = ends - begins
    symbols = per_word(symbol)
    hashes = word_hashes(data, begins, ends)
    same = np.zeros(len(begins), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(same)]] = False
    closes = mark[ends - 1] if len(ends) else np.zeros(0, bool)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:])]).reshape(n)
    longest = np.zeros(n)
    full = np.diff(first) > 0
    if full.any():
        longest[full] = np.maximum.reduceat(length, first[:-1][full])
    return np.stack(
        [
            np.log(words), np.log(size / words), per_text(upper, offsets) / size, per_text(digit, offsets) / size,
            per_text(symbol, offsets) / size, per_text(mark, offsets) / size, per_text(line, offsets) / size,
            per_text(symbols > 0, first) / words, per_text(per_word(upper) * 2 > length, first) / words,
            per_text(same, first) / words, distinct / words, per_text(closes, first) / words,
            np.log1p(longest), per_text((symbols == length), first) / words,
        ],
        axis=1,
    )


def _expand(x: np.ndarray) -> np.ndarray:
    """The measures with all products of two."""
    i, j = np.triu_indices(x.shape[1])
    return np.concatenate([x, x[:, i] * x[:, j], np.ones((len(x), 1))], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        standard = np.clip((x - self.mean) / self.spread, -4, 4)
        return 1 / (1 + np.exp(-np.clip(_expand(standard) @ self.weights, -30, 30)))


def train(good: np.ndarray, web: np.ndarray, prior: float, rounds: int = ROUNDS) -> Model:
    """Minimises the non-negative risk by Adam steps over the whole sample."""
    both = np.concatenate([good, web])
    mean, spread = both.mean(axis=0), both.std(axis=0) + 1e-6
    positive, unlabelled = (_expand(np.clip((x - mean) / spread, -4, 4)) for x in (good, web))
    weights = np.zeros(positive.shape[1])
    step, square = np.zeros_like(weights), np.zeros_like(weights)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for turn in range(1, rounds + 1):
        p, u = sigmoid(positive @ weights), sigmoid(unlabelled @ weights)
        rise = prior * ((p - 1) @ positive) / len(positive)
        fall = u @ unlabelled / len(unlabelled) - prior * (p @ positive) / len(positive)
        risk = -np.log1p(-u + 1e-9).mean() + prior * np.log1p(-p + 1e-9).mean()
        gradient = rise + fall if risk >= 0 else -fall
        gradient += 1e-4 * weights
        step, square = 0.9 * step + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        weights = weights - 0.02 * (step / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return Model(mean, spread, weights, prior)


def class_prior(good: np.ndarray, web: np.ndarray) -> float:
    """The share of good text in the web, from scores of both that were not trained on."""
    if not len(good) or not len(web):
        return 0.5
    cuts = np.unique(good)
    above = lambda scores: 1 - np.searchsorted(np.sort(scores), cuts, "left") / len(scores)
    share, whole = above(web), above(good)
    # Deviations of both shares that are exceeded once in ten times; the cut is chosen by the upper end.
    allowance = np.sqrt(np.log(20) / (2 * len(web))) + np.sqrt(np.log(20) / (2 * len(good)))
    best = np.argmin((share + allowance) / whole)
    return float(np.clip(share[best] / whole[best], 0.05, 0.95))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never looked at."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("good"), pa.array(list(measures(part.column("text"))), pa.list_(pa.float64()))],
                ["doc_id", "good", "x"],
            )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from at most ``sample`` trusted and ``sample`` unlabelled rows that aren't held out."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.where(~held_out(F.col("doc_id"))).where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chance = F.xxhash64("doc_id")
    good = marks.where("quality = 1").orderBy(chance, "doc_id").limit(sample).select("doc_id", F.lit(True).alias("good"))
    web = docs.select("doc_id").where("doc_id is not null").where(~held_out(F.col("doc_id")))
    web = web.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(sample).distinct().select("doc_id", F.lit(False).alias("good"))
    # At most 2 * sample rows of two small columns: the size of what is broadcast doesn't depend on the input.
    chosen = docs.join(F.broadcast(good.union(web)), "doc_id").select("doc_id", "good", "text")
    rows = chosen.mapInArrow(_measured, "doc_id long, good boolean, x array<double>")
    rows = rows.orderBy("good", "doc_id", "x").limit(4 * sample).toPandas()
    x = np.array(rows["x"].tolist()).reshape(len(rows), len(MEASURES))
    trusted = rows["good"].to_numpy(bool)
    if not trusted.any() or trusted.all():
        width = len(MEASURES)
        return Model(np.zeros(width), np.ones(width), np.zeros(_expand(np.zeros((1, width))).shape[1]), 0.5)
    good, web = x[trusted], x[~trusted]
    # Rows are sorted by id, so every other one is a half like the other.
    first = train(good[::2], web[::2], 0.5)
    return train(good, web, class_prior(first.score(good[1::2]), first.score(web[1::2])))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""

    def apply(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                s = model.score(measures(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array(s >= threshold).cast(pa.int32())],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return chosen.mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (any columns, among them ``text``) without the rows predicted to be bad; no shuffle."""

    def keep(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                yield part.filter(pa.array(model.score(measures(part.column("text"))) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
