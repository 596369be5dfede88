"""Toxicity: a factorization machine over hashed terms.

The terms of a text are its lower-case words and the beginnings of its words
(4 to 8 bytes, so that inflected forms share terms), each present or not,
hashed to one of BUCKETS. The machine adds to the weight of every term present
an interaction of every two of them, the product of their factor vectors: an
insult beside a mention of a group can count for more than both alone. Sums of
factors give all the interactions of a text in time linear in its terms.

The model is fitted by numpy on the driver from a bounded sample of labelled
rows. Every bucket that LEAST_ROWS of them have takes part, whatever its share
of toxic rows: a mention that is neutral alone may tell beside an insult. The
penalties on weights and factors take most terms out of the machine again while
it learns, so scoring looks at few terms of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Texts, held_out, text_slices
from strata.llm.labelled import TRAIN_ROWS, training_rows

THRESHOLD = 0.3
BUCKETS = 1 << 18
PREFIXES = range(4, 9)
#: Buckets that fewer sample rows have are left out.
LEAST_ROWS = 8
FACTORS = 8
#: A weight, and the factors of a term together, must be worth this many
#: standard errors of what a term as frequent would gain by chance.
WEIGHT_PENALTY = 3.0
FACTOR_PENALTY = 5.0


def word_terms(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every term of every text, each once, text by text."""
    b = t.buf
    if not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letter = (b >= 48) & (b <= 57) | (b >= 97) & (b <= 122) | (b >= 128)
    edge = np.zeros(len(b) + 1, dtype=bool)
    edge[t.bounds] = True
    before = np.concatenate([[False], letter[:-1]]) & ~edge[:-1]
    start = np.flatnonzero(letter & ~before)
    after = np.concatenate([letter[1:], [False]]) & ~edge[1:]
    size = np.flatnonzero(letter & ~after) + 1 - start
    doc = np.searchsorted(t.bounds, start, side="right") - 1
    keys, docs = [], []
    with np.errstate(over="ignore"):
        h = np.full(len(start), 0xCBF29CE484222325, dtype=np.uint64)
        live, k = np.arange(len(start)), 0
        while len(live):
            h[live] = (h[live] ^ b[start[live] + k].astype(np.uint64)) * np.uint64(0x100000001B3)
            k += 1
            ended = size[live] == k
            for part, salt in ((live[ended], 0), (live if k in PREFIXES else live[:0], 1)):
                x = (h[part] ^ np.uint64(salt * 0x5BD1E995)) * np.uint64(0x9E3779B97F4A7C15)
                keys.append((x >> np.uint64(40)) % np.uint64(BUCKETS))
                docs.append(doc[part])
            live = live[~ended]
    both = np.concatenate(docs).astype(np.int64) * BUCKETS + np.concatenate(keys).astype(np.int64) if keys else np.empty(0, np.int64)
    both = np.unique(both)
    return both // BUCKETS, both % BUCKETS


@dataclass(frozen=True)
class Machine:
    """``place`` maps a bucket to its row of ``weight`` and ``factor``, or -1."""

    bias: float
    place: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def log_odds(self, n: int, doc: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        at = self.place[bucket]
        doc, at = doc[at >= 0], at[at >= 0]
        return self._sum(n, doc, at)[0]

    def _sum(self, n: int, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        linear = np.bincount(doc, self.weight[at], n)
        sums = np.zeros((n, self.factor.shape[1]))
        squares = np.zeros(n)
        if len(doc):
            new = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            v = self.factor[at]
            sums[doc[new]] = np.add.reduceat(v, new, axis=0)
            squares = np.bincount(doc, (v * v).sum(1), n)
        return self.bias + linear + 0.5 * ((sums ** 2).sum(1) - squares), sums


def frequent_terms(parts: list[pa.ListArray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the terms in buckets that LEAST_ROWS rows or more have.
    ``parts`` hold the buckets of one row after the other; one part is expanded
    at a time."""
    rows = np.zeros(BUCKETS, dtype=np.int64)
    for part in parts:
        rows += np.bincount(part.flatten().to_numpy(zero_copy_only=False), minlength=BUCKETS)
    keep, kept, at = rows >= LEAST_ROWS, [], 0
    for part in parts:
        bucket = part.flatten().to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(at, at + len(part), dtype=np.int32), part.value_lengths().to_numpy(zero_copy_only=False))
        kept.append((doc[keep[bucket]], bucket[keep[bucket]]))
        at += len(part)
    return tuple(np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.empty(0, np.int32),) * 2


def fit(y: np.ndarray, doc: np.ndarray, bucket: np.ndarray, epochs: int = 12, batch: int = 256,
        rate: float = 0.1, factor_rate: float = 0.03, seed: int = 7) -> Machine:
    """Logistic loss, Adagrad steps over batches in a seeded order. After each
    step weights, and the factors of a term together, shrink towards zero by
    the penalties, in proportion to the chance deviation of their gradients:
    the standard error of a term's share of the loss, for factors times the
    usual length of a text's sum of factors. Factors shrink from the second
    epoch on: first they must have had the chance to find each other. Terms
    left with neither at the end of an epoch drop out. ``doc`` rises. With no rows, or one class, the
    machine is its bias."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    place = np.full(BUCKETS, -1, dtype=np.int32)
    if not len(y) or y.min() == y.max():
        return Machine(bias, place, np.zeros(0), np.zeros((0, FACTORS)))
    having = np.bincount(bucket, minlength=BUCKETS)
    terms = np.flatnonzero(having >= LEAST_ROWS)
    chance = np.sqrt(having[terms] * share * (1 - share)) / len(y)
    usual = 0.0  # squared length of a text's sum of factors
    place[terms] = np.arange(len(terms))
    at = place[bucket]
    doc, at = doc[at >= 0], at[at >= 0]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS))
    # the factors' sums of squares begin above zero: a rare term's first gradients move them little
    seen_b, seen_w, seen_v = 1e-8, np.full(len(terms), 1e-8), np.full(len(terms), 1e-4)
    for epoch in range(epochs):
        live = (w != 0) | v.any(axis=1)
        if epoch and not live.all():
            terms, chance, w, v, seen_w, seen_v = (x[live] for x in (terms, chance, w, v, seen_w, seen_v))
            at = np.where(live, np.cumsum(live) - 1, -1)[at]
            doc, at = doc[at >= 0], at[at >= 0]
        bounds = np.searchsorted(doc, np.arange(len(y) + 1))
        order = rng.permutation(len(y))
        for s in range(0, len(y), batch):
            rows = order[s:s + batch]
            size = bounds[rows + 1] - bounds[rows]
            owner = np.repeat(np.arange(len(rows)), size)
            a = at[np.repeat(bounds[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            z, sums = Machine(bias, place, w, v)._sum(len(rows), owner, a)
            square = (sums ** 2).sum(axis=1).mean()
            usual = 0.9 * usual + 0.1 * square if usual else square
            err = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[rows]) / len(rows)
            grad_w = np.bincount(a, err[owner], len(terms))
            pull = err[:, None] * sums
            grad_v = np.stack([np.bincount(a, pull[owner, f], len(terms)) for f in range(FACTORS)], 1) - v * grad_w[:, None]
            seen_b += err.sum() ** 2
            seen_w += grad_w ** 2
            seen_v += (grad_v ** 2).mean(axis=1)
            bias -= float(rate * err.sum() / np.sqrt(seen_b))
            step_w, step_v = rate / np.sqrt(seen_w), factor_rate / np.sqrt(seen_v)
            w -= step_w * grad_w
            w = np.sign(w) * np.maximum(np.abs(w) - step_w * WEIGHT_PENALTY * chance, 0)
            v -= step_v[:, None] * grad_v
            if epoch:
                length = np.sqrt((v ** 2).sum(axis=1))
                less = step_v * FACTOR_PENALTY * chance * np.sqrt(usual)
                v *= np.maximum(1 - less / np.maximum(length, 1e-12), 0)[:, None]
    left = np.flatnonzero((w != 0) | v.any(axis=1))
    place[:] = -1
    place[terms[left]] = np.arange(len(left))
    return Machine(bias, place, w[left], v[left])


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    NULL and empty texts have no terms and get the score of the bias. Repeated
    rows give a row each, NULL ids are passed through (not held out), other
    columns are ignored. Without labelled rows every score is one half. An
    empty table gives no rows.
    """
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, t in text_slices(batch.column(0)):
                doc, bucket = word_terms(t)
                ends = np.searchsorted(doc, np.arange(t.n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, pa.array(bucket.astype(np.int32))),
                     batch.column(1).slice(at, t.n)], names=["terms", "label"])

    lowered = training_rows(docs, labels, "toxic", rows).select(F.lower("text").alias("text"), "label")
    sample = lowered.mapInArrow(terms, "terms array<int>, label int").toArrow()
    y = (sample.column("label").to_numpy() > 0).astype(float)
    machine = fit(y, *frequent_terms(sample.column("terms").chunks))
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # BUCKETS * 76 bytes (20 MB) at most

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for at, t in text_slices(batch.column(2)):
                odds = m.log_odds(t.n, *word_terms(t))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, t.n), batch.column(1).slice(at, t.n),
                     pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], names=["doc_id", "held_out", "score"])

    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lower("text").alias("text"))
    schema = narrow.select("doc_id", "held_out", F.lit(0.0).alias("score")).schema
    return narrow.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
