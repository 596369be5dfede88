"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are shares and averages of the bytes, words and lines of the
whole text, worked out by numpy for a slice of texts at a time. The trees are
fitted on the driver from a bounded sample of labelled rows, sent to the tasks
as flat arrays, and traversed there for all rows of a slice at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import boosting
from strata.llm.common import Texts, held_out, text_slices
from strata.llm.labelled import TRAIN_ROWS, training_rows

THRESHOLD = 0.7

_HASH = np.uint64(0x100000001B3)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of every ``buf[start:end]``."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(buf) + 1, _HASH))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        # divide by the first power: multiply up to a common one instead
        raised = (total[end] - total[start]) * power[len(buf) - start]
        return (raised ^ (raised >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


def _distinct(owner: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each owner: how many distinct keys, and how often its commonest."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(key)))
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, owner[at], size)
    return np.bincount(owner[at], minlength=n), most


def document_statistics(t: Texts) -> np.ndarray:
    """A row of statistics for every text; all zero for an empty one."""
    b = t.buf
    upper = (b >= 65) & (b <= 90)
    lower = (b >= 97) & (b <= 122)
    digit = (b >= 48) & (b <= 57)
    wide = b >= 128
    lines = t.per_doc(b == 10)
    size = np.diff(t.bounds)
    words, chars = t.n_words, t.per_doc((b > 32) & ((b < 128) | (b >= 192)))
    some, text = np.maximum(words, 1), np.maximum(chars, 1)
    length = t.end - t.start
    hashes = span_hashes(b, t.start, t.end)
    kinds, most = _distinct(t.doc, hashes, t.n)
    stutter = np.zeros(len(hashes), dtype=bool)
    stutter[1:] = (t.doc[1:] == t.doc[:-1]) & (hashes[1:] == hashes[:-1])
    triple = np.flatnonzero(t.doc[2:] == t.doc[:-2]) if len(hashes) > 2 else np.empty(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        three = hashes[triple] * np.uint64(3) + hashes[triple + 1] * np.uint64(5) + (
            hashes[triple + 2] ^ (hashes[triple + 2] >> np.uint64(31))) if len(triple) else np.empty(0, np.uint64)
    triples = np.bincount(t.doc[triple], minlength=t.n)
    distinct_triples, _ = _distinct(t.doc[triple], three, t.n)
    first, last = (b[t.start], b[t.end - 1]) if len(t.start) else (np.empty(0, np.uint8),) * 2
    mean = np.bincount(t.doc, length, t.n) / some
    spread = np.sqrt(np.maximum(np.bincount(t.doc, length.astype(float) ** 2, t.n) / some - mean ** 2, 0))
    symbol = np.isin(b, np.frombuffer(b"#*$%&|<>@^~_=+\\/{}[]", dtype=np.uint8))
    cols = [
        np.log1p(words), np.log1p(size), mean, spread,
        t.per_doc(upper) / text, t.per_doc(lower) / text, t.per_doc(digit) / text, t.per_doc(wide) / np.maximum(size, 1),
        t.per_doc(symbol) / some, t.per_doc((b == 33) | (b == 63)) / some, t.per_doc((b == 46) | (b == 44)) / some,
        t.per_doc(b == 124) / some, (lines + 1) / some * (words > 0),
        t.words_with(length <= 3) / some, t.words_with(length >= 15) / some,
        t.words_with((first >= 65) & (first <= 90)) / some,
        t.words_with(np.isin(last, np.frombuffer(b".!?", dtype=np.uint8))) / some,
        t.words_with((last >= 33) & (last <= 47) | (last == 64) | (last == 94)) / some,
        kinds / np.sqrt(some), most / some, t.words_with(stutter) / some,
        1 - distinct_triples / np.maximum(triples, 1) - (triples == 0),
    ]
    return np.column_stack(cols).astype(np.float64) * (words > 0)[:, None]


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    NULL and empty texts get the score of all-zero statistics. Repeated rows
    give a row each, NULL ids are passed through (not held out), other columns
    are ignored. Without labelled rows every score is one half. An empty table
    gives no rows.
    """
    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, t in text_slices(batch.column(0)):
                x = document_statistics(t)
                flat = pa.array(x.ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.FixedSizeListArray.from_arrays(flat, x.shape[1]).cast(pa.list_(pa.float64())),
                     batch.column(1).slice(at, t.n)], names=["x", "label"])

    sample = training_rows(docs, labels, "quality", rows).mapInArrow(statistics, "x array<double>, label int").collect()
    x = np.array([r["x"] for r in sample]) if sample else np.zeros((0, 1))
    model = boosting.fit(x, np.array([float(r["label"] > 0) for r in sample]))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for batch in batches:
            for at, t in text_slices(batch.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, t.n), batch.column(1).slice(at, t.n),
                     pa.array(trees.score(document_statistics(t)))], names=["doc_id", "held_out", "score"])

    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = narrow.select("doc_id", "held_out", F.lit(0.0).alias("score")).schema
    return narrow.mapInArrow(score, schema).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
