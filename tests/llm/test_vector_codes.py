"""Vector codes against plain k-means in integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from strata.llm import vector_codes as V
from strata.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, entries=64, rounds=2):
    rows = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in rows), default=0) // 16)
    ints = [[math.floor(256 * float(np.float32(x))) for x in v] + [0] * (16 * width - len(v)) for _, v, _ in rows]
    least = {}
    for (i, _, _), x in zip(rows, ints):
        if i is not None:
            least[i] = min(least.get(i, x), x)
    seeds = [least[i] for i in sorted(least)[:entries]]
    parts = lambda x: [x[p * width:(p + 1) * width] for p in range(16)]
    books = [[parts(s)[p] for s in seeds] for p in range(16)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))[::-1] for p, x in enumerate(parts(v))] for v in ints]
    for _ in range(rounds):
        got = assign()
        for p in range(16):
            of = defaultdict(list)
            for v, codes in zip(ints, got):
                of[codes[p][0]].append(parts(v)[p])
            for k, members in of.items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    total, out = defaultdict(int), []
    for (i, _, label), codes in zip(rows, assign()):
        error = sum(d for _, d in codes)
        total[label] += error
        out.append((i, label, "".join(f"{k:02x}" for k, _ in codes), error))
    digest = hashlib.sha256(",".join(str(c) for p in books for e in p for c in e).encode()).hexdigest()
    return sorted(((i, c, e, total[lab], digest) for i, lab, c, e in out), key=str)


def result(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()), key=str)


def test_given_vectors(spark):
    df = table(spark, SF_SMALL, "embeddings")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert result(V.vector_codes(df)) == brute(rows)


@pytest.mark.parametrize("seed,dim,scale,entries,rounds", [(1, 32, 1.0, 20, 5), (2, 16, 0.02, 12, 3), (3, 48, 300.0, 9, 4), (4, 40, 1.0, 5, 2)])
def test_random_vectors_and_more_rounds(spark, seed, dim, scale, entries, rounds):
    """Small scales make many equal distances, large ones leave the float path."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, scale, dim)], int(rng.integers(3))) for i in rng.permutation(300)]
    rows += rows[:40]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(V.vector_codes(df, entries=entries, rounds=rounds)) == brute(rows, entries, rounds)


def test_bounds_save_distances():
    """On clustered vectors a later pass measures few parts in full, and its result is that of a first pass."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-300, 300, (40, 4))
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-9, 9, (3000, 4))
    books = centres[None].astype(np.int64)
    own, _, near, bounds, outer, *_ = V.Pass(books, 5, None).first(0, x)
    moved_to = books + rng.integers(-3, 4, books.shape)
    moved = np.sqrt(((moved_to - books) ** 2).sum(2)) * (1 + 1e-9)
    later = V.Pass(moved_to, 5, moved)
    got = later.again(0, x, own, near, V._below(bounds).astype(float), V._below(outer).astype(float))
    want = V.Pass(moved_to, 5, None).first(0, x)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert got[5].mean() < 0.2
    d = np.sqrt(V._distances(x, moved_to[0]).astype(float))
    for row in range(len(x)):  # bounds hold, in order
        known = got[2][row] != 255
        assert (got[3][row][known] <= d[row][got[2][row][known]] + 1e-9).all() and (np.diff(got[3][row]) >= 0).all()
        rest = np.setdiff1d(np.arange(40), [*got[2][row][known], got[0][row]])
        assert got[4][row] <= d[row][rest].min() + 1e-9


def test_half_width_bounds_round_down():
    v = np.concatenate([np.geomspace(1e-9, 1e7, 4000), [0.0, np.inf]])
    half = V._below(v)
    assert (half.astype(float) <= v).all() and np.isfinite(half).all()


def test_list_length_adapts():
    assert V.next_length(8, 64, 0.5, 8) == 16 and V.next_length(40, 64, 0.5, 8) == 63
    assert V.next_length(8, 64, 0.0, 3) == 3 and V.next_length(8, 64, 0.0, 0) == 1 and V.next_length(1, 1, 1.0, 0) == 1


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 16, 1), (1, [0.5] * 16, 1), (1, [-0.5] * 16, None), (2, None, 1), (3, [nan] * 16, 1), (4, [0.1, None] * 8, 1),
            (5, [inf] + [0.0] * 15, 2), (None, [0.25] * 16, None), (6, [], 3), (7, [0.125] * 5, 3), (8, [1.5] * 20, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(V.vector_codes(df)) == brute(rows)
    from pyspark.sql import functions as F
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("code", "error", "__x", "__own", "x", "label_error", "part")])
    assert result(V.vector_codes(clash)) == brute(rows)


def test_huge_components_count_as_the_largest(spark):
    rows = [(k, [1e30 * (-1) ** k] * 16, 0) for k in range(3)]
    clipped = [(k, [16384.0 * (-1) ** k] * 16, 0) for k in range(3)]
    assert result(V.vector_codes(spark.createDataFrame(rows, SCHEMA))) == brute(clipped)


def test_no_vectors_and_no_ids(spark):
    assert V.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    got = V.vector_codes(spark.createDataFrame([(None, [1.0] * 16, 1)], SCHEMA)).collect()
    assert [(r["code"], r["error"]) for r in got] == [("", None)]
