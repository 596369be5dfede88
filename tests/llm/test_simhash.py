"""SimHash: hashes, fingerprints, links and components against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash as S
from strata.llm.common import table, text_slices
from strata.llm.components import connected_components
from tests.conftest import SF_SMALL


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in items:
        for b in items:
            if a < b and linked(a, b):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {x: find(x) for x in items}


def far(a, b):
    return bin((a ^ b) & (2 ** 64 - 1)).count("1")


def test_hash_of_slices_is_xxh64():
    r = random.Random(3)
    data = bytes(r.randrange(256) for _ in range(5000))
    start = np.array([r.randrange(4000) for _ in range(400)])
    end = start + np.array([r.randrange(0, 200) for _ in range(400)])
    got = S.xxh64_slices(np.frombuffer(data, np.uint8), start, end)
    assert [int(x) for x in got] == [xxhash.xxh64(data[a:b], seed=42).intdigest() for a, b in zip(start, end, strict=True)]


def test_fingerprints_match_brute_force():
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéÀ日Z") for _ in range(r.choice([1, 2, 5, 9, 30, 90]))) for _ in range(200)]
    texts = ["", " ", None, "One", "One  two\x0b", "A\tb\nC"] + [
        " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 4, 40, 900]))) for _ in range(50)]
    for size in (1, 3000, 1 << 21):
        got = [S.majority_bits(*S.shingle_hashes(t, 3)) for _, t in text_slices(pa.array(texts), size)]
        assert [int(x) for x in np.concatenate(got)] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_bit_sliced_pairs_are_all_pairs(radius):
    r = random.Random(radius)
    centres = [r.getrandbits(64) for _ in range(12)]
    fps = list({c ^ sum({1 << r.randrange(64) for _ in range(r.randrange(6))}) for c in centres for _ in range(30)})
    got = set()
    n = len(fps)
    for i, j in S.close_pairs(np.array(fps, dtype=np.uint64), n - 1 - np.arange(n), radius):
        got |= set(zip(i.tolist(), j.tolist(), strict=True))
    assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if far(fps[i], fps[j]) <= radius}


@pytest.mark.parametrize("chunk", [4, 1024])
def test_links_connect_what_brute_force_connects(spark, chunk):
    """Chunks far smaller than the groups: split block values lose nothing."""
    r = random.Random(chunk)
    centres = [r.getrandbits(64) for _ in range(6)]
    fps = sorted({(c ^ sum({1 << r.randrange(64) for _ in range(r.randrange(5))})) - 2 ** 63 for c in centres for _ in range(25)})
    links = S.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp long"), chunk=chunk).collect()
    assert all(far(x["a"], x["b"]) <= 25 for x in links)
    got = components(fps, lambda a, b, s={(x["a"], x["b"]) for x in links}: (a, b) in s or (b, a) in s)
    assert got == components(fps, lambda a, b: far(a, b) <= 3)


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (5, 4), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected(rows):
    of = components(sorted({fingerprint(t) for _, t in rows}), lambda a, b: far(a, b) <= 3)
    first = {}
    for d, t in rows:
        root = of[fingerprint(t)]
        if d is not None:
            first[root] = min(d, first.get(root, d))
    return sorted(((d, fingerprint(t), first.get(of[fingerprint(t)])) for d, t in rows), key=str)


def near(docs):
    return sorted(((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in S.near_copies(docs).collect()), key=str)


def test_near_copies_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert near(docs) == expected(rows)


def test_awkward_rows(spark, awkward, clashing, no_docs):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    assert near(clashing) == expected(rows)
    assert S.near_copies(no_docs).count() == 0 and S.drop_near_copies(no_docs).count() == 0
    kept = S.drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    groups = {r["component_id"] for r in S.near_copies(awkward).collect()}
    assert kept.count() == len(groups)  # one of each, repeated rows once
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(groups, key=str)


def test_hot_group_of_copies(spark):
    """A third of the rows are copies of one text."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text in many rows").otherwise(
        F.concat_ws(" ", F.sha2(F.col("id").cast("string"), 256), F.lit("tail"), F.col("id"))).alias("text"))
    kept = S.drop_near_copies(docs)
    assert kept.count() == 2001 and kept.where("doc_id % 3 = 0").collect()[0]["doc_id"] == 0
