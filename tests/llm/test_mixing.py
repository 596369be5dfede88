"""Mixing: the schedule's deviation, and every row in its place."""

import random
from collections import Counter
from itertools import islice

import pytest

from strata.llm import mixing as M
from strata.llm.common import table
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("seed", range(12))
def test_schedule_stays_within_a_block_of_the_weights(seed):
    r = random.Random(seed)
    frame = r.choice([64, 256, 1024])
    shares = M.whole_shares([r.random() ** 3 + 1e-4 for _ in range(r.randrange(1, 40))], frame)
    assert sum(shares) == frame and min(shares) >= 1
    slots, had = M.frame_schedule(shares), [0] * len(shares)
    for t, k in enumerate(slots, 1):
        had[k] += 1
        assert all(abs(h - s * t / frame) < 1 for h, s in zip(had, shares, strict=True))
    assert had == shares


def mixture(docs, **how):
    rows = sorted(M.mix(docs, **how).collect(), key=lambda r: r["mix_row"])
    assert [r["mix_row"] for r in rows] == list(range(len(rows)))
    return rows


@pytest.mark.parametrize("weights", [None, {f"src{k}": 1.0 + k for k in range(40)}])
def test_prefixes_follow_the_weights(spark, weights):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "source")
    size = 4
    rows = mixture(docs, weights=weights, block_rows=size)
    count = Counter(r["source"] for r in docs.collect())
    wanted = {s: (weights[s] if weights else n ** M.TEMPERATURE) for s, n in count.items()}
    total = sum(wanted.values())
    had = Counter()
    for t in range(0, len(rows), size):
        block = rows[t:t + size]
        assert len({(r["source"], r["block"], r["slot"]) for r in block}) == 1  # a slot is one block of one source
        had[block[0]["source"]] += 1
        slots = t // size + 1
        for s, w in wanted.items():  # weights are rounded to one in 4096
            assert abs(had[s] - w / total * slots) < 1 + slots * 2 / 4096
    # whole results: every document in epoch 0 once, epochs read in the same order, without gaps
    assert sorted(r["doc_id"] for r in rows if r["epoch"] == 0) == sorted(r["doc_id"] for r in docs.collect())
    for s, n in count.items():
        mine = [r for r in rows if r["source"] == s]
        assert [r["epoch"] for r in mine] == [k // n for k in range(len(mine))]
        assert all(mine[k]["doc_id"] == mine[k % n]["doc_id"] for k in range(len(mine)))
    # it ends as soon as every source has been read
    last = rows[-1]["source"]
    assert sum(r["source"] == last for r in rows[:-size]) < count[last]


def test_awkward_rows(spark, awkward, clashing, no_docs):
    rows = mixture(awkward, block_rows=2)
    assert Counter(tuple(r[:5]) for r in rows if r["epoch"] == 0) == Counter(tuple(r) for r in awkward.collect())
    out = M.mix(clashing, block_rows=2)
    assert out.columns[:len(clashing.columns)] == clashing.columns and out.columns[-1] == "mix_row_"
    assert M.mixed_documents(clashing, block_rows=2).columns == clashing.columns
    assert M.mix(no_docs).count() == 0
    with pytest.raises(ValueError):
        M.mix(awkward, weights={"s1": 1.0})


def test_hot_source_is_numbered_in_parts(spark):
    """A third of the rows in one source: parts of about PART_ROWS rows."""
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 50)) as source")
    rows = mixture(docs)
    assert len({r["doc_id"] for r in rows}) == 6000


@pytest.mark.parametrize("weights, slots", [
    ([500_000 ** M.TEMPERATURE] * 20, 156_873), ([1e9 ** M.TEMPERATURE, 1.0], 200_000), ([0.1 + 0.37 * k for k in range(11)], 50_000)])
def test_deviation_does_not_grow_with_the_corpus(weights, slots):
    exact, had = M.exact_weights(weights), [0] * len(weights)
    total = sum(exact)
    for t, (k, i) in enumerate(islice(M.schedule(exact), slots), 1):
        assert had[k] == i
        had[k] += 1
        assert abs(had[k] * total - exact[k] * t) < total
        if t % 97 == 0 or t == slots:
            assert all(abs(h * total - w * t) < total for h, w in zip(had, exact, strict=True))


def test_long_mixture_follows_the_weights(spark):
    """More slots than a frame of 4,096; the light source is not read more often than its weight calls for."""
    docs = spark.range(30_001).selectExpr("id as doc_id", "if(id = 0, 'light', concat('s', id % 7)) as source")
    weights = {"light": 0.0001, **{f"s{k}": 1.0 + k / 3 for k in range(7)}}
    rows = M.mix(docs, weights=weights, block_rows=2).select("source", "slot", "mix_row").collect()
    assert sorted(r["mix_row"] for r in rows) == list(range(len(rows)))
    of = sorted({(r["slot"], r["source"]) for r in rows})
    assert len(of) == of[-1][0] + 1 > 4096
    had, total = Counter(), sum(weights.values())
    for t, (_, s) in enumerate(of, 1):
        had[s] += 1
        assert all(abs(had[x] - w / total * t) < 1 + 1e-6 for x, w in weights.items())
