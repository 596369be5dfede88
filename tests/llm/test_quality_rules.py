"""Quality rules: base statistics against plain Python, the label model, verdicts."""

import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import quality_rules as Q
from strata.llm.common import table
from tests.conftest import SF_CHECK, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def check(docs):
    got = {}
    for r in Q.quality_verdicts(docs.select("doc_id", "text"), ["doc_id", "text"]).collect():
        base = statistics(r["text"])
        assert tuple(r[s] for s in Q.STATS) == base, r["doc_id"]
        failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["quality"] >= 0.5)
        got[r["doc_id"]] = r["kept"]
    return got


def test_statistics_match_brute_force(spark):
    check(table(spark, SF_SMALL, "documents"))


def test_awkward_rows(spark, awkward, clashing, no_docs):
    check(awkward)
    out = Q.quality_verdicts(clashing, ["doc_id"])
    assert out.count() == awkward.count()
    assert Q.quality_verdicts(no_docs, ["doc_id"]).count() == 0
    kept = Q.keep_good(clashing)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out.where("kept").collect()}
    assert Q.keep_good(no_docs).count() == 0


def test_repeats_at_text_edges(spark):
    eight = "a b c d e f g h"
    texts = [eight, f"{eight} {eight}", f"{eight} x {eight}", f"{eight} i {eight} i", "z " * 40, f"{eight}\n{eight}\n{eight}"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_verdicts_agree_with_labels(spark):
    """Unsupervised, so the labels are only looked at here."""
    verdicts = Q.quality_verdicts(table(spark, SF_CHECK, "documents"), ["doc_id"]).drop("quality")
    joined = verdicts.join(table(spark, SF_CHECK, "labels"), "doc_id").where("not base_failed").collect()
    good = [r for r in joined if r["quality"] == 1]
    bad = [r for r in joined if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.95 * len(bad)


def brute_posterior(share, says, pattern):
    like = []
    for n, row in zip(share, says, strict=True):
        p = n
        for v, g in zip(pattern, row, strict=True):
            p *= 1 if v == Q.ABSTAIN else g if v == Q.GOOD else 1 - g
        like.append(p)
    return like[0] / sum(like)


def counted(votes):
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    return {tuple(map(int, p)): int(k) for p, k in zip(pattern, n, strict=True)}


def test_label_model_finds_exclusive_kinds():
    """Two kinds of bad text, each seen by one rule and missed by the other;
    the third rule votes bad on a few of everything."""
    patterns = {(1, 1, 1): 90000, (0, 1, 1): 5000, (1, 0, 1): 4000, (1, 1, 0): 200, (0, 1, 0): 11, (1, 0, 0): 9, (-1, -1, -1): 500}
    model = Q.fit_label_model(patterns, 3)
    assert model.quality((1, 1, 1)) > 0.95 and model.quality((1, 1, 0)) > 0.5
    assert model.quality((0, 1, 1)) < 0.2 and model.quality((1, 0, 1)) < 0.2
    for p in patterns:
        assert model.quality(p) == pytest.approx(brute_posterior(model.share, model.says_good, p))
    assert sum(model.share) == pytest.approx(1)


@pytest.mark.parametrize("n", [5_000, 200_000])
def test_unreliable_rule_is_outvoted(n):
    """Three rules that are right 95 times in 100, and a coin."""
    rng = np.random.default_rng(n)
    truth = rng.random(n) < 0.7
    right = rng.random((n, 3)) < 0.95
    votes = np.column_stack([np.where(right, truth[:, None], ~truth[:, None]), rng.random(n) >= 0.3]).astype(int)
    model = Q.fit_label_model(counted(votes), 4)
    assert len(model.share) == 2 and model.share[0] == pytest.approx(0.7, abs=0.05)
    for rule in range(3):
        assert model.says_good[0][rule] == pytest.approx(0.95, abs=0.05)
        assert model.says_good[1][rule] == pytest.approx(0.05, abs=0.05)
    assert model.says_good[0][3] == pytest.approx(0.7, abs=0.05) and model.says_good[1][3] == pytest.approx(0.7, abs=0.05)
    assert model.quality((1, 1, 1, 0)) > 0.9 and model.quality((0, 0, 1, 1)) < 0.5
    kept = np.array([model.quality(v) >= 0.5 for v in votes[:2000]])
    assert (kept == truth[:2000]).mean() > 0.97


def test_exact_rule_condemns_alone():
    """One rule alone sees a kind of bad text, two others see another kind;
    beside them are a noisy rule and a coin."""
    rng = np.random.default_rng(5)
    n = 100_000
    kind = rng.choice(3, n, p=[0.87, 0.05, 0.08])
    seen = (rng.random((n, 2)) < 0.95) & (kind == 2)[:, None] | (rng.random((n, 2)) < 0.02)
    votes = np.column_stack([kind != 1, rng.random(n) >= 0.3, ~seen, rng.random(n) >= 0.05]).astype(int)
    model = Q.fit_label_model(counted(votes), 5)
    assert model.quality((0, 1, 1, 1, 1)) < 0.05 and model.quality((1, 1, 0, 0, 1)) < 0.05
    assert model.quality((1, 0, 1, 1, 1)) > 0.9 and model.quality((1, 1, 1, 1, 0)) > 0.9 and model.quality((1, 0, 1, 1, 0)) > 0.9


def test_ordered_rates():
    """Against a search: the likeliest rates with the good class the lowest."""
    rng = np.random.default_rng(8)
    for _ in range(20):
        total = rng.integers(5, 60, (3, 1)).astype(float)
        yes = total * rng.random((3, 1))
        got = Q.ordered_rates(yes, total)[:, 0]
        assert (got[1:] >= got[0] - 1e-12).all()
        fit = lambda b: (yes[:, 0] * np.log(b) + (total - yes)[:, 0] * np.log(1 - b)).sum()
        grid = np.linspace(0.01, 0.99, 99)
        free = np.clip((yes / total)[:, 0], 0.01, 0.99)
        best = max(fit(np.array([g, max(g, free[1]), max(g, free[2])])) for g in grid)
        assert fit(np.clip(got, 0.01, 0.99)) >= best - 1e-6


def test_label_model_without_documents():
    model = Q.fit_label_model({}, 2)
    assert model.quality((-1, -1)) == pytest.approx(0.9)


def test_main_path_is_native(spark):
    """No Python on the executors."""
    plan = Q.keep_good(table(spark, SF_SMALL, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
