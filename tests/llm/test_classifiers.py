"""Boosted quality trees and the toxicity machine: held-out accuracy, and cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import boosting, quality_model, toxicity_fm
from strata.llm.common import held_out, table, text_slices
from tests.conftest import SF_CHECK

BIG = "/root/testdata/sf0.1"


def area(score, y):
    """Area under the ROC curve, ties counted half."""
    pos, neg = score[y == 1], score[y == 0]
    return ((pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean())


@pytest.mark.parametrize("scores, label, least", [
    (quality_model.quality_scores, "quality", 0.98), (toxicity_fm.toxicity_scores, "toxic", 0.97)])
def test_held_out_rows(spark, scores, label, least):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    out = scores(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").select("score", label, "predicted").toPandas()
    assert area(rows["score"].to_numpy(), rows[label].to_numpy()) >= least
    assert (rows["predicted"] == rows[label]).mean() >= 0.95
    assert out.count() == docs.count()


@pytest.mark.parametrize("scores", [quality_model.quality_scores, toxicity_fm.toxicity_scores])
def test_awkward_rows(spark, awkward, clashing, no_docs, scores):
    labels = table(spark, SF_CHECK, "labels")
    odd = labels.limit(3).selectExpr("cast(null as long) as doc_id", "quality", "toxic").unionByName(
        labels.limit(3).selectExpr("doc_id", "cast(null as int) as quality", "cast(null as int) as toxic"))
    out = scores(clashing, labels.unionByName(odd)).collect()
    assert len(out) == awkward.count()
    assert all(0 <= r["score"] <= 1 for r in out)
    assert scores(no_docs, labels).count() == 0
    blank = scores(awkward, labels.limit(0)).collect()  # nothing to learn from
    assert {r["score"] for r in blank} == {0.5}
    same = [r["score"] for r in out if r["doc_id"] in (1, 2)]
    assert len(set(same)) == 1


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    flipped = flipped.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for scores in (quality_model.quality_scores, toxicity_fm.toxicity_scores):
        a = {r["doc_id"]: r["score"] for r in scores(docs, labels).collect()}
        b = {r["doc_id"]: r["score"] for r in scores(docs, flipped).collect()}
        assert a == b
    for r in docs.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_flat_trees_walk_like_plain_ones():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = boosting.fit(x, y, trees=20, depth=3)
    inner = m.feature.shape[1]
    for row, odds in zip(x[:100], m.log_odds(x[:100]), strict=True):
        total = m.base
        for t in range(len(m.feature)):
            k = 0
            while k < inner:
                k = 2 * k + 1 + (row[m.feature[t, k]] > m.threshold[t, k])
            total += m.value[t, k - inner]
        assert odds == pytest.approx(total)
    assert ((m.score(x) > 0.5) == y).mean() > 0.97


def test_machine_sums_every_pair():
    rng = np.random.default_rng(2)
    place = np.full(toxicity_fm.BUCKETS, -1, np.int32)
    place[:30] = np.arange(30)
    m = toxicity_fm.Machine(0.3, place, rng.normal(size=30), rng.normal(size=(30, 8)))
    docs = [[], [3], [1, 2, 3], [500, 4], list(range(30))]
    doc = np.concatenate([np.full(len(b), k) for k, b in enumerate(docs)]).astype(int)
    got = m.log_odds(len(docs), doc, np.array([b for d in docs for b in d], dtype=int))
    for k, b in enumerate(docs):
        b = [x for x in b if x < 30]
        want = 0.3 + sum(m.weight[x] for x in b) + sum(m.factor[x] @ m.factor[y] for i, x in enumerate(b) for y in b[i + 1:])
        assert got[k] == pytest.approx(want)


def test_machine_learns_an_interaction():
    """Neither term is toxic alone; together they are."""
    rng = np.random.default_rng(3)
    has = rng.random((6000, 2)) < 0.4
    y = (has[:, 0] & has[:, 1]).astype(float)
    pairs = [(k, 10 + f) for k in range(6000) for f in range(2) if has[k, f]]
    doc, bucket = np.array(pairs).T
    m = toxicity_fm.fit(y, doc, bucket, epochs=25)
    score = m.log_odds(6000, doc, bucket)
    assert score[y == 1].min() > score[y == 0].max()


def test_machine_learns_an_exclusive_or():
    """Terms that are neutral alone: toxic if exactly one of the two is there."""
    rng = np.random.default_rng(4)
    has = rng.random((16_000, 2)) < 0.5
    y = (has[:, 0] ^ has[:, 1]).astype(float)
    doc, bucket = np.nonzero(has)
    m = toxicity_fm.fit(y[:12_000], doc[doc < 12_000], bucket[doc < 12_000] + 10)
    odds = m.log_odds(16_000, doc, bucket + 10)
    assert ((odds > 0) == y)[12_000:].mean() > 0.95


def test_machine_learns_interactions_among_other_terms():
    """Either of two terms makes a text toxic, both together do not; three
    hundred other terms say nothing."""
    rng = np.random.default_rng(6)
    n, others = 12_000, 300
    one, two = rng.random(n) < 0.2, rng.random(n) < 0.2
    y = np.where(one == two, rng.random(n) < 0.05, rng.random(n) < 0.95).astype(float)
    has = np.column_stack([one, two, rng.random((n, others)) < 0.05])
    doc, bucket = np.nonzero(has)
    m = toxicity_fm.fit(y[:9_000], doc[doc < 9_000], bucket[doc < 9_000])
    odds = m.log_odds(n, doc, bucket)
    assert ((odds > 0) == y)[9_000:].mean() > 0.92
    both = (one & two)[9_000:]
    assert ((odds > 0) == y)[9_000:][both].mean() > 0.85  # additive weights get these wrong


def test_rare_terms_are_left_out_by_rows_alone():
    parts = [pa.array([[1, 2], [1], []] * 4, pa.list_(pa.int32())), pa.array([[2, 3]] * 4, pa.list_(pa.int32()))]
    doc, bucket = toxicity_fm.frequent_terms(parts)
    assert sorted(zip(doc.tolist(), bucket.tolist(), strict=True)) == sorted(
        [(3 * k, b) for k in range(4) for b in (1, 2)] + [(3 * k + 1, 1) for k in range(4)] + [(12 + k, 2) for k in range(4)])


def test_one_row_per_labelled_id(spark):
    from strata.llm.labelled import training_rows
    docs = spark.createDataFrame([(k % 20, f"text {k}" if k % 7 else None) for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)] * 2, "doc_id long, toxic int")
    rows = training_rows(docs, labels, "toxic").collect()
    assert len(rows) == sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(20))
    assert sorted(map(str, rows)) == sorted(map(str, training_rows(docs.repartition(7), labels, "toxic").collect()))


def test_statistics_do_not_depend_on_the_slice():
    texts = ["Some words here. And here!", "", None, "x", "THE THE THE\n\nthe | the ###", "é ñ 日本 " * 50]
    whole = np.concatenate([quality_model.document_statistics(t) for _, t in text_slices(pa.array(texts))])
    each = np.concatenate([quality_model.document_statistics(t) for x in texts for _, t in text_slices(pa.array([x], pa.string()))])
    assert np.allclose(whole, each) and not whole[1].any() and not whole[2].any()
    terms = [toxicity_fm.word_terms(t) for _, t in text_slices(pa.array(texts))]
    assert (np.diff(np.concatenate([d for d, _ in terms])) >= 0).all()
