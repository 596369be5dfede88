import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import increment as I
from tests.conftest import rows

SCHEMA = "id BIGINT, k2 STRING, ts TIMESTAMP_NTZ, v STRING"


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def test_watermark_missing_empty_equal_late_and_null(spark):
    src = spark.createDataFrame(
        [(1, "a", _t(1), "late"), (2, "a", _t(5), "equal"), (3, "a", _t(6), "new"),
         (4, "a", None, "null ts")], SCHEMA)
    tgt = spark.createDataFrame([(9, "a", _t(5), "x")], SCHEMA)
    empty = tgt.limit(0)
    assert I.increment_by_watermark(src, None, "ts").count() == 4          # first load
    assert rows(I.increment_by_watermark(src, empty, "ts").select("id")) == [(1,), (2,), (3,)]
    assert rows(I.increment_by_watermark(src, tgt, "ts").select("id")) == [(3,)]


def test_watermark_literal_reaches_scan(spark, tmp_path):
    path = str(tmp_path / "ev")
    spark.createDataFrame([(1, "a", _t(1), "x"), (2, "a", _t(7), "y")], SCHEMA).write.parquet(path)
    src = spark.read.parquet(path)
    tgt = spark.createDataFrame([(9, "a", _t(5), "x")], SCHEMA)
    inc = I.increment_by_watermark(src, tgt, "ts")
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(ts" in plan
    assert rows(inc.select("id")) == [(2,)]


def test_new_rows_null_keys_duplicates_and_rerun(spark):
    src = spark.createDataFrame(
        [(1, "a", _t(1), "x"), (1, "a", _t(1), "x"), (2, None, _t(1), "y"), (3, "c", _t(1), "z")],
        SCHEMA)
    tgt = spark.createDataFrame([(1, "a", _t(0), "old"), (2, None, _t(0), "old")], SCHEMA)
    plain = I.new_rows(src, tgt, ["id", "k2"])
    assert rows(plain.select("id")) == [(2,), (3,)]            # NULL part never matches (D3)
    safe = I.new_rows(src, tgt, ["id", "k2"], null_safe=True)
    assert rows(safe.select("id")) == [(3,)]
    once = tgt.unionByName(safe)
    assert I.new_rows(src, once, ["id", "k2"], null_safe=True).count() == 0   # re-run adds 0


def test_version_increment(spark):
    src = spark.createDataFrame(
        [(1, "a", _t(1), "old version"), (2, "a", _t(9), "newer"), (3, "a", _t(5), "equal"),
         (4, "a", _t(0), "new key with old version"), (5, "a", None, "null version")],
        SCHEMA)
    tgt = spark.createDataFrame(
        [(1, "a", _t(5), "t"), (2, "a", _t(5), "t"), (2, "a", _t(6), "t2"), (3, "a", _t(5), "t"),
         (5, "a", _t(1), "t")], SCHEMA)
    inc = I.increment_by_version(src, tgt, ["id"], "ts")
    assert rows(inc.select("id", "v")) == [(2, "newer"), (4, "new key with old version")]
    assert I.increment_by_version(src, tgt.unionByName(inc), ["id"], "ts").count() == 0


def test_latest_by_key_ties_and_hot_key(spark):
    hot = [(1, f"h{i}", _t(i % 24), str(i)) for i in range(2000)]
    other = [(2, "b", _t(3), "x"), (2, "c", _t(3), "y"), (3, "d", None, "n")]
    df = spark.createDataFrame(hot + other, SCHEMA)
    out = I.latest_by_key(df, ["id"], "ts", "k2")
    got = {r["id"]: (r["k2"], r["v"]) for r in out.collect()}
    best_hot = max((h for h in hot), key=lambda r: (r[2], r[1]))
    assert got[1] == (best_hot[1], best_hot[3])
    assert got[2] == ("c", "y") and got[3] == ("d", "n")
    assert out.columns == df.columns


def test_high_water_default_and_type(spark):
    df = spark.createDataFrame([(1, "a", _t(3), "x")], SCHEMA)
    assert I.high_water(None, "ts") is None
    lit = I.high_water(df.limit(0), "ts")
    assert spark.range(1).select(lit.alias("h")).first()["h"] == dt.datetime(1900, 1, 1)
    h = I.high_water_frame(df, "ts", "1900-01-01 00:00:00").first()["high_water"]
    assert h == _t(3)
    assert df.filter(F.col("ts") > I.high_water(df, "ts")).count() == 0


def test_high_water_of_an_instant_in_a_dst_night(spark, tmp_path):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 05:40 UTC (01:40 EDT) and 06:20 UTC (01:20 EST) on 2024-11-03; the
        # target's max is the second one, whose text "01:20" reads back as
        # 05:20 UTC and would load both target rows again.
        df = spark.createDataFrame([(1730612400,), (1730614800,), (1730617200,)], "e LONG") \
            .select(F.timestamp_seconds("e").alias("t"))
        path = str(tmp_path / "dst")
        df.write.parquet(path)
        src = spark.read.parquet(path)
        tgt = src.filter(F.col("t") <= F.timestamp_seconds(F.lit(1730614800)))
        naive = F.lit(tgt.agg(F.max("t").cast("string")).first()[0]).cast("timestamp")
        assert src.filter(F.col("t") > naive).count() == 3          # the text round trip is wrong
        inc = I.increment_by_watermark(src, tgt, "t")
        assert [r[0] for r in inc.select(F.unix_seconds("t")).collect()] == [1730617200]
        assert "PushedFilters: [IsNotNull(t), GreaterThan(t," in inc._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


HISTORY = [(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, 5, None), (None, 1, "n"), (None, 1, "n"), (None, 3, None), (4, None, "z")]


def _history(spark):
    return spark.createDataFrame(HISTORY, "k INT, v INT, x STRING").withColumn("gone", F.col("k") == 2)


@pytest.mark.parametrize("keys", [["k"], ["k", "v"]])
@pytest.mark.parametrize("deleted", [None, "gone"])
def test_latest_of_a_batch_with_few_repeats_is_the_same(spark, keys, deleted):
    """F8: rows whose key is there once stay where they are, the result is that of the plain way."""
    df = _history(spark)
    plain = I.latest_by_key(df, keys, "v", deleted=deleted)
    assert rows(I.latest_by_key(df, keys, "v", deleted=deleted, few_repeats=True)) == rows(plain)
    some = I.latest_by_key(df, keys, "v", deleted=deleted, columns=["x", *keys])
    assert some.columns == ["x", *keys] and rows(some) == rows(plain.select("x", *keys))


def test_batch_without_repeats_is_not_moved(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), "id", F.col("id").cast("string").alias("x"))
    latest = I.latest_by_key(df, ["k", "id"], "x", few_repeats=True)
    assert "Exchange" not in latest._jdf.queryExecution().executedPlan().toString()
    assert rows(latest) == rows(df)


def test_increment_with_few_new_rows_moves_no_rows(spark):
    """F1, on a repeated load: the keys and versions find the new rows, which are those of the plain way."""
    src = _history(spark)
    tgt = spark.createDataFrame([(1, 1), (2, None), (None, 2), (4, 7), (5, 5)], "k INT, v INT")
    plain = I.increment_by_version(src, tgt, ["k"], "v", probe_max_rows=None)
    few = I.increment_by_version(src, tgt, ["k"], "v", probe_max_rows=None, few_new=True)
    assert rows(few) == rows(plain) and few.columns == src.columns
    assert "hashpartitioning" not in few._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("null_safe", [True, False])
def test_repeated_load_compares_buckets_of_keys(spark, null_safe):
    """keys and versions that both sides hold do not meet in a join; NULL keys, repeats and newer rows come out as before."""
    src = spark.createDataFrame([(i, i % 7) for i in range(300)] + [(None, 1), (5, 5)], "k INT, v INT")
    same = I.increment_by_version(src, src, ["k"], "v", null_safe, probe_max_rows=None, few_new=True)
    plain = I.increment_by_version(src, src, ["k"], "v", null_safe, probe_max_rows=None)
    assert rows(same) == rows(plain) and same.columns == src.columns
    if null_safe:
        assert same.isEmpty() and "Join" not in same._jdf.queryExecution().optimizedPlan().toString()
    held = src.filter("k > 3 or k is null").withColumn("v", F.when(F.col("k") == 9, F.lit(0)).when(F.col("k") == 8, F.lit(None)).otherwise(F.col("v")))
    held = held.unionByName(spark.createDataFrame([(10, 0), (1000, 1)], "k INT, v INT"))
    for tgt in (held, held.withColumn("k", F.col("k").cast("long"))):
        few = I.increment_by_version(src, tgt, ["k"], "v", null_safe, probe_max_rows=None, few_new=True)
        assert rows(few) == rows(I.increment_by_version(src, tgt, ["k"], "v", null_safe, probe_max_rows=None))


def test_buckets_differ_by_repeats_and_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (3, "y"), (4, "z"), (4, "z")], "k INT, v STRING")
    assert I._differing_buckets(a, a.orderBy(F.col("k").desc()), ["k"]) == []
    once = spark.createDataFrame([(1, "x"), (2, ""), (3, "y"), (4, "z"), (4, "z")], "k INT, v STRING")
    want = {r[0] for r in a.filter("k in (2, 3)").select(I._key_bucket(["k"])).collect()}
    assert set(I._differing_buckets(a, once, ["k"])) == want and len(want) == 2
