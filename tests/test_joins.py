from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import joins as J
from tests.conftest import SF_SMALL, rows


def test_salted_join_equals_plain_join(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    plain = rows(li.join(o, "l_orderkey"))
    for n in (1, 3, 10):
        assert rows(J.salted_join(li, o, ["l_orderkey"], n=n, broadcast_max_rows=None)) == plain
    assert rows(J.salted_join(li, o, ["l_orderkey"])) == plain        # small: broadcast, no salt
    left = rows(o.join(li, "l_orderkey", "left"))
    assert rows(J.salted_join(o, li, ["l_orderkey"], n=4, how="left", broadcast_max_rows=None)) == left


def test_salted_join_never_broadcasts_the_replicated_side(spark):
    big = spark.range(5000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.range(7).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    salted = J.salted_join(big, small, ["k"], n=5, broadcast_max_rows=None)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
    direct = J.salted_join(big, small, ["k"], n=5)
    assert "BroadcastHashJoin" in direct._jdf.queryExecution().executedPlan().toString()
    assert rows(salted) == rows(direct)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=40),
       st.integers(1, 8))
def test_salted_join_property(spark, pairs, n):
    big = spark.createDataFrame(pairs, "k INT, v INT")
    small = spark.createDataFrame([(k, f"d{k}") for k in range(3)], "k INT, d STRING")
    assert rows(J.salted_join(big, small, ["k"], n=n, broadcast_max_rows=None)) == rows(big.join(small, "k"))


def test_salt_is_deterministic(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 3)
    small = spark.range(3).withColumnRenamed("id", "k")
    a = rows(J.salted_join(big, small, ["k"], n=7, broadcast_max_rows=None))
    b = rows(J.salted_join(big, small, ["k"], n=7, broadcast_max_rows=None))
    assert a == b


def test_measure_small_bounds(spark):
    df = spark.range(100).select(F.col("id"), F.lit("abcd").alias("s"))
    chk = J.measure_small(df, max_rows=100, max_bytes=10_000)
    assert chk.rows == 100 and chk.bytes == 100 * (8 + 4 + 8) and chk.small
    assert not J.measure_small(df, max_rows=99).small
    assert not J.measure_small(df, max_rows=1000, max_bytes=100).small


def test_join_dimension_broadcasts_only_when_small(spark):
    fact = spark.range(50).withColumn("k", F.col("id") % 5)
    dim = spark.range(5).withColumnRenamed("id", "k").withColumn("name", F.lit("x"))
    small = J.join_dimension(fact, dim, "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert not J.measure_small(dim, max_rows=2).small
    big = J.join_dimension(fact, dim, "k", max_rows=2)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()
    assert rows(small) == rows(big)


def test_skew_report_with_hot_key(spark):
    df = spark.createDataFrame([(1,)] * 300 + [(2,)] * 50 + [(k,) for k in range(3, 653)], "k INT")
    rep = J.skew_report(df, "k", 3)
    got = [(r["k"], r["rows"]) for r in rep.collect()]
    assert got == [(1, 300), (2, 50), (3, 1)]
    first = rep.first()
    assert first["total_rows"] == 1000 and first["n_keys"] == 652
    assert abs(first["share"] - 0.3) < 1e-9


def test_salted_join_with_a_map_column(spark):
    big = spark.createDataFrame([(1, {"a": 1}), (2, {"b": 2}), (1, None)], "k INT, m MAP<STRING, INT>")
    small = spark.createDataFrame([(1, "x"), (2, "y")], "k INT, d STRING")
    got = J.salted_join(big, small, ["k"], n=3, broadcast_max_rows=None)
    assert sorted((r["k"], r["d"]) for r in got.collect()) == [(1, "x"), (1, "x"), (2, "y")]


def test_measure_counts_what_is_inside_and_moves_no_rows(spark):
    wide = spark.createDataFrame([(["x" * 300_000],), (None,)], "a ARRAY<STRING>")
    assert J.measure_small(wide).bytes > 300_000
    assert not J.measure_small(wide, max_bytes=100_000).small
    deep = spark.createDataFrame([(({"k": ["y" * 5000]}, 1),)], "s STRUCT<m: MAP<STRING, ARRAY<STRING>>, n: INT>")
    assert J.measure_small(deep).bytes > 5000
    import inspect
    assert "limit(" not in inspect.getsource(J.measure_small)


def test_skew_join_never_moves_rows_without_key(spark):
    big = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"))
    small = spark.range(40).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = J.skew_join(big, small, ["k"], how=how, share=0.01)
        assert rows(got) == rows(big.join(small, "k", how))
    empty = J.skew_join(big.filter("k is null"), small, ["k"], how="left")
    assert empty.count() == 2000
