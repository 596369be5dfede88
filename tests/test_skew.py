"""One key holding a third of the rows: results must not change when AQE
splits the hot partitions, and no step may gather the hot key's product."""

import contextlib
import re

from pyspark.sql import functions as F

from strata.operators import increment as I
from strata.operators import joins as J
from strata.operators import marts as M
from strata.plans import standin as S
from strata.session import fine_partitions
from tests.conftest import rows
from tests.test_marts import _brute_fact

FORCE_SPLIT = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_star(spark):
    parents = spark.range(60).select(
        F.col("id").alias("show_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("show_name"),
        F.lit("en").alias("language"),
        F.when(F.col("id") % 7 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("g"), (F.col("id") % 3).cast("string"))).alias("genres"))
    # show 0 is excluded by its empty tags; show 1 is hot: a third of the children
    kids = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(1)).otherwise(F.col("id") % 60).cast("long").alias("show_id"),
        (F.col("id") % 4).cast("int").alias("season"), F.col("id").alias("episode_id"),
        F.lit("e").alias("episode_name"), F.lit(None).cast("date").alias("airdate"),
        (F.col("id") % 50).alias("runtime"))
    bridge = spark.range(600).select(
        F.when(F.col("id") < 200, F.lit(1)).otherwise(F.col("id") % 50).cast("long").alias("show_id"),
        (F.col("id") % 97).alias("person_id"), F.concat(F.lit("p"), (F.col("id") % 97).cast("string")).alias("cast_name"),
        F.col("id").alias("character_id"), F.lit("c").alias("character_name"))
    return M.Star(parents, kids, bridge)


def test_marts_under_forced_skew_split(spark):
    star = _skewed_star(spark)
    fact = _brute_fact(star)
    want_tags = rows(fact.groupBy("genre").agg(F.count(F.lit(1))))
    want_cast = rows(fact.groupBy("person_id", "cast_name").agg(F.count_distinct("show_id")))
    want_eps = rows(fact.groupBy("show_id", "show_name", "season").agg(F.count_distinct("episode_id")))
    with conf(spark, FORCE_SPLIT):
        assert rows(M.common_tags(star)) == want_tags
        assert rows(M.cast_shows(star)) == want_cast
        assert rows(M.episodes_per_season(star)) == want_eps


def test_increments_under_forced_skew_split(spark):
    hot = [(1, i % 40) for i in range(2000)]
    src = spark.createDataFrame(hot + [(k, 50) for k in range(2, 300)], "k LONG, v INT")
    tgt = spark.createDataFrame([(1, 10)] * 500 + [(k, 45) for k in range(2, 150)], "k LONG, v INT")
    plain = rows(I.increment_by_version(src, tgt, ["k"], "v", probe_max_rows=None))
    probed = rows(I.increment_by_version(src, tgt, ["k"], "v"))
    anti_plain = rows(I.new_rows(src, tgt, ["k"], probe_max_rows=None))
    with conf(spark, FORCE_SPLIT):
        assert rows(I.increment_by_version(src, tgt, ["k"], "v", probe_max_rows=None)) == plain
        assert rows(I.new_rows(src, tgt, ["k"], probe_max_rows=None)) == anti_plain
    assert probed == plain
    assert len([r for r in plain if r[0] == 1]) == len([h for h in hot if h[1] > 10])


def test_hot_keys_finds_the_hot_key_without_cap(spark):
    df = spark.createDataFrame([(1,)] * 1000 + [(k,) for k in range(2, 2002)], "k INT")
    got = {r["k"]: r["rows"] for r in J.hot_keys(df, "k", share=0.0003).collect()}
    assert got[1] == 1000 and len(got) == 2001        # every key reaches 1/3000


def test_no_step_builds_the_pairs(spark):
    star = _skewed_star(spark)
    for fn in (M.common_tags, M.fact_summary, M.cast_shows, M.episodes_per_season, M.avg_runtime):
        plan = fn(star)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_skew_join_equals_plain_join(spark):
    big = spark.createDataFrame([(1, i) for i in range(900)] + [(k, k) for k in range(2, 200)] + [(None, 5)],
                                "k LONG, v LONG")
    small = spark.createDataFrame([(k, f"d{k}") for k in range(0, 150)] + [(1, "again")], "k LONG, d STRING")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(J.skew_join(big, small, ["k"], how=how, share=0.05, n=4)) == rows(big.join(small, ["k"], how))
    no_hot = spark.createDataFrame([(k, k) for k in range(100)], "k LONG, v LONG")
    assert rows(J.skew_join(no_hot, small, ["k"], share=0.5)) == rows(no_hot.join(small, ["k"]))


def _dealt(df, column):
    """Partitions of the plan's exchanges by ``column`` alone."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sorted(int(n) for n in re.findall(rf"Exchange hashpartitioning\({column}#\d+L?, (\d+)\)", plan))


def test_people_are_joined_in_fine_partitions_without_a_further_shuffle(spark):
    """the tasks of the semi join, which also make people's shows
    distinct, had as many rows as the session's few partitions left them."""
    star = _skewed_star(spark)
    fact = _brute_fact(star)
    want = rows(fact.where("person_id is not null").groupBy("person_id", "cast_name").agg(F.count_distinct("show_id")))
    fine = fine_partitions(spark)
    assert fine > int(spark.conf.get("spark.sql.shuffle.partitions"))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        people = M.cast_shows(star, keep_null=False)
        assert _dealt(people, "show_id").count(fine) == 2          # the parents and the bridge rows
        plan = people._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(person_id" in plan and not re.search(r"hashpartitioning\(person_id#\d+L?, cast_name#\d+, show_id", plan)
        assert rows(people) == want
    with conf(spark, FORCE_SPLIT):
        assert rows(M.cast_shows(star, keep_null=False)) == want


def test_bridge_pairs_are_joined_in_fine_partitions(spark, tmp_path):
    """so were line items and orders, with the pairs' hash table."""
    items = [(i % 40, i % 7) for i in range(300)] + [(None, 1), (3, None), (3, None), (99, 5)]
    orders = [(k, k % 9) for k in range(40)] + [(5, 2), (6, None), (None, 4)]
    spark.createDataFrame(items, "l_orderkey LONG, l_suppkey LONG").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG").write.parquet(f"{tmp_path}/orders.parquet")
    want = {(c, s) for k, s in items for o, c in orders if k is not None and k == o}
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        pairs = S.bridge_pairs(spark, str(tmp_path))
        assert _dealt(pairs, "l_orderkey") == _dealt(pairs, "o_orderkey") == [fine_partitions(spark)]
        got = pairs.collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    again = S.bridge_pairs(spark, str(tmp_path)).collect()
    assert len(again) == len(want) and {tuple(r) for r in again} == want
