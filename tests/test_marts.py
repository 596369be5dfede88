"""The factorised marts against a brute-force fact built the reference's way
(join, explode, distinct, clean) on a small fixture with the edge rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import columns as C
from strata.operators import marts as M
from tests.conftest import rows

PARENTS = [
    (1, "A", "en", ["x", "x", None]),        # duplicate and NULL tag
    (1, " A ", "en", ["x"]),                 # second version, same name after cleaning
    (1, "B", "fr", ["w"]),                   # second version, other name
    (2, "C", "en", []),                      # empty tags: out of the fact
    (3, "D", "en", None),                    # NULL tags: out of the fact
    (4, "E", None, ["y"]),                   # no bridge rows
    (5, "Hot", "en", ["x", "z"]),            # hot parent
    (6, "F", "en", ["q"]),                   # no children
]
CHILDREN = [
    (1, 1, 10, "e10", None, 30), (1, 1, 10, "e10", None, 30), (1, 2, 11, "e11", None, None),
    (1, 2, 12, "  ", None, 45),
    (4, 1, 40, "e40", None, 20),
    (99, 1, 990, "orphan", None, 5),
] + [(5, 1 + i % 3, 500 + i, f"h{i}", None, i % 7) for i in range(60)]
BRIDGE = [
    (1, 100, "Ann", 1, "c1"), (1, 100, "Ann", 1, "c1"), (1, 101, "Bob", None, None),
    (1, None, None, None, None),
    (3, 100, "Ann", 2, "c2"),                # parent out of the fact
    (5, 100, "Ann", 3, "c3"), (5, 102, " Cy ", 4, "c4"), (5, 103, "Dee", 5, "c5"),
    (6, 104, "Eve", 6, "c6"),
]


def _star(spark):
    return M.Star(
        spark.createDataFrame(PARENTS, "show_id LONG, show_name STRING, language STRING, genres ARRAY<STRING>"),
        spark.createDataFrame(CHILDREN, "show_id LONG, season INT, episode_id LONG, episode_name STRING, "
                                        "airdate DATE, runtime LONG"),
        spark.createDataFrame(BRIDGE, "show_id LONG, person_id LONG, cast_name STRING, "
                                      "character_id LONG, character_name STRING"))


def _brute_fact(star):
    """The reference's fact, materialised (only ever on a tiny fixture)."""
    e, s, c = star.children.alias("e"), star.parents.alias("s"), star.bridge.alias("c")
    fact = (e.join(s, F.col("e.show_id") == F.col("s.show_id"))
            .join(c, F.col("e.show_id") == F.col("c.show_id"), "left")
            .select(F.col("e.show_id").alias("show_id"), "s.show_name", "s.language",
                    F.explode("s.genres").alias("genre"), "e.season", "e.episode_id",
                    "e.episode_name", "e.airdate", "e.runtime", "c.person_id", "c.cast_name",
                    "c.character_id", "c.character_name")
            .distinct())
    return C.clean_strings(fact)


def test_marts_equal_brute_force(spark):
    star = _star(spark)
    fact = _brute_fact(star)
    assert rows(M.episodes_per_season(star)) == rows(
        fact.groupBy("show_id", "show_name", "season").agg(F.count_distinct("episode_id")))
    got = {(r[0], r[1]): r[2] for r in M.avg_runtime(star).collect()}
    want = {(r[0], r[1]): r[2] for r in fact.groupBy("show_id", "show_name").agg(F.avg("runtime")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert rows(M.common_tags(star)) == rows(fact.groupBy("genre").agg(F.count(F.lit(1))))
    cs = fact.groupBy("person_id", "cast_name").agg(F.count_distinct("show_id").alias("total_shows"))
    assert rows(M.cast_shows(star)) == rows(cs)
    order = [F.col("total_shows").desc(), F.col("person_id").asc_nulls_last(), F.col("cast_name")]
    brute_top = cs.withColumn("rank", F.row_number().over(Window.orderBy(*order))).filter("rank <= 3")
    assert rows(M.top_members(star, k=3)) == rows(brute_top)
    summ = (fact.groupBy("show_id").agg(F.count(F.lit(1)).alias("fact_rows"),
                                        F.count_distinct("episode_id").alias("n_episodes"),
                                        F.count_distinct("person_id").alias("n_persons")))
    assert rows(M.fact_summary(star)) == rows(summ)


def test_top_members_fewer_rows_than_k_and_no_null_group(spark):
    star = _star(spark)
    top = M.top_members(star, k=50, keep_null=False)
    got = top.collect()
    assert all(r["person_id"] is not None for r in got)
    assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
    assert got[0]["person_id"] == 100 and got[0]["total_shows"] == 2


def test_common_tags_distinct_counts(spark):
    star = _star(spark)
    got = {r["genre"]: (r["distinct_shows"], r["distinct_episodes"])
           for r in M.common_tags(star, with_distinct=True).collect()}
    assert got["x"] == (2, 63) and got["NAFS"] == (1, 3) and got["y"] == (1, 1)


def test_build_marts_isolates_failures(spark):
    star = _star(spark)
    written = []

    def boom(_):
        raise ValueError("bad mart")

    res = M.build_marts(star, lambda n, df: written.append(n),
                        {"ok": M.common_tags, "bad": boom, "ok2": M.avg_runtime},
                        raise_at_end=False)
    assert sorted(res.built) == ["ok", "ok2"] and list(res.errors) == ["bad"]
    assert written == ["ok", "ok2"]


def test_top_k_ties_across_the_cut_are_stable(spark):
    df = spark.createDataFrame([(i, f"p{i}", 5 if i in (3, 7, 9) else i % 3) for i in range(1, 21)],
                               "person_id LONG, cast_name STRING, total_shows LONG")
    order = [F.col("total_shows").desc(), F.col("person_id").asc_nulls_last(), F.col("cast_name")]
    for _ in range(3):
        got = [(r["person_id"], r["rank"]) for r in M.top_k(df.repartition(7), order, 2).collect()]
        assert sorted(got, key=lambda t: t[1]) == [(3, 1), (7, 2)]   # 9 ties at 5 but falls outside


def test_shared_star_gives_the_same_marts(spark):
    star = _star(spark)
    shared = star.shared()
    assert shared.per_parent is not None
    for fn in (M.common_tags, M.fact_summary, M.avg_runtime):
        assert rows(fn(shared)) == rows(fn(star))
    assert rows(M.common_tags(shared, with_distinct=True)) == rows(M.common_tags(star, with_distinct=True))
    plan = M.common_tags(shared)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan                       # reads the checkpoint, not the children


def test_with_rank_equals_global_row_number(spark):
    df = spark.createDataFrame([(i, (i * 7919) % 1000, f"n{i % 13}") for i in range(3000)],
                               "id LONG, score LONG, name STRING")
    order = [F.col("score").desc(), F.col("id").asc()]
    got = M.with_rank(df, order, n=7)
    want = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    assert rows(got) == rows(want)
    # a value shared by a third of the rows still spreads over several ranges
    tied = spark.createDataFrame([(i, 5 if i < 1000 else i) for i in range(3000)], "id LONG, score LONG")
    ranked = M.with_rank(tied, [F.col("score").desc(), F.col("id").asc()], n=6)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 3001))


def _tables_between_exchanges(node):
    """The most hash tables of aggregations that lie in one stage of the plan."""
    most = [0]

    def walk(n):
        name = n.nodeName()
        below = [walk(n.children().apply(i)) for i in range(n.children().size())]
        here = sum(below) + (name == "HashAggregate")
        most[0] = max(most[0], here)
        return 0 if "Exchange" in name else here
    walk(node)
    return most[0]


def test_bridge_dealt_by_its_pairs_counts_in_several_stages(spark):
    """of a bridge that is dealt out by parent and person already, every
    aggregation ran in one stage, and a task held all their tables."""
    star = _star(spark)
    pairs = star.bridge.select("show_id", "person_id").distinct()
    people = star.bridge.select("person_id", "cast_name", "character_id", "character_name").distinct()
    dealt = M.replace(star, bridge=pairs.join(F.broadcast(people), "person_id"))
    assert rows(M.fact_summary(dealt)) == rows(M.fact_summary(M.replace(star, bridge=dealt.bridge.localCheckpoint())))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M._per_parent_counts(dealt)._jdf.queryExecution().executedPlan()
        assert _tables_between_exchanges(plan) <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_and_keys_count_as_distinct_does(spark):
    """NULL keys are rows but no keys; rows that differ in a NULL differ."""
    star = _star(spark)
    for df, columns, key in ((star.bridge, M.BRIDGE_COLS, "person_id"), (star.children, M.CHILD_COLS, "episode_id")):
        plain = df.select(*columns).distinct().groupBy("show_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k"))
        assert rows(M._rows_and_keys(df, columns, key, "n", "k")) == rows(plain)
