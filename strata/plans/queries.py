"""Driver queries over the testdata, one per operator.

Every query reads the whole given tables. Where the testdata lacks the
NULLs, blanks and bad text an operator exists for, the noise is derived from
existing columns of every row (never a subset of rows), the same way in
Spark and in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import safe_date
from strata.operators import columns as C
from strata.operators import increment as I
from strata.operators import joins as J
from strata.operators import marts as M
from strata.operators import setops as U
from strata.operators import snapshots as SN
from strata.plans import standin as S
from strata.plans.registry import query
from strata.sources.landing import parse_json


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return S.read(spark, sf, name)


# ---------------------------------------------------------------- star (SQL)
# The stand-in star and the reference's fact, as DuckDB CTEs. The fact is
# built here, in the oracle only, so the factorised Spark marts are checked
# against the real fan-out.
STAR_SQL_TEMPLATE = """
WITH ord AS (SELECT o_orderkey, {custkey} AS o_custkey, o_orderdate, o_orderpriority, o_totalprice
             FROM orders),
shows AS (
  SELECT c.c_custkey AS show_id, c.c_name AS show_name, n.n_name AS language,
         CASE WHEN c.c_acctbal < 0 THEN CAST([] AS VARCHAR[])
              ELSE [c.c_mktsegment, r.r_name] END AS genres
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
episodes AS (
  SELECT o_custkey AS show_id, CAST(year(o_orderdate) AS INTEGER) AS season,
         o_orderkey AS episode_id, o_orderpriority AS episode_name,
         CAST(o_orderdate AS DATE) AS airdate,
         CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS runtime
  FROM ord),
cast_ AS (
  SELECT DISTINCT o.o_custkey AS show_id, l.l_suppkey AS person_id, s.s_name AS cast_name,
         CAST(s.s_nationkey AS BIGINT) AS character_id, n.n_name AS character_name
  FROM lineitem l JOIN ord o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey),
show_genres AS (
  SELECT show_id, show_name, language, unnest(genres) AS genre FROM shows),
fact AS (
  SELECT DISTINCT e.show_id, g.show_name, g.language, g.genre, e.season, e.episode_id,
         e.episode_name, e.airdate, e.runtime, c.person_id, c.cast_name,
         c.character_id, c.character_name
  FROM episodes e JOIN show_genres g ON e.show_id = g.show_id
  LEFT JOIN cast_ c ON e.show_id = c.show_id),
clean_fact AS (
  SELECT show_id, COALESCE(NULLIF(TRIM(show_name), ''), 'NAFS') AS show_name,
         COALESCE(NULLIF(TRIM(language), ''), 'NAFS') AS language,
         COALESCE(NULLIF(TRIM(genre), ''), 'NAFS') AS genre, season, episode_id,
         COALESCE(NULLIF(TRIM(episode_name), ''), 'NAFS') AS episode_name, airdate, runtime,
         person_id, COALESCE(NULLIF(TRIM(cast_name), ''), 'NAFS') AS cast_name, character_id,
         COALESCE(NULLIF(TRIM(character_name), ''), 'NAFS') AS character_name
  FROM fact)
"""
STAR_SQL = STAR_SQL_TEMPLATE.format(custkey="o_custkey")
# Every third order moves to parent 0 (see standin.HOT_PARENT).
HOT_STAR_SQL = STAR_SQL_TEMPLATE.format(
    custkey=f"CASE WHEN o_orderkey % 3 = 0 THEN CAST({S.HOT_PARENT} AS BIGINT) ELSE o_custkey END")


# ---------------------------------------------------------------- sources
@query("json_parse", """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""")
def json_parse(spark, sf):
    ev = parse_json(_t(spark, sf, "events"), "props", "k INT", alias="p")
    return ev.select("event_id", "user_id", F.col("p.k").alias("k"))


@query("json_flatten", """
SELECT event_id,
       CASE WHEN event_type <> 'error' THEN user_id END AS payload_user_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS payload_event_type,
       CASE WHEN event_type <> 'error' THEN value END AS payload_detail_value,
       CASE WHEN event_type <> 'error'
            THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS payload_detail_k
FROM events""")
def json_flatten(spark, sf):
    ev = parse_json(_t(spark, sf, "events"), "props", "k INT", alias="p")
    payload = F.struct("user_id", "event_type",
                       F.struct("value", F.col("p.k").alias("k")).alias("detail"))
    nested = ev.select("event_id",
                       F.when(F.col("event_type") != "error", payload).alias("payload"))
    return C.flatten_structs(nested)


@query("parent_tag", """
SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS show_id FROM orders""")
def parent_tag(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"),
                                      F.col("o_orderstatus").alias("status"), "o_custkey")
    return C.with_parent_id(o, "show_id", "o_custkey").drop("o_custkey")


# ---------------------------------------------------------------- columns
@query("normalize_names", """
SELECT c_custkey AS c_cust_key, c_name AS cust_name_full, c_acctbal AS acct_bal,
       c_mktsegment AS mkt_segment
FROM customer""")
def normalize_names(spark, sf):
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("C.Cust Key"), F.col("c_name").alias("Cust-Name (Full)"),
        F.col("c_acctbal").alias("Acct Bal"), F.col("c_mktsegment").alias("MKT.Segment"))
    return C.normalize_names(c)


# Noise derived from p_size, the same in Spark and SQL.
def _noisy_part(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    s = F.col("p_size")
    name = (F.when(s % 5 == 0, F.lit(None).cast("string"))
            .when(s % 7 == 0, F.lit("   "))
            .when(s % 3 == 0, F.concat(F.lit("  "), "p_name", F.lit(" ")))
            .otherwise(F.col("p_name")))
    brand = F.when(s % 11 == 0, F.lit("")).otherwise(F.col("p_brand"))
    ptype = (F.when(s % 13 == 0, F.lit("\t")).when(s % 17 == 0, F.lit("NAFS"))
             .otherwise(F.col("p_type")))
    return p.select("p_partkey", name.alias("name"), brand.alias("brand"),
                    ptype.alias("type"), "p_retailprice", "p_size")


NOISY_PART_SQL = """
noisy AS (
  SELECT p_partkey,
         CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN '   '
              WHEN p_size % 3 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS name,
         CASE WHEN p_size % 11 = 0 THEN '' ELSE p_brand END AS brand,
         CASE WHEN p_size % 13 = 0 THEN chr(9) WHEN p_size % 17 = 0 THEN 'NAFS'
              ELSE p_type END AS type,
         p_retailprice, p_size
  FROM part)"""


@query("require_keys", f"""
WITH {NOISY_PART_SQL}
SELECT p_partkey, name, brand FROM noisy WHERE name IS NOT NULL AND brand IS NOT NULL""")
def require_keys(spark, sf):
    p = _noisy_part(spark, sf).select("p_partkey", "name", "brand")
    return C.require_keys(p, ["name", "brand"])


@query("clean_strings", f"""
WITH {NOISY_PART_SQL}
SELECT p_partkey, COALESCE(NULLIF(TRIM(name), ''), 'NAFS') AS name,
       COALESCE(NULLIF(TRIM(brand), ''), 'NAFS') AS brand,
       COALESCE(NULLIF(TRIM(type), ''), 'NAFS') AS type,
       p_retailprice, [name, brand] AS raw
FROM noisy""")
def clean_strings(spark, sf):
    p = _noisy_part(spark, sf)
    p = p.select("p_partkey", "name", "brand", "type", "p_retailprice",
                 F.array("name", "brand").alias("raw"))
    return C.clean_strings(p)


@query("fill_numbers", """
SELECT event_id,
       COALESCE(CASE WHEN event_type = 'error' THEN NULL ELSE value END, 0.0) AS value,
       COALESCE(CASE WHEN event_type = 'purchase' THEN NULL ELSE user_id END, -1) AS user_id
FROM events""")
def fill_numbers(spark, sf):
    ev = _t(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_type") == "purchase", F.lit(None))
        .otherwise(F.col("user_id")).alias("user_id"))
    return C.fill_numbers(ev, {"value": 0.0, "user_id": -1})


def _typed_text(spark, sf) -> DataFrame:
    p = _t(spark, sf, "part")
    s = F.col("p_size")
    key = F.when(s % 6 == 0, F.lit("abc")).otherwise(F.col("p_partkey").cast("string"))
    size = F.when(s % 4 == 0, F.lit("")).otherwise(F.col("p_size").cast("string"))
    date = F.when(s % 10 == 0, F.lit("2020-02-30")).otherwise(
        F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), s), "yyyy-MM-dd"))
    stamp = F.when(s % 8 == 0, F.lit("abc")).otherwise(
        F.format_string("2024-01-%02dT%02d:30:00+%02d:00", s % 28 + 1, s % 24, s % 12))
    return p.select("p_partkey", key.alias("key_text"), size.alias("size_text"),
                    date.alias("date_text"), stamp.alias("stamp_text"))


@query("typed_columns", """
SELECT p_partkey,
       TRY_CAST(CASE WHEN p_size % 6 = 0 THEN 'abc' ELSE CAST(p_partkey AS VARCHAR) END AS BIGINT) AS key_text,
       TRY_CAST(NULLIF(TRIM(CASE WHEN p_size % 4 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END), '') AS INTEGER) AS size_text,
       TRY_CAST(CASE WHEN p_size % 10 = 0 THEN '2020-02-30'
                     ELSE strftime(DATE '1995-01-01' + p_size, '%Y-%m-%d') END AS DATE) AS date_text,
       CAST(epoch(TRY_CAST(CASE WHEN p_size % 8 = 0 THEN 'abc'
            ELSE printf('2024-01-%02dT%02d:30:00+%02d:00', p_size % 28 + 1, p_size % 24, p_size % 12)
            END AS TIMESTAMPTZ)) AS BIGINT) AS stamp_text
FROM part""")
def typed_columns(spark, sf):
    t = _typed_text(spark, sf)
    return C.apply_types(t, {
        "key_text": "bigint",
        "size_text": "int",
        "date_text": safe_date("date_text"),
        "stamp_text": F.unix_seconds(F.col("stamp_text").try_cast("timestamp")),
    })


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS partition_year,
       CAST(month(o_orderdate) AS INTEGER) AS partition_month,
       CAST(day(o_orderdate) AS INTEGER) AS partition_day
FROM orders""")
def date_parts(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return C.with_date_parts(o, "o_orderdate").drop("o_orderdate")


@query("explode_tags", STAR_SQL + """
SELECT show_id, genre FROM show_genres""")
def explode_tags(spark, sf):
    return C.explode_rows(S.shows(spark, sf), "genres", "genre", keep=["show_id"])


@query("explode_tags_outer", STAR_SQL + """
SELECT show_id, unnest(CASE WHEN len(genres) = 0 THEN [NULL::VARCHAR] ELSE genres END) AS genre
FROM shows""")
def explode_tags_outer(spark, sf):
    return C.explode_rows(S.shows(spark, sf), "genres", "genre", outer=True, keep=["show_id"])


@query("distinct_rows", """
SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem""")
def distinct_rows(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()


# ---------------------------------------------------------------- increments
EVENT_CUT = "2024-01-15 00:00:00"


def _events_before(spark, sf, cut: str = EVENT_CUT) -> DataFrame:
    return _t(spark, sf, "events").filter(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))


@query("anti_join_single", f"""
SELECT event_id, user_id, ts FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '{EVENT_CUT}'
                  AND t.event_id = e.event_id)""")
def anti_join_single(spark, sf):
    src = _t(spark, sf, "events").select("event_id", "user_id", "ts")
    return I.new_rows(src, _events_before(spark, sf), ["event_id"])


# Bridge snapshots: everything, and what was known from line items shipped
# before a cut. A person is unknown (NULL) when the supplier's balance is
# negative, so NULL key parts occur.
BRIDGE_CUT = "1998-01-01 00:00:00"


def _bridge(spark, sf, before: str | None) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    if before:
        li = li.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    o = _t(spark, sf, "orders")
    s = _t(spark, sf, "supplier")
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
            .select(F.col("o_custkey").alias("show_id"),
                    F.when(F.col("s_acctbal") >= 0, F.col("l_suppkey")).alias("person_id"),
                    F.col("l_linestatus").alias("status"))
            .distinct())


BRIDGE_SQL = f"""
WITH b AS (
  SELECT DISTINCT o.o_custkey AS show_id,
         CASE WHEN s.s_acctbal >= 0 THEN l.l_suppkey END AS person_id,
         l.l_linestatus AS status, l.l_shipdate < TIMESTAMP '{BRIDGE_CUT}' AS old
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey),
src AS (SELECT DISTINCT show_id, person_id, status FROM b),
tgt AS (SELECT DISTINCT show_id, person_id, status FROM b WHERE old)
"""


@query("anti_join_composite", BRIDGE_SQL + """
SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE tgt.show_id = src.show_id AND tgt.person_id = src.person_id
                      AND tgt.status = src.status)""")
def anti_join_composite(spark, sf):
    return I.new_rows(_bridge(spark, sf, None), _bridge(spark, sf, BRIDGE_CUT),
                      ["show_id", "person_id", "status"])


@query("anti_join_nullsafe", BRIDGE_SQL + """
SELECT * FROM src WHERE NOT EXISTS (
  SELECT 1 FROM tgt WHERE tgt.show_id IS NOT DISTINCT FROM src.show_id
                      AND tgt.person_id IS NOT DISTINCT FROM src.person_id
                      AND tgt.status IS NOT DISTINCT FROM src.status)""")
def anti_join_nullsafe(spark, sf):
    # The source here is a derived join, not a scan of new files, so the
    # shuffled plan is used (measuring its keys first would compute it twice).
    return I.new_rows(_bridge(spark, sf, None), _bridge(spark, sf, BRIDGE_CUT),
                      ["show_id", "person_id", "status"], null_safe=True, probe_max_rows=None)


@query("high_water", f"""
SELECT 'before_cut' AS scope,
       COALESCE(MAX(ts), TIMESTAMP '1900-01-01') AS high_water
FROM events WHERE ts < TIMESTAMP '{EVENT_CUT}'
UNION ALL
SELECT 'empty' AS scope, COALESCE(MAX(ts), TIMESTAMP '1900-01-01') AS high_water
FROM events WHERE ts < TIMESTAMP '2000-01-01'""")
def high_water(spark, sf):
    a = I.high_water_frame(_events_before(spark, sf), "ts", "1900-01-01 00:00:00")
    b = I.high_water_frame(_events_before(spark, sf, "2000-01-01 00:00:00"), "ts",
                           "1900-01-01 00:00:00")
    return (a.select(F.lit("before_cut").alias("scope"), "high_water")
            .unionByName(b.select(F.lit("empty").alias("scope"), "high_water")))


@query("watermark_increment", f"""
SELECT event_id, user_id, ts, value FROM events
WHERE ts > (SELECT COALESCE(MAX(ts), TIMESTAMP '1900-01-01') FROM events
            WHERE ts < TIMESTAMP '{EVENT_CUT}')""")
def watermark_increment(spark, sf):
    src = _t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return I.increment_by_watermark(src, _events_before(spark, sf), "ts")


@query("watermark_first_load", """
SELECT event_id, user_id, ts, value FROM events
WHERE ts > (SELECT COALESCE(MAX(ts), TIMESTAMP '1900-01-01') FROM events
            WHERE ts < TIMESTAMP '2000-01-01')""")
def watermark_first_load(spark, sf):
    src = _t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    empty_target = _events_before(spark, sf, "2000-01-01 00:00:00")
    return I.increment_by_watermark(src, empty_target, "ts")


@query("version_increment", f"""
WITH tv AS (SELECT user_id, MAX(ts) AS tv FROM events
            WHERE ts < TIMESTAMP '{EVENT_CUT}' AND event_type = 'click' GROUP BY user_id)
SELECT e.event_id, e.user_id, e.ts, e.event_type FROM events e
LEFT JOIN tv ON e.user_id IS NOT DISTINCT FROM tv.user_id
WHERE tv.user_id IS NULL OR e.ts > tv.tv""")
def version_increment(spark, sf):
    src = _t(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    tgt = _events_before(spark, sf).filter(F.col("event_type") == "click")
    return I.increment_by_version(src, tgt, ["user_id"], "ts")


@query("latest_by_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_by_key(spark, sf):
    return I.latest_by_key(_t(spark, sf, "events"), ["user_id"], "ts", "event_id")


# ---------------------------------------------------------------- joins
@query("broadcast_join", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def broadcast_join(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                         "c_name", "c_mktsegment")
    return J.join_dimension(o, c, "o_custkey")


@query("left_join", """
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_suppkey
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def left_join(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                          "l_linenumber", "l_suppkey")
    return o.join(li, "o_orderkey", "left")


@query("salted_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, o.o_custkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def salted_join(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # Always take the salted (shuffled) path here, to exercise it.
    return J.salted_join(li, o, ["l_orderkey"], n=10, broadcast_max_rows=None).drop("l_partkey")


@query("salted_left_join", """
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_suppkey
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def salted_left_join(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                          "l_linenumber", "l_suppkey")
    return J.salted_join(o, li, ["o_orderkey"], n=8, how="left", broadcast_max_rows=None)


@query("skew_join", """
WITH ord AS (SELECT o_orderkey,
                    CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE o_custkey END AS o_custkey
             FROM orders)
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM ord o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def skew_join(spark, sf):
    # Every third order belongs to one customer (the hot-parent stand-in).
    o = S.episodes(spark, sf, hot=True).select(F.col("episode_id").alias("o_orderkey"),
                                                F.col("show_id").alias("o_custkey"))
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.skew_join(o, c, ["o_custkey"], how="left", share=0.01, n=16)


NULL_KEYS_SQL = """
WITH ord AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS o_custkey FROM orders),
cust AS (SELECT * FROM customer WHERE c_custkey % 5 > 0)
SELECT {} FROM ord o {}"""


def _null_keys(spark, sf, how: str) -> DataFrame:
    """A third of the orders has no customer; a fifth of the customers is missing."""
    key = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("o_custkey")
    o = _t(spark, sf, "orders").select("o_orderkey", key)
    c = _t(spark, sf, "customer").filter(F.col("c_custkey") % 5 > 0).select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.skew_join(o, c, ["o_custkey"], how=how, share=0.0005, n=16)


@query("skew_join_null_left", NULL_KEYS_SQL.format(
    "o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment", "LEFT JOIN cust c ON o.o_custkey = c.c_custkey"))
def skew_join_null_left(spark, sf):
    return _null_keys(spark, sf, "left")


@query("skew_join_null_anti", NULL_KEYS_SQL.format(
    "o.o_orderkey, o.o_custkey", "WHERE NOT EXISTS (SELECT 1 FROM cust c WHERE o.o_custkey = c.c_custkey)"))
def skew_join_null_anti(spark, sf):
    return _null_keys(spark, sf, "left_anti")


@query("hot_keys", """
WITH c AS (SELECT o_custkey, COUNT(*) AS rows FROM orders GROUP BY o_custkey),
t AS (SELECT SUM(rows) AS total FROM c)
SELECT o_custkey, rows, ROUND(rows / total, 6) AS share, CAST(total AS BIGINT) AS total_rows
FROM c, t WHERE rows / total >= 0.001""")
def hot_keys(spark, sf):
    return J.hot_keys(_t(spark, sf, "orders"), "o_custkey", share=0.001)


@query("skew_report", """
WITH c AS (SELECT o_custkey, COUNT(*) AS rows FROM orders GROUP BY o_custkey),
t AS (SELECT SUM(rows) AS total, COUNT(*) AS n_keys, MAX(rows) AS mx FROM c)
SELECT o_custkey, rows, ROUND(rows / total, 6) AS share, CAST(total AS BIGINT) AS total_rows,
       n_keys, ROUND(mx / (total / n_keys), 6) AS max_over_mean
FROM c, t ORDER BY rows DESC, o_custkey LIMIT 20""")
def skew_report(spark, sf):
    return J.skew_report(_t(spark, sf, "orders"), "o_custkey", 20)


@query("skew_report_events", """
WITH c AS (SELECT user_id, COUNT(*) AS rows FROM events GROUP BY user_id),
t AS (SELECT SUM(rows) AS total, COUNT(*) AS n_keys, MAX(rows) AS mx FROM c)
SELECT user_id, rows, ROUND(rows / total, 6) AS share, CAST(total AS BIGINT) AS total_rows,
       n_keys, ROUND(mx / (total / n_keys), 6) AS max_over_mean
FROM c, t ORDER BY rows DESC, user_id LIMIT 20""")
def skew_report_events(spark, sf):
    return J.skew_report(_t(spark, sf, "events"), "user_id", 20)


# ---------------------------------------------------------------- star, marts
@query("star_fact", STAR_SQL + """
SELECT show_id, COUNT(*) AS fact_rows, COUNT(DISTINCT episode_id) AS n_episodes,
       COUNT(DISTINCT person_id) AS n_persons
FROM fact GROUP BY show_id""")
def star_fact(spark, sf):
    return M.fact_summary(S.star(spark, sf))


@query("episodes_per_season", STAR_SQL + """
SELECT show_id, show_name, season, COUNT(DISTINCT episode_id) AS total_episodes
FROM clean_fact GROUP BY show_id, show_name, season""")
def episodes_per_season(spark, sf):
    return M.episodes_per_season(S.star(spark, sf))


@query("avg_runtime", STAR_SQL + """
SELECT show_id, show_name, AVG(runtime) AS avg_runtime
FROM clean_fact GROUP BY show_id, show_name""")
def avg_runtime(spark, sf):
    return M.avg_runtime(S.star(spark, sf))


@query("global_rank", """
SELECT o_custkey, n_orders, row_number() OVER (ORDER BY n_orders DESC, o_custkey) AS rank
FROM (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey)""")
def global_rank(spark, sf):
    counts = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return M.with_rank(counts, [F.col("n_orders").desc(), F.col("o_custkey").asc()])


@query("top_members", STAR_SQL + """
SELECT person_id, cast_name, total_shows,
       CAST(row_number() OVER (ORDER BY total_shows DESC, person_id ASC NULLS LAST,
                               cast_name) AS INTEGER) AS rank
FROM (SELECT person_id, cast_name, COUNT(DISTINCT show_id) AS total_shows
      FROM clean_fact GROUP BY person_id, cast_name)
ORDER BY total_shows DESC, person_id ASC NULLS LAST, cast_name LIMIT 10""")
def top_members(spark, sf):
    return M.top_members(S.star(spark, sf), k=10)


@query("top_members_named", STAR_SQL + """
SELECT person_id, cast_name, total_shows,
       CAST(row_number() OVER (ORDER BY total_shows DESC, person_id ASC NULLS LAST,
                               cast_name) AS INTEGER) AS rank
FROM (SELECT person_id, cast_name, COUNT(DISTINCT show_id) AS total_shows
      FROM clean_fact WHERE person_id IS NOT NULL GROUP BY person_id, cast_name)
ORDER BY total_shows DESC, person_id ASC NULLS LAST, cast_name LIMIT 10""")
def top_members_named(spark, sf):
    return M.top_members(S.star(spark, sf), k=10, keep_null=False)


@query("common_tags", STAR_SQL + """
SELECT genre, COUNT(*) AS genre_count FROM clean_fact GROUP BY genre""")
def common_tags(spark, sf):
    return M.common_tags(S.star(spark, sf))


@query("common_tags_distinct", STAR_SQL + """
SELECT genre, COUNT(*) AS genre_count, COUNT(DISTINCT show_id) AS distinct_shows,
       COUNT(DISTINCT episode_id) AS distinct_episodes
FROM clean_fact GROUP BY genre""")
def common_tags_distinct(spark, sf):
    return M.common_tags(S.star(spark, sf), with_distinct=True)


# Hot-key variants: one parent holds a third of all children and of the
# bridge; its share of the reference's fan-out is about (n/3) x suppliers x 2.
@query("star_fact_hot", HOT_STAR_SQL + """
SELECT show_id, COUNT(*) AS fact_rows, COUNT(DISTINCT episode_id) AS n_episodes,
       COUNT(DISTINCT person_id) AS n_persons
FROM fact GROUP BY show_id""")
def star_fact_hot(spark, sf):
    return M.fact_summary(S.star(spark, sf, hot=True))


@query("episodes_per_season_hot", HOT_STAR_SQL + """
SELECT show_id, show_name, season, COUNT(DISTINCT episode_id) AS total_episodes
FROM clean_fact GROUP BY show_id, show_name, season""")
def episodes_per_season_hot(spark, sf):
    return M.episodes_per_season(S.star(spark, sf, hot=True))


@query("avg_runtime_hot", HOT_STAR_SQL + """
SELECT show_id, show_name, AVG(runtime) AS avg_runtime
FROM clean_fact GROUP BY show_id, show_name""")
def avg_runtime_hot(spark, sf):
    return M.avg_runtime(S.star(spark, sf, hot=True))


@query("top_members_hot", HOT_STAR_SQL + """
SELECT person_id, cast_name, total_shows,
       CAST(row_number() OVER (ORDER BY total_shows DESC, person_id ASC NULLS LAST,
                               cast_name) AS INTEGER) AS rank
FROM (SELECT person_id, cast_name, COUNT(DISTINCT show_id) AS total_shows
      FROM clean_fact GROUP BY person_id, cast_name)
ORDER BY total_shows DESC, person_id ASC NULLS LAST, cast_name LIMIT 10""")
def top_members_hot(spark, sf):
    return M.top_members(S.star(spark, sf, hot=True), k=10)


@query("common_tags_hot", HOT_STAR_SQL + """
SELECT genre, COUNT(*) AS genre_count, COUNT(DISTINCT show_id) AS distinct_shows,
       COUNT(DISTINCT episode_id) AS distinct_episodes
FROM clean_fact GROUP BY genre""")
def common_tags_hot(spark, sf):
    return M.common_tags(S.star(spark, sf, hot=True), with_distinct=True)


# ---------------------------------------------------------------- unions
@query("union_missing", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, ts, NULL::DOUBLE AS value, NULL::VARCHAR AS props
FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, 'u' || CAST(user_id AS VARCHAR) AS user_id, NULL::TIMESTAMP AS ts, value, NULL::VARCHAR AS props
FROM events WHERE event_type = 'view'
UNION ALL
SELECT event_id, NULL::VARCHAR AS user_id, NULL::TIMESTAMP AS ts, value, props
FROM events WHERE event_type NOT IN ('click', 'view')""")
def union_missing(spark, sf):
    ev = _t(spark, sf, "events")
    a = ev.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    b = ev.filter(F.col("event_type") == "view").select(
        "value", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"), "event_id")
    c = ev.filter(~F.col("event_type").isin("click", "view")).select("props", "event_id", "value")
    return U.union_all_by_name([a, b, c])


@query("union_exact", """
SELECT CAST(CAST(o_orderkey + 9007199254740993 AS DECIMAL(23, 4)) AS VARCHAR) AS amount,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS at, CAST(o_custkey AS VARCHAR) AS who
FROM orders
UNION ALL
SELECT CAST(CAST(CAST(l_quantity AS INTEGER) AS DECIMAL(23, 4)) AS VARCHAR) AS amount, l_shipdate AS at, l_returnflag AS who
FROM lineitem""")
def union_exact(spark, sf):
    """A long beside a decimal, a date beside a timestamp, a number beside text."""
    o = _t(spark, sf, "orders").select((F.col("o_orderkey") + 9007199254740993).alias("amount"),
                                       F.to_date("o_orderdate").alias("at"), F.col("o_custkey").alias("who"))
    li = _t(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").cast("decimal(12,4)").alias("amount"),
                                          F.col("l_shipdate").alias("at"), F.col("l_returnflag").alias("who"))
    return U.union_all_by_name([o, li]).withColumn("amount", F.col("amount").cast("string"))


@query("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS record_count FROM {t}" for t in S.TABLES))
def row_counts(spark, sf):
    return U.row_counts({t: _t(spark, sf, t) for t in S.TABLES})


# ---------------------------------------------------------------- snapshots
# Two snapshots of orders. Keys ending in 1 are new, in 2 gone, in 3 at another
# price; those in 4 have no key (four rows in ten of them changed); rows in 5
# come twice in the old one and three times in the new one, in 6 the reverse.
SNAPSHOT_SQL = """
WITH base AS (SELECT o_orderkey % 10 AS d, CASE WHEN o_orderkey % 10 <> 4 THEN o_orderkey END AS id, o_custkey, o_totalprice, o_orderkey FROM orders),
old AS (
  SELECT id, o_custkey, o_totalprice FROM base WHERE d <> 1
  UNION ALL SELECT id, o_custkey, o_totalprice FROM base WHERE d IN (5, 6)
  UNION ALL SELECT id, o_custkey, o_totalprice FROM base WHERE d = 6),
new AS (
  SELECT id, o_custkey, CASE WHEN d = 3 OR (d = 4 AND o_custkey % 10 < 4) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM base WHERE d <> 2
  UNION ALL SELECT id, o_custkey, o_totalprice FROM base WHERE d IN (5, 6)
  UNION ALL SELECT id, o_custkey, o_totalprice FROM base WHERE d = 5)"""


def _snapshots(spark, sf):
    o = S.read(spark, sf, "orders")
    d = F.col("o_orderkey") % 10
    base = o.select(d.alias("d"), F.when(d != 4, F.col("o_orderkey")).alias("id"), "o_custkey", "o_totalprice")
    columns = ["id", "o_custkey", "o_totalprice"]
    raised = (F.col("d") == 3) | ((F.col("d") == 4) & (F.col("o_custkey") % 10 < 4))

    def copies(*of):
        return F.explode(F.array_repeat(F.lit(0), F.when(F.col("d") == of[0], 2).when(F.col("d") == of[1], 3).otherwise(1)))
    old = base.where("d <> 1").withColumn("x", copies(5, 6)).select(*columns)
    new = base.where("d <> 2").withColumn("o_totalprice", F.when(raised, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return old, new.withColumn("x", copies(6, 5)).select(*columns)


@query("snapshot_diff", SNAPSHOT_SQL + """,
counted AS (
  SELECT id, o_custkey, o_totalprice, sum(o) AS o, sum(n) AS n FROM (
    SELECT *, 1 AS o, 0 AS n FROM old UNION ALL SELECT *, 0, 1 FROM new) GROUP BY ALL),
held AS (SELECT *, sum(o) OVER (PARTITION BY id) > 0 AS in_old, sum(n) OVER (PARTITION BY id) > 0 AS in_new FROM counted)
SELECT 'same' AS change, CAST(least(o, n) AS BIGINT) AS copies, id, o_custkey, o_totalprice FROM held WHERE least(o, n) > 0
UNION ALL SELECT CASE WHEN in_old THEN 'update' ELSE 'insert' END, CAST(n - o AS BIGINT), id, o_custkey, o_totalprice FROM held WHERE n > o
UNION ALL SELECT CASE WHEN in_new THEN 'replaced' ELSE 'delete' END, CAST(o - n AS BIGINT), id, o_custkey, o_totalprice FROM held WHERE o > n""")
def snapshot_diff(spark, sf):
    return SN.snapshot_changes(*_snapshots(spark, sf), ["id"], SN.CHANGES)


@query("snapshot_history", SNAPSHOT_SQL + " SELECT DISTINCT * FROM new WHERE id IS NOT NULL")
def snapshot_history(spark, sf):
    """A history of the old snapshot, and what the new one changed appended,
    tombstones too: the newest row per key is the new snapshot's."""
    old, new = (x.where("id is not null").distinct() for x in _snapshots(spark, sf))
    history = old.select("*", F.lit(False).alias("is_deleted"), F.lit(1).alias("load"))
    history = history.unionByName(SN.tombstones(old, new, ["id"]).select("*", F.lit(2).alias("load")))
    return I.latest_by_key(history, ["id"], "load", deleted="is_deleted").drop("is_deleted", "load")


# ---------------------------------------------------------------- the fact's increment
# First load: no episodes of one remainder, another runtime for some, fewer
# credits (none at all for some parents), one tag only for some. Second: all.
FACT_CHANGES_SQL = """,
old_episodes AS (
  SELECT * REPLACE (CASE WHEN episode_id % 10 = 0 THEN runtime + 1 ELSE runtime END AS runtime) FROM episodes WHERE episode_id % 4 <> 1),
old_cast AS (SELECT * FROM cast_ WHERE person_id % 3 <> 0 AND show_id % 7 <> 0),
old_genres AS (
  SELECT show_id, show_name, language, unnest(CASE WHEN show_id % 5 = 0 THEN genres[1:1] ELSE genres END) AS genre FROM shows),
old_fact AS (
  SELECT DISTINCT e.show_id, g.show_name, g.language, g.genre, e.season, e.episode_id, e.episode_name, e.airdate, e.runtime,
         c.person_id, c.cast_name, c.character_id, c.character_name
  FROM old_episodes e JOIN old_genres g ON e.show_id = g.show_id LEFT JOIN old_cast c ON e.show_id = c.show_id),
changes AS (
  SELECT show_id, 1 AS a, 0 AS r FROM (SELECT * FROM fact EXCEPT SELECT * FROM old_fact)
  UNION ALL SELECT show_id, 0, 1 FROM (SELECT * FROM old_fact EXCEPT SELECT * FROM fact))
SELECT show_id, CAST(sum(a) AS BIGINT) AS added_rows, CAST(sum(r) AS BIGINT) AS removed_rows FROM changes GROUP BY show_id"""


def _fact_changes(spark, sf, hot: bool):
    new = S.star(spark, sf, hot=hot)
    runtime = F.when(F.col("episode_id") % 10 == 0, F.col("runtime") + 1).otherwise(F.col("runtime"))
    old = M.Star(
        new.parents.withColumn("genres", F.when(F.col("show_id") % 5 == 0, F.slice("genres", 1, 1)).otherwise(F.col("genres"))),
        new.children.where(F.col("episode_id") % 4 != 1).withColumn("runtime", runtime),
        new.bridge.where((F.col("person_id") % 3 != 0) & (F.col("show_id") % 7 != 0)))
    return M.fact_changes(old, new)


@query("fact_increment", STAR_SQL + FACT_CHANGES_SQL)
def fact_increment(spark, sf):
    return _fact_changes(spark, sf, hot=False)


@query("fact_increment_hot", HOT_STAR_SQL + FACT_CHANGES_SQL)
def fact_increment_hot(spark, sf):
    return _fact_changes(spark, sf, hot=True)
