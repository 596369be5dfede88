"""Driver queries for the table builders: stand-in landed records through
bronze (flatten, normalise), silver (type, clean, calendar parts) and gold
(subset, distinct). Audit columns (load time, user) are dropped: they are not
deterministic. The SQL repeats the whole chain on the testdata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import increment as I
from strata.operators import marts as M
from strata.plans import layers as L
from strata.plans import standin as S
from strata.plans.entities import ENTITIES
from strata.plans.landed import LANDED, PERSON_EPOCH, SHOW_EPOCH
from strata.plans.registry import query
from strata.plans.scratch import keep_result, scratch_store
from strata.session import at_once, scratch_path
from strata.sources import sinks as K
from strata.sources.drift import read_drifting
from strata.sources.landing import CORRUPT, land_records, read_landed, split_corrupt
from strata.sources.sinks import with_audit
from strata.streaming.ingest import ingest_landed

AUDIT = ["created_at", "created_date", "dw_updated_timestamp", "dw_updated_by", L.UPSTREAM]


def cl(x: str) -> str:
    """SQL for the string clean: trimmed, NULL or blank → 'NAFS'."""
    return f"COALESCE(NULLIF(TRIM({x}), ''), 'NAFS')"


def parts(ts: str) -> str:
    return (f"CAST(year({ts}) AS INTEGER) AS partition_year, "
            f"CAST(month({ts}) AS INTEGER) AS partition_month, "
            f"CAST(day({ts}) AS INTEGER) AS partition_day")


def _bronze(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    return with_audit(L.bronze_records(LANDED[entity](spark, sf)))


def _silver(spark: SparkSession, sf: str, entity: str, few_new: bool = False) -> DataFrame:
    return L.silver_increment(ENTITIES[entity], _bronze(spark, sf, entity), None, few_new=few_new)


def _drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT if c in df.columns])


# ---------------------------------------------------------------- SQL chain
SHOWS_SQL = f"""
ls AS (
  SELECT c.c_custkey AS id,
    CASE WHEN c.c_acctbal < 0 THEN ' ' || c.c_name || ' ' ELSE c.c_name END AS name,
    c.c_mktsegment AS type, n.n_name AS language,
    CASE WHEN c.c_acctbal < 0 THEN CAST([] AS VARCHAR[]) ELSE [c.c_mktsegment, r.r_name] END AS genres,
    CASE WHEN c.c_acctbal < 0 THEN 'Ended' ELSE 'Running' END AS status,
    CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_nationkey END AS runtime,
    n.n_regionkey * 10 AS averageruntime,
    CASE WHEN c.c_acctbal < 100 THEN ''
         ELSE strftime(DATE '1990-01-01' + (c.c_nationkey * 100 + n.n_regionkey), '%Y-%m-%d') END AS premiered,
    CASE WHEN c.c_acctbal < 0 THEN '2020-02-30' END AS ended,
    CASE WHEN c.c_mktsegment <> 'BUILDING' THEN lower(c.c_name) END AS officialsite,
    CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS rating_average,
    CAST(n.n_regionkey AS BIGINT) AS network_id, r.r_name AS network_name,
    n.n_name AS network_country_name, upper(substr(n.n_name, 1, 2)) AS network_country_code,
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 'm/' || CAST(c.c_custkey AS VARCHAR) END AS image_medium,
    CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE 'o/' || CAST(c.c_custkey AS VARCHAR) END AS image_original,
    {SHOW_EPOCH} + c.c_custkey * 3600 AS updated
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
s_shows AS (
  SELECT DISTINCT CAST(id AS BIGINT) AS show_id, {cl('TRIM(name)')} AS show_name,
    {cl('type')} AS type, {cl('language')} AS language, genres, {cl('status')} AS status,
    COALESCE(runtime, 0) AS runtime, COALESCE(averageruntime, 0) AS average_runtime,
    TRY_CAST(NULLIF(TRIM(premiered), '') AS DATE) AS premiered_date,
    TRY_CAST(NULLIF(TRIM(ended), '') AS DATE) AS ended_date,
    COALESCE(rating_average, 0.0) AS rating_average, network_id,
    {cl('network_name')} AS network_name, {cl('network_country_name')} AS network_country_name,
    {cl('network_country_code')} AS network_country_code, {cl('officialsite')} AS officialsite,
    {cl('image_medium')} AS image_medium, {cl('image_original')} AS image_original,
    CAST(updated AS BIGINT) AS updated, make_timestamp(CAST(updated AS BIGINT) * 1000000) AS updated_time,
    {parts('make_timestamp(CAST(updated AS BIGINT) * 1000000)')}
  FROM ls WHERE id IS NOT NULL)"""

EPISODES_SQL = f"""
le AS (
  SELECT o_orderkey AS id, o_orderpriority AS name, CAST(year(o_orderdate) AS INTEGER) AS season,
    CAST(dayofyear(o_orderdate) AS INTEGER) AS number,
    CASE WHEN o_orderstatus = 'F' THEN 'regular' ELSE 'special' END AS type,
    CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS airdate,
    '20:00' AS airtime,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-05:00' AS airstamp,
    CAST(FLOOR(o_totalprice / 1000) AS INTEGER) AS runtime,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice / 100000 END AS rating_average,
    NULL::VARCHAR AS image_medium, NULL::VARCHAR AS image_original,
    '<p>' || o_orderpriority || '</p>' AS summary, 'ep/' || CAST(o_orderkey AS VARCHAR) AS url,
    'ep/' || CAST(o_orderkey AS VARCHAR) AS _links_self_href,
    'show/' || CAST(o_custkey AS VARCHAR) AS _links_show_href, NULL::VARCHAR AS _links_show_name,
    o_custkey AS show_id
  FROM orders),
le2 AS (SELECT *, CAST(TRY_STRPTIME(NULLIF(TRIM(airdate), ''), '%Y-%m-%d') AS DATE) AS air_date FROM le),
s_episodes AS (
  SELECT DISTINCT CAST(id AS BIGINT) AS episode_id, CAST(show_id AS BIGINT) AS show_id,
    {cl('TRIM(name)')} AS episode_name, season, number AS episode_number, {cl('type')} AS type,
    air_date, {cl('airtime')} AS airtime,
    make_timestamp(epoch_us(TRY_CAST(airstamp AS TIMESTAMPTZ))) AS air_timestamp,
    COALESCE(runtime, 0) AS runtime, {cl('summary')} AS summary,
    COALESCE(rating_average, 0.0) AS rating_average,
    {cl('image_medium')} AS image_medium, {cl('image_original')} AS image_original, {cl('url')} AS url,
    {cl('_links_self_href')} AS links_self_href, {cl('_links_show_href')} AS links_show_href,
    {cl('_links_show_name')} AS links_show_name,
    {parts('air_date')}
  FROM le2 WHERE id IS NOT NULL)"""

CAST_SQL = f"""
pairs AS (
  SELECT DISTINCT o.o_custkey AS show_id, l.l_suppkey AS person_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
lc AS (
  SELECT p.show_id, p.person_id, 'p/' || CAST(p.person_id AS VARCHAR) AS person_url,
    s.s_name AS person_name, n.n_name AS person_country_name,
    upper(substr(n.n_name, 1, 2)) AS person_country_code, 'UTC' AS person_country_timezone,
    strftime(DATE '1950-01-01' + s.s_nationkey * 300, '%Y-%m-%d') AS person_birthday,
    NULL::VARCHAR AS person_deathday,
    CASE WHEN s.s_acctbal > 5000 THEN 'Female' ELSE 'Male' END AS person_gender,
    NULL::VARCHAR AS person_image_medium, NULL::VARCHAR AS person_image_original,
    {PERSON_EPOCH} + p.person_id * 60 AS person_updated,
    p.person_id * 100 + s.s_nationkey AS character_id, NULL::VARCHAR AS character_url,
    n.n_name || ' role' AS character_name,
    NULL::VARCHAR AS character_image_medium, NULL::VARCHAR AS character_image_original,
    s.s_acctbal < 0 AS self, FALSE AS voice
  FROM pairs p JOIN supplier s ON p.person_id = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey),
s_cast AS (
  SELECT DISTINCT CAST(show_id AS BIGINT) AS show_id, CAST(person_id AS BIGINT) AS person_id,
    {cl('person_name')} AS person_name, {cl('person_gender')} AS person_gender,
    TRY_CAST(NULLIF(TRIM(person_birthday), '') AS DATE) AS person_birthday,
    TRY_CAST(NULLIF(TRIM(person_deathday), '') AS DATE) AS person_deathday,
    {cl('person_country_name')} AS person_country_name,
    {cl('person_country_code')} AS person_country_code,
    {cl('person_country_timezone')} AS person_country_timezone,
    {cl('person_url')} AS person_url, {cl('person_image_medium')} AS person_image_medium,
    {cl('person_image_original')} AS person_image_original,
    CAST(character_id AS BIGINT) AS character_id, {cl('character_name')} AS character_name,
    {cl('character_url')} AS character_url, {cl('character_image_medium')} AS character_image_medium,
    {cl('character_image_original')} AS character_image_original, self, voice,
    CAST(person_updated AS BIGINT) AS person_updated,
    make_timestamp(CAST(person_updated AS BIGINT) * 1000000) AS person_updated_time,
    {parts('make_timestamp(CAST(person_updated AS BIGINT) * 1000000)')}
  FROM lc WHERE person_id IS NOT NULL)"""


def _gold_sql(cte: str, source: str, entity: str) -> str:
    return f"WITH {cte}\nSELECT DISTINCT {', '.join(L.GOLD_COLUMNS[entity])} FROM {source}"


# ---------------------------------------------------------------- queries
@query("silver_dim", f"WITH {SHOWS_SQL}\nSELECT * FROM s_shows")
def silver_dim(spark, sf):
    return _drop_audit(_silver(spark, sf, "shows"))


@query("silver_child", f"WITH {EPISODES_SQL}\nSELECT * FROM s_episodes")
def silver_child(spark, sf):
    return _drop_audit(_silver(spark, sf, "episodes"))


@query("silver_bridge", f"WITH {CAST_SQL}\nSELECT * FROM s_cast")
def silver_bridge(spark, sf):
    return _drop_audit(_silver(spark, sf, "cast"))


def _gold(spark, sf, entity: str) -> DataFrame:
    e = ENTITIES[entity]
    return _drop_audit(L.gold_increment(e, _silver(spark, sf, entity), None))


@query("gold_dim", _gold_sql(SHOWS_SQL, "s_shows", "shows"))
def gold_dim(spark, sf):
    return _gold(spark, sf, "shows")


@query("gold_child", _gold_sql(EPISODES_SQL, "s_episodes", "episodes"))
def gold_child(spark, sf):
    return _gold(spark, sf, "episodes")


@query("gold_bridge", _gold_sql(CAST_SQL, "s_cast", "cast"))
def gold_bridge(spark, sf):
    return _gold(spark, sf, "cast")


# ---------------------------------------------------------------- bronze
def _bronze_plain(spark, sf, entity: str) -> DataFrame:
    return L.bronze_records(LANDED[entity](spark, sf))


@query("bronze_dim", f"WITH {SHOWS_SQL}\nSELECT * FROM ls")
def bronze_dim(spark, sf):
    return _bronze_plain(spark, sf, "shows")


@query("bronze_child", f"WITH {EPISODES_SQL}\nSELECT * FROM le")
def bronze_child(spark, sf):
    return _bronze_plain(spark, sf, "episodes")


@query("bronze_bridge", f"WITH {CAST_SQL}\nSELECT * FROM lc")
def bronze_bridge(spark, sf):
    return _bronze_plain(spark, sf, "cast")


# The bronze target holds the BUILDING segment's shows in every third epoch
# hour, a share that grows with the table; the new batch is every show. Sound
# mode admits each show whose id the target lacks or whose version is newer;
# reference mode admits only versions above the target's global maximum, so
# the other shows updated before it are lost.
OLD_SQL = "type = 'BUILDING' AND (updated // 3600) % 3 = 0"


def _bronze_target(spark, sf) -> DataFrame:
    return _bronze_plain(spark, sf, "shows").filter(
        (F.col("type") == "BUILDING") & (F.floor(F.col("updated") / 3600) % 3 == 0))


@query("bronze_dim_increment", f"""WITH {SHOWS_SQL},
t AS (SELECT id, MAX(updated) AS tv FROM ls WHERE {OLD_SQL} GROUP BY id)
SELECT ls.* FROM ls LEFT JOIN t ON ls.id IS NOT DISTINCT FROM t.id
WHERE t.id IS NULL OR ls.updated > t.tv""")
def bronze_dim_increment(spark, sf):
    return L.bronze_increment(ENTITIES["shows"], _bronze_plain(spark, sf, "shows"),
                              _bronze_target(spark, sf))


@query("bronze_dim_increment_reference", f"""WITH {SHOWS_SQL}
SELECT * FROM ls WHERE updated > (SELECT COALESCE(MAX(updated), 0) FROM ls WHERE {OLD_SQL})""")
def bronze_dim_increment_reference(spark, sf):
    return L.bronze_increment(ENTITIES["shows"], _bronze_plain(spark, sf, "shows"),
                              _bronze_target(spark, sf), reference_mode=True)


# ---------------------------------------------------------------- second loads
# First load: every second key. Second load: every key, and the keys divisible
# by three once more in a version an hour newer (late rows among them: their
# times lie between those already loaded). New are the odd keys, and the newer
# versions of all keys.
SECOND = {  # entity: SQL chain, landed rows, silver table, key, version
    "shows": (SHOWS_SQL, "ls", "s_shows", "id", "updated"),
    "episodes": (EPISODES_SQL, "le2", "s_episodes", "id", None),
    "cast": (CAST_SQL, "lc", "s_cast", "person_id", "person_updated"),
}


def _loads(spark, sf, entity: str) -> tuple[DataFrame, DataFrame]:
    """Bronze rows of the first and of the second load."""
    _, _, _, key, version = SECOND[entity]
    bronze = K.stage(_bronze(spark, sf, entity))  # read several times, as a bronze table is
    second = bronze
    if version:
        second = bronze.unionByName(bronze.filter(F.col(key) % 3 == 0).withColumn(version, F.col(version) + 3600))
    return bronze.filter(F.col(key) % 2 == 0), second


def _second_sql(entity: str, select: str = "SELECT *") -> str:
    chain, landed, silver, key, version = SECOND[entity]
    newer = (f" UNION ALL SELECT * REPLACE ({version} + 3600 AS {version}) FROM {landed} WHERE {key} % 3 = 0"
             if version else "")
    rows = f"new_rows AS (SELECT * FROM {landed} WHERE {key} % 2 = 1{newer}),\n{silver} AS ("
    return f"WITH {chain}".replace(f"{silver} AS (", rows).replace(
        f"FROM {landed} WHERE {key} IS NOT NULL", f"FROM new_rows WHERE {key} IS NOT NULL") + f"\n{select} FROM {silver}"


def _silver_second(spark, sf, entity: str) -> DataFrame:
    e = ENTITIES[entity]
    first, second = _loads(spark, sf, entity)
    return _drop_audit(L.silver_increment(e, second, L.silver_increment(e, first, None)))


def _gold_second(spark, sf, entity: str) -> DataFrame:
    e = ENTITIES[entity]
    first, second = _loads(spark, sf, entity)
    target = L.gold_increment(e, L.silver_increment(e, first, None), None)
    return _drop_audit(L.gold_increment(e, L.silver_increment(e, second, None), target))


for _name, _entity in (("dim", "shows"), ("child", "episodes"), ("bridge", "cast")):
    query(f"silver_{_name}_increment", _second_sql(_entity))(
        lambda spark, sf, _e=_entity: _silver_second(spark, sf, _e))
    query(f"gold_{_name}_increment", _second_sql(_entity, f"SELECT DISTINCT {', '.join(L.GOLD_COLUMNS[_entity])}"))(
        lambda spark, sf, _e=_entity: _gold_second(spark, sf, _e))


# ---------------------------------------------------------------- repeated keys
@query("silver_child_doubled", "WITH " + EPISODES_SQL.replace(
    "s_episodes AS (", "le3 AS (SELECT * REPLACE (CASE WHEN id % 5 = 0 THEN 'new ' || name ELSE name END AS name) FROM le2),\n"
    "s_episodes AS (").replace("FROM le2 WHERE", "FROM le3 WHERE") + "\nSELECT * FROM s_episodes")
def silver_child_doubled(spark, sf):
    """Every fifth episode comes twice in a batch; the row loaded last stays."""
    bronze = _bronze(spark, sf, "episodes")
    again = bronze.filter(F.col("id") % 5 == 0).select(
        *[F.concat(F.lit("new "), "name").alias(c) if c == "name"
          else (F.col(c) + F.expr("interval 1 hour")).alias(c) if c == "created_date" else F.col(c)
          for c in bronze.columns])
    return _drop_audit(L.silver_increment(ENTITIES["episodes"], bronze.unionByName(again), None))


@query("silver_child_corrected", "WITH " + EPISODES_SQL.replace(
    "s_episodes AS (", "le3 AS (SELECT * REPLACE (CASE WHEN id % 5 = 0 THEN 'new ' || name ELSE name END AS name) FROM le2),\n"
    "s_episodes AS (").replace("FROM le2 WHERE", "FROM le3 WHERE") + "\nSELECT * FROM s_episodes")
def silver_child_corrected(spark, sf):
    """The source has no version, and gives every fifth episode again under
    another name, the others unchanged. The second load brings the corrected
    ones only; the newest row per episode shows them."""
    bronze = _bronze(spark, sf, "episodes")
    later = bronze.select(*[
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("new "), "name")).otherwise(F.col(c)).alias(c) if c == "name"
        else (F.col(c) + F.expr("interval 1 hour")).alias(c) if c == "created_date" else F.col(c) for c in bronze.columns])
    e = ENTITIES["episodes"]
    first = K.stage(L.silver_increment(e, bronze, None))
    second = L.silver_increment(e, later, first)
    return _drop_audit(I.latest_by_key(first.unionByName(second), list(e.silver_keys), "created_at"))


def _renamed_star(spark, sf) -> M.Star:
    """The silver star, with an older credit under another name for every
    second person. Only the latest version of a credit counts."""
    cast = _silver(spark, sf, "cast")
    older = cast.filter(F.col("person_id") % 2 == 0).withColumn("person_name", F.concat(F.lit("Old "), "person_name")) \
        .withColumn("person_updated", F.col("person_updated") - 100)
    return L.silver_star(_silver(spark, sf, "shows"), _silver(spark, sf, "episodes", few_new=True), cast.unionByName(older))


RENAMED_SQL = f"""WITH {SHOWS_SQL}, {EPISODES_SQL}, {CAST_SQL},
fact AS (
  SELECT e.show_id, g.genre, e.episode_id, c.person_id, c.person_name
  FROM s_episodes e JOIN (SELECT show_id, unnest(genres) AS genre FROM s_shows) g USING (show_id)
  LEFT JOIN s_cast c USING (show_id))"""


@query("top_members_renamed", f"""{RENAMED_SQL}
SELECT person_id, person_name AS cast_name, COUNT(DISTINCT show_id) AS total_shows,
       CAST(ROW_NUMBER() OVER (ORDER BY COUNT(DISTINCT show_id) DESC, person_id) AS INTEGER) AS rank
FROM fact WHERE person_id IS NOT NULL GROUP BY person_id, person_name
ORDER BY rank LIMIT 10""")
def top_members_renamed(spark, sf):
    return L.marts(_renamed_star(spark, sf))["top_cast_members"](_renamed_star(spark, sf))


@query("common_tags_renamed", f"""{RENAMED_SQL}
SELECT {cl('genre')} AS genre, COUNT(*) AS genre_count, COUNT(DISTINCT show_id) AS distinct_shows,
       COUNT(DISTINCT episode_id) AS distinct_episodes
FROM fact GROUP BY 1""")
def common_tags_renamed(spark, sf):
    star = _renamed_star(spark, sf)
    return L.marts(star)["common_genres"](star)


# ---------------------------------------------------------------- a whole run
RUN_SQL = "\nUNION ALL ".join(
    f"SELECT '{layer}_{label}' AS table_name, (SELECT COUNT(*) FROM {table}) AS record_count"
    for label, table in (("shows", "customer"), ("cast", "pairs"), ("episodes", "orders"))
    for layer in ("bronze", "silver")) + """
UNION ALL SELECT 'dim_shows', (SELECT COUNT(*) FROM customer)
UNION ALL SELECT 'dim_cast', (SELECT COUNT(*) FROM pairs)
UNION ALL SELECT 'fact_episodes', NULL"""


@query("run_row_counts", "WITH pairs AS (SELECT DISTINCT o_custkey, l_suppkey FROM lineitem JOIN orders "
       "ON l_orderkey = o_orderkey)\n" + RUN_SQL)
def run_row_counts(spark, sf):
    """L1 and Q1: land every record as JSON, run the layers twice (the second
    run finds nothing new), leave out the last gold table, count them all."""
    with scratch_store(spark, "run") as store:
        at_once(spark, [lambda e=entity, fn=fn: land_records(fn(spark, sf), f"{store.root}/landed/{e}")
                        for entity, fn in LANDED.items()])
        for layers in (["bronze", "silver"], ["bronze", "silver"], ["gold"]):
            entities = ["shows", "cast"] if layers == ["gold"] else list(ENTITIES)
            L.run(spark, store, f"{store.root}/landed", layers, entities, with_marts=False)
        return keep_result(L.layer_row_counts(store))


@query("bad_lines", """
SELECT CASE WHEN event_id % 7 > 0 THEN event_id END AS id, CASE WHEN event_id % 7 > 0 THEN event_type END AS name,
       CASE WHEN event_id % 7 = 0 THEN '{"id": ' || event_id || ', "name": "' || event_type END AS corrupt_record
FROM events""")
def bad_lines(spark, sf):
    """Every seventh landed line breaks off; it comes back as text."""
    ev = S.read(spark, sf, "events")
    line = F.concat(F.lit('{"id": '), "event_id", F.lit(', "name": "'), "event_type",
                    F.when(F.col("event_id") % 7 > 0, F.lit('"}')).otherwise(F.lit("")))
    path = scratch_path(spark, "lines")
    ev.select(line.alias("value")).write.text(path)
    back = read_landed(spark, path, "id BIGINT, name STRING")
    good = F.col(CORRUPT).isNull()
    return back.select(F.when(good, F.col("id")).alias("id"), F.when(good, F.col("name")).alias("name"), CORRUPT)


# ---------------------------------------------------------------- drifting records
@query("drifted_landing", """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 7 = 0 THEN '"c-' || o_custkey || '"' END AS customer_drift,
       o_orderpriority AS customer_name,
       CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus END AS customer_status,
       CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS extra_priority,
       CASE WHEN o_orderkey % 3 = 0 THEN list_value(o_orderkey, o_custkey) END AS extra_ids,
       CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 11 = 1 THEN '"' || o_orderstatus || '"' END AS mixed,
       CASE WHEN o_orderkey % 13 = 0 THEN '"' || o_orderstatus || '"' END AS id_clash
FROM orders""")
def drifted_landing(spark, sf):
    """A first load has the declared fields only. The records of a
    second one bring new and nested fields, one of mixed type, a name that is
    taken, and texts where a number was declared. Bronze takes both loads."""
    o = S.read(spark, sf, "orders")
    key = F.col("o_orderkey")

    def text(name: str, value, when=None):
        pair = F.concat(F.lit(f', "{name}": '), value)
        return pair if when is None else F.when(when, pair).otherwise(F.lit(""))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    customer = F.concat(
        F.lit('{"name": '), quoted("o_orderpriority"),
        text("id", F.when(key % 7 > 0, F.col("o_custkey").cast("string")).otherwise(quoted(F.concat(F.lit("c-"), F.col("o_custkey"))))),
        text("status", quoted("o_orderstatus"), key % 5 == 0), F.lit("}"))
    drifts = (key % 7 == 0) | (key % 5 == 0) | (key % 3 == 0) | (key % 11 < 2) | (key % 13 == 0)
    line = F.concat(
        F.lit('{"id": '), key, text("customer", customer),
        text("extra", F.concat(F.lit('{"priority": '), quoted("o_orderpriority"), F.lit(', "ids": ['), key, F.lit(", "), "o_custkey", F.lit("]}")), key % 3 == 0),
        text("mixed", F.when(key % 11 == 0, key.cast("string")).otherwise(quoted("o_orderstatus")), key % 11 < 2),
        text("ID", quoted("o_orderstatus"), key % 13 == 0), F.lit("}"))
    declared = "id BIGINT, customer STRUCT<id: BIGINT, name: STRING>"
    with scratch_store(spark, "drift") as store:
        store.ensure_database("bronze")
        name = store.name("bronze", "orders_drifting")
        for part in (~drifts, drifts):
            path = scratch_path(spark, "drifting-lines")
            o.filter(part).select(line.alias("value")).write.text(path)
            held = store.read("bronze", "orders_drifting")
            records, _ = split_corrupt(K.stage(read_drifting(spark, path, declared, table=held.schema if held is not None else None)))
            K.append_table(L.bronze_records(records), name, created=None)
        drifted = F.col("drifted")
        return keep_result(store.read("bronze", "orders_drifting").select(
            "id", "customer_id", drifted["customer.id"].alias("customer_drift"), "customer_name", "customer_status", "extra_priority",
            "extra_ids", "mixed", drifted["ID"].alias("id_clash")))


# ---------------------------------------------------------------- streaming
@query("stream_ingest", f"WITH {CAST_SQL}\nSELECT * FROM lc")
def stream_ingest(spark, sf):
    """Land the cast records as JSON, ingest them with an availableNow
    file stream into bronze, ingest again (nothing new), read bronze back."""
    with scratch_store(spark, "stream") as store:
        land_records(LANDED["cast"](spark, sf), f"{store.root}/landed/cast")
        entity = ENTITIES["cast"]
        ingest_landed(spark, store, entity, f"{store.root}/landed")
        ingest_landed(spark, store, entity, f"{store.root}/landed")
        return keep_result(store.read("bronze", entity.bronze_table).drop("created_date"))
