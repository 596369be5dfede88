"""Stand-in landed records: the testdata shaped like the nested source records
(shows, episodes, cast) so the bronze → silver → gold chain runs over whole
tables. Every value is derived from the given tables, the same way in Spark
(here) and in the oracle SQL (``layer_queries``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import standin as S

SHOW_EPOCH = 1_700_000_000
PERSON_EPOCH = 1_600_000_000


def _null_struct(cond, struct):
    return F.when(~cond, struct)


def landed_shows(spark: SparkSession, sf: str) -> DataFrame:
    c, n, r = S.read(spark, sf, "customer"), S.read(spark, sf, "nation"), S.read(spark, sf, "region")
    neg = F.col("c_acctbal") < 0
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    premiered = F.date_add(F.lit("1990-01-01").cast("date"),
                           F.col("c_nationkey") * 100 + F.col("n_regionkey")).cast("string")
    return j.select(
        F.col("c_custkey").alias("id"),
        F.when(neg, F.concat(F.lit(" "), "c_name", F.lit(" "))).otherwise(F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("type"),
        F.col("n_name").alias("language"),
        F.when(neg, F.array().cast("array<string>"))
        .otherwise(F.array("c_mktsegment", "r_name")).alias("genres"),
        F.when(neg, F.lit("Ended")).otherwise(F.lit("Running")).alias("status"),
        F.when(neg, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("runtime"),
        (F.col("n_regionkey") * 10).alias("averageRuntime"),
        F.when(F.col("c_acctbal") < 100, F.lit("")).otherwise(premiered).alias("premiered"),
        F.when(neg, F.lit("2020-02-30")).alias("ended"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.lower("c_name")).alias("officialSite"),
        _null_struct(neg, F.struct(F.col("c_acctbal").alias("average"))).alias("rating"),
        F.struct(F.col("n_regionkey").cast("long").alias("id"), F.col("r_name").alias("name"),
                 F.struct(F.col("n_name").alias("name"),
                          F.upper(F.substring("n_name", 1, 2)).alias("code")).alias("country")
                 ).alias("network"),
        _null_struct(F.col("c_mktsegment") == "HOUSEHOLD",
                     F.struct(F.concat(F.lit("m/"), F.col("c_custkey").cast("string")).alias("medium"),
                              F.concat(F.lit("o/"), F.col("c_custkey").cast("string")).alias("original"))
                     ).alias("image"),
        (F.lit(SHOW_EPOCH) + F.col("c_custkey") * 3600).cast("long").alias("updated"))


def landed_episodes(spark: SparkSession, sf: str) -> DataFrame:
    o = S.read(spark, sf, "orders")
    # A date cast to text is yyyy-MM-dd; the timestamps are whole seconds, so
    # their text form with 'T' is the ISO stamp.
    day = F.col("o_orderdate").cast("date").cast("string")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.year("o_orderdate").alias("season"),
        F.dayofyear("o_orderdate").alias("number"),
        F.when(F.col("o_orderstatus") == "F", F.lit("regular")).otherwise(F.lit("special")).alias("type"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(day).alias("airdate"),
        F.lit("20:00").alias("airtime"),
        F.concat(F.regexp_replace(F.col("o_orderdate").cast("string"), " ", "T"),
                 F.lit("-05:00")).alias("airstamp"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("runtime"),
        _null_struct(F.col("o_orderstatus") == "O",
                     F.struct((F.col("o_totalprice") / 100000).alias("average"))).alias("rating"),
        F.lit(None).cast("struct<medium: string, original: string>").alias("image"),
        F.concat(F.lit("<p>"), "o_orderpriority", F.lit("</p>")).alias("summary"),
        F.concat(F.lit("ep/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.struct(F.struct(F.concat(F.lit("ep/"), F.col("o_orderkey").cast("string")).alias("href")).alias("self"),
                 F.struct(F.concat(F.lit("show/"), F.col("o_custkey").cast("string")).alias("href"),
                          F.lit(None).cast("string").alias("name")).alias("show")).alias("_links"),
        F.col("o_custkey").alias("show_id"))


def landed_cast(spark: SparkSession, sf: str) -> DataFrame:
    pairs = S.bridge_pairs(spark, sf)
    s, n = S.read(spark, sf, "supplier"), S.read(spark, sf, "nation")
    people = s.join(n, s.s_nationkey == n.n_nationkey)
    j = pairs.join(people, pairs.person_id == people.s_suppkey)
    birthday = F.date_add(F.lit("1950-01-01").cast("date"), F.col("s_nationkey") * 300).cast("string")
    person = F.struct(
        F.col("person_id").alias("id"),
        F.concat(F.lit("p/"), F.col("person_id").cast("string")).alias("url"),
        F.col("s_name").alias("name"),
        F.struct(F.col("n_name").alias("name"), F.upper(F.substring("n_name", 1, 2)).alias("code"),
                 F.lit("UTC").alias("timezone")).alias("country"),
        birthday.alias("birthday"),
        F.lit(None).cast("string").alias("deathday"),
        F.when(F.col("s_acctbal") > 5000, F.lit("Female")).otherwise(F.lit("Male")).alias("gender"),
        F.lit(None).cast("struct<medium: string, original: string>").alias("image"),
        (F.lit(PERSON_EPOCH) + F.col("person_id") * 60).cast("long").alias("updated"))
    character = F.struct(
        (F.col("person_id") * 100 + F.col("s_nationkey")).cast("long").alias("id"),
        F.lit(None).cast("string").alias("url"),
        F.concat("n_name", F.lit(" role")).alias("name"),
        F.lit(None).cast("struct<medium: string, original: string>").alias("image"))
    return j.select(person.alias("person"), character.alias("character"),
                    (F.col("s_acctbal") < 0).alias("self"), F.lit(False).alias("voice"),
                    F.col("show_id"))


LANDED = {"shows": landed_shows, "episodes": landed_episodes, "cast": landed_cast}
