"""Driver queries for the sinks: write the testdata to fresh tables under the
shared checkpoint folder and read the rows back. The oracle selects them from
the source tables, so equal results mean the sink kept every value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import columns as C
from strata.operators import increment as I
from strata.plans import standin as S
from strata.plans.registry import query
from strata.plans.scratch import keep_result, scratch_store
from strata.sources import sinks as K

ORDER_CUT = "1998-01-01 00:00:00"


def _orders(spark, sf) -> DataFrame:
    return S.read(spark, sf, "orders")


def _before(col: str, cut: str = ORDER_CUT):
    return F.col(col) < F.lit(cut).cast("timestamp_ntz")


def _split(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = _orders(spark, sf)
    return o.filter(_before("o_orderdate")), o.filter(~_before("o_orderdate"))


@query("append_roundtrip", "SELECT * FROM orders")
def append_roundtrip(spark, sf):
    with scratch_store(spark, "append") as store:
        name = store.name("silver", "orders_rt")
        store.ensure_database("silver")
        early, late = _split(spark, sf)
        K.append_table(early, name, created=None)
        K.append_table(late, name, created=None)
        # Re-running the second batch through a key increment appends nothing.
        K.write_if_any(I.new_rows(late, spark.table(name), ["o_orderkey"]),
                       lambda d: K.append_table(d, name, created=None))
        return keep_result(spark.table(name))


@query("schema_evolve", f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '{ORDER_CUT}' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def schema_evolve(spark, sf):
    with scratch_store(spark, "evolve") as store:
        name = store.name("bronze", "orders_evolving")
        store.ensure_database("bronze")
        early, late = _split(spark, sf)
        K.append_table(early.select("o_orderkey", "o_custkey", "o_totalprice"), name, created=None)
        # New column o_orderpriority, missing column o_totalprice.
        K.append_table(late.select("o_orderpriority", "o_orderkey", "o_custkey"), name, created=None)
        return keep_result(spark.table(name))


@query("schema_evolve_nested", f"""
SELECT o_orderkey, o_custkey AS who_cust,
       CASE WHEN o_orderdate >= TIMESTAMP '{ORDER_CUT}' THEN o_orderpriority END AS who_priority,
       o_totalprice AS price,
       CASE WHEN o_orderdate >= TIMESTAMP '{ORDER_CUT}' THEN o_orderstatus END AS status
FROM orders""")
def schema_evolve_nested(spark, sf):
    """New fields in a struct and in the structs of an array."""
    with scratch_store(spark, "nested") as store:
        name = store.name("bronze", "orders_nested")
        store.ensure_database("bronze")
        early, late = _split(spark, sf)
        cust, price = F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price")
        K.append_table(early.select("o_orderkey", F.struct(cust).alias("who"), F.array(F.struct(price)).alias("items")),
                       name, created=None)
        K.append_table(late.select("o_orderkey", F.struct(F.col("o_orderpriority").alias("priority"), cust).alias("who"),
                                   F.array(F.struct(price, F.col("o_orderstatus").alias("status"))).alias("items")),
                       name, created=None)
        item = F.col("items")[0]
        return keep_result(spark.table(name).select(
            "o_orderkey", F.col("who.cust").alias("who_cust"), F.col("who.priority").alias("who_priority"),
            item["price"].alias("price"), item["status"].alias("status")))


@query("widen_exact", f"""
SELECT CAST(o_orderkey AS BIGINT) + CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN 9007199254740993 ELSE 0 END AS k,
       CAST(CAST(year(o_orderdate) AS DECIMAL(21, 2)) AS VARCHAR) AS exact, CAST(year(o_orderdate) AS DOUBLE) AS real,
       CAST(o_orderdate AS DATE)::TIMESTAMP AS day, CAST(o_custkey AS VARCHAR) AS label
FROM orders""")
def widen_exact(spark, sf):
    """Narrower columns appended to wider ones keep every value."""
    with scratch_store(spark, "widen") as store:
        name = store.name("bronze", "orders_wide")
        store.ensure_database("bronze")
        early, late = _split(spark, sf)
        year, day = F.year("o_orderdate"), F.to_date("o_orderdate")
        K.append_table(early.select(
            (F.col("o_orderkey") + 9007199254740993).alias("k"), year.cast("decimal(21,2)").alias("exact"),
            year.cast("double").alias("real"), day.cast("timestamp_ntz").alias("day"),
            F.col("o_custkey").cast("string").alias("label")), name, created=None)
        K.append_table(late.select(
            F.col("o_orderkey").cast("int").alias("k"), year.alias("exact"), year.cast("short").alias("real"),
            day.alias("day"), F.col("o_custkey").alias("label")), name, created=None)
        return keep_result(spark.table(name).withColumn("exact", F.col("exact").cast("string")))


@query("overwrite_evolve", """
SELECT NULL::BIGINT AS o_custkey, o_orderkey, o_orderpriority FROM orders""")
def overwrite_evolve(spark, sf):
    """A full refresh merges schemas: old columns stay, new ones come."""
    with scratch_store(spark, "refresh") as store:
        name = store.name("gold", "orders_refreshed")
        store.ensure_database("gold")
        o = _orders(spark, sf)
        K.append_table(o.select("o_custkey", "o_orderkey"), name, created=None)
        K.overwrite_table(o.select("o_orderkey", "o_orderpriority"), name, created=None)
        return keep_result(spark.table(name))


@query("overwrite_evolve_partitions", f"""
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderdate >= TIMESTAMP '{ORDER_CUT}' THEN o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS partition_year
FROM orders""")
def overwrite_evolve_partitions(spark, sf):
    """Overwriting the later partitions with another column keeps the rest."""
    with scratch_store(spark, "parts") as store:
        name = store.name("silver", "orders_by_year")
        store.ensure_database("silver")
        o = _orders(spark, sf).withColumn("partition_year", F.year("o_orderdate"))
        by = ["partition_year"]
        K.write_table(o.select("o_orderkey", "o_custkey", *by), name, partition_by=by, created=None)
        K.write_table(o.filter(~_before("o_orderdate")).select("o_orderkey", "o_orderpriority", *by), name,
                      "overwrite", partition_by=by, created=None)
        return keep_result(spark.table(name))


@query("partition_counts", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS partition_year,
       CAST(month(l_shipdate) AS INTEGER) AS partition_month
FROM lineitem""")
def partition_counts(spark, sf):
    with scratch_store(spark, "months") as store:
        store.ensure_database("silver")
        name = store.name("silver", "lineitem_by_month")
        li = C.with_date_parts(
            S.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"),
            "l_shipdate").drop("partition_day")
        parts = ["partition_year", "partition_month"]
        K.write_table(li, name, "append", partition_by=parts, created=None)
        # Dynamic partition overwrite: re-writing one year replaces only its
        # partitions, so the rows stay the same.
        K.write_table(li.filter(F.col("partition_year") == 1998), name, "overwrite",
                      partition_by=parts, created=None)
        return keep_result(spark.table(name))


def _rewritten(spark, sf, change) -> DataFrame:
    """Orders appended year by year, as small loads leave them, then rewritten."""
    with scratch_store(spark, "rewrite") as store:
        store.ensure_database("gold")
        name = store.name("gold", "orders_small_files")
        o = _orders(spark, sf)
        for year in range(1992, 1999):
            rows = o.filter(F.year("o_orderdate") == year if year < 1998 else ~_before("o_orderdate"))
            K.append_table(rows, name, created=None)
        change(name)
        return keep_result(spark.table(name))


@query("compact_roundtrip", "SELECT * FROM orders WHERE year(o_orderdate) >= 1992")
def compact_roundtrip(spark, sf):
    return _rewritten(spark, sf, lambda name: K.compact(spark, name))


@query("cluster_roundtrip", "SELECT * FROM orders WHERE year(o_orderdate) >= 1992")
def cluster_roundtrip(spark, sf):
    return _rewritten(spark, sf, lambda name: K.cluster_rewrite(spark, name, ["o_custkey"]))


@query("compact_partial", "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS partition_year FROM orders")
def compact_partial(spark, sf):
    """Every second year arrives in four appends and is packed; the other
    years keep the file they were written to."""
    with scratch_store(spark, "partial") as store:
        name = store.name("silver", "orders_partial")
        store.ensure_database("silver")
        o = _orders(spark, sf).withColumn("partition_year", F.year("o_orderdate"))
        odd = F.col("partition_year") % 2 == 1
        K.append_table(o.filter(~odd | F.col("partition_year").isNull()), name, ["partition_year"], created=None)
        for k in range(4):
            K.append_table(o.filter(odd & (F.col("o_orderkey") % 4 == k)), name, ["partition_year"], created=None)
        K.compact_where_needed(spark, name)
        return keep_result(spark.table(name))


@query("cluster_two_columns", "SELECT * FROM orders")
def cluster_two_columns(spark, sf):
    """Laid out along a curve through customer and date."""
    with scratch_store(spark, "curve") as store:
        store.ensure_database("gold")
        name = store.name("gold", "orders_on_curve")
        K.append_table(_orders(spark, sf), name, created=None)
        K.cluster_rewrite(spark, name, ["o_custkey", "o_orderdate"], target_file_mb=1)
        return keep_result(spark.table(name))
