import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import sinks as K
from tests.conftest import SF_SMALL, rows


@pytest.fixture()
def store(spark):
    return K.TableStore(spark, scratch_path(spark, "sink-tests"), prefix=f"t{uuid.uuid4().hex[:8]}")


def test_append_evolves_schema(spark, store):
    store.ensure_database("bronze")
    name = store.name("bronze", "t")
    K.append_table(spark.createDataFrame([(1, "a")], "id INT, x STRING"), name, created=None)
    K.append_table(spark.createDataFrame([("b", 2, 9.5)], "x STRING, id INT, y DOUBLE"), name, created=None)
    K.append_table(spark.createDataFrame([(3,)], "id INT"), name, created=None)
    back = spark.table(name)
    assert back.columns == ["id", "x", "y"]
    assert rows(back) == [(1, "a", None), (2, "b", 9.5), (3, None, None)]


def test_created_date_added_once(spark, store):
    store.ensure_database("bronze")
    name = store.name("bronze", "c")
    K.append_table(spark.createDataFrame([(1,)], "id INT"), name)
    K.append_table(spark.createDataFrame([(2,)], "id INT"), name)
    back = spark.table(name)
    assert back.columns == ["id", "created_date"]
    assert back.filter(F.col("created_date").isNull()).count() == 0


def test_partitioned_append_null_partition_and_dynamic_overwrite(spark, store):
    store.ensure_database("silver")
    name = store.name("silver", "p")
    df = spark.createDataFrame([(1, 2024), (2, 2024), (3, 2025), (4, None)], "id INT, partition_year INT")
    K.write_table(df, name, "append", partition_by=["partition_year"], created=None)
    K.write_table(spark.createDataFrame([(9, 2024)], "id INT, partition_year INT"), name,
                  "overwrite", partition_by=["partition_year"], created=None)
    assert rows(spark.table(name)) == [(3, 2025), (4, None), (9, 2024)]
    assert spark.table(name).filter("partition_year IS NULL").count() == 1


def test_overwrite_of_table_being_read(spark, store):
    store.ensure_database("gold")
    name = store.name("gold", "o")
    K.write_table(spark.createDataFrame([(1,), (2,)], "id INT"), name, "append", created=None)
    K.overwrite_table(spark.table(name).withColumn("id", F.col("id") * 10), name, created=None)
    assert rows(spark.table(name)) == [(10,), (20,)]


def test_write_if_any_skips_empty(spark, store):
    store.ensure_database("gold")
    name = store.name("gold", "e")
    assert not K.write_if_any(spark.createDataFrame([], "id INT"), lambda d: K.append_table(d, name))
    assert not K.table_exists(spark, name)
    assert K.load_kind(spark, name) == "first"


def test_compaction_and_clustering_keep_rows(spark, store):
    store.ensure_database("silver")
    name = store.name("silver", "small")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    K.append_table(o.repartition(12), name, created=None)
    before = rows(spark.table(name))
    st = K.compact(spark, name, target_file_mb=1)
    assert st.files_before == 12 and st.files_after < 12
    assert rows(spark.table(name)) == before
    assert K.cluster_rewrite(spark, name, []) is None
    K.cluster_rewrite(spark, name, ["o_custkey"], target_file_mb=0.01)
    assert rows(spark.table(name)) == before
    per_file = (spark.table(name).groupBy(F.input_file_name().alias("f"))
                .agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi"))
                .orderBy("lo").collect())
    assert len(per_file) > 1
    assert all(a["hi"] < b["lo"] for a, b in zip(per_file, per_file[1:]))


def test_compaction_of_partitioned_table(spark, store):
    store.ensure_database("silver")
    name = store.name("silver", "pp")
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("p"),
                                  F.lit(dt.date(2024, 1, 1)).alias("d"))
    K.write_table(df.repartition(10), name, "append", partition_by=["p"], created=None, layout=False)
    st = K.compact(spark, name, target_file_mb=16)
    assert st.files_after < st.files_before
    assert K.partition_columns(spark, name) == ["p"]
    assert spark.table(name).count() == 3000


def test_since_last_load_prunes_upstream(spark, store):
    import time as _t

    from strata.plans.layers import since_last_load
    store.ensure_database("bronze")
    store.ensure_database("silver")
    up, down = store.name("bronze", "up"), store.name("silver", "down")
    K.append_table(spark.createDataFrame([(1,)], "id INT"), up)
    K.append_table(spark.table(up).withColumnRenamed("created_date", "created_at"), down)
    _t.sleep(0.01)
    K.append_table(spark.createDataFrame([(2,)], "id INT"), up)
    new = since_last_load(spark.table(up), spark.table(down), "created_date", "created_at")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_date" in plan
    assert rows(new.select("id")) == [(1,), (2,)]       # equal stamps stay in


def test_append_widens_safely_and_refuses_lossy_types(spark, store):
    store.ensure_database("bronze")
    name = store.name("bronze", "w")
    K.append_table(spark.createDataFrame([(1, 1.5, "a")], "id BIGINT, x DOUBLE, s STRING"), name, created=None)
    K.append_table(spark.createDataFrame([(2, 2.5, 7)], "id INT, x FLOAT, s INT"), name, created=None)
    assert rows(spark.table(name)) == [(1, 1.5, "a"), (2, 2.5, "7")]
    with pytest.raises(K.SchemaMismatch):
        K.append_table(spark.createDataFrame([("abc", 1.0, "b")], "id STRING, x DOUBLE, s STRING"),
                       name, created=None)
    assert spark.table(name).count() == 2


def test_partitioned_write_keeps_about_one_file_per_partition(spark, store):
    store.ensure_database("silver")
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 5).cast("int").alias("p")).repartition(8)
    laid, raw = store.name("silver", "laid"), store.name("silver", "raw")
    K.write_table(df, laid, "append", partition_by=["p"], created=None)
    K.write_table(df, raw, "append", partition_by=["p"], created=None, layout=False)
    assert K.file_count(spark, raw) == 40                   # 8 tasks x 5 values
    assert K.file_count(spark, laid) <= 5 + 8               # about one per value
    assert rows(spark.table(laid)) == rows(spark.table(raw))


LOSSY = [("BIGINT", "DOUBLE"), ("BIGINT", "DECIMAL(18,0)"), ("INT", "DECIMAL(10,1)"), ("INT", "FLOAT"), ("DOUBLE", "BIGINT"),
         ("DECIMAL(10,2)", "DECIMAL(10,1)"), ("DECIMAL(10,2)", "DECIMAL(9,2)"), ("TIMESTAMP", "DATE"), ("BINARY", "STRING"),
         ("STRUCT<a: BIGINT>", "STRUCT<a: INT>"), ("ARRAY<STRING>", "ARRAY<INT>"), ("ARRAY<INT>", "STRING")]
SAFE = [("INT", "DECIMAL(12,2)"), ("BIGINT", "DECIMAL(19,0)"), ("SMALLINT", "FLOAT"), ("INT", "DOUBLE"), ("DATE", "TIMESTAMP"),
        ("DECIMAL(10,2)", "DECIMAL(12,4)"), ("STRUCT<a: INT>", "STRUCT<b: STRING, a: BIGINT>"), ("MAP<STRING, INT>", "MAP<STRING, BIGINT>")]


@pytest.mark.parametrize("src, tgt, ok", [(*x, False) for x in LOSSY] + [(*x, True) for x in SAFE])
def test_widening_is_exact(src, tgt, ok):
    from pyspark.sql.types import StructType
    a, b = (StructType.fromDDL(f"x {t}")[0].dataType for t in (src, tgt))
    assert K.widens_to(a, b) is ok


@pytest.mark.parametrize("write", [
    lambda d, n: K.append_table(d, n, created=None), lambda d, n: K.overwrite_table(d, n, created=None),
    lambda d, n: K.write_table(d, n, "overwrite", partition_by=["p"], created=None)])
def test_no_write_path_loses_values(spark, store, write):
    store.ensure_database("silver")
    name = store.name("silver", "lossless")
    K.write_table(spark.createDataFrame([(1, 2)], "a INT, p INT"), name, partition_by=["p"], created=None)
    with pytest.raises(K.SchemaMismatch):
        write(spark.createDataFrame([("x", 2)], "a STRING, p INT"), name)
    assert rows(spark.table(name)) == [(1, 2)]
    write(spark.createDataFrame([(5, 7, 3)], "a INT, extra INT, p INT"), name)
    assert (5, 7, 3) in {(r["a"], r["extra"], r["p"]) for r in spark.table(name).collect()}


def test_new_columns_raise_without_evolve(spark, store):
    store.ensure_database("bronze")
    name = store.name("bronze", "fixed")
    K.append_table(spark.createDataFrame([(1,)], "a INT"), name, created=None)
    more = spark.createDataFrame([(1, 2)], "a INT, b INT")
    for write in (lambda: K.append_table(more, name, evolve=False, created=None),
                  lambda: K.overwrite_table(more, name, evolve=False, created=None)):
        with pytest.raises(K.SchemaMismatch):
            write()
    assert spark.table(name).columns == ["a"]


def test_nested_evolution_of_a_partitioned_table(spark, store):
    store.ensure_database("bronze")
    name = store.name("bronze", "nested")
    K.write_table(spark.createDataFrame([(("x",), 1)], "s STRUCT<a: STRING>, p INT"), name, partition_by=["p"], created=None)
    K.write_table(spark.createDataFrame([((2, None), 2), (None, 1)], "s STRUCT<b: INT, a: STRING>, p INT"), name,
                  partition_by=["p"], created=None)
    assert K.partition_columns(spark, name) == ["p"]
    got = {(r["p"], r["s"] and tuple(r["s"])) for r in spark.table(name).collect()}
    assert got == {(1, ("x", None)), (2, (None, 2)), (1, None)}
    assert not [t for t in spark.catalog.listTables(name.split(".")[0]) if "staging" in t.name]


def test_an_increment_is_computed_once(spark, store):
    store.ensure_database("gold")
    seen = spark.sparkContext.accumulator(0)

    def tick(batches):
        seen.add(1)
        yield from batches
    df = spark.range(10).repartition(1).mapInArrow(tick, "id long").withColumn("p", F.col("id") % 2)
    assert K.write_if_any(df, lambda d: K.append_table(d, store.name("gold", "once"), ["p"]))
    assert seen.value == 1


def test_rows_are_dealt_out_by_counts_of_partition_values(spark):
    """equal pieces in the order of the partition columns, without a pass over whole rows; a hot value spans several."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 4 > 0, F.lit(7)).when(F.col("id") % 8 == 0, (F.col("id") / 100).cast("int"))
                                  .alias("p"), F.expr("map(id, 'x')").alias("m"))
    dealt = K._layout_by_counts(df, 8, ["p"])
    assert dealt.columns == df.columns and "rangepartitioning" not in dealt._jdf.queryExecution().executedPlan().toString()
    assert rows(dealt.select("id", "p")) == rows(df.select("id", "p"))
    of = dealt.select("p", F.spark_partition_id().alias("piece")).groupBy("piece").agg(
        F.count("*").alias("n"), F.min(F.coalesce("p", F.lit(-1))).alias("lo"), F.max(F.coalesce("p", F.lit(-1))).alias("hi")).orderBy("piece").collect()
    assert len(of) == 8 and all(300 < r["n"] < 700 for r in of)
    assert all(a["hi"] <= b["lo"] for a, b in zip(of, of[1:]))
    assert K._layout_by_counts(df.limit(0), 8, ["p"]).count() == 0


def test_reads_that_shuffle_are_told_apart(spark):
    df = spark.range(10)
    assert not K.moves_rows(df.filter("id > 3")) and K.moves_rows(df.groupBy(F.col("id") % 2).count())
