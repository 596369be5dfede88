"""Clustering on several columns."""

import datetime

import pytest
from pyspark.sql import functions as F

from strata.sources import curve
from strata.sources import sinks as K
from tests.conftest import rows


@pytest.fixture
def store(spark, tmp_path):
    s = K.TableStore(spark, str(tmp_path), prefix="curving")
    s.ensure_database("gold")
    yield s
    spark.sql("DROP DATABASE curving_gold CASCADE")


def files_read(spark, name, col, value):
    """(files whose range of ``col`` holds ``value``, all files)."""
    per = spark.table(name).groupBy(F.col("_metadata.file_path")).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return per.where(F.lit(value).between(F.col("lo"), F.col("hi"))).count(), per.count()


def test_a_filter_on_either_column_skips_files(spark, store):
    name = store.name("gold", "grid")
    df = spark.range(60_000).select(
        (F.xxhash64("id") % 5000).alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    df.write.saveAsTable(name)
    content = rows(spark.table(name))
    stats = K.cluster_rewrite(spark, name, ["a", "s"], target_file_mb=0.06)
    assert stats.files_after >= 50 and rows(spark.table(name)) == content
    for col, values in (("a", (-3000, 0, 3000)), ("s", ("2", "8", "e"))):
        for v in values:
            read, all_files = files_read(spark, name, col, v)
            assert read * 3 <= all_files


def test_equal_rows_span_several_files_and_partitions_stay(spark, store):
    name = store.name("gold", "hot")
    df = spark.range(30_000).select(F.lit(1).alias("a"), F.lit("x").alias("b"), F.sha2(F.col("id").cast("string"), 256).alias("s"),
                                    (F.col("id") % 2).cast("int").alias("p"))
    df.write.partitionBy("p").saveAsTable(name)
    stats = K.cluster_rewrite(spark, name, ["a", "b"], target_file_mb=0.25)
    assert stats.files_after >= 6 and spark.table(name).count() == 30_000
    assert K.partition_columns(spark, name) == ["p"]


def test_places_on_the_curve(spark):
    """Against plain Python: ranks of the values, bits interleaved."""
    day = datetime.date(2020, 1, 1)
    data = [(i, day + datetime.timedelta(days=j)) for i in range(8) for j in range(8)] + [(None, day), (3, None), (None, None)]
    df = spark.createDataFrame(data, "a int, d date")
    got = {(r["a"], r["d"]): r["z"] for r in df.withColumn("z", curve.curve_key(df, ["a", "d"])).collect()}
    # the smallest value is a bound of its own, so value k has number k + 1 and NULL 0
    for a, d in data:
        i, j = 0 if a is None else a + 1, 0 if d is None else (d - day).days + 1
        assert got[a, d] == sum((i >> b & 1) << 2 * b + 1 | (j >> b & 1) << 2 * b for b in range(6))


def test_awkward_columns(spark, store):
    df = spark.createDataFrame([(None, None, float("nan"), [1]), ("", True, 1.5, None), ("né", False, None, [2])],
                               "t string, f boolean, x double, xs array<int>")
    assert len(df.select(curve.curve_key(df, ["t", "f", "x"])).collect()) == 3
    empty = df.where("false")
    assert empty.select(curve.curve_key(empty, ["t", "x"])).count() == 0
    for bad in (["xs"], [], ["t"] * 61):
        with pytest.raises(ValueError):
            curve.curve_key(df, bad)
    name = store.name("gold", "nothing")
    empty.write.saveAsTable(name)
    K.cluster_rewrite(spark, name, ["t", "x"])
    assert spark.table(name).count() == 0
