"""Compaction of the partitions that need it."""

import pytest
from pyspark.sql import functions as F

from strata.sources import sinks as K
from tests.conftest import rows


@pytest.fixture
def store(spark, tmp_path):
    s = K.TableStore(spark, str(tmp_path), prefix="compacting")
    s.ensure_database("silver")
    yield s
    spark.sql("DROP DATABASE compacting_silver CASCADE")


def files_of(spark, name):
    return {(r["p"], r["file"]) for r in K.partition_files(spark, name).collect()}


def test_only_partitions_with_small_files_are_rewritten(spark, store):
    name = store.name("silver", "parts")
    df = spark.range(4000).select("id", (F.col("id") % 5).cast("int").alias("p"), F.repeat(F.lit("x"), 20).alias("s"))
    df = df.withColumn("p", F.when(F.col("p") < 4, F.col("p")))  # a NULL partition too
    whole = F.col("p").isin(0, 1)
    df.filter(whole).repartition(1).write.partitionBy("p").saveAsTable(name)
    for k in range(3):
        K.append_table(df.filter(~F.coalesce(whole, F.lit(False)) & (F.col("id") % 3 == k)), name, ["p"], created=None)
    before, content = files_of(spark, name), rows(spark.table(name))
    stats = K.compact_where_needed(spark, name)
    after = files_of(spark, name)
    assert {x for x in before if x[0] in (0, 1)} == {x for x in after if x[0] in (0, 1)}
    assert not {x for x in before if x[0] not in (0, 1)} & after
    assert rows(spark.table(name)) == content
    assert stats.partitions == 3 and stats.files_before == len(before) and stats.files_after == len(after) == 5
    assert K.compact_where_needed(spark, name) is None  # nothing is left to do


def test_choice_of_partitions(spark):
    mb = 1024 * 1024
    sizes = {"one small": [1], "two small": [1, 2], "full": [100, 128, 200], "full and one small": [128, 5],
             "no gain": [90, 95], "hot": [128] * 50 + [1] * 9}
    files = spark.createDataFrame([(p, f"{p}{k}", b * mb) for p, all_ in sizes.items() for k, b in enumerate(all_)], "p string, file string, bytes long")
    got = {r["p"]: (r["small"], r["packed"]) for r in K.partitions_to_compact(files, ["p"]).collect()}
    assert got == {"two small": (2, 1), "hot": (9, 51)}


def test_a_large_partition_spans_several_files(spark, store):
    name = store.name("silver", "large")
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit(1).alias("p"))
    df.repartition(40).write.partitionBy("p").saveAsTable(name)
    stats = K.compact_where_needed(spark, name, target_file_mb=0.5)
    assert 3 <= stats.files_after <= 12 < stats.files_before and spark.table(name).count() == 60_000


def test_unpartitioned_and_empty_tables(spark, store):
    name = store.name("silver", "flat")
    spark.range(100).repartition(6).write.saveAsTable(name)
    assert K.compact_where_needed(spark, name).files_after == 1 and spark.table(name).count() == 100
    assert K.compact_where_needed(spark, name) is None
    empty = store.name("silver", "nothing")
    spark.range(0).write.saveAsTable(empty)
    assert K.compact_where_needed(spark, empty) is None
