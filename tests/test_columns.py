import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import columns as C
from tests.conftest import rows


def test_flatten_nested_null_missing_and_arrays(spark):
    df = spark.createDataFrame(
        [(1, {"a": {"b": {"c": 5}}, "tags": ["x"]}, None),
         (2, None, {"k": "v"}),
         (3, {"a": None, "tags": []}, {"k": None})],
        "id INT, s STRUCT<a: STRUCT<b: STRUCT<c: INT>>, tags: ARRAY<STRING>>, t STRUCT<k: STRING>")
    out = C.flatten_structs(df)
    assert out.columns == ["id", "s_a_b_c", "s_tags", "t_k"]
    assert rows(out) == [(1, 5, ["x"], None), (2, None, None, "v"), (3, None, [], None)]


def test_flatten_collision_raises_or_suffixes(spark):
    df = spark.createDataFrame([(1, {"b": 2})], "a_b INT, a STRUCT<b: INT>")
    with pytest.raises(C.NameCollision):
        C.flatten_structs(df)
    assert C.flatten_structs(df, on_collision="suffix").columns == ["a_b", "a_b_1"]


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Rating.Average", "first name", "x-y", "Cost (USD)"])
    assert C.normalize_names(df).columns == ["rating_average", "first_name", "x_y", "cost_usd"]
    clash = spark.createDataFrame([(1, 2)], ["a.b", "A_B"])
    with pytest.raises(C.NameCollision):
        C.normalize_names(clash)


def test_clean_strings_edge_rows_and_idempotent(spark):
    df = spark.createDataFrame(
        [(1, None, ["  a "], dt.date(2020, 1, 1)), (2, "", None, None), (3, "  ", None, None),
         (4, " a ", None, None), (5, "\t", None, None), (6, "NAFS", None, None)],
        "id INT, s STRING, arr ARRAY<STRING>, d DATE")
    once = C.clean_strings(df)
    got = {r["id"]: r["s"] for r in once.collect()}
    assert got == {1: "NAFS", 2: "NAFS", 3: "NAFS", 4: "a", 5: "\t", 6: "NAFS"}
    assert once.filter("id = 1").first()["arr"] == ["  a "]
    assert rows(C.clean_strings(once)) == rows(once)


def test_apply_types_bad_text_is_null(spark):
    df = spark.createDataFrame(
        [("abc", "", "2020-02-30", "2024-01-05T10:30:00+05:00"),
         ("7", "3", "2020-02-29", "1970-01-01T00:00:00Z")],
        "a STRING, b STRING, d STRING, t STRING")
    out = C.apply_types(df, {"a": "bigint", "b": "int", "d": "date",
                             "t": F.unix_seconds(F.col("t").try_cast("timestamp"))})
    assert rows(out) == [(None, None, None, 1704432600), (7, 3, dt.date(2020, 2, 29), 0)]


def test_fill_numbers_nan_stays(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, 1.5)], "id INT, x DOUBLE")
    got = {r["id"]: r["x"] for r in C.fill_numbers(df, {"x": 0.0}).collect()}
    assert got[1] == 0.0 and got[3] == 1.5 and got[2] != got[2]


def test_require_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k INT, j STRING")
    assert rows(C.require_keys(df, ["k", "j"])) == [(1, "a")]


def test_explode_rows_inner_and_outer(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, "a", "a"])], "id INT, g ARRAY<STRING>")
    assert rows(C.explode_rows(df, "g", "genre")) == [(3, None), (3, "a"), (3, "a")]
    assert len(rows(C.explode_rows(df, "g", "genre", outer=True))) == 5


def test_date_parts_null_goes_null(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),), (None,)], "ts TIMESTAMP_NTZ")
    out = C.with_date_parts(df, "ts")
    assert rows(out.select("partition_year", "partition_month", "partition_day")) == [
        (None, None, None), (2024, 3, 10)]


def test_epoch_times_keep_both_instants_of_a_dst_night(spark):
    from strata.functions.scalars import epoch_to_ntz
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 05:30 and 06:30 UTC on 2024-11-03 are both 01:30 on New York clocks.
        df = spark.createDataFrame([(1730611800,), (1730615400,)], "e LONG")
        text = {r[0] for r in df.select(F.from_unixtime("e")).collect()}
        assert len(text) == 1                                   # a text round trip merges them
        got = [r[0] for r in df.select(epoch_to_ntz("e")).orderBy(1).collect()]
        assert got == [dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30)]
        parts = C.with_date_parts(df.select(epoch_to_ntz("e").alias("t")), "t")
        assert {r["partition_day"] for r in parts.collect()} == {3}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
