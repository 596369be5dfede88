"""Snapshot differences and corrected rows."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import increment as I
from strata.operators import snapshots as SN
from strata.plans import layers as L
from strata.plans.entities import ENTITIES
from tests.conftest import rows

SCHEMA = "k int, a string, b int"
row = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1]))


def brute(old, new):
    o, n, out = Counter(old), Counter(new), []
    in_old, in_new = {r[0] for r in old}, {r[0] for r in new}
    for r in o.keys() | n.keys():
        if both := min(o[r], n[r]):
            out.append(("same", both, *r))
        if n[r] > o[r]:
            out.append(("update" if r[0] in in_old else "insert", n[r] - o[r], *r))
        if o[r] > n[r]:
            out.append(("replaced" if r[0] in in_new else "delete", o[r] - n[r], *r))
    return sorted(out, key=str)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.lists(row, max_size=8), new=st.lists(row, max_size=8))
def test_classes_against_plain_python(spark, old, new):
    got = SN.snapshot_changes(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"], SN.CHANGES)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(old, new)


def test_hash_tells_nulls_and_nested_values_apart(spark):
    df = spark.createDataFrame(
        [(None, "a", [1], {"x": 1}), ("a", None, [1], {"x": 1}), ("a", None, [1, None], {"x": 1}), ("a", None, None, {"x": 1}),
         ("a", None, [], {"x": 1}), ("a", None, [], {"x": None}), ("a", None, [], None)], "p string, q string, r array<int>, m map<string, int>")
    assert df.select(I.content_hash(df, df.columns).alias("h")).distinct().count() == 7
    one = spark.sql("select map('a', 1, 'b', 2) as m union all select map('b', 2, 'a', 1)")
    assert one.select(I.content_hash(one, ["m"]).alias("h")).distinct().count() == 1


def test_changed_rows_compare_with_the_newest(spark):
    tgt = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "n", 1)], "k int, a string, at int")
    src = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d"), (None, "n"), (None, "m")], "k int, a string")
    for probe in (1000, None):
        got = I.changed_rows(src, tgt, ["k"], "at", probe_max_rows=probe)
        assert rows(got) == [(None, "m"), (1, "a"), (3, "d")]
    wider = src.selectExpr("k", "a", "if(k = 2, 5, null) as extra")
    assert (2, "c", 5) in rows(I.changed_rows(wider, tgt, ["k"], "at"))
    assert I.changed_rows(src, None, ["k"], "at") is src


def test_tombstones_hide_a_key(spark):
    df = spark.createDataFrame([(1, 1, False), (1, 2, True), (2, 1, False), (3, 1, True), (3, 2, None)], "k int, v int, gone boolean")
    assert rows(I.latest_by_key(df, ["k"], "v", deleted="gone")) == [(2, 1, False), (3, 2, None)]


def test_reference_mode_knows_no_corrections(spark):
    e = ENTITIES["episodes"]
    held = spark.createDataFrame([(1, "a", "2020-01-01")], "id long, name string, created_date string")
    again = spark.createDataFrame([(1, "b"), (2, "c")], "id long, name string")
    assert rows(L.bronze_increment(e, again, held)) == [(1, "b"), (2, "c")]
    assert rows(L.bronze_increment(e, again, held, reference_mode=True)) == [(2, "c")]
