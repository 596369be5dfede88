"""Property tests: loading in batches through the increments
gives what one full load gives; re-running a batch adds nothing."""

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import columns as C
from strata.operators import increment as I
from tests.conftest import rows

SCHEMA = "k LONG, v LONG, x STRING"

batches = st.lists(
    st.lists(st.tuples(st.integers(0, 12), st.integers(0, 30), st.sampled_from(["a", " b", None, ""])),
             min_size=0, max_size=12),
    min_size=1, max_size=4)


def _load(spark, parts, step):
    target = None
    for part in parts:
        batch = spark.createDataFrame(part, SCHEMA)
        inc = step(batch, target)
        target = inc if target is None else target.unionByName(inc)
        assert step(batch, target).count() == 0            # re-run adds nothing
    return target


@settings(max_examples=4, deadline=None)
@given(batches)
def test_key_increments_equal_full_load(spark, parts):
    seen, uniq = set(), []
    for part in parts:                                      # keys unique across batches
        keep = [r for r in part if r[0] not in seen and not seen.add(r[0])]
        uniq.append(keep)
    loaded = _load(spark, uniq, lambda b, t: I.new_rows(b, t, ["k"], null_safe=True))
    full = [r for part in uniq for r in part]
    assert rows(loaded) == sorted(full, key=lambda t: tuple((v is not None, v) for v in t))


@settings(max_examples=4, deadline=None)
@given(batches)
def test_version_increments_keep_latest_view(spark, parts):
    seen, uniq = set(), []
    for part in parts:                                      # (key, version) unique
        keep = [r for r in part if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]
        uniq.append(keep)
    loaded = _load(spark, uniq, lambda b, t: I.increment_by_version(b, t, ["k"], "v"))
    full = spark.createDataFrame([r for part in uniq for r in part], SCHEMA)
    assert rows(I.latest_by_key(loaded, ["k"], "v")) == rows(I.latest_by_key(full, ["k"], "v"))


@settings(max_examples=3, deadline=None)
@given(batches)
def test_clean_strings_idempotent(spark, parts):
    df = spark.createDataFrame([r for part in parts for r in part], SCHEMA)
    once = C.clean_strings(df)
    assert rows(C.clean_strings(once)) == rows(once)
    assert once.filter("x IS NULL OR x = '' OR x != trim(x)").count() == 0
