"""Incremental-load operators: high-water mark, key and version increments,
latest version per key.

Only aggregate rows reach the driver: the high-water mark, and the measured
size of a batch's keys. A batch whose keys measure small probes
the target through a broadcast of those keys (the target is scanned, never
shuffled). Otherwise every step is a shuffle on the key after map-side
pre-aggregation, so a key holding a large share of the rows is reduced
before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, IntegralType, MapType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from strata.functions.scalars import LOW_WATER_DEFAULT
from strata.operators.joins import BROADCAST_MAX_ROWS, measure_small
from strata.session import shared_dir


def _default_for(dtype) -> object | None:
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return LOW_WATER_DEFAULT
    if isinstance(dtype, DateType):
        return LOW_WATER_DEFAULT[:10]
    return None


def high_water_frame(df: DataFrame, column: str | Column, default: object = None,
                     alias: str = "high_water") -> DataFrame:
    """One-row frame with ``coalesce(max(column), default)``."""
    c = F.col(column) if isinstance(column, str) else column
    agg = F.max(c)
    if default is not None:
        agg = F.coalesce(agg, F.lit(default).cast(df.select(c).schema[0].dataType))
    return df.agg(agg.alias(alias))


def high_water(df: DataFrame | None, column: str, default: object = "auto") -> Column | None:
    """The target's maximum of ``column`` as a typed literal Column.

    The maximum is collected (one row) and rebuilt as a constant of the
    column's type, which Catalyst folds into a literal that reaches the
    scan's pushed filters. Wall-clock types, dates and numbers travel as
    text, which round-trips exactly. A ``timestamp`` (an instant shown in
    the session zone) travels as epoch microseconds: its text would be
    ambiguous in the doubled hour of a DST night. ``default="auto"`` uses
    1900-01-01 for time columns. Returns None when there is no target or no
    maximum and no default.
    """
    if df is None:
        return None
    dtype = df.schema[column].dataType
    if default == "auto":
        default = _default_for(dtype)
    if isinstance(dtype, TimestampType):
        m = df.agg(F.unix_micros(F.max(column)).alias("m")).first()["m"]
        if m is not None:
            return F.timestamp_micros(F.lit(int(m)))
    else:
        m = df.agg(F.max(column).cast("string").alias("m")).first()["m"]
        if m is not None:
            return F.lit(str(m)).cast(dtype)
    if default is None:
        return None
    return F.lit(str(default)).cast(dtype)


def increment_by_watermark(src: DataFrame, tgt: DataFrame | None, column: str,
                           tgt_column: str | None = None,
                           default: object = "auto") -> DataFrame:
    """Rows of ``src`` whose ``column`` is strictly above the target's max.

    No target (first load) keeps everything. An empty target falls back to
    the default low-water mark instead of dropping every row (D9).
    """
    if tgt is None:
        return src
    hw = high_water(tgt, tgt_column or column, default)
    if hw is None:
        return src
    return src.filter(F.col(column) > hw)


def _key_condition(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   right_names: Sequence[str], null_safe: bool) -> Column:
    cond = None
    for k, rk in zip(keys, right_names):
        c = left[k].eqNullSafe(right[rk]) if null_safe else (left[k] == right[rk])
        cond = c if cond is None else (cond & c)
    return cond


def _batch_keys(src: DataFrame, keys: Sequence[str], probe_max_rows: int | None):
    """The source's keys when a measurement proves them small enough to
    broadcast, else None. They are measured as they come: making them
    distinct first would be a shuffle, and a semi join needs none."""
    if not probe_max_rows:
        return None
    sk = src.select(*keys)
    return sk if measure_small(sk, probe_max_rows).small else None


def _target_keys(tgt: DataFrame, tgt_keys: Sequence[str], renamed: Sequence[str],
                 batch_keys: DataFrame | None, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Target key columns, renamed. With ``batch_keys`` (small, measured) the
    target is first probed map-side against the broadcast batch keys (semi
    join), so only keys the batch contains survive: the target history is
    scanned but never shuffled."""
    t = tgt.select(*[F.col(k).alias(r) for k, r in zip(tgt_keys, renamed)])
    if batch_keys is not None:
        b = F.broadcast(batch_keys)
        t = t.join(b, _key_condition(t, b, renamed, keys, null_safe), "left_semi")
    return t


def new_rows(src: DataFrame, tgt: DataFrame | None, keys: Sequence[str],
             null_safe: bool = False, tgt_keys: Sequence[str] | None = None,
             probe_max_rows: int | None = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of ``src`` whose key is absent from ``tgt`` (left anti join).

    With ``null_safe=False`` a NULL key part never matches, as with ``=``, so
    such rows come back on every run (D3); ``null_safe=True`` matches NULL to
    NULL.

    Two plans. A batch whose keys measure at most
    ``probe_max_rows`` probes the target through a broadcast of those keys,
    and the matched target keys (bounded by the batch's) are broadcast into
    the anti join: no shuffle of either side. Otherwise the target keys are
    de-duplicated map-side before a shuffled anti join, so an append-only
    history is not moved whole. The measurement computes the batch's keys
    once more: cheap for a batch that is a scan of new files; for an
    expensive derived source pass ``probe_max_rows=None``.
    """
    if tgt is None:
        return src
    keys = list(keys)
    tgt_keys = list(tgt_keys or keys)
    renamed = [f"__tk{i}" for i in range(len(keys))]
    batch = _batch_keys(src, keys, probe_max_rows)
    t = _target_keys(tgt, tgt_keys, renamed, batch, keys, null_safe).distinct()
    if batch is not None:
        t = F.broadcast(t)
    return src.join(t, _key_condition(src, t, keys, renamed, null_safe), "left_anti")


def increment_by_version(src: DataFrame, tgt: DataFrame | None, keys: Sequence[str],
                         version: str, null_safe: bool = True,
                         tgt_version: str | None = None,
                         probe_max_rows: int | None = BROADCAST_MAX_ROWS,
                         few_new: bool = False) -> DataFrame:
    """Rows of ``src`` that are newer than the target's version *of the same
    key*, or whose key the target lacks (I4).

    The target is reduced to one row per key with a partial ``max`` before
    the shuffle; the join is many-to-one, so AQE can split a hot source key.
    A NULL source version only enters for a key the target lacks. As in
    ``new_rows``, a small batch (measured) probes the target through a
    broadcast of its keys and gets the per-key versions back by broadcast.

    ``few_new`` is for a larger batch of which little should be new, as on a
    repeated load: its keys and versions alone meet the target first, those of
    buckets in which both sides hold the same left out, and if the new ones
    measure small, the rows are picked by a broadcast of them and stay where
    they are. This reads the batch's keys up to twice more.
    """
    if tgt is None:
        return src
    keys = list(keys)
    renamed = [f"__tk{i}" for i in range(len(keys))]
    batch = _batch_keys(src, keys, probe_max_rows)
    if batch is None and few_new:
        on = [*keys, version]
        now, held = src.select(*on), tgt.select(*keys, F.col(tgt_version or version).alias(version))
        if null_safe and _hashes_by_value(now, held, keys):
            differing = _differing_buckets(now, held, keys)
            if not differing:
                return src.filter(F.lit(False))
            if len(differing) < KEY_BUCKETS:
                now, held = [df.filter(_key_bucket(keys).isin(differing)) for df in (now, held)]
        found = increment_by_version(now, held, keys, version, null_safe, probe_max_rows=None)
        shared_dir(src.sparkSession)                  # the checkpoint folder must be set
        found = found.toDF(*[f"__nk{i}" for i in range(len(on))]).checkpoint(eager=True)
        if measure_small(found).small:
            b = F.broadcast(found)
            return src.join(b, _key_condition(src, b, on, found.columns, True), "left_semi")
    t = tgt.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)],
                   F.col(tgt_version or version).alias("__v"))
    if batch is not None:
        b = F.broadcast(batch)
        t = t.join(b, _key_condition(t, b, renamed, keys, null_safe), "left_semi")
    tv = t.groupBy(*renamed).agg(F.max("__v").alias("__tv"), F.max(F.lit(True)).alias("__hit"))
    if batch is not None:
        tv = F.broadcast(tv)
    joined = src.join(tv, _key_condition(src, tv, keys, renamed, null_safe), "left")
    v, tver, hit = F.col(version), F.col("__tv"), F.col("__hit")
    keep = hit.isNull() | (tver.isNull() & v.isNotNull()) | (v > tver)
    return joined.filter(keep).select(*[src[c] for c in src.columns])


# Fixed value: buckets of keys in which two sides are compared by sums.
KEY_BUCKETS = 4096


def _hashes_by_value(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    """Do equal keys of both sides have equal hashes? Not across types, and not
    where values that differ in their bits are equal (0.0 and -0.0)."""
    return all(a.schema[k].dataType == b.schema[k].dataType
               and isinstance(a.schema[k].dataType, (IntegralType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType))
               and "collate" not in a.schema[k].dataType.simpleString() for k in keys)


def _key_hash(keys: Sequence[str]) -> Column:
    """A 64-bit hash of the keys; NULLs, which hash functions skip, are marked."""
    return F.xxhash64(*[p for k in keys for p in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())])


def _key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(_key_hash(keys), F.lit(KEY_BUCKETS))


def _differing_buckets(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> list[int]:
    """The buckets of keys in which the rows of ``a`` and ``b`` (same columns,
    in the same order) are not the same ones, each as often. Told by the number
    of rows and the sum of their 128-bit hashes, so of each bucket and task one
    row moves, and at most ``KEY_BUCKETS`` numbers reach the driver."""
    def signed(df: DataFrame, sign: int) -> DataFrame:
        h = content_hash(df, df.columns)
        halves = [part for x in (h["h1"], h["h2"]) for part in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
        return df.select(_key_bucket(keys).alias("__bucket"), *[(F.lit(sign) * v).cast("long").alias(f"__s{i}")
                                                                for i, v in enumerate([F.lit(1), *halves])])
    sums = [f"__s{i}" for i in range(5)]
    both = signed(a, 1).unionAll(signed(b, -1)).groupBy("__bucket").agg(*[F.sum(s).alias(s) for s in sums])
    return [r[0] for r in both.filter(" or ".join(f"{s} != 0" for s in sums)).select("__bucket").collect()]


def content_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits that tell rows apart by the values of ``columns``. Hash
    functions skip NULLs, and refuse maps, so NULLs are marked and nested
    values go in as text."""
    def marked(name: str) -> list[Column]:
        c, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(kind, MapType):
            c, kind = F.array_sort(F.map_entries(c)), ArrayType(kind)
        if isinstance(kind, (ArrayType, StructType)):
            c = F.to_json(c, {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
                              "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
        return [c, c.isNull()]
    parts = [p for name in columns for p in marked(name)] or [F.lit(0)]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))


def changed_rows(src: DataFrame, tgt: DataFrame | None, keys: Sequence[str], order: str,
                 ignore: Sequence[str] = (), probe_max_rows: int | None = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of ``src`` whose key ``tgt`` lacks, or whose content differs from
    the key's newest row there (by ``order``): the increment of a source that
    corrects its rows without a version. NULL keys are keys.

    The columns of ``src`` are compared, but the keys, ``order`` and
    ``ignore``; one that the target lacks counts as NULL there. The target is
    reduced to one 128-bit hash per key (a partial aggregate) before it moves,
    and a small batch (measured) probes it through a broadcast of its keys, as
    in ``increment_by_version``."""
    if tgt is None:
        return src
    keys = list(keys)
    compared = [c for c in src.columns if c not in {*keys, order, *ignore}]
    renamed = [f"__tk{i}" for i in range(len(keys))]
    missing = [F.lit(None).cast(src.schema[c].dataType).alias(c) for c in compared if c not in tgt.columns]
    t = tgt.select("*", *missing)
    # in the target's own types values may be wider, never different
    t = t.select(*[F.col(f"`{k}`").alias(r) for k, r in zip(keys, renamed)], F.col(f"`{order}`").alias("__order"),
                 *[F.col(f"`{c}`").cast(src.schema[c].dataType).alias(c) for c in compared])
    t = t.select(*renamed, "__order", content_hash(t, compared).alias("__was"))
    batch = _batch_keys(src, keys, probe_max_rows)
    if batch is not None:
        b = F.broadcast(batch)
        t = t.join(b, _key_condition(t, b, renamed, keys, True), "left_semi")
    newest = t.groupBy(*renamed).agg(F.max_by("__was", F.struct("__order", "__was")).alias("__was"))
    if batch is not None:
        newest = F.broadcast(newest)
    now = src.withColumn("__now", content_hash(src, compared))
    joined = now.join(newest, _key_condition(now, newest, keys, renamed, True), "left")
    return joined.filter(~F.col("__now").eqNullSafe(F.col("__was"))).select(*[src[c] for c in src.columns])


def _repeated(df: DataFrame, keys: Sequence[str]) -> tuple[Column, DataFrame]:
    """A 64-bit hash of the keys, and its values that more than one row has:
    every repeated key's is among them. Computed once, from the keys alone."""
    key = _key_hash(keys)
    shared_dir(df.sparkSession)                       # the checkpoint folder must be set
    found = (df.groupBy(key.alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
             .filter("__n > 1").select("__key").checkpoint(eager=True))
    return key, found


def latest_by_key(df: DataFrame, keys: Sequence[str], version: str,
                  tiebreak: Sequence[str] | str | None = None, deleted: str | None = None,
                  columns: Sequence[str] | None = None, few_repeats: bool = False) -> DataFrame:
    """The newest row per key of an append-only history (I5). With ``deleted``
    (a boolean column that marks tombstones) a key whose newest row is one is
    left out.

    ``max_by`` is a partial aggregate: each task keeps one candidate per key
    before the shuffle, so a key with a third of all rows costs no more than
    any other. Ties on ``version`` go to the largest ``tiebreak``, then to the
    largest hash of the row, so that the choice is the same on every run.

    ``columns``: those to return, if not all; no others move. ``few_repeats``
    is for a batch that should hold each key once: the keys alone are counted
    first, and if the repeated ones measure small, the rows of all others stay
    where they are. This computes the batch's keys once more.
    """
    keys = list(keys)
    if isinstance(tiebreak, str):
        tiebreak = [tiebreak]
    out = list(columns or df.columns)
    if few_repeats:
        key, found = _repeated(df, keys)
        size = measure_small(found)
        if size.small:
            single, many = df, None
            if size.rows:
                marked = df.withColumn("__key", key)
                single = marked.join(F.broadcast(found), "__key", "left_anti")
                many = marked.join(F.broadcast(found), "__key", "left_semi").select(*df.columns)
                many = latest_by_key(many, keys, version, tiebreak, deleted, columns)
            if deleted:
                single = single.filter(~F.coalesce(F.col(deleted), F.lit(False)))
            single = single.select(*out)
            return single if many is None else single.unionByName(many)
    rest = [c for c in df.columns if c not in keys]
    plain = [c for c in rest if not isinstance(df.schema[c].dataType, MapType)]
    last = [F.xxhash64(*[F.col(f"`{c}`") for c in plain]).alias("__hash")] if plain else []
    order = F.struct(*[F.col(c) for c in [version, *(tiebreak or [])]], *last)
    kept = [c for c in rest if c in out or c == deleted]
    picked = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in kept]), order).alias("__row")))
    rows = picked.select(*keys, *[F.col("__row")[c].alias(c) for c in kept])
    if deleted:
        rows = rows.filter(~F.coalesce(F.col(deleted), F.lit(False)))
    return rows.select(*out)
