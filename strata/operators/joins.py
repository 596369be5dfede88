"""Join operators: size-checked broadcast, salted join for skew, skew report.

Broadcasting is decided by a measurement, never assumed: one aggregate counts
the small side's rows and sums their real bytes; above either bound the join
is left to Spark's shuffle join (with AQE, which may still convert it at run
time from real shuffle sizes).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType,
                               DateType, DecimalType, FloatType, IntegerType,
                               MapType, ShortType, StringType, StructType, DataType)

# Bounds used when the caller gives none: a broadcast side must have at most
# this many rows and this many bytes (measured, not estimated).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _fixed_width(t) -> int:
    if isinstance(t, (BooleanType, ByteType)):
        return 1
    if isinstance(t, ShortType):
        return 2
    if isinstance(t, (IntegerType, FloatType, DateType)):
        return 4
    if isinstance(t, DecimalType):
        return 16
    return 8


def _value_bytes(c: Column, t: DataType) -> Column:
    """Bytes of one value, NULLs as 8: what Spark holds for it, with the text
    and elements inside arrays, maps and structs."""
    if isinstance(t, (StringType, BinaryType)):
        size = F.octet_length(c) + 8
    elif isinstance(t, ArrayType):
        if isinstance(t.elementType, (StringType, BinaryType, ArrayType, MapType, StructType)):
            size = F.aggregate(c, F.lit(16).cast("long"),
                               lambda n, x: n + _value_bytes(x, t.elementType).cast("long"))
        else:
            size = F.size(c) * 8 + 16
    elif isinstance(t, MapType):
        size = (_value_bytes(F.map_keys(c), ArrayType(t.keyType))
                + _value_bytes(F.map_values(c), ArrayType(t.valueType)))
    elif isinstance(t, StructType):
        size = F.lit(8)
        for f in t.fields:
            size = size + _value_bytes(c[f.name], f.dataType)
    else:
        return F.lit(_fixed_width(t)).cast("long")
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def _row_bytes(df: DataFrame) -> Column:
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        total = total + _value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return total


@dataclass(frozen=True)
class SizeCheck:
    rows: int
    bytes: int
    small: bool


def measure_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                  max_bytes: int = BROADCAST_MAX_BYTES) -> SizeCheck:
    """Rows and bytes of ``df`` by one aggregate: every task sends one row,
    whatever the size of ``df``."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    n, b = int(r["n"]), int(r["b"] or 0)
    return SizeCheck(n, b, n <= max_rows and b <= max_bytes)


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                   max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a fact to a dimension, broadcasting the dimension only when a
    measurement proves it small; otherwise a shuffle join."""
    check = measure_small(dim, max_rows, max_bytes)
    side = F.broadcast(dim) if check.small else dim
    return fact.join(side, on, how)


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str],
                n: int = 10, how: str = "inner",
                salt_from: Sequence[str] | None = None,
                broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
                broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Equi-join that spreads each key of ``big`` over ``n`` salts.

    Salting only helps a shuffled join. If a measurement shows
    ``small`` fits under the broadcast bounds, it is broadcast unsalted: the
    probe side is not shuffled, so a hot key costs nothing extra, while a
    salted broadcast would only be ``n`` times larger. Otherwise the salt is a
    hash of the row (``salt_from``, default all columns of ``big``), not
    ``rand()``: a recomputed task after an executor loss gets the same salt,
    so no row is lost or doubled. Each row of ``small`` is replicated ``n``
    times and the join is hinted to shuffle, so the replicated side is never
    broadcast. ``broadcast_max_rows=None`` always salts.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join keeps every row only for left-driven joins, not {how}")
    if broadcast_max_rows and measure_small(small, broadcast_max_rows, broadcast_max_bytes).small:
        return big.join(F.broadcast(small), keys, how)
    # Hash functions refuse maps, so map columns never feed the salt.
    src_cols = [c for c in (salt_from or big.columns)
                if not isinstance(big.schema[c].dataType, MapType)] or keys
    b = big.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in src_cols]),
                                        F.lit(n)).cast("int"))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).hint("merge")
    return b.join(s, keys + ["__salt"], how).drop("__salt")


def skew_report(df: DataFrame, key: str | Sequence[str], k: int = 20) -> DataFrame:
    """Rows per key, largest first (top ``k``), with each key's share of all
    rows and the max/mean ratio over keys.

    The per-key counts are a partial aggregate; the top-k is a bounded
    ``TakeOrderedAndProject``; the totals are one collected aggregate row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    tot = counts.agg(F.sum("rows").alias("total"), F.count(F.lit(1)).alias("n_keys"),
                     F.max("rows").alias("max_rows")).first()
    total, n_keys, mx = int(tot["total"] or 0), int(tot["n_keys"] or 0), int(tot["max_rows"] or 0)
    mean = total / n_keys if n_keys else 0.0
    top = counts.orderBy(F.col("rows").desc(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)
    return top.select(
        *keys, "rows",
        F.round(F.col("rows") / F.lit(float(total or 1)), 6).alias("share"),
        F.lit(total).cast("long").alias("total_rows"),
        F.lit(n_keys).cast("long").alias("n_keys"),
        F.lit(round(mx / mean, 6) if mean else 0.0).alias("max_over_mean"))


def hot_keys(df: DataFrame, key: str | Sequence[str], share: float = 0.01) -> DataFrame:
    """Every key holding at least ``share`` of all rows, with its count and
    share. No cap is needed: shares sum to 1, so at most ``1 / share`` keys
    can qualify, and the filter is on the exact (unrounded) share."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    total = int(counts.agg(F.sum("rows").alias("t")).first()["t"] or 0)
    return (counts.filter(F.col("rows") / F.lit(float(total or 1)) >= F.lit(float(share)))
            .select(*keys, "rows",
                    F.round(F.col("rows") / F.lit(float(total or 1)), 6).alias("share"),
                    F.lit(total).cast("long").alias("total_rows")))


def skew_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
              share: float = 0.01, n: int = 16) -> DataFrame:
    """Join that salts only the hot keys of ``big``.

    Keys holding at least ``share`` of ``big``'s rows are found with a
    partial aggregate (``hot_keys``); there are at most ``1 / share`` of them,
    a proven bound, so they are broadcast to split ``big`` into hot and cold
    rows without a shuffle. Cold rows take a plain join. Hot rows take a
    salted join against only the hot keys' rows of ``small``, replicated
    ``n`` times, so one key with a third of the rows is spread over ``n``
    tasks while nothing else is replicated. Every row of ``big`` goes to
    exactly one side, so results equal the plain join. Rows with a NULL key
    part match nothing: they take no part in the joins, and come back (left
    and anti joins) without moving at all.
    """
    keys = list(keys)
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"skew join keeps every row only for left-driven joins, not {how}")
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(f"`{k}`").isNull()
    keyed = big.filter(~no_key)
    hot = hot_keys(keyed, keys, share).select(*keys)
    if hot.isEmpty():
        out = keyed.join(small, keys, how)
    else:
        marked = hot.withColumn("__hot", F.lit(True))
        tagged = keyed.join(F.broadcast(marked), keys, "left")
        cold = tagged.filter(F.col("__hot").isNull()).drop("__hot").join(small, keys, how)
        hot_rows = tagged.filter(F.col("__hot").isNotNull()).drop("__hot")
        small_hot = small.join(F.broadcast(hot), keys, "left_semi")
        out = cold.unionByName(salted_join(hot_rows, small_hot, keys, n=n, how=how, broadcast_max_rows=None))
    if how in ("inner", "left_semi"):
        return out
    lost = big.filter(no_key)
    if how != "left_anti":
        lost = lost.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                  for f in small.schema if f.name not in keys])
    return out.unionByName(lost)
