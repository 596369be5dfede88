"""Difference of two snapshots of a source without versions.

Rows are told apart by key and content hash. Both snapshots are reduced to
(key, hash, copies in the old, copies in the new) in one grouping, which
combines before it shuffles; whole rows move only where something changed.
NULL keys are keys, and repeated rows count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.increment import content_hash
from strata.operators.joins import measure_small
from strata.sources.sinks import stage

#: What a row is. ``replaced``: an old row whose key has a new one.
CHANGES = ("same", "insert", "update", "replaced", "delete")


def _narrow(df: DataFrame, keys: Sequence[str], old: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, content_hash(df, rest).alias("__h"), F.lit(int(old)).cast("long").alias("__old"),
                     F.lit(int(not old)).cast("long").alias("__new"))


def snapshot_classes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, __h, change, copies): what became of each distinct row. A row
    that both have counts as ``same`` as often as both have it; further copies
    are an insert or update (in the new one) or replaced or deleted (in the
    old), by whether the other snapshot has the key."""
    keys = list(keys)
    both = _narrow(old, keys, True).unionByName(_narrow(new.select(*old.columns), keys, False))
    rows = stage(both.groupBy(*keys, "__h").agg(F.sum("__old").alias("__old"), F.sum("__new").alias("__new")), "snapshot")
    held = rows.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        (F.sum("__old") > 0).alias("__in_old"), (F.sum("__new") > 0).alias("__in_new"))
    same_key = F.lit(True)
    for i, k in enumerate(keys):
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    extra = F.col("__new") - F.col("__old")

    def found_as(change, copies):
        return F.struct(change.alias("change"), copies.alias("copies"))
    found = rows.join(held, same_key).select(*keys, "__h", F.explode(F.array(
        found_as(F.lit("same"), F.least("__old", "__new")),
        found_as(F.when(F.col("__in_old"), "update").otherwise("insert"), extra),
        found_as(F.when(F.col("__in_new"), "replaced").otherwise("delete"), -extra))).alias("__c"))
    return found.select(*keys, "__h", "__c.change", "__c.copies").where("copies > 0")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str],
                     changes: Sequence[str] = ("insert", "update", "delete")) -> DataFrame:
    """(change, copies, columns of ``old``): one row per distinct changed row,
    in its new state, or its old one if it is gone."""
    keys = list(keys)
    classes = stage(snapshot_classes(old, new, keys).where(F.col("change").isin(*changes)), "changes")
    names = [f"__k{i}" for i in range(len(keys))]
    classes = classes.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__h").alias("__of"), "change", "copies")
    if measure_small(classes).small:
        classes = F.broadcast(classes)
    out = None
    for side, of in ((old, ("replaced", "delete")), (new.select(*old.columns), ("same", "insert", "update"))):
        if not set(of) & set(changes):
            continue
        rest = [c for c in side.columns if c not in keys]
        rows = side.withColumn("__h", content_hash(side, rest))
        on = F.col("__h") == F.col("__of")
        for k, n in zip(keys, names):
            on = on & rows[k].eqNullSafe(F.col(n))
        found = rows.join(classes.where(F.col("change").isin(*of)), on)
        found = found.dropDuplicates([*names, "__of", "change"]).select("change", "copies", *[rows[c] for c in side.columns])
        out = found if out is None else out.unionByName(found)
    return out


def tombstones(old: DataFrame, new: DataFrame, keys: Sequence[str], deleted: str = "is_deleted") -> DataFrame:
    """What to append to a history of ``old`` so that ``latest_by_key(...,
    deleted=...)`` gives ``new``: inserted and updated rows, and the deleted
    keys' last rows, marked."""
    found = snapshot_changes(old, new, keys)
    return found.select(*old.columns, (F.col("change") == "delete").alias(deleted))
