"""Connected components of a link table, by alternating star contraction.

Each round replaces links by links to the smallest neighbour, first for the
larger neighbours of every node (large star), then for the smaller ones
(small star), until every component is one star around its smallest node. It
takes a logarithmic number of rounds in practice. Each step is a grouped
minimum and an equi-join, so a hub with many links is reduced before it is
shuffled and the joined side can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def _totals(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _relink(links: DataFrame, towards_smaller: bool) -> DataFrame:
    """Links (u, v) grouped by u: every v, and u itself, gets the smallest of
    v and u as its neighbour. ``towards_smaller``: only the v below u are
    given (small star); otherwise only the v above u are linked anew."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = links.join(least, "u")
    if towards_smaller:
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        return new.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that ``links`` names, root being the
    smallest node of its component. Self links and repeated links are fine;
    a link with a NULL end is none. No links give no rows."""
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    edges = staged(pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    before = _totals(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = _relink(both, towards_smaller=False)
        edges = staged(_relink(stars, towards_smaller=True), "links")
        now = _totals(edges)
        if now == before:
            break
        before = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
