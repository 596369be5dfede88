"""Marts over the star of parents (shows), children (episodes) and a
many-to-many bridge (cast).

The denormalised fact is ``distinct(children ⋈ parents ⋈left bridge,
explode(tags))`` with one row per child × tag × bridge row of the same
parent: every pair inside a parent. It is never materialised here. Each mart
is an aggregate of that product, and every such aggregate factors into
per-parent aggregates of the three inputs:

* rows per (parent, tag)   = tags × distinct children × max(distinct bridge rows, 1)
* distinct children per (parent, name, season) = distinct children per
  (parent, season), since every child pairs with every name of its parent
* average per (parent, name) over fact rows = average over distinct children,
  since each child of a parent is repeated the same number of times
* distinct parents per person = distinct parents of its bridge rows

So each mart is a few partial aggregates and joins on per-parent rows; no
step grows with the product, and a parent holding a third of all children
is pre-aggregated before any shuffle. The SQL oracle builds the product and
aggregates it; the results match.

Column names follow the fact: parents ``show_id, show_name, language,
genres``; children ``show_id, season, episode_id, episode_name, airdate,
runtime``; bridge ``show_id, person_id, cast_name, character_id,
character_name``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalars import BLANK_DEFAULT, clean_string
from strata.operators.increment import content_hash
from strata.session import fine_partitions, shared_dir

log = logging.getLogger(__name__)

PARENT_COLS = ["show_id", "show_name", "language", "genres"]
CHILD_COLS = ["show_id", "season", "episode_id", "episode_name", "airdate", "runtime"]
BRIDGE_COLS = ["show_id", "person_id", "cast_name", "character_id", "character_name"]


@dataclass(frozen=True)
class Star:
    parents: DataFrame
    children: DataFrame
    bridge: DataFrame
    # Per-parent aggregates shared by several marts, once computed (see
    # ``shared``); None means each mart computes what it needs.
    per_parent: DataFrame | None = None

    def shared(self) -> "Star":
        """The same star with its per-parent aggregates computed once and
        checkpointed (reliably, to the session's checkpoint folder). They hold
        one row per parent, and every mart built from the returned star reads
        them instead of scanning children and bridge again."""
        shared_dir(self.parents.sparkSession)      # the checkpoint folder must be set
        per = _per_parent_counts(self, with_avg=True).checkpoint(eager=True)
        return replace(self, per_parent=per)

    # --- factors -----------------------------------------------------------
    def parent_tags(self) -> DataFrame:
        """Distinct (show_id, show_name, language, genre); parents with a NULL
        or empty tag array drop out, as with ``explode``."""
        return (self.parents.select("show_id", "show_name", "language",
                                    F.explode("genres").alias("genre"))
                .distinct())

    def parent_names(self) -> DataFrame:
        """Distinct (show_id, cleaned show_name) of parents with tags, as the
        fact's cleaned name column has them; one aggregation."""
        return (self.parents.filter(F.size("genres") > 0)
                .select("show_id", clean_string("show_name").alias("show_name")).distinct())

    def child_rows(self) -> DataFrame:
        return self.children.select(*CHILD_COLS).distinct()

    def bridge_rows(self) -> DataFrame:
        return self.bridge.select(*BRIDGE_COLS).distinct()

    def fact_parents(self) -> DataFrame:
        """show_id of parents present in the fact (tags and a child)."""
        return (self.parents.filter(F.size("genres") > 0).select("show_id").distinct()
                .join(self.children.select("show_id").distinct(), "show_id", "left_semi"))


def _rows_and_keys(df: DataFrame, columns: list[str], key: str, n_rows: str, n_keys: str) -> DataFrame:
    """Per parent, the distinct rows of ``columns`` and the distinct values of
    ``key``, NULL not counted. A row's other columns go by their 128-bit hash.

    Parent and key are grouped as one struct: a frame already dealt out by
    these two columns is dealt out again between the steps, so that a task
    holds the hash tables of one step, not those of all of them at once."""
    rest = [c for c in columns if c not in ("show_id", key)]
    rows = df.select(F.struct("show_id", key).alias("__pair"), content_hash(df, rest).alias("__rest")).distinct()
    pairs = rows.groupBy("__pair").agg(F.count(F.lit(1)).alias("__n"))
    return (pairs.groupBy(F.col("__pair.show_id").alias("show_id"))
            .agg(F.sum("__n").alias(n_rows), F.count(f"__pair.{key}").alias(n_keys)))


def _per_parent_counts(star: Star, with_avg: bool = False) -> DataFrame:
    """show_id, n_child_rows, n_episodes, n_bridge_rows (≥1), n_persons, and
    with ``with_avg`` the average runtime over distinct child rows."""
    if star.per_parent is not None:
        return star.per_parent
    if with_avg:
        kids = star.child_rows().groupBy("show_id").agg(
            F.count(F.lit(1)).alias("n_child_rows"), F.count_distinct("episode_id").alias("n_episodes"),
            F.avg("runtime").alias("avg_runtime"))
    else:
        kids = _rows_and_keys(star.children, CHILD_COLS, "episode_id", "n_child_rows", "n_episodes")
    brg = _rows_and_keys(star.bridge, BRIDGE_COLS, "person_id", "n_bridge", "n_persons")
    return (kids.join(brg, "show_id", "left")
            .select("show_id", "n_child_rows", "n_episodes",
                    F.greatest(F.coalesce("n_bridge", F.lit(0)), F.lit(1)).cast("long").alias("n_bridge_rows"),
                    F.coalesce("n_persons", F.lit(0)).cast("long").alias("n_persons"),
                    *(["avg_runtime"] if with_avg else [])))


def episodes_per_season(star: Star) -> DataFrame:
    """M1: distinct children per (parent, cleaned name, season)."""
    per_season = (star.children.groupBy("show_id", "season")
                  .agg(F.count_distinct("episode_id").alias("total_episodes")))
    return (per_season.join(star.parent_names(), "show_id")
            .select("show_id", "show_name", "season", "total_episodes"))


def avg_runtime(star: Star) -> DataFrame:
    """M2: average runtime per (parent, cleaned name) over fact rows, which
    equals the average over the parent's distinct child rows."""
    if star.per_parent is not None and "avg_runtime" in star.per_parent.columns:
        per_show = star.per_parent.select("show_id", "avg_runtime")
    else:
        per_show = star.child_rows().groupBy("show_id").agg(F.avg("runtime").alias("avg_runtime"))
    return per_show.join(star.parent_names(), "show_id").select("show_id", "show_name", "avg_runtime")


def cast_shows(star: Star, keep_null: bool = True) -> DataFrame:
    """(person_id, cast_name, total_shows): distinct parents per person over
    the fact. Parents without bridge rows form the (NULL, 'NAFS') group unless
    ``keep_null=False``."""
    # Bridge rows of parents in the fact: a left semi join. Its tasks sort the
    # bridge rows and, as people's shows need no further shuffle to become
    # distinct, hold their hash tables too: hence the fine partitions. A bridge
    # row with NULL person and name joins the (NULL, 'NAFS') group after cleaning.
    in_fact = star.fact_parents()
    in_fact = in_fact.repartition(fine_partitions(in_fact.sparkSession), "show_id")
    credits = (star.bridge.select("show_id", "person_id", "cast_name")
               .join(in_fact, "show_id", "left_semi")
               .select("person_id", clean_string("cast_name").alias("cast_name"), "show_id"))
    if keep_null:
        # Parents without bridge rows; the bridge is reduced to its distinct
        # parent keys (map-side) before the anti join.
        lonely = (in_fact.join(star.bridge.select("show_id").distinct(), "show_id", "left_anti")
                  .select(F.lit(None).cast("long").alias("person_id"),
                          F.lit(BLANK_DEFAULT).alias("cast_name"), "show_id"))
        credits = credits.unionByName(lonely)
    else:
        credits = credits.filter(F.col("person_id").isNotNull())
    return (credits.groupBy("person_id", "cast_name")
            .agg(F.count_distinct("show_id").alias("total_shows")))


def with_rank(df: DataFrame, order: list, rank_col: str = "rank",
              n: int | None = None) -> DataFrame:
    """A 1-based row number over one global order, without any task
    holding more than one range of the rows.

    The rows are range-partitioned on the order (a row hash is appended as a
    last key, so a value shared by many rows still spans several ranges),
    sorted and numbered within their range, and checkpointed with range
    number and local number. The rank adds the number of rows in the ranges
    before: a running sum over one row per range. Each row is shuffled once.
    ``order`` should end in a unique tie-break for a reproducible numbering;
    rows tied on the whole order are numbered in hash order."""
    spark = df.sparkSession
    shared_dir(spark)                                 # the checkpoint folder must be set
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"] or df.columns[:1]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in hashable])
    # Range bounds come from sampling seeded per plan, so the ranges are
    # materialised once (a reliable checkpoint in the shared folder) and both
    # the numbering and the range sizes read the same ranges. The id has the
    # range number above bit 33 and the place within the range below.
    ranged = (df.withColumn("__tie", tie).repartitionByRange(n, *order, F.col("__tie"))
              .sortWithinPartitions(*order, F.col("__tie"))
              .withColumn("__id", F.monotonically_increasing_id())).drop("__tie").checkpoint(eager=True)
    pid = F.shiftright("__id", 33).alias("__pid")
    local = ranged.select("*", pid, F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)).alias("__local"))
    sizes = ranged.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"))
    return (local.join(F.broadcast(offsets), "__pid")
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("__offset") + F.col("__local") + 1).alias(rank_col)))


def top_k(df: DataFrame, order: list, k: int, rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows by ``order`` with a 1-based rank. ``order`` must end in a
    unique tie-break for a stable cut. ``orderBy().limit()`` plans as a
    per-partition top-k merged on one task (``TakeOrderedAndProject``), so at
    most ``k`` rows per partition move; the rank is numbered over those k."""
    top = df.orderBy(*order).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_members(star: Star, k: int = 10, keep_null: bool = True) -> DataFrame:
    """M3: top ``k`` people by distinct parents, tie-broken by id then name."""
    order = [F.col("total_shows").desc(), F.col("person_id").asc_nulls_last(),
             F.col("cast_name").asc()]
    return top_k(cast_shows(star, keep_null), order, k)


def common_tags(star: Star, with_distinct: bool = False) -> DataFrame:
    """M4: fact rows per cleaned tag (``genre_count``, as the reference counts
    fan-out rows, D6). ``with_distinct`` adds distinct parents and children
    per tag; a child belongs to one parent (its key), so distinct children
    per tag is the sum of the parents' distinct children."""
    tags = star.parent_tags().groupBy("show_id", "genre").agg(F.count(F.lit(1)).alias("n_tag_rows"))
    counts = _per_parent_counts(star)
    rows = (tags.join(counts, "show_id")
            .select(clean_string("genre").alias("genre"), "show_id", "n_episodes",
                    (F.col("n_tag_rows") * F.col("n_child_rows") * F.col("n_bridge_rows")).alias("n")))
    if not with_distinct:
        return rows.groupBy("genre").agg(F.sum("n").cast("long").alias("genre_count"))
    per_show = rows.groupBy("genre", "show_id").agg(F.sum("n").alias("n"),
                                                    F.max("n_episodes").alias("n_episodes"))
    return per_show.groupBy("genre").agg(
        F.sum("n").cast("long").alias("genre_count"),
        F.count(F.lit(1)).alias("distinct_shows"),
        F.sum("n_episodes").cast("long").alias("distinct_episodes"))


def fact_summary(star: Star) -> DataFrame:
    """Per parent in the fact: fact rows, distinct children, distinct people."""
    tags = star.parent_tags().groupBy("show_id").agg(F.count(F.lit(1)).alias("n_tag_rows"))
    counts = _per_parent_counts(star)
    return (tags.join(counts, "show_id")
            .select("show_id",
                    (F.col("n_tag_rows") * F.col("n_child_rows") * F.col("n_bridge_rows"))
                    .cast("long").alias("fact_rows"),
                    F.col("n_episodes").cast("long").alias("n_episodes"),
                    "n_persons"))


def _factor_changes(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """Per parent, how many distinct rows of a factor the old state has, the
    new one, and both. One grouping by row, which combines before it shuffles,
    then one by parent."""
    flag = lambda df, is_old: df.where("show_id is not null").select(
        "*", F.lit(int(is_old)).alias("__o"), F.lit(int(not is_old)).alias("__n"))
    rows = flag(old, True).unionByName(flag(new, False)).groupBy(*old.columns).agg(F.max("__o").alias("__o"), F.max("__n").alias("__n"))
    return rows.groupBy("show_id").agg(F.sum("__o").alias(f"{name}_old"), F.sum("__n").alias(f"{name}_new"),
                                       F.sum(F.col("__o") * F.col("__n")).alias(f"{name}_both"))


def fact_changes(old: Star, new: Star) -> DataFrame:
    """Per parent, the fact rows that a load adds and takes away, from the
    changes of the fact's three factors (the increment of J7/B7).

    The fact is tags x children x bridge rows of a parent, so two states share
    exactly the product of what their factors share. The new state's product
    less the shared one is added, the old state's less the shared one is gone:
    for growing factors that is new x old + old x new + new x new, summed. No
    product is built. A parent without bridge rows has one row of NULLs in
    their place, which goes when it gets its first. Parents whose rows stay
    are left out; NULL parents are in no fact."""
    tags = _factor_changes(old.parent_tags(), new.parent_tags(), "t")
    kids = _factor_changes(old.children.select(*CHILD_COLS), new.children.select(*CHILD_COLS), "c")
    bridge = _factor_changes(old.bridge.select(*BRIDGE_COLS), new.bridge.select(*BRIDGE_COLS), "b")
    joined = tags.join(kids, "show_id").join(bridge, "show_id", "left")
    n = {f"b_{s}": F.coalesce(F.col(f"b_{s}"), F.lit(0)) for s in ("old", "new", "both")}
    none_old, none_new = n["b_old"] == 0, n["b_new"] == 0
    n["b_both"] = F.when(none_old & none_new, 1).otherwise(n["b_both"])
    n["b_old"], n["b_new"] = F.greatest(n["b_old"], F.lit(1)), F.greatest(n["b_new"], F.lit(1))
    rows = {s: F.col(f"t_{s}") * F.col(f"c_{s}") * n[f"b_{s}"] for s in ("old", "new", "both")}
    out = joined.select("show_id", (rows["new"] - rows["both"]).cast("long").alias("added_rows"),
                        (rows["old"] - rows["both"]).cast("long").alias("removed_rows"))
    return out.where("added_rows > 0 or removed_rows > 0")


MARTS: Mapping[str, Callable[[Star], DataFrame]] = {
    "episodes_per_season": episodes_per_season,
    "avg_runtime_per_show": avg_runtime,
    "top_cast_members": top_members,
    "common_genres": common_tags,
}


@dataclass
class MartResult:
    built: dict
    errors: dict


def build_marts(star: Star, write: Callable[[str, DataFrame], None] | None = None,
                marts: Mapping[str, Callable[[Star], DataFrame]] = MARTS,
                raise_at_end: bool = True) -> MartResult:
    """M5: build (and optionally write) every mart; one failing does not stop
    the others. The guard covers both plan building and the write; if any
    failed, raise once at the end."""
    built, errors = {}, {}
    for name, fn in marts.items():
        try:
            df = fn(star)
            if write is not None:
                write(name, df)
            built[name] = df
        except Exception as e:  # noqa: BLE001 - collected and re-raised below
            log.error("mart %s failed: %s", name, e)
            errors[name] = e
    if errors and raise_at_end:
        raise RuntimeError(f"marts failed: {sorted(errors)}") from next(iter(errors.values()))
    return MartResult(built, errors)
