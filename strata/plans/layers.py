"""Bronze, silver and gold table builders (B1–B10), marts, and the run of
chosen layers and entities (L1).

Each builder is a pure ``DataFrame -> DataFrame`` step (source rows, the
current target or None) plus a thin ``load_*`` that reads the target, calls
it, and appends only when there is something to load. Two modes:

* default (sound): per-key version increments (I4) instead of one global
  watermark (D2, D2b), null-safe keys (D3), latest show version in the
  marts (D1), the no-cast group dropped from the top list (D8);
* ``reference_mode=True``: global strict watermarks and ``=`` keys, all
  show versions joined, as the reference loads them.

Times derived from epoch seconds or offset text are UTC ``timestamp_ntz``
values, so calendar partitions never depend on a session time zone (D14).
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import (epoch_to_ntz, instant_to_utc, safe_date,
                                      safe_timestamp)
from strata.operators import columns as C
from strata.operators import increment as I
from strata.operators import marts as M
from strata.operators.setops import row_counts
from strata.plans.entities import (CALENDAR, ENTITIES, FACT_CLUSTER, LAYERS, MART_TABLES,
                                   ORDER, Entity)
from strata.session import at_once
from strata.sources import sinks as K
from strata.sources.drift import read_drifting
from strata.sources.landing import CORRUPT, read_landed, split_corrupt

log = logging.getLogger(__name__)

def _parts(c: Column) -> list[Column]:
    return [F.year(c).alias(CALENDAR[0]), F.month(c).alias(CALENDAR[1]),
            F.dayofmonth(c).alias(CALENDAR[2])]


# ================================================================ bronze
def bronze_records(landed: DataFrame) -> DataFrame:
    """S2 + P1: one column per leaf, named by its dotted path, normalised."""
    return C.normalize_names(C.flatten_structs(landed, sep="."))


def bronze_increment(entity: Entity, records: DataFrame, target: DataFrame | None,
                     reference_mode: bool = False) -> DataFrame:
    """Rows of the new batch that bronze does not hold yet."""
    if entity.name == "shows":
        if reference_mode:
            return I.increment_by_watermark(records, target, "updated", default=0)
        return I.increment_by_version(records, target, ["id"], "updated")
    if entity.name == "episodes":
        if reference_mode:
            return I.new_rows(records, target, ["id"])
        return I.changed_rows(records, target, ["id"], "created_date")
    if reference_mode:
        return I.new_rows(records, target, list(entity.bronze_keys))
    return I.increment_by_version(records, target, list(entity.bronze_keys), "person_updated")


# ================================================================ silver
def silver_shows(b: DataFrame) -> DataFrame:
    updated_time = epoch_to_ntz(F.col("updated").try_cast("bigint"))
    return (b.filter(F.col("id").isNotNull()).select(
        F.col("id").try_cast("bigint").alias("show_id"),
        F.trim("name").alias("show_name"),
        "type", "language", "genres", "status",
        F.coalesce("runtime", F.lit(0)).alias("runtime"),
        F.coalesce("averageruntime", F.lit(0)).alias("average_runtime"),
        safe_date("premiered").alias("premiered_date"),
        safe_date("ended").alias("ended_date"),
        F.coalesce("rating_average", F.lit(0.0)).alias("rating_average"),
        F.col("network_id").try_cast("bigint").alias("network_id"),
        "network_name", "network_country_name", "network_country_code",
        "officialsite", "image_medium", "image_original",
        F.col("updated").try_cast("bigint").alias("updated"),
        updated_time.alias("updated_time"),
        F.col("created_date").alias("created_at"),
        *_parts(updated_time)))


def silver_episodes(b: DataFrame) -> DataFrame:
    air_date = safe_date("airdate", "yyyy-MM-dd")
    return (b.filter(F.col("id").isNotNull()).select(
        F.col("id").try_cast("bigint").alias("episode_id"),
        F.col("show_id").try_cast("bigint").alias("show_id"),
        F.trim("name").alias("episode_name"),
        F.col("season").try_cast("int").alias("season"),
        F.col("number").try_cast("int").alias("episode_number"),
        "type",
        air_date.alias("air_date"),
        "airtime",
        instant_to_utc(safe_timestamp("airstamp")).alias("air_timestamp"),
        F.coalesce("runtime", F.lit(0)).alias("runtime"),
        "summary",
        F.coalesce("rating_average", F.lit(0.0)).alias("rating_average"),
        "image_medium", "image_original", "url",
        F.col("_links_self_href").alias("links_self_href"),
        F.col("_links_show_href").alias("links_show_href"),
        F.col("_links_show_name").alias("links_show_name"),
        F.col("created_date").alias("created_at"),
        *_parts(air_date)))


def silver_cast(b: DataFrame) -> DataFrame:
    updated_time = epoch_to_ntz(F.col("person_updated").try_cast("bigint"))
    return (b.filter(F.col("person_id").isNotNull()).select(
        F.col("show_id").try_cast("bigint").alias("show_id"),
        F.col("person_id").try_cast("bigint").alias("person_id"),
        "person_name", "person_gender",
        safe_date("person_birthday").alias("person_birthday"),
        safe_date("person_deathday").alias("person_deathday"),
        "person_country_name", "person_country_code", "person_country_timezone",
        "person_url", "person_image_medium", "person_image_original",
        F.col("character_id").try_cast("bigint").alias("character_id"),
        "character_name", "character_url", "character_image_medium",
        "character_image_original", "self", "voice",
        F.col("person_updated").try_cast("bigint").alias("person_updated"),
        updated_time.alias("person_updated_time"),
        F.col("created_date").alias("created_at"),
        *_parts(updated_time)))


SILVER = {"shows": silver_shows, "episodes": silver_episodes, "cast": silver_cast}


def with_dw(df: DataFrame) -> DataFrame:
    return df.select("*", F.current_timestamp().alias("dw_updated_timestamp"),
                     F.current_user().alias("dw_updated_by"))


def silver_increment(entity: Entity, bronze: DataFrame, target: DataFrame | None,
                     reference_mode: bool = False, few_new: bool = False) -> DataFrame:
    """Typed, cleaned rows not yet in silver. Of several rows with one
    key (and version) in a batch the one loaded last stays (D10). An entity
    without version also loads corrected rows: those that differ from the
    key's newest one in silver. Reference mode only drops rows that are equal
    in every column, and knows no corrections. ``few_new``: the source is cheap
    to read twice, and few of its rows repeat a key or are new to a target."""
    src = SILVER[entity.name](bronze)
    if reference_mode:
        src = src.distinct()
        inc = (I.new_rows(src, target, ["episode_id"], null_safe=True) if entity.silver_version is None
               else I.increment_by_watermark(src, target, entity.silver_version))
        return C.clean_strings(with_dw(inc))
    if entity.silver_version is None:
        src = I.latest_by_key(src, list(entity.silver_keys), "created_at", entity.tiebreak, few_repeats=few_new)
        inc = I.changed_rows(C.clean_strings(src), target, list(entity.silver_keys), "created_at")
    else:
        inc = I.increment_by_version(src, target, list(entity.silver_keys), entity.silver_version, few_new=few_new)
        # next to a target the rows have just been dealt out by their keys
        inc = I.latest_by_key(inc, [*entity.silver_keys, entity.silver_version], "created_at", entity.tiebreak,
                              few_repeats=target is None)
    return C.clean_strings(with_dw(inc))


# ================================================================ gold
# The columns each gold table keeps, in the reference's order.
GOLD_COLUMNS = {
    "shows": ["show_id", "show_name", "type", "language", "genres", "status",
              "premiered_date", "ended_date", "rating_average", "network_name",
              "network_country_name", "officialsite", "image_medium", "image_original",
              "updated", "updated_time", *CALENDAR],
    "cast": ["show_id", "person_id", "person_name", "person_gender", "person_birthday",
             "person_country_name", "character_id", "character_name", "person_updated",
             "person_updated_time", *CALENDAR],
    "episodes": ["episode_id", "show_id", "episode_name", "season", "episode_number",
                 "air_date", "air_timestamp", "runtime", "rating_average", *CALENDAR],
}


# Fixed value: the gold column that keeps the load time of the silver row.
UPSTREAM = "upstream_date"


def gold_frame(entity: Entity, silver: DataFrame, reference_mode: bool = False) -> DataFrame:
    """The gold columns and the silver load time. Silver has one row per key
    (and version), so only reference mode needs DISTINCT."""
    if reference_mode:
        return silver.select(*GOLD_COLUMNS[entity.name]).distinct()
    stamp = [F.col("created_date").alias(UPSTREAM)] if "created_date" in silver.columns else []
    return silver.select(*GOLD_COLUMNS[entity.name], *stamp)


def gold_increment(entity: Entity, silver: DataFrame, target: DataFrame | None,
                   reference_mode: bool = False, few_new: bool = False) -> DataFrame:
    """Column subset, increment, cleaned. Corrected rows of an entity
    without version are loaded again, as in silver."""
    src = gold_frame(entity, silver, reference_mode)
    if entity.silver_version is None and (reference_mode or UPSTREAM not in src.columns):
        inc = I.new_rows(src, target, list(entity.silver_keys), null_safe=True)
    elif entity.silver_version is None:
        src = I.latest_by_key(src, list(entity.silver_keys), UPSTREAM, few_repeats=few_new)
        inc = I.changed_rows(C.clean_strings(src), target, list(entity.silver_keys), UPSTREAM)
    elif reference_mode:
        inc = I.increment_by_watermark(src, target, entity.silver_version)
    else:
        inc = I.increment_by_version(src, target, list(entity.silver_keys), entity.silver_version, few_new=few_new)
    return C.clean_strings(with_dw(inc))


# ================================================================ star, marts
def silver_star(shows: DataFrame, episodes: DataFrame, cast: DataFrame,
                reference_mode: bool = False) -> M.Star:
    """The fact's three factors from silver. Unless in reference mode, only
    the latest version of each show, credit and (corrected) episode counts (D1)."""
    if not reference_mode:
        ties = lambda df: [c for c in ("created_at", "dw_updated_timestamp") if c in df.columns]
        shows = I.latest_by_key(shows, ["show_id"], "updated", ties(shows),
                                columns=["show_id", "show_name", "language", "genres"])
        cast = I.latest_by_key(cast, list(ENTITIES["cast"].silver_keys), "person_updated", ties(cast),
                               columns=["show_id", "person_id", "person_name", "character_id", "character_name"])
        if ties(episodes):
            first, *more = ties(episodes)
            episodes = I.latest_by_key(episodes, list(ENTITIES["episodes"].silver_keys), first, more,
                                       columns=["show_id", "season", "episode_id", "episode_name", "air_date", "runtime"])
    return M.Star(
        shows.select("show_id", "show_name", "language", "genres"),
        episodes.select("show_id", "season", "episode_id", "episode_name",
                        F.col("air_date").alias("airdate"), "runtime"),
        cast.select("show_id", "person_id", F.col("person_name").alias("cast_name"),
                    "character_id", "character_name"))


def marts(star: M.Star, reference_mode: bool = False) -> dict:
    """The four marts (M1–M4); outside reference mode the top list drops the
    no-cast group and the genre mart adds distinct counts (D6, D8)."""
    return {
        "episodes_per_season": lambda s: M.episodes_per_season(s),
        "avg_runtime_per_show": lambda s: M.avg_runtime(s),
        "top_cast_members": lambda s: M.top_members(s, 10, keep_null=reference_mode),
        "common_genres": lambda s: M.common_tags(s, with_distinct=not reference_mode),
    }


# ================================================================ loads
def _landed_path(root: str, entity: Entity) -> str:
    return f"{root.rstrip('/')}/{entity.name}"


def landed_schema(entity: Entity) -> str:
    """The landed record schema; child entities also carry the parent id
    that partition discovery fills in from ``<parent>=<id>`` folders."""
    if entity.parent:
        return f"{entity.landed_schema.strip()}, {entity.parent} BIGINT"
    return entity.landed_schema


def read_entity(spark: SparkSession, landed_root: str, entity: Entity, keep_drift: bool = False) -> DataFrame:
    """The entity's landed records; ``keep_drift`` keeps what the declared schema lacks."""
    if keep_drift:
        return read_drifting(spark, _landed_path(landed_root, entity), entity.landed_schema, entity.parent)
    return read_landed(spark, _landed_path(landed_root, entity), landed_schema(entity),
                       parent_col=entity.parent)


def rejected_table(entity: Entity) -> str:
    return f"{entity.bronze_table}_rejected"


def load_bronze(store: K.TableStore, entity: Entity, landed: DataFrame,
                reference_mode: bool = False) -> bool:
    """Append what bronze lacks. Lines that are no records are kept in a
    table of their own, each once, and reported."""
    store.ensure_database("bronze")
    name = store.name("bronze", entity.bronze_table)
    records, lines = split_corrupt(K.stage(landed, "landed"))  # parsed once
    if lines is not None:
        rejected = store.name("bronze", rejected_table(entity))

        def keep(bad: DataFrame) -> None:
            new = I.new_rows(bad.distinct(), store.read("bronze", rejected_table(entity)), [CORRUPT])
            log.warning("%s: %d landed lines are no records, see %s", entity.name, bad.count(), rejected)
            K.write_if_any(new, lambda d: K.append_table(d, rejected))
        K.write_if_any(lines, keep, staged=True)
    target = store.read("bronze", entity.bronze_table)
    inc = bronze_increment(entity, bronze_records(records), target, reference_mode)
    return K.write_if_any(inc, lambda d: K.append_table(d, name), staged=target is None)


def since_last_load(upstream: DataFrame, target: DataFrame | None, up_col: str = "created_date",
                    tgt_col: str = "created_date", few_files: bool = False) -> DataFrame:
    """Upstream rows of the newest upstream load that the target has seen, and
    of later ones. ``tgt_col`` must hold the upstream's own load times, so one
    clock is compared with itself; the key or version increment that follows
    drops the rows already there. The bound is a literal, so parquet min/max
    statistics skip the files of earlier loads: an incremental run reads the
    new batch, not the whole history. Loads are assumed to run one after
    another. ``few_files``: the upstream is not laid out by partitions, unlike
    the target; its load times are read first, and if there is but one, which
    leaves nothing to skip, the target's many files are not opened for it."""
    if target is None or up_col not in upstream.columns or tgt_col not in target.columns:
        return upstream
    if few_files and upstream.agg(F.min(up_col).eqNullSafe(F.max(up_col))).first()[0]:
        return upstream
    hw = I.high_water(target, tgt_col, default=None)
    return upstream if hw is None else upstream.filter(F.col(up_col) >= hw)


def load_silver(store: K.TableStore, entity: Entity, reference_mode: bool = False) -> bool:
    store.ensure_database("silver")
    name = store.name("silver", entity.silver_table)
    bronze = store.read("bronze", entity.bronze_table)
    target = store.read("silver", entity.silver_table)
    if not reference_mode:
        bronze = since_last_load(bronze, target, "created_date", "created_at", few_files=True)
    inc = silver_increment(entity, bronze, target, reference_mode, few_new=True)
    # without repeated keys, a first load is a projection of the bronze table
    scan = target is None and not reference_mode and not K.moves_rows(inc)
    return K.write_if_any(inc, lambda d: K.append_table(d, name, list(entity.partition_cols)), staged=scan)


def load_gold(store: K.TableStore, entity: Entity, reference_mode: bool = False) -> bool:
    store.ensure_database("gold")
    name = store.name("gold", entity.gold_table)
    silver = store.read("silver", entity.silver_table)
    target = store.read("gold", entity.gold_table)
    if not reference_mode:
        silver = since_last_load(silver, target, "created_date", UPSTREAM)
    inc = gold_increment(entity, silver, target, reference_mode, few_new=True)
    scan = target is None and entity.silver_version is not None  # a projection of the silver table
    return K.write_if_any(inc, lambda d: K.append_table(d, name, list(entity.partition_cols)), staged=scan and not reference_mode)


def load_marts(store: K.TableStore, reference_mode: bool = False) -> M.MartResult:
    """Full refresh of every mart from the silver star; one failing mart does
    not stop the others (M5)."""
    store.ensure_database("gold")
    # Per-parent aggregates are computed once and checkpointed; every mart
    # below reads them instead of scanning the silver children and bridge.
    star = silver_star(store.read("silver", "s_shows"), store.read("silver", "s_episodes"),
                       store.read("silver", "s_cast"), reference_mode).shared()

    def write(key: str, df: DataFrame) -> None:
        out = C.clean_strings(with_dw(df))
        K.overwrite_table(out, store.name("gold", MART_TABLES[key]))

    return M.build_marts(star, write, marts(star, reference_mode))


def optimize_written(store: K.TableStore, done: dict, target_file_mb: int = K.DEFAULT_FILE_MB) -> list:
    """Rewrite what a run left in too small files into fewer, larger ones (S12):
    of partitioned tables only the partitions that gain by it. Silver
    episodes, the fact's child factor, are laid out by the fact's cluster
    columns (S13). Returns the rewritten table names."""
    spark = store.spark
    names = []
    for (layer, entity), loaded in done.items():
        if entity == "marts":
            names += [store.name("gold", MART_TABLES[m]) for m in loaded]
        elif loaded:
            e = ENTITIES[entity]
            table = {"bronze": e.bronze_table, "silver": e.silver_table, "gold": e.gold_table}[layer]
            names.append(store.name(layer, table))
    for name in names:
        if name == store.name("silver", ENTITIES["episodes"].silver_table):
            K.cluster_rewrite(spark, name, list(FACT_CLUSTER), target_file_mb)
        else:
            K.compact_where_needed(spark, name, target_file_mb)
    return names


def run(spark: SparkSession, store: K.TableStore, landed_root: str,
        layers: Iterable[str] = LAYERS, entities: Iterable[str] = ORDER,
        reference_mode: bool = False, with_marts: bool = True,
        optimize: bool = False, keep_drift: bool = False) -> dict:
    """L1: build the chosen layers of the chosen entities in order (bronze,
    silver, gold), then the marts; with ``optimize``, compact what was written.
    A load reads no other entity's tables, so the entities are built at once; if
    one fails, the others are still built, no mart is, and its error is raised.
    Bronze takes landed files as a stream source
    that remembers which it has read, so a run reads the new ones only; with
    ``keep_drift`` (the command line's default) fields that the source has
    added come along.
    Returns what loaded."""
    from strata.streaming.ingest import ingest_landed
    layers, entities = [x for x in LAYERS if x in set(layers)], [e for e in ORDER if e in set(entities)]

    def build(e: Entity, layer: str) -> bool:
        if layer == "bronze":
            return ingest_landed(spark, store, e, landed_root, reference_mode=reference_mode, keep_drift=keep_drift)["appended"] > 0
        return (load_silver if layer == "silver" else load_gold)(store, e, reference_mode)
    if entities:
        for layer in layers:
            store.ensure_database(layer)
    loaded = at_once(spark, [lambda e=ENTITIES[name]: {layer: build(e, layer) for layer in layers} for name in entities])
    done: dict = {(layer, name): got[layer] for layer in layers for name, got in zip(entities, loaded)}
    if with_marts and "gold" in layers and all(
            store.exists("silver", t) for t in ("s_shows", "s_episodes", "s_cast")):
        done[("gold", "marts")] = sorted(load_marts(store, reference_mode).built)
    if optimize:
        optimize_written(store, done)
    return done


# The reconciliation listing, (label, layer, table) in the
# order the reference reports them.
VALIDATION_TABLES = [
    ("bronze_shows", "bronze", "b_shows"),
    ("silver_shows", "silver", "s_shows"),
    ("dim_shows", "gold", "dim_shows"),
    ("bronze_cast", "bronze", "b_cast"),
    ("silver_cast", "silver", "s_cast"),
    ("dim_cast", "gold", "dim_cast"),
    ("bronze_episodes", "bronze", "b_episodes"),
    ("silver_episodes", "silver", "s_episodes"),
    ("fact_episodes", "gold", "fact_episodes"),
]


def layer_row_counts(store: K.TableStore) -> DataFrame:
    """Q1: row count of every layer table as one result; NULL for a table
    that is missing."""
    return row_counts([(label, store.read(layer, t)) for label, layer, t in VALIDATION_TABLES])
