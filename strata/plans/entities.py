"""Entity definitions: the shape of each landed record and how each layer
keys, versions, partitions and clusters it (one frozen record per entity)."""

from __future__ import annotations

from dataclasses import dataclass

# Landed record schemas (field names as the source emits them),
# per entity.
SHOWS_SCHEMA = """
id BIGINT, name STRING, type STRING, language STRING, genres ARRAY<STRING>,
status STRING, runtime INT, averageRuntime INT, premiered STRING, ended STRING,
officialSite STRING,
rating STRUCT<average: DOUBLE>,
network STRUCT<id: BIGINT, name: STRING, country: STRUCT<name: STRING, code: STRING>>,
image STRUCT<medium: STRING, original: STRING>,
updated BIGINT
"""

EPISODES_SCHEMA = """
id BIGINT, name STRING, season INT, number INT, type STRING, airdate STRING,
airtime STRING, airstamp STRING, runtime INT,
rating STRUCT<average: DOUBLE>,
image STRUCT<medium: STRING, original: STRING>,
summary STRING, url STRING,
_links STRUCT<self: STRUCT<href: STRING>, show: STRUCT<href: STRING, name: STRING>>
"""

CAST_SCHEMA = """
person STRUCT<id: BIGINT, url: STRING, name: STRING,
              country: STRUCT<name: STRING, code: STRING, timezone: STRING>,
              birthday: STRING, deathday: STRING, gender: STRING,
              image: STRUCT<medium: STRING, original: STRING>, updated: BIGINT>,
character STRUCT<id: BIGINT, url: STRING, name: STRING,
                 image: STRUCT<medium: STRING, original: STRING>>,
self BOOLEAN, voice BOOLEAN
"""

CALENDAR = ["partition_year", "partition_month", "partition_day"]


@dataclass(frozen=True)
class Entity:
    name: str
    landed_schema: str
    bronze_table: str
    silver_table: str
    gold_table: str
    bronze_keys: tuple[str, ...]          # key for the bronze increment
    silver_keys: tuple[str, ...]          # key of one silver row version
    silver_version: str | None            # silver/gold change column (timestamp)
    tiebreak: tuple[str, ...] = ()        # silver columns that order equal versions
    parent: str | None = None             # parent id column (from folder names)
    partition_cols: tuple[str, ...] = tuple(CALENDAR)


# Table names per layer, keys and change columns per entity,
# the calendar partition columns, and the mart table names.
SHOWS = Entity("shows", SHOWS_SCHEMA, "b_shows", "s_shows", "dim_shows",
               bronze_keys=("id",), silver_keys=("show_id",),
               silver_version="updated_time")
EPISODES = Entity("episodes", EPISODES_SCHEMA, "b_episodes", "s_episodes", "fact_episodes",
                  bronze_keys=("id",), silver_keys=("episode_id",),
                  silver_version=None, tiebreak=("air_timestamp",), parent="show_id")
CAST = Entity("cast", CAST_SCHEMA, "b_cast", "s_cast", "dim_cast",
              bronze_keys=("show_id", "person_id", "character_id"),
              silver_keys=("show_id", "person_id", "character_id"),
              silver_version="person_updated_time",
              parent="show_id")

ENTITIES = {e.name: e for e in (SHOWS, EPISODES, CAST)}
# Build order: parents before children; bronze, silver, gold.
ORDER = ("shows", "cast", "episodes")
LAYERS = ("bronze", "silver", "gold")

# Fact and marts.
FACT_CLUSTER = ("show_id", "episode_id")
MART_TABLES = {
    "episodes_per_season": "g_episodes_per_season",
    "avg_runtime_per_show": "g_avg_runtime_per_show",
    "top_cast_members": "g_top_cast_members",
    "common_genres": "g_common_genres",
}
