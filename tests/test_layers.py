"""End to end: landed JSON → bronze, silver, gold and marts; a re-run adds
nothing; changed records add exactly those; the stream ingest matches."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans import layers as L
from strata.plans.entities import ENTITIES
from strata.plans.landed import LANDED
from strata.session import scratch_path
from strata.sources.sinks import TableStore
from strata.streaming.ingest import ingest_landed
from tests.conftest import SF_SMALL

TABLES = [("bronze", "b_shows"), ("bronze", "b_cast"), ("bronze", "b_episodes"),
          ("silver", "s_shows"), ("silver", "s_cast"), ("silver", "s_episodes"),
          ("gold", "dim_shows"), ("gold", "dim_cast"), ("gold", "fact_episodes")]
MARTS = [("gold", t) for t in ("g_episodes_per_season", "g_avg_runtime_per_show",
                               "g_top_cast_members", "g_common_genres")]


def land(spark, root, entity, df):
    w = df.write.mode("append")
    if ENTITIES[entity].parent:
        w = w.partitionBy(ENTITIES[entity].parent)
    w.json(f"{root}/{entity}")


def counts(store):
    return {t: store.read(layer, t).count() for layer, t in TABLES}


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_path(spark, "landed")
    for e, fn in LANDED.items():
        land(spark, root, e, fn(spark, SF_SMALL))
    return root


def test_run_rerun_and_changes(spark, landed):
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"e{uuid.uuid4().hex[:8]}")
    done = L.run(spark, store, landed)
    assert all(done[(layer, e)] for layer in ("bronze", "silver", "gold")
               for e in ("shows", "cast", "episodes"))
    first = counts(store)
    assert first["b_shows"] == first["s_shows"] == first["dim_shows"] == 150
    assert first["b_episodes"] == first["s_episodes"] == first["fact_episodes"] == 1500
    assert first["b_cast"] == first["s_cast"] == first["dim_cast"] > 0
    for layer, t in MARTS:
        assert store.exists(layer, t)
    assert store.read("gold", "g_top_cast_members").count() == 10
    assert "created_date" in store.read("silver", "s_shows").columns
    listing = {r["table_name"]: r["record_count"] for r in L.layer_row_counts(store).collect()}
    assert listing["bronze_shows"] == 150 and listing["fact_episodes"] == 1500
    assert len(listing) == 9

    # Same landed files again: nothing new anywhere.
    again = L.run(spark, store, landed)
    assert not any(v for k, v in again.items() if k[1] != "marts")
    assert counts(store) == first

    # Ten shows change (newer `updated`); exactly those flow through.
    changed_root = scratch_path(spark, "landed2")
    shows = LANDED["shows"](spark, SF_SMALL).filter(F.col("id") < 10)
    changed = shows.withColumn("updated", F.col("updated") + 1).withColumn("name", F.lit("Renamed"))
    land(spark, changed_root, "shows", changed)
    L.run(spark, store, changed_root, entities=["shows"])
    third = counts(store)
    for t in ("b_shows", "s_shows", "dim_shows"):
        assert third[t] == first[t] + 10
    eps = store.read("gold", "g_episodes_per_season")
    assert eps.filter(F.col("show_name") == "Renamed").select("show_id").distinct().count() > 0
    assert eps.filter((F.col("show_id") < 10) & (F.col("show_name") != "Renamed")).count() == 0


def test_reference_mode_watermark_drops_late_rows(spark, landed):
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"r{uuid.uuid4().hex[:8]}")
    L.run(spark, store, landed, entities=["shows"], reference_mode=True, with_marts=False)
    late_root = scratch_path(spark, "landed3")
    late = (LANDED["shows"](spark, SF_SMALL).filter(F.col("id") < 5)
            .withColumn("id", F.col("id") + 100000))          # new shows, old `updated`
    land(spark, late_root, "shows", late)
    before = store.read("bronze", "b_shows").count()
    L.run(spark, store, late_root, entities=["shows"], reference_mode=True, with_marts=False)
    assert store.read("bronze", "b_shows").count() == before      # lost (D2)
    again = scratch_path(spark, "landed4")            # a stream source reads a file once
    land(spark, again, "shows", late)
    L.run(spark, store, again, entities=["shows"], layers=["bronze"], with_marts=False)
    assert store.read("bronze", "b_shows").count() == before + 5  # per-key version keeps them


def test_stream_ingest_is_idempotent(spark, landed):
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"s{uuid.uuid4().hex[:8]}")
    e = ENTITIES["cast"]
    first = ingest_landed(spark, store, e, landed)
    n = store.read("bronze", "b_cast").count()
    assert first["appended"] >= 1 and n > 0
    second = ingest_landed(spark, store, e, landed)
    assert second["batches"] == 0 and store.read("bronze", "b_cast").count() == n
    batch = L.bronze_records(L.read_entity(spark, landed, e))
    assert n == batch.count()


def test_silver_dedupe_keeps_one_row_per_episode(spark):
    from strata.sources.sinks import with_audit
    e = ENTITIES["episodes"]
    landed = LANDED["episodes"](spark, SF_SMALL).filter(F.col("id") < 20)
    twice = landed.unionByName(landed.withColumn("name", F.lit("changed title")))
    bronze = with_audit(L.bronze_records(twice))
    plain = L.silver_increment(e, bronze, None, reference_mode=True)
    deduped = L.silver_increment(e, bronze, None)
    assert plain.count() == 40                       # DISTINCT keeps both (D10)
    assert deduped.count() == 20
    assert deduped.select("episode_id").distinct().count() == 20


def test_read_landed_malformed_and_null_structs(spark, tmp_path):
    path = tmp_path / "shows"
    path.mkdir()
    (path / "a.json").write_text(
        '{"id": 1, "name": "A", "rating": null, "network": {"id": 2, "country": null}, "updated": 5}\n'
        '{"id": "not a number", "name": "B"}\n'
        'this line is not json\n'
        '{"id": 3, "genres": [], "updated": 7}\n')
    landed = L.read_entity(spark, str(tmp_path), ENTITIES["shows"])
    assert sorted(r["corrupt_record"][:8] for r in landed.filter("corrupt_record is not null").select(
        "corrupt_record", "id").collect()) == ["this lin", '{"id": "']
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"b{uuid.uuid4().hex[:8]}")
    for _ in range(2):                               # again: nothing new
        L.load_bronze(store, ENTITIES["shows"], landed)
        assert store.read("bronze", "b_shows").count() == 2
        assert store.read("bronze", "b_shows_rejected").count() == 2
    df = L.bronze_records(landed)
    assert "rating_average" in df.columns and "network_country_code" in df.columns
    got = {r["name"]: (r["id"], r["rating_average"], r["network_id"]) for r in df.collect()}
    assert got["A"] == (1, None, 2)
    assert got["B"][0] is None                       # bad number → NULL, row kept
    assert df.count() == 4
    silver = L.silver_increment(ENTITIES["shows"], df.withColumn("created_date", F.current_timestamp()), None)
    assert sorted(r["show_id"] for r in silver.collect()) == [1, 3]   # NULL ids dropped


def test_silver_star_versions_sound_vs_reference(spark):
    import datetime as dt
    shows = spark.createDataFrame(
        [(1, "Old", "en", ["x"], 10, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)),
         (1, "New", "en", ["x"], 20, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2))],
        "show_id LONG, show_name STRING, language STRING, genres ARRAY<STRING>, updated LONG, "
        "created_at TIMESTAMP, dw_updated_timestamp TIMESTAMP")
    episodes = spark.createDataFrame([(1, 1, 7, "e", None, 30)],
                                     "show_id LONG, season INT, episode_id LONG, episode_name STRING, "
                                     "air_date DATE, runtime INT")
    cast = spark.createDataFrame([(1, 5, "P", 9, "C", 2), (1, 5, "Older name", 9, "C", 1)],
                                 "show_id LONG, person_id LONG, person_name STRING, "
                                 "character_id LONG, character_name STRING, person_updated LONG")
    latest = L.silver_star(shows, episodes, cast)
    every = L.silver_star(shows, episodes, cast, reference_mode=True)
    names = lambda star: sorted(r["show_name"] for r in L.M.episodes_per_season(star).collect())
    assert names(latest) == ["New"]                      # D1: latest version only
    assert names(every) == ["New", "Old"]                # reference: every version
    tags = {r["genre"]: r["genre_count"] for r in L.M.common_tags(every).collect()}
    assert tags == {"x": 4}                              # fan-out over both versions of both
    assert [r["cast_name"] for r in L.M.top_members(latest, 10).collect()] == ["P"]


def test_command_line_launcher(spark, landed, capsys):
    import json

    from strata.__main__ import main
    wh = scratch_path(spark, "cli")
    main(["--landed", landed, "--warehouse", wh, "--prefix", f"c{uuid.uuid4().hex[:6]}",
          "--layers", "bronze", "--entities", "shows", "--no-marts"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["loaded"] == {"bronze.shows": True}
    assert {k: v for k, v in out["row_counts"].items() if v is not None} == {"bronze_shows": 150}
    assert len(out["row_counts"]) == 9


def test_optimize_after_run_keeps_rows(spark, landed):
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"o{uuid.uuid4().hex[:8]}")
    done = L.run(spark, store, landed, layers=["bronze", "silver"], entities=["shows", "episodes"],
                 with_marts=False)
    before = counts_of(store, [("bronze", "b_shows"), ("silver", "s_episodes")])
    names = L.optimize_written(store, done)
    assert store.name("silver", "s_episodes") in names
    assert counts_of(store, [("bronze", "b_shows"), ("silver", "s_episodes")]) == before


def counts_of(store, tables):
    return {t: store.read(layer, t).count() for layer, t in tables}


def test_gold_takes_silver_rows_older_than_its_last_load(spark):
    """A silver row stamped before the last gold load, but committed after it."""
    import datetime as dt
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"g{uuid.uuid4().hex[:8]}")
    e = ENTITIES["episodes"]
    store.ensure_database("silver")
    bronze = LANDED["episodes"](spark, SF_SMALL).filter(F.col("id") < 40)
    from strata.sources.sinks import append_table, with_audit
    silver = L.silver_increment(e, with_audit(L.bronze_records(bronze)), None)
    early = F.lit(dt.datetime.now() - dt.timedelta(hours=2))
    one = silver.filter("episode_id % 2 = 0").withColumn("created_date", early)
    append_table(one, store.name("silver", "s_episodes"), created=None)
    assert L.load_gold(store, e)
    n = store.read("gold", "fact_episodes").count()
    late = silver.filter("episode_id % 2 = 1").withColumn("created_date", early + F.expr("interval 1 hour"))
    append_table(late, store.name("silver", "s_episodes"), created=None)
    assert L.load_gold(store, e)
    assert store.read("gold", "fact_episodes").count() == store.read("silver", "s_episodes").count() > n
    assert not L.load_gold(store, e)


def test_landed_records_are_compressed_and_staged_once(spark, monkeypatch):
    """landed text took most of what the query wrote, and a first load staged its rows twice."""
    from strata.sources.landing import land_records
    root, staged, stage = scratch_path(spark, "landed"), [], L.K.stage
    cast = LANDED["cast"](spark, SF_SMALL)
    land_records(cast, f"{root}/cast")
    files = spark.read.format("binaryFile").load(f"{root}/cast").select("path").collect()
    assert files and all(f["path"].endswith(".json.gz") for f in files)
    monkeypatch.setattr(L.K, "stage", lambda df, name="staged": staged.append(name) or stage(df, name))
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"z{uuid.uuid4().hex[:8]}")
    assert L.load_bronze(store, ENTITIES["cast"], L.read_entity(spark, root, ENTITIES["cast"]))
    assert staged == ["landed"]
    bronze = store.read("bronze", "b_cast")
    want = L.bronze_records(cast)
    assert bronze.drop("created_date").select(want.columns).exceptAll(want).isEmpty() and bronze.count() == cast.count()


def test_first_silver_load_is_staged_only_if_it_shuffles(spark, monkeypatch):
    """without repeated keys a first load is a projection of bronze; writing it to scratch first took a pass more."""
    staged, stage = [], L.K.stage
    monkeypatch.setattr(L.K, "stage", lambda df, name="staged": staged.append(name) or stage(df, name))
    from strata.sources.sinks import append_table
    for twice, want in ((False, []), (True, ["increment"])):
        store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"f{uuid.uuid4().hex[:8]}")
        store.ensure_database("bronze")
        e = ENTITIES["cast"]
        cast = LANDED["cast"](spark, SF_SMALL).filter("show_id < 30")
        append_table(L.bronze_records(cast.unionAll(cast) if twice else cast), store.name("bronze", e.bronze_table))
        staged.clear()
        assert L.load_silver(store, e) and staged == want
        silver = store.read("silver", e.silver_table)
        assert silver.count() == silver.select(*e.silver_keys).distinct().count() == cast.count()
        assert L.K.partition_columns(spark, store.name("silver", e.silver_table)) == list(e.partition_cols)
        assert not L.load_silver(store, e)


def test_single_upstream_load_needs_no_look_at_the_target(spark):
    import datetime as dt
    day = lambda n: dt.datetime(2024, 1, n)
    target = spark.createDataFrame([(1, day(2))], "id INT, created_at TIMESTAMP")
    up = spark.createDataFrame([(1, day(2)), (2, day(2))], "id INT, created_date TIMESTAMP")
    assert L.since_last_load(up, target, tgt_col="created_at", few_files=True) is up
    more = up.unionByName(spark.createDataFrame([(0, day(1)), (3, day(3))], up.schema))
    assert sorted(r["id"] for r in L.since_last_load(more, target, tgt_col="created_at", few_files=True).collect()) == [1, 2, 3]


def test_entities_are_built_at_once_and_all_end_before_an_error(spark, monkeypatch):
    """one after another, each entity's loads left cores idle."""
    import threading
    meet, ended = threading.Barrier(3), []

    def load(store, e, reference_mode=False):
        meet.wait(60)                                 # breaks unless all three are there
        if e.name == "shows":
            raise ValueError("shows")
        ended.append(e.name)
        return e.name == "cast"
    store = TableStore(spark, scratch_path(spark, "wh"), prefix=f"a{uuid.uuid4().hex[:8]}")
    monkeypatch.setattr(L, "load_silver", load)
    with pytest.raises(ValueError, match="shows"):
        L.run(spark, store, "", layers=["silver"], with_marts=False)
    assert sorted(ended) == ["cast", "episodes"]
    monkeypatch.setattr(L, "load_silver", lambda store, e, reference_mode=False: meet.wait(60) < 3 and e.name == "cast")
    monkeypatch.setattr(L, "load_gold", lambda store, e, reference_mode=False: True)
    done = L.run(spark, store, "", layers=["gold", "silver"], with_marts=False)
    assert list(done.items()) == [(("silver", "shows"), False), (("silver", "cast"), True), (("silver", "episodes"), False),
                                  (("gold", "shows"), True), (("gold", "cast"), True), (("gold", "episodes"), True)]
