"""Live ingests, the id index beside them, dead letters, and silver brought up to date from the ledger."""

import json
import random
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators import silver
from match_lake.plans import jobs
from match_lake.sources import idindex, landing, manifest, store, tables
from match_lake.streaming import landing as streaming

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
COLUMNS = ("match_id", "platform", "payload")


def doc(match_id=None, duration=60):
    return json.dumps({"metadata": {"matchId": match_id} if match_id else {}, "info": {"gameDuration": duration}})


def bronze(spark, ids, platform="br1", duration=60):
    return spark.createDataFrame([(i, platform, T0, doc(i, duration)) for i in ids], schemas.TABLES[schemas.MATCHES])


def arrived(spark, documents):
    """(value, file_path, file_name) of documents given as {name: text}."""
    return spark.createDataFrame([(text, f"/in/{name}", name) for name, text in documents.items()], "value string, file_path string, file_name string")


def stored(spark, database, platform=None):
    return rows(tables.read_or_empty(spark, database, schemas.MATCHES, platform), *COLUMNS)


class Stop(Exception):
    pass


STEPS = [(idindex, "write_index"), (manifest, "publish"), (tables, "drop_replaced"), (manifest, "drop_ingests"), (idindex, "drop_index")]


def stop_at(patch, module, step, after):
    real = getattr(module, step)

    def stopped(*args, **kw):
        if after:
            real(*args, **kw)
        raise Stop

    patch.setattr(module, step, stopped)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize(("module", "step"), STEPS, ids=[s for _, s in STEPS])
def test_compaction_stopped_anywhere(spark, database, monkeypatch, module, step, after):
    for i in range(3):
        tables.append_table(bronze(spark, [f"m{i}", f"n{i}"]), database, schemas.MATCHES)
    tables.append_table(bronze(spark, ["k1"], "kr"), database, schemas.MATCHES)
    before = stored(spark, database)
    with monkeypatch.context() as patch:
        stop_at(patch, module, step, after)
        with pytest.raises(Stop):
            tables.compact(spark, database, schemas.MATCHES, "br1")
    name = f"{database}.matches"
    assert stored(spark, database) == before
    assert rows(idindex.unseen_ids(bronze(spark, ["m0", "n2", "x"]).select("match_id"), name, "br1")) == [("x",)]
    tables.compact(spark, database, schemas.MATCHES, "br1")
    tables.vacuum(spark, database, schemas.MATCHES)
    assert stored(spark, database) == before
    live = {(x.platform, x.ingest) for x in manifest.live(spark, name)}
    assert len(live) == 2 and tables.vacuum(spark, database, schemas.MATCHES) == 0
    for table in (name, idindex.index_table(name)):
        assert {(p["platform"], p["ingest"]) for p in manifest.partitions(spark, table)} == live


@pytest.mark.parametrize(("module", "step"), STEPS[:2], ids=[s for _, s in STEPS[:2]])
def test_a_write_that_stops_is_not_seen(spark, database, monkeypatch, module, step):
    tables.append_table(bronze(spark, ["m1"]), database, schemas.MATCHES)
    load = arrived(spark, {"a": doc("m2"), "b": doc("m3")})
    with monkeypatch.context() as patch:
        stop_at(patch, module, step, False)
        with pytest.raises(Stop):
            tables.append_table(bronze(spark, ["m9"]), database, schemas.MATCHES)
        with pytest.raises(Stop):
            store.store_new(load, database, schemas.MATCHES, "br1", "monday", T0)
    assert stored(spark, database) == [("m1", "br1", doc("m1"))]
    store.store_new(load, database, schemas.MATCHES, "br1", "monday", T0)
    assert [r[0] for r in stored(spark, database)] == ["m1", "m2", "m3"]
    assert tables.vacuum(spark, database, schemas.MATCHES) == 1


def test_the_first_write_of_a_table_may_stop(spark, database, monkeypatch):
    with monkeypatch.context() as patch:
        stop_at(patch, idindex, "write_index", False)
        with pytest.raises(Stop):
            tables.append_table(bronze(spark, ["m1"]), database, schemas.MATCHES)
    assert stored(spark, database) == []
    tables.append_table(bronze(spark, ["m1"]), database, schemas.MATCHES)
    assert len(stored(spark, database)) == 1


def test_a_replay_that_stops_leaves_what_was_there(spark, database, monkeypatch):
    store.store_new(arrived(spark, {"a": doc("m1")}), database, schemas.MATCHES, "br1", "monday", T0)
    more = arrived(spark, {"a": doc("m1", 61), "b": doc("m2")})
    for module, step in STEPS[:2]:
        with monkeypatch.context() as patch:
            stop_at(patch, module, step, False)
            with pytest.raises(Stop):
                store.store_new(more, database, schemas.MATCHES, "br1", "monday", T0)
        assert stored(spark, database) == [("m1", "br1", doc("m1"))]
    store.store_new(more, database, schemas.MATCHES, "br1", "monday", T0)
    assert stored(spark, database) == [("m1", "br1", doc("m1", 61)), ("m2", "br1", doc("m2"))]
    assert [(x.generation, x.documents) for x in manifest.live(spark, f"{database}.matches")] == [(2, 2)]


def test_load_names_do_not_meet(spark, database):
    for name, match in (("a", "m1"), ("a", "m1"), ("a", "m1"), ("2-a", "m2"), ("load-a", "m3"), ("3-a", "m4")):
        store.store_new(arrived(spark, {"x": doc(match)}), database, schemas.MATCHES, "br1", name, T0)
    assert [r[0] for r in stored(spark, database)] == ["m1", "m2", "m3", "m4"]


def test_odd_names(spark, database):
    store.store_new(arrived(spark, {"x": doc("m1")}), database, schemas.MATCHES, "br1", "2024-01-01T00:00:00/a=b %41", T0)
    tables.append_table(bronze(spark, ["m2"], "b r/1"), database, schemas.MATCHES, "x:y")
    assert [r[0] for r in stored(spark, database)] == ["m1", "m2"]
    got = idindex.unseen_ids(bronze(spark, ["m1", "m2", "m3"]).select("match_id"), f"{database}.matches")
    assert rows(got) == [("m3",)] and tables.vacuum(spark, database, schemas.MATCHES) == 0


def test_a_table_without_manifest(spark, database):
    """As written by something else: every ingest counts, none has an index."""
    name = f"{database}.matches"
    old = bronze(spark, ["m1", "m2"]).withColumn("ingest", F.lit("load-monday"))
    old.write.partitionBy("platform", "ingest").saveAsTable(name)
    assert [r[0] for r in stored(spark, database)] == ["m1", "m2"] and manifest.live(spark, name) is None
    assert rows(idindex.unseen_ids(bronze(spark, ["m2", "m3"]).select("match_id"), name, "br1")) == [("m3",)]
    store.store_new(arrived(spark, {"x": doc("m1", 5), "y": doc("m2"), "z": doc("m3")}), database, schemas.MATCHES, "br1", "monday", T0)
    tables.append_table(bronze(spark, ["m4"]), database, schemas.MATCHES)
    assert [(r[0], r[2]) for r in stored(spark, database)] == [("m1", doc("m1", 5)), ("m2", doc("m2")), ("m3", doc("m3")), ("m4", doc("m4"))]


def test_one_write_for_several_platforms(spark, database):
    both = bronze(spark, ["m1", "m2"]).union(bronze(spark, ["m1"], "kr"))
    assert tables.append_table(both, database, schemas.MATCHES) == 3
    assert [(x.platform, x.documents) for x in manifest.live(spark, f"{database}.matches")] == [("br1", None), ("kr", None)]
    for platform, left in (("br1", []), ("kr", [("m2",)])):
        assert rows(idindex.unseen_ids(bronze(spark, ["m1", "m2"]).select("match_id"), f"{database}.matches", platform)) == left


def test_versions_of_a_manifest_do_not_pile_up(spark, database):
    for i in range(6):
        tables.append_table(bronze(spark, [f"m{i}"]), database, schemas.MATCHES)
    name = f"{database}.matches"
    assert len(manifest.partitions(spark, manifest.companion(name))) == manifest.VERSIONS_KEPT and len(stored(spark, database)) == 6


# --- id index ----------------------------------------------------------------


@pytest.mark.parametrize(("ids", "level"), [(0, 0), (1, 0), (2_048, 0), (2_049, 1), (4_097, 2), (1_000_000, 9)])
def test_level_for(ids, level):
    assert idindex.level_for(ids) == level


def test_every_stored_id_hits_and_few_others_do(spark, database):
    rng = random.Random(6)
    ingests = [[f"BR1_{rng.randrange(10**9)}" for _ in range(n)] for n in (1, 3_000, 9_000)]
    for ids in ingests:
        tables.append_table(bronze(spark, ids), database, schemas.MATCHES)
    name = f"{database}.matches"
    live = manifest.live(spark, name)
    assert sorted(x.level for x in live) == [0, 1, 3]
    known = [i for ids in ingests for i in ids]
    strange = [f"KR_{i}" for i in range(5_000)]
    candidates = spark.createDataFrame([(i,) for i in [*known, *strange, *known[:50], None]], "match_id string")
    hits = rows(idindex.probe(candidates, spark, name, live).groupBy("match_id").count())
    assert set(known) <= {i for i, _ in hits}
    false = sum(n for i, n in hits) - sum(len(set(ids)) for ids in ingests)
    assert false < 0.01 * 3 * (len(known) + len(strange))
    assert {r[0] for r in rows(idindex.stored_ids(candidates, name, "br1"))} == set(known)
    assert sorted(r[0] or "" for r in rows(idindex.unseen_ids(candidates, name, "br1"))) == sorted([*strange, ""])


def test_a_batch_opens_only_the_ingests_that_may_hold_it(spark, database):
    """100 ingests, ten ids of which two are stored: the exact test lists the folders of a few."""
    name = tables.ensure_table(spark, database, schemas.MATCHES)
    everything = spark.range(10_000).select(
        F.concat(F.lit("m"), "id").alias("match_id"), F.lit("br1").alias("platform"), F.lit(T0).alias("fetched_at"),
        F.lit("{}").alias("payload"), F.concat(F.lit("load-"), (F.col("id") % 100).cast("string")).alias("ingest"),
    )
    everything.repartition(4, "ingest").write.partitionBy("platform", "ingest").mode("append").saveAsTable(name)
    blocks = everything.select("ingest", F.pmod(F.xxhash64("match_id"), F.lit(1)).alias("block"), F.explode(F.array(*idindex._places("match_id"))).alias("p"))
    blocks = blocks.groupBy("block", "ingest").agg(F.bitmap_construct_agg("p").alias("bits")).withColumn("platform", F.lit("br1"))
    blocks.select("block", "bits", "platform", "ingest").coalesce(1).write.partitionBy("platform", "ingest").saveAsTable(idindex.index_table(name))
    manifest.publish(spark, name, [manifest.Live("br1", f"load-{i}", level=0) for i in range(100)])
    ids = ["m7", "m1234", *[f"new{i}" for i in range(8)]]
    batch = spark.createDataFrame([(i,) for i in ids], "match_id string")
    stored_here = idindex.stored_ids(batch, name, "br1")
    opened = {f.split("ingest=")[1].split("/")[0] for f in stored_here.inputFiles() if "/ingest=" in f and "/matches/" in f}
    assert {"load-7", "load-34"} <= opened and len(opened) < 10
    assert rows(stored_here) == [("m1234",), ("m7",)]
    store.store_new(arrived(spark, {i: doc(i) for i in ids}), database, schemas.MATCHES, "br1", "late", T0)
    assert tables.read_or_empty(spark, database, schemas.MATCHES).count() == 10_008


def test_stored_ids_against_plain_sets(spark, database):
    rng, name = random.Random(8), f"{database}.matches"
    held = set()
    for turn in range(5):
        ids = [f"m{rng.randrange(200)}" for _ in range(60)]
        documents = {f"{turn}-{k}": doc(i, k) for k, i in enumerate(ids)}
        expected = sorted({i for i in ids if i not in held})
        before = len(stored(spark, database))
        store.store_new(arrived(spark, documents), database, schemas.MATCHES, "br1", f"t{turn}", T0)
        held |= set(ids)
        assert len(stored(spark, database)) - before == len(expected)
        if turn == 2:
            tables.compact(spark, database, schemas.MATCHES, "br1")
    assert sorted(r[0] for r in stored(spark, database)) == sorted(held)
    assert len(manifest.live(spark, name)) == 3


# --- silver by ledger --------------------------------------------------------


def refreshed(spark, database):
    """Silver after a refresh, and what a full rebuild gives."""
    full = silver.flatten_matches(tables.read_or_empty(spark, database, schemas.MATCHES))
    return rows(jobs.silver_refresh(spark, database).select(*full.columns)), rows(full)


def test_silver_follows_every_change_of_a_load(spark, database):
    loads = [
        ("a", {"x": doc("m1")}), ("b", {"x": doc("m7"), "y": doc("m1", 9)}), ("a", {"x": doc("m1"), "y": doc("m2")}), ("a", {"x": doc("m1", 75), "y": doc("m2")}),
        ("c", {"z": doc("m3")}), ("c", {"z": doc("m3", 80), "y": doc("m4"), "q": doc("m5")}),
    ]
    for turn, (name, documents) in enumerate(loads):
        store.store_new(arrived(spark, documents), database, schemas.MATCHES, "br1", name, T0.replace(day=turn + 1))
        ours, full = refreshed(spark, database)
        assert ours == full and ours
    tables.compact(spark, database, schemas.MATCHES, "br1")
    assert refreshed(spark, database) == (full, full)
    store.store_new(arrived(spark, loads[0][1]), database, schemas.MATCHES, "br1", "a", T0)
    assert refreshed(spark, database) == (full, full)


def test_only_what_changed_is_parsed(spark, database, monkeypatch):
    tables.append_table(bronze(spark, ["m1", "m2"]), database, schemas.MATCHES)
    jobs.silver_refresh(spark, database)
    tables.append_table(bronze(spark, ["m3"]), database, schemas.MATCHES)
    parsed = []
    monkeypatch.setattr(store, "replace_folders", lambda df, name, real=store.replace_folders: (parsed.append(df.count()), real(df, name)))
    assert jobs.silver_refresh(spark, database).count() == 3 and parsed == [1]
    assert jobs.silver_refresh(spark, database).count() == 3 and parsed == [1]


@pytest.mark.parametrize("step", ["publish", "drop_ingests"])
def test_a_refresh_that_stops_is_done_again(spark, database, monkeypatch, step):
    store.store_new(arrived(spark, {"x": doc("m1")}), database, schemas.MATCHES, "br1", "a", T0)
    first, _ = refreshed(spark, database)
    store.store_new(arrived(spark, {"x": doc("m1", 2), "y": doc("m2")}), database, schemas.MATCHES, "br1", "a", T0)
    with monkeypatch.context() as patch:
        stop_at(patch, manifest, step, False)
        with pytest.raises(Stop):
            jobs.silver_refresh(spark, database)
    seen = rows(manifest.live_rows(spark, f"{database}.silver_by_load").select(*tables_columns()))
    ours, full = refreshed(spark, database)
    assert ours == full and seen == (first if step == "publish" else full)


def tables_columns():
    return [c.split()[0] for c in schemas.SILVER_MATCHES.split(", ")]


# --- dead letters ------------------------------------------------------------


def test_kept_and_dead_letters_are_all_that_arrived(spark, database, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [doc("m1"), doc(), "not json", '{"metadata": {}}', "", doc("m2"), "[1, 2", "null"]
    (folder / "a.jsonl").write_text("\n".join(lines))
    (folder / "b.jsonl").write_text("\n".join([doc("m3"), "not json"]))
    for turn in range(3):
        state = str(tmp_path / ("one" if turn < 2 else "two"))
        arriving = streaming.read_landing_stream(spark, str(folder), whole_files=False)
        streaming.stream_land(arriving, database, schemas.MATCHES, "br1", state, fetched_at=T0, whole_files=False).awaitTermination()
        dead = store.dead_letters(spark, database, schemas.MATCHES)
        if turn < 2:
            kept = [r[2] for r in stored(spark, database)]
            assert sorted(kept + [r["payload"] for r in dead.collect()]) == sorted([*lines, doc("m3"), "not json"])
            reasons = {r["payload"]: r["reason"] for r in dead.collect()}
            assert reasons["not json"] == reasons["[1, 2"] == reasons[""] == store.NOT_JSON
            assert reasons[doc()] == reasons['{"metadata": {}}'] == store.NO_ID
    # a second stream over the same files is another load, and brings its own
    assert dead.count() == 14 and len(stored(spark, database)) == 3


def test_dead_letters_of_a_load_run_again(spark, database):
    first = landing_rows(spark, ["x", doc("m1"), "y"])
    store.store_new(first, database, schemas.MATCHES, "br1", "monday", T0, whole_files=False)
    store.store_new(first, database, schemas.MATCHES, "br1", "monday", T0, whole_files=False)
    assert rows(store.dead_letters(spark, database, schemas.MATCHES, "br1"), "payload") == [("x",), ("y",)]
    fixed = landing_rows(spark, [doc("m1"), doc("m2")])
    store.store_new(fixed, database, schemas.MATCHES, "br1", "monday", T0, whole_files=False)
    assert store.dead_letters(spark, database, schemas.MATCHES).count() == 0 and len(stored(spark, database)) == 2
    assert store.dead_letters(spark, database, schemas.TIMELINES).count() == 0


def landing_rows(spark, lines):
    return spark.createDataFrame([(x, "/in/a.jsonl", "a.jsonl") for x in lines], "value string, file_path string, file_name string")


def test_named_files_without_json_are_kept(spark, database):
    store.store_new(arrived(spark, {"m1.json": "not json", ".json": "no name"}), database, schemas.MATCHES, "br1", "a", T0)
    assert stored(spark, database) == [("m1", "br1", "not json")]
    assert rows(store.dead_letters(spark, database, schemas.MATCHES), "reason") == [(store.NOT_JSON,)]
    assert landing.landing_rejects(arrived(spark, {".json": "no name"})).count() == 1
