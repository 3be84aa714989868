"""Data tests that follow refreshes, against the tests over the whole table."""

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from test_manifest import T0, Stop, arrived, bronze, doc, stop_at

from match_lake import schemas
from match_lake.operators import quality
from match_lake.plans import jobs
from match_lake.sources import checks, idindex, manifest, store, tables


def both(spark, database):
    silver = jobs.silver_refresh(spark, database, strict=False)
    return rows(checks.refresh_checks(spark, database)), rows(quality.run_checks(silver))


@pytest.mark.parametrize("seed", range(3))
def test_checks_follow_every_change(spark, database, seed):
    rng = random.Random(seed)
    for turn in range(6):
        ids = [f"m{rng.randrange(30)}" for _ in range(6)]
        step = rng.choice(["append", "append", "load", "replay", "compact", "other"])
        if step in ("load", "replay"):
            name = "a" if step == "replay" else f"l{turn}"
            documents = {f"x{i}": doc(i, rng.choice([60, "n/a"])) for i in {*ids, "a0"}}
            try:
                store.store_new(arrived(spark, documents), database, schemas.MATCHES, "br1", name, T0)
            except ValueError:  # another load of that name
                continue
        elif step == "compact" and spark.catalog.tableExists(f"{database}.matches"):
            tables.compact(spark, database, schemas.MATCHES, "br1")
        else:
            platform = "kr" if step == "other" else "br1"
            tables.append_table(bronze(spark, ids, platform, rng.choice([60, "x"])), database, schemas.MATCHES)
        ours, full = both(spark, database)
        assert ours == full and len(ours) == 3


def test_nothing_stored_yet(spark, database):
    tables.ensure_table(spark, database, schemas.MATCHES)
    ours, full = both(spark, database)
    assert ours == full and all(r[-1] for r in ours)


def test_only_new_ingests_are_read(spark, database, monkeypatch):
    tables.append_table(bronze(spark, ["m1", "m1", "m2"]), database, schemas.MATCHES)
    assert [r[2] for r in both(spark, database)[0]] == [0, 0, 1]
    tables.append_table(bronze(spark, ["m2", "m3"]), database, schemas.MATCHES)
    read = []
    real = checks._notes
    monkeypatch.setattr(checks, "_notes", lambda s, a, b, now, new, c: (read.append((len(now), len(new))), real(s, a, b, now, new, c))[1])
    ours, full = both(spark, database)
    assert ours == full and read == [(2, 1)] and [r[2] for r in ours] == [0, 0, 2]
    assert both(spark, database)[0] == ours and read == [(2, 1)]


def test_checks_that_stop_are_done_again(spark, database, monkeypatch):
    tables.append_table(bronze(spark, ["m1", "m1"]), database, schemas.MATCHES)
    jobs.silver_refresh(spark, database)
    for step in ("publish", "drop_ingests"):
        with monkeypatch.context() as patch:
            stop_at(patch, manifest, step, False)
            try:
                checks.refresh_checks(spark, database).count()
            except Stop:
                pass
        ours, full = both(spark, database)
        assert ours == full
        tables.compact(spark, database, schemas.MATCHES, "br1")
        tables.append_table(bronze(spark, ["m1"]), database, schemas.MATCHES)
        jobs.silver_refresh(spark, database)
    assert manifest.live_rows(spark, f"{database}.silver_by_load_checks").filter(F.col("test") == "suspect").count() > 0


@pytest.mark.parametrize(("many", "few"), [(1, 10**9), (10**9, 0)])
def test_several_new_ingests_at_once(spark, database, monkeypatch, many, few):
    """Ids twice in one ingest, in two new ones, in a new and an old one, and none; then those met by them go."""
    monkeypatch.setattr(checks, "MANY", many)
    monkeypatch.setattr(checks, "FEW", few)
    monkeypatch.setattr(idindex, "PARTS", 2)
    loads = [[["a", "b", "old"]], [["b", "c", "c"], ["d", "e", None], ["e", "f", "old"]], [["f", "g"]]]
    for turn, ingests in enumerate(loads):
        for ids in ingests:
            tables.append_table(bronze(spark, ids), database, schemas.MATCHES)
        ours, full = both(spark, database)
        assert ours == full, turn
    assert [r[2] for r in ours] == [0, 1, 5]
    live = manifest.live(spark, f"{database}.matches")
    manifest.publish(spark, f"{database}.matches", live[1:-1])
    ours, full = both(spark, database)
    assert ours == full


def test_ids_of_new_ingests_are_shuffled_once(spark, database, monkeypatch):
    tables.append_table(bronze(spark, ["m1", "m2"]), database, schemas.MATCHES)
    both(spark, database)
    tables.append_table(bronze(spark, ["m2", "m3", "m3"]), database, schemas.MATCHES)
    plans = []
    real = store.replace_folders
    monkeypatch.setattr(checks, "FEW", 10**9)
    monkeypatch.setattr(store, "replace_folders", lambda df, name: (plans.append((name, plan_of(df))), real(df, name))[1])
    ours, full = both(spark, database)
    assert ours == full
    noted = [plan for name, plan in plans if name.endswith("_checks")]
    assert len(noted) == 1 and noted[0].count("hashpartitioning(match_id") == 1


def test_many_candidates_meet_what_a_part_of_them_did_not_hit(spark, database, monkeypatch):
    name = f"{database}.{schemas.MATCHES}"
    tables.append_table(bronze(spark, [f"m{i}" for i in range(400)]), database, schemas.MATCHES, "all")
    tables.append_table(bronze(spark, ["m7"]), database, schemas.MATCHES, "one")
    tables.append_table(bronze(spark, ["x"]), database, schemas.MATCHES, "none")
    live = manifest.resolved(spark, name)
    ids = spark.createDataFrame([(f"m{i}",) for i in range(400)], "match_id string")
    probed = []
    real = idindex.probe
    monkeypatch.setattr(idindex, "probe", lambda c, s, n, of, i: (probed.append((c.count(), [x.ingest.split("-")[1] for x in of])), real(c, s, n, of, i))[1])
    hit = idindex.ingests_hit(ids, spark, name, live, many=True)
    assert {i.split("-")[1] for _, i in hit} == {"all", "one"} and hit == idindex.ingests_hit(ids, spark, name, live)
    assert probed[0][0] < 40 and sorted(probed[0][1]) == ["all", "none", "one"]
    assert probed[1] == (400, [x.ingest.split("-")[1] for x in live if "-all-" not in x.ingest])
