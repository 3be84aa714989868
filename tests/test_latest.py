"""The kept latest state against the window over all snapshots."""

import itertools
import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators import cohort
from match_lake.sources import latest, manifest, tables

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
DDL = schemas.TABLES[schemas.LEAGUE_ENTRIES]


def snapshots(seed, turns=5, accounts=25):
    """Ladder rows by snapshot: ties within one, the same moment in several, several queues and platforms."""
    rng = random.Random(seed)
    return [
        [
            (
                f"p{rng.randrange(accounts)}", rng.choice(["br1", "kr"]), rng.choice(["SOLO", "FLEX", None]), rng.choice(schemas.TIERS[:3]), rng.choice("I II".split()),
                rng.randrange(3), rng.randrange(2), 0, rng.choice([True, False, None]), T0 + timedelta(days=rng.randrange(turns)),
            )
            for _ in range(40)
        ]
        for _ in range(turns)
    ]


def frame(spark, entries):
    return spark.createDataFrame(entries, DDL)


@pytest.mark.parametrize("seed", range(4))
def test_any_order_of_snapshots_gives_the_same_state(spark, database, seed):
    parts = snapshots(seed)
    whole = frame(spark, list(itertools.chain(*parts)))
    want = rows(cohort.latest_per_key(whole, latest.KEYS, "fetched_at", latest.TIES))
    order = list(range(len(parts)))
    random.Random(seed).shuffle(order)
    for at in [*order, order[1]]:
        count = latest.merge_snapshot(frame(spark, parts[at]), database)
    state = latest.read_latest(spark, database)
    assert rows(state) == want and count <= len(want)
    # from the state as from the history
    for platform, queue in (("br1", "SOLO"), ("kr", None)):
        ties = [t for t in latest.TIES] + ["queue_type"]
        chosen = [
            rows(cohort.select_cohort(ladder, spark.createDataFrame([], schemas.TABLES[schemas.LISTED_ACCOUNTS]), "BRONZE+", 9, T0, 24, platform, ties, queue))
            for ladder in (whole, latest.read_latest(spark, database, platform))
        ]
        assert chosen[0] == chosen[1] and chosen[0]


def test_only_the_platforms_of_a_snapshot_are_rewritten(spark, database):
    one, two = (frame(spark, [("a", p, "SOLO", "GOLD", "I", 1, 1, 1, False, T0)]) for p in ("br1", "kr"))
    latest.merge_snapshot(one, database)
    latest.merge_snapshot(two, database)
    before = {x.platform: x.ingest for x in manifest.live(spark, f"{database}.league_latest")}
    assert latest.merge_snapshot(two.withColumn("fetched_at", F.expr("fetched_at + interval 1 day")), database) == 1
    after = {x.platform: x.ingest for x in manifest.live(spark, f"{database}.league_latest")}
    assert after["br1"] == before["br1"] and after["kr"] != before["kr"]
    assert len(manifest.partitions(spark, f"{database}.league_latest")) == 2


def test_nothing_and_rows_without_account(spark, database):
    assert latest.read_latest(spark, database).count() == 0
    assert latest.merge_snapshot(frame(spark, []), database) == 0
    assert latest.merge_snapshot(frame(spark, [(None, "br1", "SOLO", "GOLD", "I", 1, 1, 1, False, T0)]), database) == 0
    assert rows(latest.read_latest(spark, database)) == [] and latest.read_latest(spark, database).columns == tables.stored_columns(schemas.LEAGUE_ENTRIES)


@pytest.mark.parametrize("step", ["publish", "drop_ingests"])
def test_a_merge_that_stops_is_run_again(spark, database, monkeypatch, step):
    parts = snapshots(9, 2)
    latest.merge_snapshot(frame(spark, parts[0]), database)
    before = rows(latest.read_latest(spark, database))
    with monkeypatch.context() as patch:
        patch.setattr(manifest, step, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            latest.merge_snapshot(frame(spark, parts[1]), database)
    whole = rows(cohort.latest_per_key(frame(spark, parts[0] + parts[1]), latest.KEYS, "fetched_at", latest.TIES))
    assert rows(latest.read_latest(spark, database)) == (before if step == "publish" else whole)
    latest.merge_snapshot(frame(spark, parts[1]), database)
    assert rows(latest.read_latest(spark, database)) == whole
