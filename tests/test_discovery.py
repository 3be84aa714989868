import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_of, rows

from match_lake import schemas
from match_lake.operators import discovery, metrics, ordering
from match_lake.sources.tables import empty

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
DAY = timedelta(days=1)


def ids(spark, names, platform="br1"):
    return spark.createDataFrame([(n, platform) for n in names], "match_id string, platform string")


def listing(spark, entries):
    return spark.createDataFrame([(a, m, at, q) for a, m, at, q in entries], schemas.LISTING)


def test_unseen_keeps_duplicates_and_other_columns(spark):
    candidates = spark.createDataFrame([("m2", 0), ("m1", 1), ("m2", 2), ("m3", 3)], "match_id string, pos int")
    got = discovery.unseen_ids(candidates, ids(spark, ["m1", "m9", "m1"]), "br1")
    assert [r["match_id"] for r in got.orderBy("pos").collect()] == ["m2", "m2", "m3"]


def test_unseen_is_per_platform_and_takes_empty_inputs(spark):
    candidates = spark.createDataFrame([("m1",)], "match_id string")
    assert discovery.unseen_ids(candidates, ids(spark, ["m1"], "kr"), "br1").count() == 1
    assert discovery.unseen_ids(candidates.limit(0), ids(spark, ["m1"]), "br1").count() == 0
    assert rows(discovery.known_ids(candidates, ids(spark, ["m1", "m1"]), "br1")) == [("m1",)]


def test_a_match_without_its_timeline_is_not_complete(spark):
    matches, timelines = ids(spark, ["m1", "m2", "m2"]), ids(spark, ["m1", "m3"])
    assert rows(discovery.complete_ids(matches, timelines), "match_id") == [("m1",)]
    assert rows(discovery.missing_timelines(matches, timelines), "match_id") == [("m2",)]


@pytest.mark.parametrize("spec,want", [
    ("Name#BR1,Other#1234", [("Name", "BR1"), ("Other", "1234")]),
    (" A b#x#y ,\tq", [("A b", "x#y"), ("q", "")]),
    ("#tag", [("", "tag")]),
    ("", []),
    (" , #,x#", [("x", "")]),
])
def test_parse_ids(spark, spec, want):
    df = spark.createDataFrame([(spec,)], "spec string")
    got = discovery.parse_ids(df).orderBy("ordinal")
    assert [(r["game_name"], r["tag_line"]) for r in got.collect()] == want
    assert discovery.parse_ids(df).count() + discovery.parse_id_rejects(df).count() == len(spec.split(","))


def test_list_ids(spark):
    df = listing(spark, [
        ("a", "m1", T0, 420), ("a", "m2", T0 + DAY, 420), ("a", "m2", T0 + DAY, 420), ("a", "m3", T0 + 2 * DAY, 440),
        ("a", "m4", T0 + 3 * DAY, 420), ("b", "m4", T0 + 3 * DAY, 420),
    ])
    assert rows(discovery.list_ids(df, since=T0, queue=420), "account", "match_id") == [("a", "m2"), ("a", "m4"), ("b", "m4")]
    assert rows(discovery.list_ids(df, max_games=2), "account", "match_id") == [("a", "m3"), ("a", "m4"), ("b", "m4")]
    assert discovery.list_ids(df).count() == 5


def walk(accounts, played, known, budget, batch):
    """Batch after batch with a running call count, as a person with a pencil would."""
    stored, used, fetched, listed = set(known), 0, {}, []
    accounts = sorted(accounts)
    for b, start in enumerate(range(0, len(accounts), batch)):
        group = accounts[start:start + batch]
        used += len(group)
        new = sorted({m for a in group for m in played[a]} - stored)
        new = new[:max(0, (budget - used) // 2)]
        listed.append(b)
        for pos, m in enumerate(new):
            fetched[m] = (b, pos)
        stored |= set(new)
        used += 2 * len(new)
        if used >= budget:
            break
    return fetched, listed, used


@pytest.mark.parametrize("seed", range(14))
def test_crawl_plan_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    batch = rng.choice([2, 3, 5])
    accounts = [f"a{i}" for i in range(rng.randint(1, 30))]
    played = {a: [f"m{rng.randint(0, 60)}" for _ in range(rng.randint(0, 8))] for a in accounts}
    played[accounts[0]] += [f"m{i}" for i in range(rng.choice([0, 40]))]
    known = [f"m{i}" for i in range(60) if rng.random() < 0.3]
    budget = rng.choice([0, 1, batch, 7, 11, rng.randint(5, 90), rng.randint(5, 90), 500])
    plan = discovery.crawl_plan(
        spark.createDataFrame([(a,) for a in accounts], "puuid string"),
        listing(spark, [(a, m, T0, 420) for a, ms in played.items() for m in ms]),
        ids(spark, known), budget, workers=3, platform="br1", batch=batch, fetch_batch=4,
    )
    fetched, listed, used = walk(accounts, played, known, budget, batch)
    got = {r["match_id"]: r for r in plan.fetch.collect()}
    assert {m: (r["batch_no"], r["pos"]) for m, r in got.items()} == fetched
    assert all(r["fetch_no"] == r["pos"] // 4 and r["worker"] == r["pos"] % 3 for r in got.values())
    assert sorted(r["batch_no"] for r in plan.batches.filter("listed").collect()) == listed
    progress = metrics.run_progress(plan.batches, budget).orderBy("batch_no").collect()
    assert progress[-1]["budget_used"] == used and progress[-1]["matches_written"] == len(fetched)
    assert [r["over_budget"] for r in progress] == [r["budget_used"] > budget for r in progress]
    seen = {m for a in sorted(accounts)[:batch * len(listed)] for m in played[a]}
    assert {r["match_id"] for r in plan.deferred.collect()} == seen - set(known) - set(fetched)


def walk_with_pending(pending, accounts, played, known, budget, batch):
    """As walk, after a first round that lists nobody and fetches what is pending."""
    stored, new = set(known), sorted(set(pending) - set(known))
    fetched = {m: (-1, pos) for pos, m in enumerate(new[: max(0, budget // 2)])}
    listed, used = [-1] if pending else [], 2 * len(fetched)
    # ids over the budget stay with their round
    if new and used >= budget:
        return fetched, listed, used
    more, later, used_later = walk(accounts, played, stored | set(new), budget - used, batch) if accounts else ({}, [], 0)
    return {**fetched, **more}, listed + later, used + used_later


@pytest.mark.parametrize("seed", range(10))
def test_pending_ids_come_first_and_cost_no_listing(spark, seed):
    rng = random.Random(100 + seed)
    batch = rng.choice([2, 3])
    accounts = [f"a{i}" for i in range(rng.choice([0, 0, 4, 9]))]
    played = {a: [f"m{rng.randint(0, 40)}" for _ in range(rng.randint(0, 6))] for a in accounts}
    known = [f"m{i}" for i in range(40) if rng.random() < 0.2]
    pending = [f"m{rng.randint(0, 60)}" for _ in range(rng.choice([0, 1, 8, 30]))]
    budget = rng.choice([0, 1, 2, 7, 12, 40, 300])
    plan = discovery.crawl_plan(
        spark.createDataFrame([(a,) for a in accounts], "puuid string"), listing(spark, [(a, m, T0, 420) for a, ms in played.items() for m in ms]),
        ids(spark, known), budget, platform="br1", batch=batch,
        pending=spark.createDataFrame([(m,) for m in [*pending, None]], "match_id string"),
    )
    fetched, listed, used = walk_with_pending(pending, accounts, played, known, budget, batch)
    assert {r["match_id"]: (r["batch_no"], r["pos"]) for r in plan.fetch.collect()} == fetched
    assert sorted(r["batch_no"] for r in plan.batches.filter("listed").collect()) == listed
    reached = accounts[: batch * (max(listed, default=-1) + 1)]
    seen = set(pending) | {m for a in reached for m in played[a]}
    assert {r["match_id"] for r in plan.deferred.collect()} == seen - set(known) - set(fetched)
    progress = metrics.run_progress(plan.batches, budget).orderBy("batch_no").collect()
    assert (progress[-1]["budget_used"] if progress else 0) == used


def test_deferred_ids_outlive_runs_without_accounts(spark):
    """A budget of two matches a run and nobody to list: what was deferred is fetched bit by bit, none is lost."""
    nobody, nothing = empty(spark, "puuid string"), empty(spark, schemas.LISTING)
    pending, stored = ids(spark, [f"m{i}" for i in range(5)]).select("match_id"), []
    for left in (3, 1, 0):
        plan = discovery.crawl_plan(nobody, nothing, ids(spark, stored), 5, platform="br1", pending=pending)
        stored += [r["match_id"] for r in plan.fetch.collect()]
        pending = spark.createDataFrame(plan.deferred.select("match_id").collect(), "match_id string")
        assert pending.count() == left
    assert sorted(stored) == [f"m{i}" for i in range(5)]


def test_a_plan_writes_three_tables(spark, monkeypatch):
    written = []
    for module in (discovery, ordering):
        monkeypatch.setattr(module, "cut_lineage", lambda df, purpose="step", real=module.cut_lineage: (written.append(purpose), real(df, purpose))[1])
    df = listing(spark, [("a", f"m{i}", T0, 1) for i in range(5)])
    plan = discovery.crawl_plan(spark.createDataFrame([("a",)], "puuid string"), df, ids(spark, []), 7, platform="br1")
    assert [plan.fetch.count(), plan.deferred.count(), plan.batches.count()] == [3, 2, 1]
    assert written == ["sliced", "found", "sliced"]


def test_without_a_budget_everything_is_fetched(spark):
    df = listing(spark, [("a", "m2", T0, 1), ("b", "m1", T0, 1), ("b", "m2", T0, 1)])
    plan = discovery.crawl_plan(
        spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "puuid string"), df, ids(spark, []), None, batch=1,
    )
    assert rows(plan.fetch, "batch_no", "match_id", "pos") == [(0, "m2", 0), (1, "m1", 0)]
    assert plan.deferred.count() == 0
    assert rows(plan.batches, "batch_no", "found", "unseen", "fetched") == [(0, 1, 1, 1), (1, 2, 1, 1)]


def test_nothing_to_do(spark):
    plan = discovery.crawl_plan(
        empty(spark, "puuid string"), empty(spark, schemas.LISTING), ids(spark, []), 100,
    )
    assert plan.fetch.count() == plan.deferred.count() == plan.batches.count() == 0


def test_checkpoint_waits_for_what_has_not_landed(spark):
    df = listing(spark, [("a", "m1", T0, 1), ("b", "m2", T0, 1)])
    accounts = spark.createDataFrame([("a",), ("b",), ("c",)], "puuid string")
    plan = discovery.crawl_plan(accounts, df, ids(spark, []), 100, platform="br1", batch=1)
    got = discovery.landed_checkpoint(plan, ids(spark, ["m1", "m2"]), ids(spark, ["m1"]), T0, "br1")
    assert rows(got, "puuid", "platform") == [("a", "br1"), ("c", "br1")]


@pytest.mark.parametrize("budget", [7, 8, 11])
def test_every_match_is_fetched_in_the_end(spark, budget):
    """Runs under a budget that cuts batches, each landing what it fetched; accounts are listed only when all landed."""
    played = {"a": ["a0", "a1", "a2", "a3", "a4"], "b": ["b0", "a1"], "c": [], "d": [f"d{i}" for i in range(7)]}
    df = listing(spark, [(x, m, T0, 1) for x, ms in played.items() for m in ms])
    stored, listed, runs = set(), set(), 0
    while listed != set(played):
        todo = spark.createDataFrame([(x,) for x in sorted(set(played) - listed)], "puuid string")
        plan = discovery.crawl_plan(todo, df, ids(spark, sorted(stored)), budget, platform="br1", batch=1)
        stored |= {r["match_id"] for r in plan.fetch.collect()}
        landed = ids(spark, sorted(stored))
        listed |= {r["puuid"] for r in discovery.landed_checkpoint(plan, landed, landed, T0, "br1").collect()}
        assert {m for x in listed for m in played[x]} <= stored
        runs += 1
        assert runs < 20
    assert stored == {m for ms in played.values() for m in ms}


def test_deferred_matches_flow_into_the_next_plan(spark):
    df = listing(spark, [("a", f"m{i}", T0, 1) for i in range(5)])
    one = spark.createDataFrame([("a",)], "puuid string")
    first = discovery.crawl_plan(one, df, ids(spark, []), 7, platform="br1")
    assert [first.fetch.count(), first.deferred.count()] == [3, 2]
    assert discovery.landed_checkpoint(first, *[ids(spark, ["m0", "m1", "m2"])] * 2, T0, "br1").count() == 0
    second = discovery.crawl_plan(one, df.limit(0), ids(spark, ["m0", "m1", "m2"]), 7, platform="br1", pending=first.deferred)
    assert rows(second.fetch, "match_id") == [("m3",), ("m4",)]
    everything = ids(spark, [f"m{i}" for i in range(5)])
    assert rows(discovery.landed_checkpoint(second, everything, everything, T0, "br1"), "puuid") == [("a",)]


def test_the_stored_side_is_not_shuffled_for_few_candidates(spark, tmp_path):
    spark.range(50_000).selectExpr("concat('m', id) as match_id", "'br1' as platform", "repeat('x', 20) as payload").write.parquet(f"{tmp_path}/stored")
    spark.range(5).selectExpr("concat('m', id) as match_id").write.parquet(f"{tmp_path}/few")
    got = discovery.unseen_ids(spark.read.parquet(f"{tmp_path}/few"), spark.read.parquet(f"{tmp_path}/stored"), "br1")
    assert got.count() == 0
    plan = plan_of(got)
    before_scan = plan[: plan.index("/stored")]
    assert "BroadcastHashJoin" in before_scan and "LeftSemi" in before_scan
    below_semi = before_scan[before_scan.index("LeftSemi"):]
    assert "hashpartitioning" not in below_semi.split("FileScan")[0]


def test_progress_tells_who_is_left(spark):
    accounts = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "puuid string")
    df = listing(spark, [("a", "m1", T0, 1), ("a", "m2", T0, 1)])
    plan = discovery.crawl_plan(accounts, df, ids(spark, []), 3, platform="br1", batch=1)
    got = metrics.run_progress(plan.batches, 3, accounts=accounts).orderBy("batch_no").collect()
    assert [(r["accounts_listed"], r["accounts_total"], r["accounts_left"]) for r in got] == [(1, 3, 2)]


def test_rates_are_zero_while_no_time_has_passed(spark):
    batches = spark.createDataFrame(
        [(0, 2, 3, 3, 3, True), (1, 2, 1, 1, 1, True), (2, 2, 0, 9, 0, False)],
        "batch_no bigint, accounts bigint, found bigint, unseen bigint, fetched bigint, listed boolean",
    )
    timings = spark.createDataFrame([(0, 4.0, 0.0), (1, 4.0, 2.0)], "batch_no bigint, list_seconds double, fetch_seconds double")
    got = metrics.run_progress(batches, 100, timings).orderBy("batch_no").collect()
    assert [(r["accounts_per_second"], r["matches_per_second"]) for r in got] == [(0.5, 0.0), (0.5, 2.0)]
