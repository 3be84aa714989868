from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators import cohort
from match_lake.sources.tables import empty

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
HOUR = timedelta(hours=1)


def ladder(spark, entries):
    return spark.createDataFrame(
        [(p, plat, "Q", tier, "I", lp, 0, 0, False, at) for p, plat, tier, lp, at in entries],
        schemas.TABLES[schemas.LEAGUE_ENTRIES],
    )


def listed(spark, entries):
    return spark.createDataFrame([(p, "br1", at) for p, at in entries], schemas.TABLES[schemas.LISTED_ACCOUNTS])


def test_an_account_that_left_the_tier_drops_out(spark):
    df = ladder(spark, [
        ("a", "br1", "DIAMOND", 1, T0), ("a", "br1", "EMERALD", 2, T0 + HOUR),
        ("b", "br1", "EMERALD", 3, T0), ("b", "br1", "DIAMOND", 4, T0 + HOUR),
        ("c", "br1", "DIAMOND", 5, T0),
    ])
    got = cohort.select_cohort(df, listed(spark, []), "DIAMOND", 10, T0, 24, "br1")
    assert rows(got) == [("b", "DIAMOND", 4), ("c", "DIAMOND", 5)]


def test_the_limit_comes_before_the_exclusion(spark):
    df = ladder(spark, [(p, "br1", "GOLD", 0, T0) for p in "dcba"])
    recent = listed(spark, [("a", T0)])
    got = cohort.select_cohort(df, recent, "GOLD", 2, T0 + HOUR, 24, "br1")
    assert rows(got, "puuid") == [("b",)]


def test_ties_follow_the_tie_breakers(spark):
    df = ladder(spark, [("a", "br1", "GOLD", 7, T0), ("a", "br1", "GOLD", 3, T0), ("a", "br1", "GOLD", 5, T0)])
    got = cohort.latest_per_key(df, tie_breakers=["league_points"])
    assert rows(got, "league_points") == [(3,)]


def test_platform_is_filtered_before_the_latest_row_is_chosen(spark):
    df = ladder(spark, [("a", "br1", "GOLD", 1, T0), ("a", "kr", "IRON", 2, T0 + HOUR)])
    got = cohort.select_cohort(df, listed(spark, []), "GOLD", 5, T0, 1, "br1")
    assert rows(got) == [("a", "GOLD", 1)]


def test_recency_is_strict(spark):
    df = listed(spark, [("at", T0), ("before", T0 - HOUR), ("after", T0 + timedelta(microseconds=1)), ("after", T0 + HOUR)])
    assert rows(cohort.recently_listed(df, T0 + 24 * HOUR, 24)) == [("after",)]


def test_time_may_be_given_as_text_and_is_utc(spark):
    df = listed(spark, [("a", T0), ("b", T0 - HOUR)])
    assert rows(cohort.recently_listed(df, "2024-01-01 00:30:00", 1)) == [("a",)]


@pytest.mark.parametrize("spec,want", [
    ("diamond", ("DIAMOND",)), ("Diamond+", ("DIAMOND", "MASTER", "GRANDMASTER", "CHALLENGER")), ("IRON+", schemas.TIERS),
    ("CHALLENGER+", ("CHALLENGER",)),
])
def test_tier_specs(spec, want):
    assert cohort.parse_tiers(spec) == want


@pytest.mark.parametrize("spec", ["WOOD", "WOOD+", "", "+", "GOLD++"])
def test_unknown_tiers_are_refused(spec):
    with pytest.raises(ValueError):
        cohort.parse_tiers(spec)


def test_since_last_listed_finds_what_a_fixed_cut_off_skips(spark):
    listing = spark.createDataFrame(
        [("a", "m1", T0 + 2 * HOUR, 420), ("a", "m0", T0 + HOUR, 420), ("new", "m2", T0 + 2 * HOUR, 420), ("new", "m3", T0 - 30 * HOUR, 420)],
        schemas.LISTING,
    )
    checkpoint = listed(spark, [("a", T0 + HOUR), ("a", T0 - 9 * HOUR), ("a", T0 + 50 * HOUR)])
    got = cohort.since_last_listed(listing, checkpoint, T0 + 24 * HOUR, 24)
    assert rows(got, "account", "match_id") == [("a", "m1"), ("new", "m2")]


def test_thirty_one_buckets(spark):
    got = rows(cohort.rank_buckets(spark), "tier", "division")
    assert len(got) == 31 == len(set(got))
    assert [d for t, d in got if t == "MASTER"] == ["I"]
    assert [d for t, d in got if t == "IRON"] == ["I", "II", "III", "IV"]


def test_cohort_plan_prunes_before_it_shuffles(spark, tmp_path):
    df = ladder(spark, [(f"p{i}", "br1", "GOLD", i, T0) for i in range(50)])
    df.write.parquet(str(tmp_path / "l"))
    stored = spark.read.parquet(str(tmp_path / "l"))
    final = plan_of(cohort.select_cohort(stored, listed(spark, []), "GOLD", 5, T0, 24, "br1"))
    # the first accounts are cut out by ranges of the order, not gathered by one task
    assert "LeftAnti" in final and "TakeOrderedAndProject" not in final
    latest = cohort.latest_per_key(cohort.on_platform(stored, "br1"), ("puuid",), "fetched_at")
    plan = plan_of(cohort.tier_filter(latest, "GOLD").select("puuid", "tier", "league_points"))
    assert "WindowGroupLimit" in plan
    assert "EqualTo(platform,br1)" in plan
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "wins" not in read and "queue_type" not in read
    assert "IsNotNull(tier)" not in plan and "In(tier" not in plan  # the tier is no filter of the scan


def test_empty_tables(spark):
    got = cohort.select_cohort(
        empty(spark, schemas.TABLES[schemas.LEAGUE_ENTRIES]), empty(spark, schemas.TABLES[schemas.LISTED_ACCOUNTS]), "GOLD+", 5, T0, 24, "br1"
    )
    assert got.count() == 0


def test_a_second_queue_does_not_move_accounts_between_tiers(spark):
    solo = ladder(spark, [("a", "br1", "DIAMOND", 1, T0), ("b", "br1", "GOLD", 2, T0)])
    flex = ladder(spark, [("a", "br1", "IRON", 3, T0 + HOUR), ("b", "br1", "DIAMOND", 4, T0 + HOUR)]).withColumn("queue_type", F.lit("FLEX"))
    both = solo.union(flex)
    assert rows(cohort.select_cohort(both, listed(spark, []), "DIAMOND", 10, T0, 24, "br1", queue="Q"), "puuid") == [("a",)]
    assert rows(cohort.select_cohort(both, listed(spark, []), "DIAMOND", 10, T0, 24, "br1", queue="FLEX"), "puuid") == [("b",)]
