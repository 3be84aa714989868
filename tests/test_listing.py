"""The listing stored by account: joined in place, hot accounts over several buckets."""

from datetime import datetime, timedelta, timezone

from conftest import plan_of, rows
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators import discovery
from match_lake.sources import listing

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def played(spark, n=600):
    """A third of all rows under one account, and rows without account or match."""
    entries = [(f"a{i % 40}" if i % 3 else "hot", f"m{i % 150}", T0 + timedelta(hours=i), 420 + i % 2) for i in range(n)]
    return spark.createDataFrame([*entries, (None, "m1", T0, 420), ("a1", None, T0, 420)], schemas.LISTING)


def test_what_is_stored(spark, database):
    assert listing.read_listing(spark, database).count() == 0
    one = played(spark)
    listing.append_listing(one.filter("queue_id = 420"), database, buckets=6)
    listing.append_listing(one.filter("queue_id = 421"), database, buckets=99)
    stored = listing.read_listing(spark, database)
    assert rows(stored.select(*listing.COLUMNS)) == rows(one.filter("account is not null and match_id is not null"))
    sizes = [r["count"] for r in stored.filter("account = 'hot'").groupBy(listing.PART).count().collect()]
    assert len(sizes) > listing.PARTS / 2 and max(sizes) < 600 / 3 / 4


def test_a_plan_is_the_same_from_either_listing(spark, database):
    plain = played(spark)
    listing.append_listing(plain, database, buckets=5)
    stored = listing.read_listing(spark, database)
    accounts = spark.createDataFrame([(f"a{i}",) for i in range(0, 50, 2)] + [("hot",)], "puuid string")
    known = spark.createDataFrame([(f"m{i}", "br1") for i in range(20)], "match_id string, platform string")
    for since, budget in ((None, 70), (T0 + timedelta(hours=200), None)):
        plans = [discovery.crawl_plan(accounts, discovery.played(x, since), known, budget, platform="br1", batch=4) for x in (plain, stored)]
        assert rows(plans[0].fetch) == rows(plans[1].fetch) and plans[0].fetch.count() > 0
        assert rows(plans[0].batches) == rows(plans[1].batches)


def test_the_stored_listing_is_not_exchanged(spark, database):
    listing.append_listing(played(spark), database, buckets=8)
    numbered = discovery.account_batches(spark.createDataFrame([(f"a{i}",) for i in range(9)], "puuid string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(discovery.batch_matches(numbered, listing.read_listing(spark, database)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan[plan.index("SortMergeJoin"):]
    sides = join.split("FileScan")
    assert len(sides) == 3  # one scan a side
    bucketed = 1 if "Bucketed: true" in sides[1] else 2
    above = (sides[0], sides[1].split("ReadSchema")[1])[bucketed - 1]
    assert "Exchange" not in above and "Exchange" in (sides[0] if bucketed == 2 else sides[1].split("ReadSchema")[1])
    assert rows(discovery.batch_matches(numbered, listing.read_listing(spark, database))) == rows(discovery.batch_matches(numbered, played(spark)))


def test_queries_read_it_like_any_listing(spark, database):
    listing.append_listing(played(spark), database, buckets=4)
    stored, plain = listing.read_listing(spark, database), played(spark).filter("account is not null and match_id is not null")
    for options in ({}, {"queue": 420}, {"max_games": 3}, {"since": T0 + timedelta(hours=300)}):
        assert rows(discovery.list_ids(stored, **options)) == rows(discovery.list_ids(plain, **options))
    assert rows(stored.groupBy(F.col("account")).count()) == rows(plain.groupBy("account").count())
