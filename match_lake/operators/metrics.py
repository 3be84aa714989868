"""Counts and sizes: ladder snapshots, stored documents, crawl progress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators.cohort import rank_buckets
from match_lake.operators.ordering import running_total
from match_lake.sources import manifest

SIZES = "table_name string, records bigint, logical_bytes bigint"


def tier_breakdown(df: DataFrame, tier: str = "tier") -> DataFrame:
    """Accounts per tier, largest first, ties by name."""
    counts = df.groupBy(tier).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(tier).asc())


def bucket_counts(ladder: DataFrame) -> DataFrame:
    """Rows in each of the 31 rank buckets, empty ones included."""
    counts = ladder.groupBy("tier", "division").agg(F.count(F.lit(1)).alias("n"))
    buckets = rank_buckets(ladder.sparkSession)
    # counts holds a row per bucket at most, buckets always 31
    return buckets.join(counts, ["tier", "division"], "left").select(
        "tier", "tier_rank", "division", F.coalesce("n", F.lit(0)).alias("n")
    )


def snapshot_totals(ladder: DataFrame, outer: str = "tier", inner: str = "division") -> DataFrame:
    """Rows per bucket, per tier and overall: (level, tier, division, n).

    Rolled up from the bucket counts, so the rows themselves are read once and not
    multiplied by the three levels.
    """
    counts = ladder.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("_n"))
    depth = F.grouping_id()
    level = F.when(depth == 0, "bucket").when(depth == 1, "tier").otherwise("total")
    return counts.rollup(outer, inner).agg(level.alias("level"), F.sum("_n").alias("n")).select("level", outer, inner, "n")


def payload_sizes(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ("match_id",)) -> DataFrame:
    """Size of each document: whole KB of characters, and bytes as stored."""
    return df.select(
        *keep,
        F.expr(f"length(`{payload}`) div 1024").alias("kb"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
    )


def storage_summary(tables: Mapping[str, DataFrame], payload: str = "payload") -> DataFrame:
    """Per table: records, bytes, bytes per record, share of all bytes."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("records"),
            F.coalesce(F.sum(F.octet_length(payload).cast("bigint")), F.lit(0)).alias("logical_bytes"),
        ).select(F.lit(name).alias("table_name"), "records", "logical_bytes")
        for name, df in tables.items()
    ]
    return _with_shares(reduce(DataFrame.unionByName, parts))


def stored_summary(spark: SparkSession, database: str, names: Sequence[str]) -> DataFrame:
    """storage_summary of document tables from their manifests: what each write counted, added up.

    No document is read, unless an ingest has no counts of its own (a table without a manifest, or one
    write for several platforms); only those ingests are scanned.
    """
    parts = []
    for table in names:
        name = f"{database}.{table}"
        live = manifest.resolved(spark, name)
        known = [x for x in live if x.documents is not None]
        counts = spark.createDataFrame([(table, sum(x.documents for x in known), sum(x.bytes or 0 for x in known))], SIZES)
        parts.append(counts)
        if len(known) < len(live):
            rest = manifest.of_ingests(spark.table(name), [x for x in live if x.documents is None])
            parts.append(_sizes(rest.select(F.lit(table).alias("table_name"), "payload"), "payload"))
    sizes = reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.sum("records").alias("records"), F.sum("logical_bytes").alias("logical_bytes")
    )
    return _with_shares(sizes)


def _sizes(df: DataFrame, payload: str) -> DataFrame:
    return df.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.octet_length(payload).cast("bigint")), F.lit(0)).alias("logical_bytes"),
    )


def storage_by(df: DataFrame, group: str, payload: str = "payload") -> DataFrame:
    """storage_summary over the groups of one table."""
    return _with_shares(_sizes(df.select(F.col(group).alias("table_name"), payload), payload))


def _with_shares(sizes: DataFrame) -> DataFrame:
    # Both columns are summed so that the subquery groups exactly as the rows do:
    # Spark then runs that grouping, which reads every document, only once.
    sums = sizes.agg(F.struct(F.sum("logical_bytes").alias("logical_bytes"), F.sum("records").alias("records")).alias("_all"))
    total = sums.scalar()["logical_bytes"]
    return sizes.select(
        "table_name", "records", "logical_bytes",
        F.try_divide(F.col("logical_bytes").cast("double"), F.col("records")).alias("bytes_per_record"),
        F.try_divide(F.col("logical_bytes").cast("double"), total).alias("share"),
    )


def run_progress(
    batches: DataFrame, budget: int | None, timings: DataFrame | None = None, accounts: DataFrame | None = None, key: str = "puuid"
) -> DataFrame:
    """State of a crawl after each listed batch, running totals included.

    From CrawlPlan.batches. `over_budget` marks the overshoot a batch causes when
    listing it takes more calls than were left. `timings` (batch_no, list_seconds,
    fetch_seconds), as measured by whatever does the fetching, adds the rates so
    far; a rate is 0 while no time has passed. `accounts`, the whole cohort, adds how many
    there are to list and how many of them are still not listed after a batch.
    """
    rows = batches.filter("listed").select("batch_no", "accounts", "found", "unseen", "fetched")
    totals = {"accounts": "_accounts", "fetched": "_fetched"}
    if timings is not None:
        rows = rows.join(timings, "batch_no", "left").na.fill(0, ["list_seconds", "fetch_seconds"])
        totals |= {"list_seconds": "_listing", "fetch_seconds": "_fetching"}
    running = running_total(rows, "batch_no", totals)
    done = F.col("_accounts") + F.col("accounts")
    written = F.col("_fetched") + F.col("fetched")
    used = done + schemas.CALLS_PER_MATCH * written
    out = [
        "batch_no", "accounts", "found", "unseen", "fetched",
        done.alias("accounts_listed"), written.alias("matches_written"), used.alias("budget_used"),
        (F.lit(False) if budget is None else used > budget).alias("over_budget"),
    ]
    if timings is not None:
        out += [
            _rate(done, F.col("_listing") + F.col("list_seconds")).alias("accounts_per_second"),
            _rate(written, F.col("_fetching") + F.col("fetch_seconds")).alias("matches_per_second"),
        ]
    if accounts is not None:
        total = accounts.select(F.count_distinct(key)).scalar()
        out += [total.alias("accounts_total"), (total - done).alias("accounts_left")]
    return running.select(*out)


def _rate(count: Column, seconds: Column) -> Column:
    return F.coalesce(F.try_divide(count.cast("double"), seconds), F.lit(0.0))
