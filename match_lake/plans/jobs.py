"""Cohort and personal crawls, ladder snapshot, silver build."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.moments import instant
from match_lake.operators import cohort, discovery, metrics, quality, silver
from match_lake.operators.ordering import number_rows, spread_join
from match_lake.session import cut_lineage
from match_lake.sources import landing, latest, manifest, store, tables


class Crawl(NamedTuple):
    cohort: DataFrame
    plan: discovery.CrawlPlan
    progress: DataFrame


def cohort_crawl(
    ladder: DataFrame,
    checkpoint: DataFrame,
    listing: DataFrame,
    matches: DataFrame,
    as_of: datetime,
    platform: str = "br1",
    timelines: DataFrame | None = None,
    tiers: str = "DIAMOND",
    max_accounts: int = 1_000,
    lookback_hours: int = 24,
    call_budget: int = 12_000,
    workers: int = 1,
    per_account: bool = False,
    pending: DataFrame | None = None,
    queue: str | None = None,
) -> Crawl:
    """What a forward-only run for a ranked cohort lists and fetches.

    With `timelines`, a match counts as stored only when both its documents are.
    `ladder` holds all snapshots, or the latest state kept of them.
    `per_account` replaces the fixed look-back by each account's own last listing
    (and so leaves nobody out for having been listed recently). `pending` takes the
    deferred ids of the run before, which a fixed look-back may not reach any more. `queue`
    names the ladder the tiers are read from.
    """
    nobody = checkpoint.limit(0)
    chosen = cohort.select_cohort(
        ladder, nobody if per_account else checkpoint, tiers, max_accounts, as_of, lookback_hours, platform,
        ["tier", "league_points"], queue,
    )
    if per_account:
        recent = cohort.since_last_listed(listing, checkpoint, as_of, lookback_hours, platform)
    else:
        recent = discovery.played(listing, since=as_of - timedelta(hours=lookback_hours))
    stored = matches if timelines is None else discovery.complete_ids(matches, timelines)
    plan = discovery.crawl_plan(
        chosen, recent, stored, call_budget, workers, platform, max_accounts=max_accounts, pending=pending
    )
    return Crawl(chosen, plan, metrics.run_progress(plan.batches, call_budget, accounts=chosen))


def personal_crawl(
    accounts: DataFrame,
    listing: DataFrame,
    matches: DataFrame,
    platform: str = "br1",
    queue: int | None = None,
    max_games: int | None = None,
    workers: int = 1,
    fetch_batch: int = schemas.MATCHES_PER_FETCH,
) -> DataFrame:
    """Unseen matches in the full history of the accounts, in the order to fetch them.

    No look-back and no budget. `accounts` holds (account, ordinal); a match played
    by several of them is fetched for the first. Newest first within an account.
    """
    # Written first, so Spark knows its size: few accounts go to where the listing is read.
    keyed = cut_lineage(accounts.groupBy("account").agg(F.min("ordinal").alias("ordinal")), "accounts")
    own = listing.join(keyed.select("account"), "account")
    history = discovery.unseen_ids(discovery.list_ids(own, None, queue, max_games), matches, platform)
    ranked = history.join(keyed, "account")
    row = F.struct("account", "played_at", "queue_id", "ordinal")
    first = ranked.groupBy("match_id").agg(F.min_by(row, F.struct("ordinal", "account")).alias("_row"))
    todo = cut_lineage(first.select("match_id", "_row.*").withColumn("_age", -F.unix_micros("played_at")))
    numbered = number_rows(todo, ["ordinal", "account", "_age", "match_id"], "_overall")
    starts = numbered.groupBy("account").agg(F.min("_overall").alias("_start"))
    placed = spread_join(numbered, starts, "account", "match_id").withColumn("pos", F.col("_overall") - F.col("_start"))
    return placed.select("account", "match_id", "played_at", "queue_id", *discovery.fetch_slots(fetch_batch, workers))


def account_keys(ids: DataFrame, resolved: DataFrame) -> DataFrame:
    """(account, ordinal) of the named players found among the resolved accounts.

    Names compare as written; `ids` holds (game_name, tag_line, ordinal) and
    `resolved` (game_name, tag_line, puuid).
    """
    names = ids.groupBy("game_name", "tag_line").agg(F.min("ordinal").alias("ordinal"))
    return resolved.join(names, ["game_name", "tag_line"]).select(F.col("puuid").alias("account"), "ordinal")


class Snapshot(NamedTuple):
    written: int
    totals: DataFrame
    buckets: DataFrame


def ladder_snapshot(
    pages: DataFrame, platform: str, fetched_at: datetime | str, database: str, keep_latest: bool = False, fmt: str = "parquet"
) -> Snapshot:
    """Append landed ladder pages (landing.read_documents) as one snapshot and count it.

    The counts are read back from what was stored. With `keep_latest` the snapshot is also merged into the latest state
    (sources.latest), which a cohort can be chosen from instead of from all snapshots.
    """
    written = tables.append_ladder(landing.parse_ladder_page(pages, platform, fetched_at), database, fmt)
    stored = tables.read_or_empty(pages.sparkSession, database, schemas.LEAGUE_ENTRIES, platform)
    stored = stored.filter(F.col("fetched_at") == instant(fetched_at))
    if keep_latest:
        latest.merge_snapshot(stored, database, fmt)
    return Snapshot(written, metrics.snapshot_totals(stored), metrics.bucket_counts(stored))


class SilverBuild(NamedTuple):
    table: DataFrame
    rejects: DataFrame
    checks: DataFrame


def silver_build(
    matches: DataFrame, database: str, table: str = "silver_matches", strict: bool = True, fmt: str = "parquet"
) -> SilverBuild:
    """Rebuild the silver table in full and run its data tests on the result."""
    built = tables.rebuild(silver.flatten_matches(matches, strict), database, table, fmt)
    return SilverBuild(built, silver.match_rejects(matches), quality.run_checks(built))


def silver_refresh(
    spark: SparkSession, database: str, table: str = "silver_by_load", strict: bool = True, fmt: str = "parquet"
) -> DataFrame:
    """The silver table brought up to what is stored now; the same rows as a full rebuild.

    It is laid out by platform and ingest like the documents, and its manifest is the ledger of what it was made
    from: ingests by generation and digest. What the documents' manifest names and the ledger
    does not, or with another digest, is parsed; what only the ledger names goes. A load run again with more, other or
    fewer documents is a new generation, and a compaction a new ingest, so both are caught. The new ledger
    is published in one step when everything parsed is in place: stopped before, the next refresh does it again.
    """
    source, name = (tables.qualified(database, t) for t in (schemas.MATCHES, table))
    spark.catalog.refreshTable(source)
    bronze = spark.table(source)
    parsed = silver.flatten_matches(bronze, strict, [manifest.INGEST])
    if not spark.catalog.tableExists(name):
        manifest.publish(spark, name, [])
        parsed.limit(0).write.format(fmt).partitionBy("platform", manifest.INGEST).saveAsTable(name)
    ledger = {(x.platform, x.ingest, x.digest) for x in manifest.resolved(spark, name)}
    now = manifest.resolved(spark, source)
    new = [x for x in now if x.digest is None or (x.platform, x.ingest, x.digest) not in ledger]
    gone = {(p, i) for p, i, _ in ledger} - {(x.platform, x.ingest) for x in now}
    if new:
        rows = silver.flatten_matches(manifest.of_ingests(bronze, new), strict, [manifest.INGEST])
        store.replace_folders(rows, name)
    if new or gone:
        manifest.publish(spark, name, now)
        manifest.drop_ingests(spark, name, gone)
    return manifest.live_rows(spark, name).drop(manifest.INGEST)
