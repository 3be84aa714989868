"""Every operator as a named query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.documents import flatten_payload
from match_lake.functions.identity import player_identity, split_identity
from match_lake.functions.moments import hours_before, iso_utc
from match_lake.operators import cohort, discovery, metrics, quality, silver, timeline
from match_lake.plans import jobs
from match_lake.session import scratch_dir
from match_lake.sources import checks, idindex, landing, latest, store, tables
from match_lake.sources import listing as stored_by_account
from match_lake.streaming import landing as streaming
from workload import standins as given

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TIE = ["tier", "league_points"]
LOOKBACK = 24
SINCE = "1998-01-01 00:00:00"
BUDGET = 12_000
WORKERS = 4
SMALL_BUDGET, PENDING_BUDGET = 900, 61


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as UTC clock time, the type the generated tables use."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def no_gaps(df: DataFrame) -> DataFrame:
    """Missing numbers as -1 and missing flags as false, which every tool prints alike."""
    return df.na.fill(-1).na.fill(False)


def new_database(spark: SparkSession) -> str:
    """A database of its own for a query that writes, kept in the shared scratch folder."""
    name = f"lake_{uuid.uuid4().hex[:12]}"
    spark.sql(f"create database {name} location '{scratch_dir(spark, name)}'")
    return name


# --- cohort ------------------------------------------------------------------


@query
def latest_per_key(spark, sf):
    rows = cohort.latest_per_key(given.ladder(spark, sf, None), ["platform", "puuid"], "fetched_at", TIE)
    return plain_time(rows, "fetched_at")


@query
def recently_listed(spark, sf):
    return cohort.recently_listed(given.checkpoint(spark, sf), given.AS_OF, LOOKBACK, given.PLATFORM)


@query
def tier_filter(spark, sf):
    kept = cohort.tier_filter(given.ladder(spark, sf), "platinum+")
    ranked = kept.withColumn("tier_rank", schemas.tier_rank())
    return ranked.select("puuid", "tier", "tier_rank", "league_points")


@query
def select_cohort(spark, sf):
    return cohort.select_cohort(
        given.ladder(spark, sf), given.checkpoint(spark, sf), "GOLD+", 60, given.AS_OF, LOOKBACK, given.PLATFORM, TIE
    )


@query
def exclude_recent(spark, sf):
    latest = cohort.latest_per_key(given.ladder(spark, sf), ["puuid"], "fetched_at", TIE)
    recent = cohort.recently_listed(given.checkpoint(spark, sf), given.AS_OF, LOOKBACK)
    return cohort.exclude_recent(latest.select("puuid", "tier"), recent)


@query
def since_last_listed(spark, sf):
    # the listing dates from before the checkpoint: move it into the same days
    moved = given.listing(spark, sf).withColumn("played_at", F.expr("played_at + interval 8240 days"))
    rows = cohort.since_last_listed(moved, given.checkpoint(spark, sf), given.AS_OF, LOOKBACK)
    return plain_time(rows, "played_at")


@query
def rank_buckets(spark, sf):
    return metrics.bucket_counts(given.ladder(spark, sf))


@query
def tier_breakdown(spark, sf):
    latest = cohort.latest_per_key(given.ladder(spark, sf), ["puuid"], "fetched_at", TIE)
    return metrics.tier_breakdown(latest)


# --- discovery ---------------------------------------------------------------


@query
def parse_ids(spark, sf):
    return discovery.parse_ids(given.id_specs(spark, sf), "spec", ("request",))


@query
def parse_id_rejects(spark, sf):
    return discovery.parse_id_rejects(given.id_specs(spark, sf), "spec", ("request",))


@query
def list_ids(spark, sf):
    rows = discovery.list_ids(given.listing(spark, sf), SINCE, 420, 3)
    return plain_time(rows, "played_at")


@query
def list_ids_full(spark, sf):
    return plain_time(discovery.list_ids(given.listing(spark, sf)), "played_at")


@query
def account_batches(spark, sf):
    return discovery.account_batches(given.accounts(spark, sf))


@query
def discovered_ids(spark, sf):
    batches = discovery.account_batches(given.accounts(spark, sf))
    return discovery.discovered_ids(batches, discovery.played(given.listing(spark, sf), SINCE))


@query
def known_ids(spark, sf):
    return discovery.known_ids(given.listing(spark, sf), given.stored_matches(spark, sf), given.PLATFORM)


@query
def unseen_ids(spark, sf):
    candidates = given.listing(spark, sf).select("match_id", "account")
    return discovery.unseen_ids(candidates, given.stored_matches(spark, sf), given.PLATFORM)


@query
def complete_ids(spark, sf):
    return discovery.complete_ids(given.stored_matches(spark, sf), given.stored_timelines(spark, sf))


@query
def missing_timelines(spark, sf):
    return discovery.missing_timelines(given.stored_matches(spark, sf), given.stored_timelines(spark, sf))


def _crawl(spark, sf, budget) -> discovery.CrawlPlan:
    return discovery.crawl_plan(
        given.accounts(spark, sf), discovery.played(given.listing(spark, sf), SINCE),
        given.stored_matches(spark, sf), budget, WORKERS, given.PLATFORM,
    )


@query
def crawl_plan(spark, sf):
    return _crawl(spark, sf, BUDGET).fetch


@query
def crawl_plan_unbounded(spark, sf):
    return _crawl(spark, sf, None).fetch


@query
def crawl_deferred(spark, sf):
    return _crawl(spark, sf, BUDGET).deferred


@query
def run_progress(spark, sf):
    return metrics.run_progress(_crawl(spark, sf, BUDGET).batches, BUDGET, accounts=given.accounts(spark, sf))


@query
def landed_checkpoint(spark, sf):
    plan = _crawl(spark, sf, None)
    # every match has landed by now, but the dearest are without their timelines
    orders = given.table(spark, sf, "orders")
    ids = given.prefixed("M_", "o_orderkey").alias("match_id"), F.lit(given.PLATFORM).alias("platform")
    matches = orders.select(*ids)
    timelines = orders.filter(F.col("o_totalprice") <= 499_950).select(*ids)
    rows = discovery.landed_checkpoint(plan, matches, timelines, given.AS_OF, given.PLATFORM)
    return plain_time(rows, "listed_at")


# --- silver ------------------------------------------------------------------


@query
def flatten_event_props(spark, sf):
    events = given.table(spark, sf, "events")
    return flatten_payload(events, {"k": ("k", "int"), "missing": ("no.such", "string")}, "props", ["event_id"])


@query
def silver_matches(spark, sf):
    return plain_time(silver.flatten_matches(given.match_headers(spark, sf)), "fetched_at", "created_at")


@query
def silver_matches_permissive(spark, sf):
    rows = silver.flatten_matches(given.damaged_headers(spark, sf), strict=False)
    told = [F.col(c).isNull().alias(f"no_{c}") for c in ("created_at", "duration_seconds", "queue_id")]
    return no_gaps(rows.select("match_id", "platform", "duration_seconds", "queue_id", "game_version", *told).na.fill("none", ["game_version"]))


@query
def silver_rejects(spark, sf):
    return silver.match_rejects(given.damaged_headers(spark, sf)).select("match_id", "platform", "reason")


@query
def newest(spark, sf):
    rows = silver.newest(silver.flatten_matches(given.match_headers(spark, sf)), 25)
    return plain_time(rows, "created_at").select("match_id", "created_at", "queue_id")


@query
def participants(spark, sf):
    return plain_time(silver.participants(given.match_docs(spark, sf)), "fetched_at")


@query
def scoreboard(spark, sf):
    rows = silver.participants(given.match_docs(spark, sf), schemas.SCOREBOARD)
    return rows.drop("fetched_at", "player")


@query
def key_scoped_ids(spark, sf):
    rows = silver.participants(given.match_docs(spark, sf), ("puuid", "summoner_id"), key_scoped=True)
    return rows.select("match_id", "seat", "puuid", "summoner_id")


@query
def stable_view(spark, sf):
    """What differs between the documents of one match fetched with two keys: nothing."""
    return silver.rendition_differences(given.match_docs(spark, sf, "k1"), given.match_docs(spark, sf, "k2"))


@query
def stable_view_changed(spark, sf):
    """As stable_view, with every 500th match missing from the second set: its players are the difference."""
    number = F.substr("match_id", F.lit(3)).cast("bigint")
    other = given.match_docs(spark, sf, "k2").filter(number % 500 != 0)
    return silver.rendition_differences(given.match_docs(spark, sf, "k1"), other)


@query
def player_matches(spark, sf):
    played = silver.player_matches(given.match_docs(spark, sf))
    return played.groupBy("player").agg(F.count(F.lit(1)).alias("matches"))


@query
def identity(spark, sf):
    people = given.table(spark, sf, "customer").select(
        player_identity(F.col("c_mktsegment"), F.col("c_name")).alias("player"),
        player_identity(F.col("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("half"),
    )
    name, tag = split_identity(F.col("player"))
    return people.select("player", "half", name.alias("game_name"), tag.alias("tag_line"))


@query
def participant_rejects(spark, sf):
    """Every fourth match document damaged: cut off, without players, a text for a number."""
    number = F.substr("match_id", F.lit(3)).cast("bigint") % 12
    payload = (
        F.when(number == 0, F.substr("payload", F.lit(1), F.lit(200))).when(number == 4, F.lit('{"info": {"queueId": 420}}'))
        .when(number == 8, F.regexp_replace("payload", '"kills":[0-9]+', '"kills":"many"')).otherwise(F.col("payload"))
    )
    docs = given.match_docs(spark, sf).withColumn("payload", payload)
    return silver.participant_rejects(docs).select("match_id", "platform", "reason")


@query
def with_timeline(spark, sf):
    matches = silver.flatten_matches(given.match_headers(spark, sf)).select(
        "match_id", "platform", "duration_seconds", "queue_id"
    )
    facts = timeline.timeline_facts(given.timeline_docs(spark, sf)).drop("payload_bytes")
    return plain_time(silver.with_timeline(matches, facts), "timeline_fetched_at")


@query
def with_region(spark, sf):
    return silver.with_region(given.ladder(spark, sf, None)).select("puuid", "platform", "region", "league_points")


@query
def region_rejects(spark, sf):
    return silver.region_rejects(given.ladder(spark, sf, None)).select("puuid", "platform", "league_points")


# --- timeline ----------------------------------------------------------------


@query
def timeline_frames(spark, sf):
    return timeline.participant_frames(given.timeline_docs(spark, sf))


@query
def timeline_rejects(spark, sf):
    """Every fourth timeline damaged; what is kept plus what is rejected is everything."""
    number = F.substr("match_id", F.lit(3)).cast("bigint") % 12
    payload = (
        F.when(number == 0, F.substr("payload", F.lit(1), F.lit(60))).when(number == 4, F.lit('{"info": {}}'))
        .when(number == 8, F.lit(None)).otherwise(F.col("payload"))
    )
    docs = given.timeline_docs(spark, sf).withColumn("payload", payload)
    rejects = timeline.timeline_rejects(docs).select("match_id", "reason")
    kept = timeline.participant_frames(docs, ["xp"], strict=False).select("match_id").distinct()
    return rejects.union(kept.select("match_id", F.lit("kept")))


@query
def pivot_gold(spark, sf):
    return no_gaps(timeline.pivot_metric(timeline.participant_frames(given.timeline_docs(spark, sf), ["totalGold"])))


@query
def last_minutes(spark, sf):
    pivoted = timeline.pivot_metric(timeline.participant_frames(given.timeline_docs(spark, sf), ["totalGold"]))
    return no_gaps(timeline.last_minutes(pivoted, 5))


@query
def gold_by_minute(spark, sf):
    return no_gaps(timeline.stat_by_minute(given.timeline_docs(spark, sf), "totalGold"))


@query
def gold_tail(spark, sf):
    return no_gaps(timeline.stat_by_minute(given.timeline_docs(spark, sf), "totalGold", last=5))


@query
def pivot_embeddings(spark, sf):
    """All 64 components as one column each, rows first unfolded."""
    cells = given.table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode("embedding").alias("component", "value")
    ).withColumn("value", F.col("value").cast("double"))
    return timeline.pivot_metric(cells, "value", ["vec_id"], "component", range(64), "c")


def _plain_events(events: DataFrame, *more: str) -> DataFrame:
    assists = F.array_join(F.transform("assisting_participant_ids", lambda i: i.cast("string")), ",")
    return no_gaps(events.select(
        "match_id", "minute", "pos", *more, "timestamp", "killer_id", "victim_id", assists.alias("assists"),
        F.col("position.x").alias("x"), F.col("position.y").alias("y"),
    ))


@query
def timeline_events(spark, sf):
    return _plain_events(timeline.events(given.timeline_docs(spark, sf)), "type")


@query
def event_counts(spark, sf):
    return timeline.event_counts(timeline.event_types(given.timeline_docs(spark, sf)))


@query
def event_counts_by_match(spark, sf):
    return timeline.event_counts(timeline.event_types(given.timeline_docs(spark, sf)), ["match_id"])


@query
def event_counts_relational(spark, sf):
    return timeline.event_counts(given.table(spark, sf, "events"), (), "event_type")


@query
def kill_feed(spark, sf):
    return _plain_events(timeline.kill_feed(timeline.events(given.timeline_docs(spark, sf))))


@query
def kill_feed_head(spark, sf):
    return _plain_events(timeline.kill_feed(timeline.events(given.timeline_docs(spark, sf)), 20))


# --- quality -----------------------------------------------------------------


def _doubtful_silver(spark, sf) -> DataFrame:
    """Durations that could not be read, and pending matches stored twice."""
    once = given.damaged_headers(spark, sf)
    twice = once.unionByName(once.filter(F.get_json_object("payload", "$.info.gameDuration") == "n/a"))
    return silver.flatten_matches(twice, strict=False)


@query
def check_not_null(spark, sf):
    return quality.not_null(_doubtful_silver(spark, sf), "duration_seconds").select("match_id")


@query
def check_unique(spark, sf):
    return quality.unique(_doubtful_silver(spark, sf), "match_id")


@query
def run_checks(spark, sf):
    return quality.run_checks(_doubtful_silver(spark, sf))


# --- metrics -----------------------------------------------------------------


@query
def snapshot_totals(spark, sf):
    return metrics.snapshot_totals(given.ladder(spark, sf))


@query
def payload_sizes(spark, sf):
    return metrics.payload_sizes(given.table(spark, sf, "documents"), "text", ("doc_id",))


@query
def storage_summary(spark, sf):
    stored = {
        "documents": given.table(spark, sf, "documents").select(F.col("text").alias("payload")),
        "pages": given.table(spark, sf, "pages").select(F.col("html").alias("payload")),
        "conversations": given.table(spark, sf, "conversations").select(F.col("text").alias("payload")),
    }
    return metrics.storage_summary(stored)


@query
def storage_by_source(spark, sf):
    return metrics.storage_by(given.table(spark, sf, "documents"), "source", "text")


# --- landing and writing -----------------------------------------------------


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("payload").alias("value"), F.concat("match_id", F.lit(".json")).alias("file_name"))


@query
def land_payloads(spark, sf):
    """Documents with the id inside, without it (pages: the file name tells), and with neither."""
    named = _raw(given.match_headers(spark, sf))
    pages = given.table(spark, sf, "pages").select(
        F.col("html").alias("value"), F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".json")).alias("file_name")
    )
    rows = landing.to_bronze(named.unionByName(pages), given.PLATFORM, given.FETCHED_AT)
    told = rows.withColumns({"chars": F.length("payload"), "payload_sha256": F.sha2(F.col("payload").cast("binary"), 256)})
    return plain_time(told.drop("payload"), "fetched_at")


@query
def landing_rejects(spark, sf):
    pages = given.table(spark, sf, "pages").select(
        F.col("html").alias("value"),
        F.when(F.col("page_id") % 3 == 0, F.lit("x.json")).otherwise(F.lit(".json")).alias("file_name"), "page_id",
    )
    return landing.landing_rejects(pages).select("page_id")


@query
def parse_ladder_page(spark, sf):
    rows = landing.parse_ladder_page(given.ladder_pages(spark, sf), given.PLATFORM, given.FETCHED_AT)
    return no_gaps(plain_time(rows, "fetched_at"))


@query
def page_rejects(spark, sf):
    """Raw web pages among the ladder pages: none of them is a ladder page."""
    pages = given.table(spark, sf, "pages").select("page_id", F.col("html").alias("value"))
    fine = given.ladder_pages(spark, sf).select(F.lit(-1).cast("bigint").alias("page_id"), "value")
    return landing.page_rejects(pages.unionByName(fine)).select("page_id", "reason")


@query
def append_bronze(spark, sf):
    """Both tables written, and what each holds afterwards next to what the write counted."""
    database = new_database(spark)
    written = tables.append_bronze(
        given.match_headers(spark, sf), given.timeline_docs(spark, sf), database, "first"
    )
    parts = [
        tables.read_or_empty(spark, database, name, given.PLATFORM).agg(
            F.count(F.lit(1)).alias("stored"), F.countDistinct("match_id").alias("ids"),
        ).select(F.lit(name).alias("table_name"), F.lit(written[name]).alias("written"), "stored", "ids")
        for name in (schemas.MATCHES, schemas.TIMELINES)
    ]
    return parts[0].unionByName(parts[1])


@query
def append_ladder(spark, sf):
    """Two snapshots: the second adds to the first."""
    database = new_database(spark)
    tables.append_ladder(given.ladder(spark, sf), database)
    later = given.ladder(spark, sf).withColumn("fetched_at", F.expr("fetched_at + interval 40 days"))
    tables.append_ladder(later, database)
    rows = tables.read_or_empty(spark, database, schemas.LEAGUE_ENTRIES, given.PLATFORM)
    return plain_time(cohort.latest_per_key(rows, ["puuid"], "fetched_at", TIE), "fetched_at")


@query
def append_checkpoint(spark, sf):
    database = new_database(spark)
    tables.append_checkpoint(given.accounts(spark, sf), given.PLATFORM, given.AS_OF, database)
    rows = tables.read_or_empty(spark, database, schemas.LISTED_ACCOUNTS, given.PLATFORM)
    return plain_time(rows, "listed_at")


@query
def read_or_empty(spark, sf):
    """Nothing stored yet: every candidate is unseen."""
    database = new_database(spark)
    missing = tables.read_or_empty(spark, database, schemas.MATCHES, given.PLATFORM)
    return discovery.unseen_ids(given.listing(spark, sf).select("match_id"), missing, given.PLATFORM)


@query
def rebuild_silver(spark, sf):
    database = new_database(spark)
    build = jobs.silver_build(given.match_headers(spark, sf), database)
    build = jobs.silver_build(given.match_headers(spark, sf), database)
    return plain_time(build.table, "fetched_at", "created_at")


@query
def refresh_silver(spark, sf):
    """Silver brought up to date after each of two appends and a compaction, instead of rebuilt."""
    database = new_database(spark)
    headers = given.match_headers(spark, sf)
    odd = F.pmod(F.xxhash64("match_id"), F.lit(2)) == 1
    for part in (headers.filter(odd), headers.filter(~odd)):
        tables.append_table(part, database, schemas.MATCHES)
        jobs.silver_refresh(spark, database)
    tables.compact(spark, database, schemas.MATCHES, given.PLATFORM)
    columns = silver.flatten_matches(headers).columns
    return plain_time(jobs.silver_refresh(spark, database), "fetched_at", "created_at").select(*columns)


@query
def refresh_silver_replay(spark, sf):
    """A load run again with more documents than the first time, and others beside it: silver follows."""
    database = new_database(spark)
    docs = given.match_headers(spark, sf).select(
        F.col("payload").alias("value"), F.col("match_id").alias("file_path"), F.col("match_id").alias("file_name")
    )
    part = F.pmod(F.xxhash64("file_path"), F.lit(4))
    for load, of in (("a", part == 0), ("b", part == 1), ("a", part != 1)):
        store.store_new(docs.filter(of), database, schemas.MATCHES, given.PLATFORM, load, given.FETCHED_AT)
        rows = jobs.silver_refresh(spark, database)
    return plain_time(rows, "fetched_at", "created_at").select(*silver.flatten_matches(given.match_headers(spark, sf)).columns)


@query
def checks_by_ingest(spark, sf):
    """run_checks over a silver table refreshed after each of three appends, from notes of each ingest."""
    database = new_database(spark)
    once = given.damaged_headers(spark, sf)
    again = once.filter(F.get_json_object("payload", "$.info.gameDuration") == "n/a")
    odd = F.pmod(F.xxhash64("match_id"), F.lit(2)) == 1
    for part in (once.filter(odd), again, once.filter(~odd)):
        tables.append_table(part, database, schemas.MATCHES)
        jobs.silver_refresh(spark, database, strict=False)
        rows = checks.refresh_checks(spark, database)
    return rows


@query
def unseen_by_index(spark, sf):
    """unseen_ids against four stored ingests by way of their id indexes."""
    database = new_database(spark)
    finished = given.stored_matches(spark, sf).select(
        "match_id", "platform", F.lit(given.FETCHED_AT).cast("timestamp").alias("fetched_at"), F.lit("{}").alias("payload")
    )
    for i in range(4):
        tables.append_table(finished.filter(F.pmod(F.xxhash64("match_id"), F.lit(4)) == i), database, schemas.MATCHES)
    candidates = given.listing(spark, sf).select("match_id", "account")
    return idindex.unseen_ids(candidates, f"{database}.{schemas.MATCHES}", given.PLATFORM)


@query
def dead_letters(spark, sf):
    """Pages, some raw and some as documents without an id, among match headers; the load is run twice."""
    database = new_database(spark)
    pages = given.table(spark, sf, "pages").select(
        F.when(F.col("page_id") % 2 == 0, F.col("html")).otherwise(F.to_json(F.struct("page_id", "html"))).alias("value"),
        given.prefixed("page-", "page_id").alias("file_path"),
    )
    headers = given.match_headers(spark, sf).select(F.col("payload").alias("value"), F.col("match_id").alias("file_path"))
    docs = pages.unionByName(headers).withColumn("file_name", F.col("file_path"))
    for _ in range(2):
        store.store_new(docs, database, schemas.MATCHES, given.PLATFORM, "one", given.FETCHED_AT, whole_files=False)
    return store.dead_letters(spark, database, schemas.MATCHES, given.PLATFORM).select("file_path", "reason")


@query
def stored_summary(spark, sf):
    """What the writes of two tables counted, after a compaction; no document is read."""
    database = new_database(spark)
    for name, source, text in ((schemas.MATCHES, "documents", "text"), (schemas.TIMELINES, "conversations", "text")):
        rows = given.table(spark, sf, source)
        ids = F.monotonically_increasing_id().cast("string").alias("match_id")
        docs = rows.select(
            ids, F.lit(given.PLATFORM).alias("platform"), F.lit(given.FETCHED_AT).cast("timestamp").alias("fetched_at"), F.col(text).alias("payload")
        )
        half = F.pmod(F.xxhash64("payload"), F.lit(2)) == 0
        for part in (docs.filter(half), docs.filter(~half)):
            tables.append_table(part, database, name)
    tables.compact(spark, database, schemas.MATCHES, given.PLATFORM)
    return metrics.stored_summary(spark, database, (schemas.MATCHES, schemas.TIMELINES))


def _merged_state(spark, sf, platform) -> DataFrame:
    """The ladder in four snapshots that arrive in no order, one of them twice."""
    database = new_database(spark)
    rows = given.ladder(spark, sf, platform)
    for i in (2, 0, 3, 2, 1):
        latest.merge_snapshot(rows.filter(F.pmod(F.xxhash64("puuid", "fetched_at"), F.lit(4)) == i), database)
    return latest.read_latest(spark, database, platform)


@query
def latest_state(spark, sf):
    return plain_time(_merged_state(spark, sf, None), "fetched_at")


@query
def select_cohort_from_state(spark, sf):
    """select_cohort, from the latest state instead of all snapshots."""
    return cohort.select_cohort(
        _merged_state(spark, sf, given.PLATFORM), given.checkpoint(spark, sf), "GOLD+", 60, given.AS_OF, LOOKBACK, given.PLATFORM, TIE
    )


@query
def stream_land(spark, sf):
    """Headers written out as lines, streamed in; then written out again and streamed on top: nothing changes."""
    database = new_database(spark)
    folder, state = scratch_dir(spark, "landing"), scratch_dir(spark, "stream")
    docs = given.match_headers(spark, sf).select(F.col("payload").alias("value"))
    for _ in range(2):
        docs.write.mode("append").text(folder)
        arriving = streaming.read_landing_stream(spark, folder, whole_files=False)
        streaming.stream_land(
            arriving, database, schemas.MATCHES, given.PLATFORM, state, fetched_at=given.FETCHED_AT, whole_files=False
        ).awaitTermination()
    rows = tables.read_or_empty(spark, database, schemas.MATCHES, given.PLATFORM)
    return plain_time(silver.flatten_matches(rows), "fetched_at", "created_at")


# --- jobs --------------------------------------------------------------------


def _cohort_crawl(spark, sf, listing, lookback, **options) -> jobs.Crawl:
    return jobs.cohort_crawl(
        given.ladder(spark, sf), given.checkpoint(spark, sf), listing, given.stored_matches(spark, sf),
        datetime.fromisoformat(given.AS_OF), given.PLATFORM, tiers="GOLD+", max_accounts=1_000,
        lookback_hours=lookback, call_budget=1_500, workers=WORKERS, **options,
    )


@query
def cohort_crawl(spark, sf):
    # the listing dates from before the ladder: move it into the same days
    moved = given.listing(spark, sf).withColumn("played_at", F.expr("played_at + interval 8240 days"))
    return _cohort_crawl(spark, sf, moved, 24 * 365, per_account=True).plan.fetch


@query
def cohort_crawl_fixed(spark, sf):
    """The look-back of the default job. Matches are spread over the two days before it."""
    hours = F.make_interval(hours=F.pmod(F.substr("match_id", F.lit(3)).cast("int"), F.lit(48)))
    recent = given.listing(spark, sf).withColumn("played_at", F.lit(given.AS_OF).cast("timestamp") - hours)
    return _cohort_crawl(spark, sf, recent, LOOKBACK).plan.fetch


@query
def crawl_pending(spark, sf):
    """What a run without accounts to list fetches of the ids an earlier one deferred, under a smaller budget than they need."""
    deferred = _crawl(spark, sf, SMALL_BUDGET).deferred
    nobody, nothing = given.accounts(spark, sf).limit(0), given.listing(spark, sf).limit(0)
    return discovery.crawl_plan(
        nobody, nothing, given.stored_matches(spark, sf), PENDING_BUDGET, WORKERS, given.PLATFORM, pending=deferred
    ).fetch


@query
def crawl_plan_in_place(spark, sf):
    """crawl_plan, from the listing stored by account."""
    database = new_database(spark)
    stored_by_account.append_listing(given.listing(spark, sf), database)
    listing = discovery.played(stored_by_account.read_listing(spark, database), SINCE)
    return discovery.crawl_plan(
        given.accounts(spark, sf), listing, given.stored_matches(spark, sf), BUDGET, WORKERS, given.PLATFORM
    ).fetch


@query
def landed_checkpoint_cut(spark, sf):
    """As landed_checkpoint, under a budget: the batch it cuts and the ones after it have not landed."""
    plan = _crawl(spark, sf, BUDGET)
    orders = given.table(spark, sf, "orders")
    landed = orders.select(given.prefixed("M_", "o_orderkey").alias("match_id"), F.lit(given.PLATFORM).alias("platform"))
    return plain_time(discovery.landed_checkpoint(plan, landed, landed, given.AS_OF, given.PLATFORM), "listed_at")


@query
def personal_crawl(spark, sf):
    """Named players, found among the customers, with all their unseen matches."""
    named = discovery.parse_ids(given.id_specs(spark, sf), "spec", ("request",)).withColumn("ordinal", F.col("request"))
    customers = given.table(spark, sf, "customer").select(
        F.lit("Customer").alias("game_name"),
        F.concat(F.substr("c_name", F.lit(10)), F.lit("#"), F.col("c_mktsegment")).alias("tag_line"),
        given.prefixed("acct-", "c_custkey").alias("puuid"),
    )
    keys = jobs.account_keys(named, customers)
    rows = jobs.personal_crawl(
        keys, given.listing(spark, sf), given.stored_matches(spark, sf), given.PLATFORM, workers=WORKERS
    )
    return plain_time(rows, "played_at")


@query
def ladder_snapshot(spark, sf):
    folder = scratch_dir(spark, "pages")
    given.ladder_pages(spark, sf).write.text(folder)
    pages = landing.read_documents(spark, folder, whole_files=False)
    database = new_database(spark)
    snapshot = jobs.ladder_snapshot(pages, given.PLATFORM, given.FETCHED_AT, database)
    return snapshot.totals


@query
def lookback_cutoff(spark, sf):
    """The cut-off of every event's day, as text and as an instant."""
    events = given.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("_at"))
    seconds = F.unix_timestamp("_at")
    return events.select(
        "event_id",
        iso_utc(seconds - LOOKBACK * 3600).alias("since"),
        (F.col("_at") > hours_before(given.AS_OF, LOOKBACK)).alias("recent"),
    )
