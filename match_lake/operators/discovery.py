"""From accounts to the matches worth fetching, within a call budget."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.identity import split_identity, trimmed
from match_lake.functions.moments import instant
from match_lake.operators.cohort import on_platform
from match_lake.operators.ordering import number_rows, running_total, spread_join, top_per_key
from match_lake.session import cut_lineage
from match_lake.sources.listing import PART, by_part


def parse_ids(df: DataFrame, spec: str = "spec", keep: tuple[str, ...] = ()) -> DataFrame:
    """Comma-separated `Name#TAG` texts to one row each: ordinal, game_name, tag_line.

    Cut at the first separator, outer blanks trimmed; no separator leaves the tag
    empty. Entries with neither name nor tag are left to parse_id_rejects.
    """
    return _split_ids(df, spec, keep).filter(~_blank_id()).drop("raw")


def parse_id_rejects(df: DataFrame, spec: str = "spec", keep: tuple[str, ...] = ()) -> DataFrame:
    return _split_ids(df, spec, keep).filter(_blank_id()).select(*keep, "ordinal", "raw")


def _blank_id():
    return (F.col("game_name") == "") & (F.col("tag_line") == "")


def _split_ids(df: DataFrame, spec: str, keep: tuple[str, ...]) -> DataFrame:
    entries = df.select(*keep, F.posexplode(F.split(spec, ",")).alias("ordinal", "raw"))
    name, tag = split_identity(trimmed(F.col("raw")))
    return entries.select(*keep, "ordinal", "raw", name.alias("game_name"), tag.alias("tag_line"))


def played(listing: DataFrame, since: datetime | str | None = None, queue: int | None = None) -> DataFrame:
    """Listing rows later than `since`, in one queue."""
    rows = listing
    if since is not None:
        rows = rows.filter(F.col("played_at") > instant(since))
    if queue is not None:
        rows = rows.filter(F.col("queue_id") == queue)
    return rows


def list_ids(
    listing: DataFrame,
    since: datetime | str | None = None,
    queue: int | None = None,
    max_games: int | None = None,
) -> DataFrame:
    """An account's matches: later than `since`, in one queue, the newest `max_games`.

    A match repeated for one account counts once.
    """
    rows = played(listing, since, queue).groupBy("account", "match_id").agg(
        F.max("played_at").alias("played_at"), F.max_by("queue_id", "played_at").alias("queue_id")
    )
    if max_games is None:
        return rows
    return top_per_key(rows, ["account"], [F.col("played_at").desc(), F.col("match_id").desc()], max_games)


def stored_among(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct candidate ids that are stored.

    The stored side is met where it is read and only its hits are de-duplicated, so a
    short list of candidates, which Spark broadcasts by its size, leaves it unshuffled.
    """
    wanted = candidates.select("match_id").distinct()
    return stored.select("match_id").join(wanted, "match_id", "left_semi").distinct()


def known_ids(candidates: DataFrame, stored: DataFrame, platform: str | None = None) -> DataFrame:
    """Distinct candidate ids already stored."""
    return stored_among(candidates, on_platform(stored, platform))


def unseen_ids(candidates: DataFrame, stored: DataFrame, platform: str | None = None) -> DataFrame:
    """Candidate rows whose id is not stored; duplicates and other columns are kept."""
    return candidates.join(known_ids(candidates, stored, platform), "match_id", "left_anti")


def complete_ids(matches: DataFrame, timelines: DataFrame) -> DataFrame:
    """Ids stored in both tables. Used as `stored`, a match that lost its timeline is fetched again."""
    both = ["match_id", "platform"]
    return matches.select(*both).distinct().join(timelines.select(*both).distinct(), both, "left_semi")


def missing_timelines(matches: DataFrame, timelines: DataFrame) -> DataFrame:
    both = ["match_id", "platform"]
    return matches.select(*both).distinct().join(timelines.select(*both).distinct(), both, "left_anti")


def account_batches(
    accounts: DataFrame, key: str = "puuid", batch: int = schemas.ACCOUNTS_PER_BATCH, at_most: int | None = None
) -> DataFrame:
    """(account, pos, batch_no): accounts in order, `batch` to a batch."""
    named = accounts.select(F.col(key).alias("account")).filter(F.col("account").isNotNull())
    numbered = number_rows(named.distinct(), ["account"], "pos", at_most)
    return numbered.withColumn("batch_no", F.expr(f"pos div {batch}"))


def batch_matches(batches: DataFrame, listing: DataFrame) -> DataFrame:
    """Distinct (batch_no, match_id): every match found while listing each batch.

    Numbered accounts are a scan of a written copy, so Spark knows their size: few go to where the
    listing is read, and only what they played is shuffled. Many are dealt into the buckets of a listing that is
    stored by account (sources.listing), which then stays where it is as well.
    """
    keyed, on = batches.select("account", "batch_no"), ["account"]
    if PART in listing.columns:
        keyed, on = by_part(keyed), ["account", PART]
    pairs = listing.select(*on, "match_id").filter(F.col("match_id").isNotNull())
    return pairs.join(keyed, on).select("batch_no", "match_id").distinct()


def discovered_ids(batches: DataFrame, listing: DataFrame) -> DataFrame:
    """Distinct match ids with the first batch that finds each."""
    return _first_batch(batch_matches(batches, listing))


def _first_batch(found: DataFrame) -> DataFrame:
    return found.groupBy("match_id").agg(F.min("batch_no").alias("batch_no"))


def fetch_slots(fetch_batch: int, workers: int) -> list[Column]:
    """pos, the fetch batch it falls into, and the worker that takes it."""
    return [
        F.col("pos"),
        F.expr(f"pos div {fetch_batch}").alias("fetch_no"),
        F.pmod("pos", F.lit(workers)).cast("int").alias("worker"),
    ]


# The batch of ids an earlier plan deferred.
PENDING = -1


class CrawlPlan(NamedTuple):
    """fetch: ids within the budget. deferred: ids of listed batches beyond it.

    batches: one row per account batch with what it costs and yields.
    accounts: account to batch, as far as the budget can reach.
    """

    fetch: DataFrame
    deferred: DataFrame
    batches: DataFrame
    accounts: DataFrame


def crawl_plan(
    accounts: DataFrame,
    listing: DataFrame,
    stored: DataFrame,
    budget: int | None,
    workers: int = 1,
    platform: str | None = None,
    key: str = "puuid",
    batch: int = schemas.ACCOUNTS_PER_BATCH,
    fetch_batch: int = schemas.MATCHES_PER_FETCH,
    max_accounts: int | None = None,
    salts: int = 8,
    pending: DataFrame | None = None,
) -> CrawlPlan:
    """Which matches to fetch, in which order, by which worker.

    Accounts are listed batch by batch at one call each; the unseen matches first
    found in a batch follow, by id, at two calls each, until the budget is spent.
    Seen over all batches that is one running cost along (batch, id): the g-th
    match overall (from 0), in a batch that ends the first k accounts, is affordable
    exactly when 2 * (g + 1) + k <= budget. No loop and no state are needed, and batches being
    of one size, k follows from the batch's number.

    `pending` (match_id) are ids an earlier plan deferred. They are a batch of their own, number PENDING, that costs
    no listing and comes before all others, also when there is no account to list.

    Three tables are written: accounts in order, what their listing finds, and unseen ids in order. All numbers and
    totals come from these.
    """
    at_most = max_accounts
    if budget is not None:
        # Every full batch costs `batch` calls before it fetches anything, so
        # later batches than these cannot be reached.
        batches_at_most = max(0, budget) // batch + 2
        at_most = min(batches_at_most * batch, at_most if at_most is not None else batches_at_most * batch)
    numbered = account_batches(accounts, key, batch, at_most)
    found = batch_matches(numbered, listing)
    if pending is not None:
        first = pending.filter(F.col("match_id").isNotNull()).select(F.lit(PENDING).cast("bigint").alias("batch_no"), "match_id")
        found = found.union(first.distinct())
    found = cut_lineage(found, "found")
    unseen = number_rows(unseen_ids(_first_batch(found), stored, platform), ["batch_no", "match_id"], "_overall")
    batches = _batch_costs(numbered, found, unseen, budget)

    affordable = F.lit(True)
    if budget is not None:
        members = numbered.count()
        through = F.greatest(F.lit(0), F.least((F.col("batch_no") + 1) * batch, F.lit(members)))
        affordable = schemas.CALLS_PER_MATCH * (F.col("_overall") + 1) + through <= budget
    chosen = unseen.filter(affordable)
    starts = chosen.groupBy("batch_no").agg(F.min("_overall").alias("_start"))
    placed = spread_join(chosen, starts, "batch_no", "match_id", "inner", salts).withColumn("pos", F.col("_overall") - F.col("_start"))
    fetch = placed.select("batch_no", "match_id", *fetch_slots(fetch_batch, workers))
    # two rows at most: the batch the budget cuts, and the one an odd call still lists
    cut_off = batches.filter(F.col("listed") & (F.col("fetched") < F.col("unseen"))).select("batch_no")
    deferred = unseen.filter(~affordable).join(F.broadcast(cut_off), "batch_no", "left_semi")
    return CrawlPlan(fetch, deferred.select("batch_no", "match_id"), batches, numbered)


def _batch_costs(
    numbered: DataFrame, found: DataFrame, unseen: DataFrame, budget: int | None
) -> DataFrame:
    """One row per batch: sizes, what came before it, whether it is listed.

    The first batch is always listed, unless pending ids use up the budget, and a later one while calls are left. Since a
    match costs two calls, an odd remainder leaves one call over when a batch is
    cut; that call lets exactly one more batch be listed, which then fetches nothing.
    """
    cost = schemas.CALLS_PER_MATCH

    def ones(df: DataFrame, name: str, shift: int = 0) -> DataFrame:
        return df.select((F.col("batch_no") + shift).alias("batch_no"), F.lit(name).alias("_of"))

    names = ["accounts", "found", "unseen", "unseen_in_previous"]
    members = ones(numbered, "accounts").union(ones(found, "found")).union(ones(unseen, "unseen"))
    members = members.union(ones(unseen, "unseen_in_previous", 1))
    sizes = members.groupBy("batch_no").agg(*[F.count(F.when(F.col("_of") == n, 1)).alias(n) for n in names])
    sizes = sizes.filter((F.col("accounts") > 0) | (F.col("batch_no") == PENDING))
    totals = running_total(sizes, "batch_no", {"accounts": "accounts_before", "unseen": "unseen_before"})
    if budget is None:
        listed, fetched = F.lit(True), F.col("unseen")
    else:
        used = F.col("accounts_before") + cost * F.col("unseen_before")
        left_in_previous = budget - used + cost * F.col("unseen_in_previous")
        first = (F.col("batch_no") <= 0) & (F.col("unseen_before") == 0)
        odd_call_left = ~first & (
            (left_in_previous > 0) & (F.pmod(left_in_previous, F.lit(cost)) == 1)
            & (cost * F.col("unseen_in_previous") > left_in_previous)
        )
        listed = first | (used < budget) | odd_call_left
        affordable = F.greatest(F.lit(0), F.floor((budget - used - F.col("accounts")) / cost))
        fetched = F.when(F.col("listed"), F.least("unseen", affordable)).otherwise(F.lit(0)).cast("bigint")
    return totals.withColumn("listed", listed).withColumn("fetched", fetched).drop("unseen_in_previous")


def landed_checkpoint(
    plan: CrawlPlan, matches: DataFrame, timelines: DataFrame, listed_at: datetime | str, platform: str
) -> DataFrame:
    """Checkpoint rows for the accounts whose batch has fully landed.

    Taken from what is stored, not from what was asked for: a run that dies
    between listing and landing leaves its accounts to be listed again, and so does a
    budget that cuts a batch or lists one it cannot fetch. Accounts of a batch that
    found nothing new count as landed.
    """
    stored = complete_ids(on_platform(matches, platform), on_platform(timelines, platform))
    waiting = unseen_ids(plan.fetch, stored).select("batch_no").distinct()
    done = plan.batches.filter("listed and fetched = unseen").select("batch_no").join(waiting, "batch_no", "left_anti")
    return plan.accounts.join(done, "batch_no", "left_semi").select(
        F.col("account").alias("puuid"), F.lit(platform).alias("platform"), instant(listed_at).alias("listed_at")
    )
