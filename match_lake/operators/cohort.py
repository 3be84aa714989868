"""Choosing accounts: latest ladder row, tier filter, recency exclusion."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.moments import hours_before, instant
from match_lake.operators.ordering import first_rows, spread_join, top_per_key


def on_platform(df: DataFrame, platform: str | None) -> DataFrame:
    return df if platform is None else df.filter(F.col("platform") == F.lit(platform))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = ("puuid",),
    by: str = "fetched_at",
    tie_breakers: Sequence[Column | str] = (),
) -> DataFrame:
    """Each key's most recent row. Ties on `by` follow `tie_breakers`, in order."""
    ties = [F.col(t) if isinstance(t, str) else t for t in tie_breakers]
    return top_per_key(df, keys, [F.col(by).desc(), *ties], 1)


def parse_tiers(spec: str) -> tuple[str, ...]:
    """Tier names meant by a job parameter: "GOLD" is one, "GOLD+" it and all above."""
    name = spec.upper().removesuffix("+")
    if name not in schemas.TIERS:
        raise ValueError(f"unknown tier {spec!r}; expected one of {', '.join(schemas.TIERS)}, optionally with '+'")
    return schemas.TIERS[schemas.TIERS.index(name):] if spec.endswith("+") else (name,)


def tier_filter(df: DataFrame, spec: str, tier: str = "tier") -> DataFrame:
    return df.filter(F.col(tier).isin(*parse_tiers(spec)))


def recently_listed(
    checkpoint: DataFrame, as_of: datetime | str, within_hours: int, platform: str | None = None, key: str = "puuid"
) -> DataFrame:
    """Distinct accounts listed strictly after `as_of` minus `within_hours`."""
    recent = on_platform(checkpoint, platform).filter(F.col("listed_at") > hours_before(as_of, within_hours))
    return recent.select(key).distinct()


def exclude_recent(cohort: DataFrame, recent: DataFrame, key: str = "puuid") -> DataFrame:
    return cohort.join(recent, key, "left_anti")


def select_cohort(
    ladder: DataFrame,
    checkpoint: DataFrame,
    tiers: str,
    max_accounts: int,
    as_of: datetime | str,
    lookback_hours: int,
    platform: str | None = None,
    tie_breakers: Sequence[Column | str] = (),
    queue: str | None = None,
) -> DataFrame:
    """Accounts to list: (puuid, tier, league_points).

    `queue` keeps one ladder; without it an account's latest row counts, of whatever queue.

    The order of steps is part of the result. The latest row is taken before the
    tier filter, so an account that left the tier drops out; the limit is taken
    before the exclusion, so a restart lists what is left of the same cohort
    instead of the next accounts in line. Ordered by puuid: league points are not
    comparable across tiers and would change the cohort from run to run.
    """
    narrow = on_platform(ladder, platform)
    if queue is not None:
        narrow = narrow.filter(F.col("queue_type") == queue)
    latest = latest_per_key(narrow, ("puuid",), "fetched_at", tie_breakers)
    ranked = tier_filter(latest, tiers).select("puuid", "tier", "league_points")
    cohort = first_rows(ranked, ["puuid"], max_accounts)
    return exclude_recent(cohort, recently_listed(checkpoint, as_of, lookback_hours, platform))


def since_last_listed(
    listing: DataFrame,
    checkpoint: DataFrame,
    as_of: datetime | str,
    lookback_hours: int,
    platform: str | None = None,
) -> DataFrame:
    """Listing rows played after the account's own last listing.

    An account never listed before falls back to the lookback. With a fixed
    cut-off instead, an account listed late yesterday is skipped today and what it
    played in between is found by neither run.
    """
    last = on_platform(checkpoint, platform).filter(F.col("listed_at") <= instant(as_of))
    last = last.groupBy(F.col("puuid").alias("account")).agg(F.max("listed_at").alias("_last"))
    joined = spread_join(listing, last, "account", "match_id", "left")
    floor = F.coalesce("_last", hours_before(as_of, lookback_hours))
    return joined.filter(F.col("played_at") > floor).select(*listing.columns)


def rank_buckets(spark: SparkSession) -> DataFrame:
    """The 31 (tier, division) pairs the ladder is read in, lowest tier first."""
    dim = schemas.tier_dim(spark)
    divisions = F.when(F.col("has_division"), schemas.string_array(schemas.DIVISIONS)).otherwise(
        F.array(F.lit(schemas.APEX_DIVISION))
    )
    return dim.select("tier", "tier_rank", F.explode(divisions).alias("division"))
