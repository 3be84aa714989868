"""Table contracts, payload shapes and the small fixed vocabularies.

Everything here is a fixed value of the data being read: column names and types
of the stored tables, field names inside the JSON payloads, the rank ladder and
the platform codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: stored tables -------------------------------------------

MATCHES = "matches"
TIMELINES = "timelines"
LEAGUE_ENTRIES = "league_entries"
LISTED_ACCOUNTS = "listed_accounts"

TABLES = {
    MATCHES: "match_id string, platform string, fetched_at timestamp, payload string",
    TIMELINES: "match_id string, platform string, fetched_at timestamp, payload string",
    LEAGUE_ENTRIES: (
        "puuid string, platform string, queue_type string, tier string, division string, "
        "league_points int, wins int, losses int, inactive boolean, fetched_at timestamp"
    ),
    LISTED_ACCOUNTS: "puuid string, platform string, listed_at timestamp",
}

SILVER_MATCHES = (
    "match_id string, platform string, fetched_at timestamp, created_at timestamp, "
    "duration_seconds bigint, queue_id int, map_id int, game_version string"
)

# Re-aimed account listing: which account played which match, and when.
LISTING = "account string, match_id string, played_at timestamp, queue_id int"

# --- fixed values: payload fields ------------------------------------------

# silver column -> (path in the match payload, type). "epoch_ms" is a bigint of
# milliseconds read as an instant.
MATCH_FIELDS = {
    "created_at": ("info.gameCreation", "epoch_ms"),
    "duration_seconds": ("info.gameDuration", "bigint"),
    "queue_id": ("info.queueId", "int"),
    "map_id": ("info.mapId", "int"),
    "game_version": ("info.gameVersion", "string"),
}

# payload field -> (silver column, type)
PARTICIPANT_FIELDS = {
    "riotIdGameName": ("game_name", "string"),
    "riotIdTagline": ("tag_line", "string"),
    "teamId": ("team_id", "int"),
    "teamPosition": ("team_position", "string"),
    "championId": ("champion_id", "int"),
    "championName": ("champion_name", "string"),
    "kills": ("kills", "int"),
    "deaths": ("deaths", "int"),
    "assists": ("assists", "int"),
    "totalMinionsKilled": ("minions_killed", "int"),
    "goldEarned": ("gold_earned", "int"),
    "totalDamageDealtToChampions": ("damage_to_champions", "int"),
    "visionScore": ("vision_score", "int"),
    "win": ("win", "boolean"),
}

# Encrypted differently for every API key, so never comparable between rows.
KEY_SCOPED_FIELDS = {
    "puuid": ("puuid", "string"),
    "summonerId": ("summoner_id", "string"),
}

# The twelve columns of the scoreboard, in display order.
SCOREBOARD = (
    "game_name", "team_id", "team_position", "champion_name", "kills", "deaths", "assists",
    "minions_killed", "gold_earned", "damage_to_champions", "vision_score", "win",
)

# Field of a participant's frame: our column and its type.
FRAME_STATS = {
    "totalGold": ("gold", "int"),
    "xp": ("xp", "int"),
    "minionsKilled": ("cs", "int"),
    "level": ("level", "int"),
    "position": ("position", "struct<x: int, y: int>"),
}

TIMELINE_EVENT = (
    "type: string, timestamp: bigint, killerId: int, victimId: int, "
    "assistingParticipantIds: array<int>, position: struct<x: int, y: int>"
)

LADDER_PAGE = (
    "array<struct<puuid: string, queueType: string, tier: string, rank: string, "
    "leaguePoints: int, wins: int, losses: int, inactive: boolean>>"
)

LADDER_RENAMES = {
    "queueType": "queue_type",
    "rank": "division",
    "leaguePoints": "league_points",
}

CHAMPION_KILL = "CHAMPION_KILL"
PARTICIPANTS_PER_MATCH = 10

# --- fixed values: vocabularies --------------------------------------------

DIVISION_TIERS = ("IRON", "BRONZE", "SILVER", "GOLD", "PLATINUM", "EMERALD", "DIAMOND")
APEX_TIERS = ("MASTER", "GRANDMASTER", "CHALLENGER")
TIERS = DIVISION_TIERS + APEX_TIERS
DIVISIONS = ("I", "II", "III", "IV")
APEX_DIVISION = "I"

PLATFORM_REGIONS = {
    "na1": "americas",
    "br1": "americas",
    "la1": "americas",
    "la2": "americas",
    "euw1": "europe",
    "eun1": "europe",
    "tr1": "europe",
    "ru": "europe",
    "kr": "asia",
    "jp1": "asia",
}

# --- fixed values: crawl arithmetic ----------------------------------------

ACCOUNTS_PER_BATCH = 100
MATCHES_PER_FETCH = 50
CALLS_PER_MATCH = 2


def string_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def tier_rank(tier: str | Column = "tier") -> Column:
    """Ordinal of a rank tier, 0 for the lowest; NULL for an unknown name."""
    return F.nullif(F.array_position(string_array(TIERS), F.col(tier) if isinstance(tier, str) else tier), F.lit(0)) - 1


def region_of(platform: str | Column = "platform") -> Column:
    """Routing region of a platform code; NULL for an unknown code."""
    pairs = [F.lit(x) for pair in PLATFORM_REGIONS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(platform) if isinstance(platform, str) else platform)


def tier_dim(spark: SparkSession) -> DataFrame:
    """(tier, tier_rank, has_division): ten rows."""
    rows = F.array(*[
        F.struct(F.lit(t).alias("tier"), F.lit(i).alias("tier_rank"), F.lit(t in DIVISION_TIERS).alias("has_division"))
        for i, t in enumerate(TIERS)
    ])
    return spark.range(1).select(F.inline(rows))


def platform_dim(spark: SparkSession) -> DataFrame:
    """(platform, region): ten rows."""
    rows = F.array(*[
        F.struct(F.lit(p).alias("platform"), F.lit(r).alias("region")) for p, r in PLATFORM_REGIONS.items()
    ])
    return spark.range(1).select(F.inline(rows))
