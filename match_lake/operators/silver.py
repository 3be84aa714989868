"""Typed tables out of stored match documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.documents import array_rejects, flatten_payload, flatten_rejects, parse_mode
from match_lake.functions.identity import player_identity
from match_lake.session import cut_lineage

KEYS = ("match_id", "platform", "fetched_at")


def flatten_matches(matches: DataFrame, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Top-level facts of every stored match, one row per stored row.

    A match stored twice gives two rows; compose with cohort.latest_per_key for a
    current view. Strict parsing raises on a value of the wrong type; otherwise it
    becomes NULL and the row shows up in match_rejects. `keep` names further columns to
    carry along.
    """
    return flatten_payload(matches, schemas.MATCH_FIELDS, "payload", (*KEYS, *keep), strict)


def match_rejects(matches: DataFrame) -> DataFrame:
    return flatten_rejects(matches, schemas.MATCH_FIELDS, "payload", KEYS)


def participants(
    matches: DataFrame, columns: Sequence[str] | None = None, key_scoped: bool = False, strict: bool = False
) -> DataFrame:
    """One row per player of a match: keys, seat (from 1), identity, statistics.

    `columns` limits the statistics taken (schemas.SCOREBOARD for the scoreboard);
    only those are read from the document. The identifiers that differ by API key
    are left out unless asked for, because joining on them across rows gives
    wrong results. Strict parsing raises on a document that cannot be read in full;
    otherwise it gives no players, or players with gaps, and shows up in
    participant_rejects.
    """
    fields = dict(schemas.PARTICIPANT_FIELDS)
    if key_scoped:
        fields |= schemas.KEY_SCOPED_FIELDS
    if columns is not None:
        wanted = {*columns, "game_name", "tag_line"}
        fields = {field: (name, kind) for field, (name, kind) in fields.items() if name in wanted}
    doc = F.from_json("payload", _seats_schema(fields), parse_mode(strict))
    seats = matches.select(*KEYS, F.posexplode(doc["info"]["participants"]).alias("_seat", "_p"))
    out = list(columns) if columns is not None else [name for name, _ in fields.values()]
    source = {name: field for field, (name, _) in fields.items()}
    return seats.select(
        *KEYS,
        (F.col("_seat") + 1).alias("seat"),
        player_identity(F.col("_p.riotIdGameName"), F.col("_p.riotIdTagline")).alias("player"),
        *[F.col(f"_p.{source[name]}").alias(name) for name in out],
    )


def participant_rejects(matches: DataFrame) -> DataFrame:
    """Match documents whose players cannot be read, or not in full, with the reason."""
    return array_rejects(matches, _seats_schema(schemas.PARTICIPANT_FIELDS), "info.participants", "payload", KEYS)


def _seats_schema(fields: Mapping[str, tuple[str, str]]) -> str:
    one = ", ".join(f"{field}: {kind}" for field, (_, kind) in fields.items())
    return f"info struct<participants: array<struct<{one}>>>"


def stable_view(matches: DataFrame) -> DataFrame:
    """Players of a match without anything that varies with the API key or the fetch.

    Two renditions of one match fetched with different keys give the same rows.
    """
    return participants(matches).drop("fetched_at")


def differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows that occur more often in one table than in the other, with the surplus.

    `surplus` is positive for the first table, negative for the second. Both are
    read once and meet in a single grouping; copies are added up before they move.
    """
    counted = one.withColumn("_n", F.lit(1)).unionByName(other.withColumn("_n", F.lit(-1)))
    return counted.groupBy(*one.columns).agg(F.sum("_n").alias("surplus")).filter(F.col("surplus") != 0)



def rendition_differences(one: DataFrame, other: DataFrame) -> DataFrame:
    """`differences` of the stable views of two sets of match documents.

    Documents are compared by a digest of their players first, one narrow row each; only
    the matches whose digests differ are unfolded. These are written before the documents are read again: Spark
    then knows how few they are and takes them to the documents instead of shuffling both sides.
    """
    keys = ["match_id", "platform"]

    def digests(matches: DataFrame, side: str) -> DataFrame:
        doc = F.from_json("payload", _seats_schema(schemas.PARTICIPANT_FIELDS))
        rows = matches.select(*keys, F.xxhash64(doc["info"]["participants"]).cast("decimal(38,0)").alias("_digest"))
        return rows.groupBy(*keys).agg(F.struct(F.count(F.lit(1)), F.sum("_digest")).alias(side))

    both = digests(one, "_one").join(digests(other, "_other"), keys, "full_outer")
    suspects = cut_lineage(both.filter(~F.col("_one").eqNullSafe(F.col("_other"))).select(*keys), "suspects")
    views = [stable_view(docs.join(suspects, keys, "left_semi")) for docs in (one, other)]
    return differences(*views)


def player_matches(matches: DataFrame) -> DataFrame:
    """(player, match_id, platform): who played what, by the stable identity."""
    return participants(matches, ()).filter(F.col("player").isNotNull()).select("player", "match_id", "platform")


def with_timeline(matches: DataFrame, timelines: DataFrame) -> DataFrame:
    """Pair details with timeline by match and platform.

    Project both sides to what is needed first (flatten_matches, timeline_facts):
    the join shuffles its inputs and documents are far too large to move. The fetch
    time differs between the two tables and takes no part.
    """
    right = timelines.withColumnRenamed("fetched_at", "timeline_fetched_at")
    return matches.join(right, ["match_id", "platform"])


def newest(matches: DataFrame, n: int | None = None) -> DataFrame:
    """Most recently created match first."""
    ordered = matches.orderBy(F.col("created_at").desc(), F.col("match_id").asc())
    return ordered if n is None else ordered.limit(n)


def with_region(df: DataFrame, platform: str = "platform") -> DataFrame:
    """Add the routing region of the platform; rows of unknown platforms are left to region_rejects."""
    return df.withColumn("region", schemas.region_of(platform)).filter(F.col("region").isNotNull())


def region_rejects(df: DataFrame, platform: str = "platform") -> DataFrame:
    return df.filter(schemas.region_of(platform).isNull())
