"""Minute frames and events out of stored timeline documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.documents import array_rejects, parse_mode
from match_lake.operators.ordering import top_per_key

KEYS = ("match_id", "platform")


def _frames(timelines: DataFrame, frame: str, strict: bool) -> DataFrame:
    """(keys, minute, _frame), reading only the wanted part of each frame.

    `minute` is the index of the frame, whatever its timestamp says. Strict parsing raises
    on a document that cannot be read in full; otherwise it gives no frames, or frames with
    gaps, and shows up in timeline_rejects.
    """
    doc = F.from_json("payload", f"info struct<frames: array<struct<{frame}>>>", parse_mode(strict))
    return timelines.select(*KEYS, F.posexplode(doc["info"]["frames"]).alias("minute", "_frame"))


def timeline_rejects(timelines: DataFrame) -> DataFrame:
    """Timelines whose frames cannot be read, or not in full, with the reason."""
    stats = ", ".join(f"{field}: {kind}" for field, (_, kind) in schemas.FRAME_STATS.items())
    frame = f"participantFrames: map<string, struct<{stats}>>, events: array<struct<{schemas.TIMELINE_EVENT}>>"
    return array_rejects(timelines, f"info struct<frames: array<struct<{frame}>>>", "info.frames", "payload", KEYS)


def participant_frames(
    timelines: DataFrame, stats: Sequence[str] = ("totalGold", "xp", "minionsKilled"), strict: bool = False
) -> DataFrame:
    """(match, minute, participant, gold, xp, cs), one row per player and minute.

    `stats` may also name level and position.
    """
    one = ", ".join(f"{s}: {schemas.FRAME_STATS[s][1]}" for s in stats)
    frames = _frames(timelines, f"participantFrames: map<string, struct<{one}>>", strict)
    seats = frames.select(*KEYS, "minute", F.explode("_frame.participantFrames").alias("_id", "_stats"))
    return seats.select(
        *KEYS, "minute", F.col("_id").cast("int").alias("participant"),
        *[F.col(f"_stats.{s}").alias(schemas.FRAME_STATS[s][0]) for s in stats],
    )


def stat_by_minute(
    timelines: DataFrame,
    stat: str = "totalGold",
    ids: Sequence[int] = range(1, schemas.PARTICIPANTS_PER_MATCH + 1),
    prefix: str = "p",
    last: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """One row per match and minute, one column per participant, straight from the document.

    The same rows as pivot_metric over participant_frames, and with `last` as
    last_minutes over that; but all participants of a minute lie in one frame, so
    nothing has to be shuffled.
    """
    frame = f"struct<participantFrames: map<string, struct<{stat}: int>>>"
    doc = F.from_json("payload", f"info struct<frames: array<{frame}>>", parse_mode(strict))
    numbered = F.transform(doc["info"]["frames"], lambda f, i: F.struct(i.alias("minute"), f["participantFrames"].alias("_seats")))
    played = F.filter(numbered, lambda f: F.size(f["_seats"]) > 0)
    if last is not None:
        parsed = timelines.select(*KEYS, F.explode(F.array(played)).alias("_played"))
        shown = F.greatest(F.lit(1), F.size("_played") - (last - 1))
        minutes = parsed.select(*KEYS, F.inline(F.slice("_played", shown, F.lit(last))))
    else:
        minutes = timelines.select(*KEYS, F.inline(played))
    cells = [F.try_element_at("_seats", F.lit(str(i)))[stat].alias(f"{prefix}{i}") for i in ids]
    return minutes.select(*KEYS, "minute", *cells)


def pivot_metric(
    frames: DataFrame,
    metric: str = "gold",
    keys: Sequence[str] = ("match_id", "platform", "minute"),
    participant: str = "participant",
    ids: Sequence[int] = range(1, schemas.PARTICIPANTS_PER_MATCH + 1),
    prefix: str = "p",
) -> DataFrame:
    """One column per participant. The ids are given, so no pass looks for them.

    A participant absent from a frame is NULL. (match, minute, participant) has to
    be unique, which quality.unique can check.
    """
    cells = [F.max(F.when(F.col(participant) == i, F.col(metric))).alias(f"{prefix}{i}") for i in ids]
    return frames.groupBy(*keys).agg(*cells)


def last_minutes(pivoted: DataFrame, n: int = 5, keys: Sequence[str] = KEYS, minute: str = "minute") -> DataFrame:
    """The last n minutes of every match."""
    return top_per_key(pivoted, keys, [F.col(minute).desc()], n)


def events(timelines: DataFrame, strict: bool = False, with_text: bool = False) -> DataFrame:
    """Every event: keys, minute, ordinal in the minute, and the fields of kills.

    With `with_text`, also `event`, the whole event as JSON, since other kinds have fields of
    their own (item, building, level). It costs a second look at each event.
    """
    kind = "string" if with_text else f"struct<{schemas.TIMELINE_EVENT}>"
    frames = _frames(timelines, f"events: array<{kind}>", strict)
    rows = frames.select(*KEYS, "minute", F.posexplode("_frame.events").alias("pos", "_e"))
    if with_text:
        one = F.from_json("_e", f"struct<{schemas.TIMELINE_EVENT}>", parse_mode(strict))
        rows = rows.select(*KEYS, "minute", "pos", F.col("_e").alias("event"), F.explode(F.array(one)).alias("_e"))
    return rows.select(
        *KEYS, "minute", "pos",
        F.col("_e.type").alias("type"),
        F.col("_e.timestamp").alias("timestamp"),
        F.col("_e.killerId").alias("killer_id"),
        F.col("_e.victimId").alias("victim_id"),
        F.col("_e.assistingParticipantIds").alias("assisting_participant_ids"),
        F.col("_e.position").alias("position"),
        *(["event"] if with_text else []),
    )


def event_types(timelines: DataFrame, strict: bool = False) -> DataFrame:
    """(match, minute, type) without parsing anything else of the event."""
    frames = _frames(timelines, "events: array<struct<type: string>>", strict)
    return frames.select(*KEYS, "minute", F.explode("_frame.events.type").alias("type"))


def event_counts(typed: DataFrame, by: Sequence[str] = (), type_col: str = "type") -> DataFrame:
    """How often each event type occurs, most common first, ties by name; in no order within `by`."""
    counts = typed.groupBy(*by, type_col).agg(F.count(F.lit(1)).alias("n"))
    return counts if by else counts.orderBy(F.col("n").desc(), F.col(type_col).asc())


def kill_feed(
    feed: DataFrame,
    limit: int | None = None,
    kind: str = schemas.CHAMPION_KILL,
    type_col: str = "type",
    columns: Sequence[str] = ("timestamp", "killer_id", "victim_id", "assisting_participant_ids", "position"),
    order: Sequence[str] = ("match_id", "minute", "pos"),
) -> DataFrame:
    """The kill events in order of play; `limit` gives the head of the feed.

    Without a limit the rows are not sorted: order by `order` where it matters.
    """
    kills = feed.filter(F.col(type_col) == kind).select(*order, *[c for c in columns if c not in order])
    return kills if limit is None else kills.orderBy(*order).limit(limit)


def timeline_facts(timelines: DataFrame, strict: bool = False) -> DataFrame:
    """Small facts of a timeline to pair with its match: frame count, event count, bytes."""
    doc = F.from_json("payload", "info struct<frames: array<struct<events: array<struct<type: string>>>>>", parse_mode(strict))
    frames = timelines.select(*KEYS, "fetched_at", F.octet_length("payload").alias("payload_bytes"), doc["info"]["frames"].alias("_frames"))
    per_frame = F.transform("_frames", lambda f: F.coalesce(F.size(f["events"]), F.lit(0)))
    return frames.select(
        *KEYS, "fetched_at", F.size("_frames").alias("frames"),
        F.reduce(per_frame, F.lit(0), lambda total, n: total + n).alias("events"), "payload_bytes",
    )
