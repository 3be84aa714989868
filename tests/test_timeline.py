import json
from datetime import datetime, timezone

import pytest
from conftest import plan_of, rows

from match_lake import schemas
from match_lake.operators import quality, timeline

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def stat(gold):
    return {"totalGold": gold, "xp": gold // 2, "minionsKilled": 1, "level": 3, "position": {"x": 1, "y": 2}}


def kill(at, killer, victim, assists=None):
    return {"type": "CHAMPION_KILL", "timestamp": at, "killerId": killer, "victimId": victim,
            "assistingParticipantIds": assists or [], "position": {"x": at, "y": -at}}


DOC = {"info": {"frames": [
    {"timestamp": 5, "participantFrames": {"1": stat(500), "10": stat(510), "2": stat(520)},
     "events": [{"type": "PAUSE_END", "timestamp": 0}, kill(10, 1, 2, [3, 4])]},
    {"timestamp": 60011, "participantFrames": {"1": stat(600), "2": stat(620)}, "events": []},
    {"timestamp": 120000, "participantFrames": {"10": stat(700)}, "events": [kill(99, 0, 1), {"type": "X"}, kill(98, 2, 1)]},
]}}


def docs(spark, *payloads):
    return spark.createDataFrame(
        [(f"m{i}", "br1", T0, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)],
        schemas.TABLES[schemas.TIMELINES],
    )


def test_frames_are_numbered_by_position(spark):
    got = timeline.participant_frames(docs(spark, DOC))
    assert rows(got, "minute", "participant", "gold", "xp", "cs") == [
        (0, 1, 500, 250, 1), (0, 10, 510, 255, 1), (0, 2, 520, 260, 1), (1, 1, 600, 300, 1), (1, 2, 620, 310, 1), (2, 10, 700, 350, 1),
    ]


def test_an_absent_participant_is_null_in_the_pivot(spark):
    frames = timeline.participant_frames(docs(spark, DOC), ["totalGold"])
    got = timeline.pivot_metric(frames).orderBy("minute").collect()
    assert [(r["p1"], r["p2"], r["p10"], r["p3"]) for r in got] == [(500, 520, 510, None), (600, 620, None, None), (None, None, 700, None)]
    assert quality.unique(frames, "match_id", "minute", "participant").count() == 0
    assert plan_of(timeline.pivot_metric(frames)).count("Exchange") == 1


def test_the_pivot_straight_from_the_document(spark):
    df = docs(spark, DOC, {"info": {"frames": [{"participantFrames": {}}, {"participantFrames": {"4": stat(9)}}, {}]}}, "junk", {"info": {}})
    pivoted = timeline.pivot_metric(timeline.participant_frames(df, ["totalGold"]))
    direct = timeline.stat_by_minute(df, "totalGold")
    assert rows(direct) == rows(pivoted.select(*direct.columns)) and direct.count() == 4
    assert "Exchange" not in plan_of(direct) and plan_of(direct).count("from_json") == 1
    tail = timeline.stat_by_minute(docs(spark, DOC, DOC), "xp", last=2)
    assert rows(tail, "match_id", "minute", "p1") == [("m0", 1, 300), ("m0", 2, None), ("m1", 1, 300), ("m1", 2, None)]
    assert timeline.stat_by_minute(docs(spark, DOC), last=50).count() == 3
    assert rows(timeline.stat_by_minute(df, last=1), "match_id", "minute") == [("m0", 2), ("m1", 1)]
    assert rows(timeline.last_minutes(pivoted, 1), "match_id", "minute") == [("m0", 2), ("m1", 1)]


def test_last_minutes_per_match(spark):
    pivoted = timeline.pivot_metric(timeline.participant_frames(docs(spark, DOC, DOC), ["totalGold"]))
    got = timeline.last_minutes(pivoted, 2)
    assert rows(got, "match_id", "minute") == [("m0", 1), ("m0", 2), ("m1", 1), ("m1", 2)]
    assert "WindowGroupLimit" in plan_of(got)


def test_events_and_kills(spark):
    feed = timeline.events(docs(spark, DOC))
    assert rows(feed, "minute", "pos", "type") == [
        (0, 0, "PAUSE_END"), (0, 1, "CHAMPION_KILL"), (2, 0, "CHAMPION_KILL"), (2, 1, "X"), (2, 2, "CHAMPION_KILL"),
    ]
    kills = timeline.kill_feed(feed).orderBy("match_id", "minute", "pos").collect()
    assert [(r["timestamp"], r["killer_id"], r["assisting_participant_ids"], r["position"]["y"]) for r in kills] == [
        (10, 1, [3, 4], -10), (99, 0, [], -99), (98, 2, [], -98),
    ]
    assert [r["timestamp"] for r in timeline.kill_feed(feed, 2).collect()] == [10, 99]


def test_event_counts_break_ties_by_name(spark):
    got = [tuple(r) for r in timeline.event_counts(timeline.event_types(docs(spark, DOC, DOC))).collect()]
    assert got == [("CHAMPION_KILL", 6), ("PAUSE_END", 2), ("X", 2)]


def test_facts(spark):
    got = timeline.timeline_facts(docs(spark, DOC, {"info": {"frames": [{}]}}, "junk"))
    assert rows(got, "match_id", "frames", "events") == [("m0", 3, 5), ("m1", 1, 0), ("m2", None, None)]


def test_documents_without_frames_give_nothing(spark):
    odd = docs(spark, "junk", {"info": {}}, {"info": {"frames": []}})
    assert timeline.participant_frames(odd).count() == 0
    assert timeline.events(odd).count() == 0


def test_only_the_wanted_part_is_read(spark):
    assert "participantFrames" not in plan_of(timeline.event_types(docs(spark, DOC)))
    assert "killerId" not in plan_of(timeline.event_types(docs(spark, DOC)))


def test_damaged_timelines_are_rejected_not_lost(spark):
    good = '{"info": {"frames": [{"participantFrames": {"1": {"xp": 5, "level": 2, "position": {"x": 3, "y": 4}}}, "events": [{"type": "ITEM_PURCHASED", "itemId": 7, "timestamp": 9}]}]}}'
    texts = [good, good[:50], None, '{"info": {}}', good.replace("5", '"x"')]
    docs = spark.createDataFrame([(f"m{i}", "br1", None, t) for i, t in enumerate(texts)], schemas.TABLES[schemas.TIMELINES])
    assert dict(rows(timeline.timeline_rejects(docs), "match_id", "reason")) == {"m1": "malformed", "m2": "malformed", "m3": "missing", "m4": "wrong type"}
    frames = timeline.participant_frames(docs.limit(1), ["xp", "level", "position"])
    assert rows(frames.select("xp", "level", "position.x", "position.y")) == [(5, 2, 3, 4)]
    (event,) = timeline.events(docs.limit(1), with_text=True).collect()
    assert event["type"] == "ITEM_PURCHASED" and event["timestamp"] == 9 and '"itemId":7' in event["event"]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        timeline.events(docs.filter("match_id = 'm1'"), strict=True).collect()
