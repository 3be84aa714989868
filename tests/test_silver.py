import json
from datetime import datetime, timezone

import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.documents import flatten_payload
from match_lake.functions.moments import iso_utc
from match_lake.operators import cohort, metrics, quality, silver

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
INFO = {"gameCreation": 1704067200123, "gameDuration": 1800, "queueId": 420, "mapId": 11, "gameVersion": "14.1.2"}


def bronze(spark, payloads):
    return spark.createDataFrame(
        [(i, "br1", T0, p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in payloads],
        schemas.TABLES[schemas.MATCHES],
    )


def test_flatten(spark):
    got = silver.flatten_matches(bronze(spark, [("m1", {"info": INFO, "metadata": {}})]))
    want = spark.createDataFrame([], schemas.SILVER_MATCHES).schema
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want]
    row = got.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")).first()
    assert row["created_at"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (row["duration_seconds"], row["queue_id"], row["map_id"], row["game_version"]) == (1800, 420, 11, "14.1.2")


ODD = [
    ("fine", {"info": INFO}),
    ("missing", {"info": {k: v for k, v in INFO.items() if k != "gameDuration"}}),
    ("null", {"info": {**INFO, "gameDuration": None}}),
    ("case", {"INFO": INFO, "info": {"gameduration": 1, "queueId": 1}}),
    ("text", "no json at all"),
    ("none", None),
]


def test_missing_fields_are_null_and_names_are_case_sensitive(spark):
    got = silver.flatten_matches(bronze(spark, ODD))
    durations = dict(rows(got, "match_id", "duration_seconds"))
    assert durations == {"fine": 1800, "missing": None, "null": None, "case": None, "text": None, "none": None}


def test_a_wrong_type_raises_when_strict_and_is_reported_otherwise(spark):
    df = bronze(spark, [*ODD, ("wrong", {"info": {**INFO, "gameDuration": "long", "mapId": [1]}})])
    with pytest.raises(PySparkException):
        silver.flatten_matches(df).collect()
    lenient = silver.flatten_matches(df, strict=False)
    assert dict(rows(lenient, "match_id", "queue_id"))["wrong"] == 420
    assert rows(silver.match_rejects(df), "match_id", "reason") == [("text", "malformed"), ("wrong", "duration_seconds,map_id")]


def test_one_parse_however_many_fields(spark):
    assert plan_of(silver.flatten_matches(bronze(spark, ODD)).filter("duration_seconds > 5")).count("from_json") == 1
    assert plan_of(silver.match_rejects(bronze(spark, ODD))).count("from_json") == 1
    plan = plan_of(silver.flatten_matches(bronze(spark, ODD)))
    assert plan.count("from_json") == 1 and "get_json_object" not in plan


def test_flatten_any_paths(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": "7", "c": {"d": [1, 2]}}, "e": 1.5}')], "id int, doc string")
    fields = {"b": ("a.b", "int"), "d": ("a.c.d", "string"), "e": ("e", "double"), "all": ("a", "string")}
    with pytest.raises(ValueError):  # a path cannot be both a leaf and a parent
        flatten_payload(df, fields, "doc", ["id"])
    fields.pop("all")
    assert rows(flatten_payload(df, fields, "doc", ["id"])) == [(1, 7, "[1,2]", 1.5)]


def player(name, tag, key, **more):
    return {"riotIdGameName": name, "riotIdTagline": tag, "puuid": f"{key}-{name}", "summonerId": key, "kills": 3, "win": True, **more}


def rendition(key):
    people = [player("Ann", "BR1", key), player("Bo", None, key), player("C#d", "1", key)]
    return {"metadata": {"participants": [p["puuid"] for p in people]}, "info": {**INFO, "participants": people}}


def test_players(spark):
    got = silver.participants(bronze(spark, [("m1", rendition("k1"))]))
    assert "puuid" not in got.columns and "summoner_id" not in got.columns
    assert rows(got, "seat", "player", "kills", "win", "deaths") == [
        (1, "Ann#BR1", 3, True, None), (2, None, 3, True, None), (3, "C#d#1", 3, True, None),
    ]
    keyed = silver.participants(bronze(spark, [("m1", rendition("k1"))]), key_scoped=True)
    assert rows(keyed, "puuid", "summoner_id")[0] == ("k1-Ann", "k1")


def test_scoreboard_reads_its_twelve_columns(spark):
    got = silver.participants(bronze(spark, [("m1", rendition("k1"))]), schemas.SCOREBOARD)
    assert got.columns == ["match_id", "platform", "fetched_at", "seat", "player", *schemas.SCOREBOARD]
    assert "championId" not in plan_of(got)


def test_strict_players_raise(spark):
    bad = {"info": {"participants": [player("a", "b", "k", kills="many")]}}
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        silver.participants(bronze(spark, [("m1", bad)]), strict=True).collect()
    assert silver.participants(bronze(spark, [("m1", bad)])).count() <= 1


def test_two_renditions_are_the_same_in_the_stable_view(spark):
    one = silver.stable_view(bronze(spark, [("m1", rendition("k1"))]))
    other = silver.stable_view(bronze(spark, [("m1", rendition("k2"))]))
    assert one.exceptAll(other).count() == 0 == other.exceptAll(one).count() and one.count() == 3
    assert silver.differences(one, other).count() == 0
    assert sorted(r["surplus"] for r in silver.differences(one.unionByName(one), other.limit(2)).collect()) == [1, 1, 2]


def test_half_an_identity_is_none(spark):
    assert rows(silver.player_matches(bronze(spark, [("m1", rendition("k1"))])), "player") == [("Ann#BR1",), ("C#d#1",)]


def test_newest(spark):
    df = silver.flatten_matches(bronze(spark, [
        (m, {"info": {**INFO, "gameCreation": at}}) for m, at in (("b", 2000), ("a", 2000), ("c", 1000), ("d", 3000))
    ]))
    assert [r["match_id"] for r in silver.newest(df, 3).collect()] == ["d", "a", "b"]
    assert [r["match_id"] for r in silver.newest(df).collect()] == ["d", "a", "b", "c"]
    assert "TakeOrderedAndProject" in plan_of(silver.newest(df, 3))


def test_pairs_ignore_the_fetch_time(spark):
    one = bronze(spark, [("m1", {"info": INFO}), ("m2", {"info": INFO})]).drop("payload")
    other = spark.createDataFrame([("m1", "br1", datetime(2025, 1, 1), 7), ("m1", "kr", T0, 8)], "match_id string, platform string, fetched_at timestamp, frames int")
    assert rows(silver.with_timeline(one, other), "match_id", "platform", "frames") == [("m1", "br1", 7)]


def test_regions(spark):
    df = spark.createDataFrame([("br1",), ("kr",), ("zz",), (None,)], "platform string")
    assert rows(silver.with_region(df)) == [("br1", "americas"), ("kr", "asia")]
    assert rows(silver.region_rejects(df)) == [("zz",), (None,)] or rows(silver.region_rejects(df)) == [(None,), ("zz",)]
    assert rows(schemas.platform_dim(spark).filter("platform = 'ru'")) == [("ru", "europe")]


def test_checks(spark):
    twice = bronze(spark, [("m1", {"info": INFO}), ("m1", {"info": INFO}), ("m2", {"info": {}}), (None, {"info": INFO}), (None, {})])
    df = silver.flatten_matches(twice)
    assert quality.not_null(df, "match_id").count() == 2
    assert rows(quality.unique(df, "match_id")) == [("m1", 2)]
    assert rows(quality.run_checks(df)) == [
        ("not_null", "duration_seconds", 2, False), ("not_null", "match_id", 2, False), ("unique", "match_id", 1, False),
    ]
    current = cohort.latest_per_key(df.filter("duration_seconds is not null and match_id is not null"), ["match_id"])
    assert all(r["passed"] for r in quality.run_checks(current).collect())
    assert all(r["passed"] for r in quality.run_checks(df.limit(0)).collect())


def test_sizes_count_characters_and_bytes(spark):
    df = bronze(spark, [("m1", "é" * 1024), ("m2", "x" * 1023), ("m3", None)])
    assert rows(metrics.payload_sizes(df)) == [("m1", 1, 2048), ("m2", 0, 1023), ("m3", None, None)]
    got = metrics.storage_summary({"a": df, "b": df.limit(0)}).orderBy("table_name").collect()
    assert [(r["records"], r["logical_bytes"], r["share"]) for r in got] == [(3, 3071, 1.0), (0, 0, 0.0)]
    assert got[1]["bytes_per_record"] is None


def test_snapshot_totals_tell_levels_from_missing_values(spark):
    df = spark.createDataFrame([("IRON", "I"), ("IRON", "I"), ("IRON", None), ("GOLD", "IV")], "tier string, division string")
    got = {(r["level"], r["tier"], r["division"]): r["n"] for r in metrics.snapshot_totals(df).collect()}
    assert got == {
        ("bucket", "IRON", "I"): 2, ("bucket", "IRON", None): 1, ("bucket", "GOLD", "IV"): 1,
        ("tier", "IRON", None): 3, ("tier", "GOLD", None): 1, ("total", None, None): 4,
    }


def test_iso_text(spark):
    assert spark.range(1).select(iso_utc(F.lit(1704067200))).first()[0] == "2024-01-01T00:00:00+00:00"


def test_damaged_documents_are_rejected_not_lost(spark):
    good = '{"info": {"participants": [{"riotIdGameName": "a", "kills": 3}]}}'
    texts = [good, good[:30], "not json", "", None, '{"info": {}}', "[]", good.replace("3", '"x"'), '{"info": {"participants": []}}']
    docs = spark.createDataFrame([(f"m{i}", "br1", None, t) for i, t in enumerate(texts)], schemas.TABLES[schemas.MATCHES])
    rejects = dict(rows(silver.participant_rejects(docs), "match_id", "reason"))
    assert rejects == {
        "m1": "malformed", "m2": "malformed", "m3": "malformed", "m4": "malformed", "m5": "missing", "m6": "missing", "m7": "wrong type",
    }
    kept = {r["match_id"] for r in silver.participants(docs).collect()}
    assert kept == {"m0", "m7"}
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        silver.participants(docs.filter("match_id = 'm7'"), strict=True).collect()


def test_documents_stay_where_they_are_for_few_differences(spark, tmp_path):
    """The matches that differ are known before the documents are read again, and go to them."""
    text = '{"info": {"participants": [{"riotIdGameName": "n%s", "kills": %s}]}}'
    schema = "match_id string, platform string, fetched_at timestamp, payload string"
    for side in (0, 1):
        docs = [(f"M_{i}", "br1", None, text % (i, i + side * (i == 7))) for i in range(200)]
        spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/{side}")
    one, other = (spark.read.parquet(f"{tmp_path}/{side}") for side in (0, 1))
    found = silver.rendition_differences(one, other)
    plan = plan_of(found)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "FullOuter" not in plan
    assert rows(found, "match_id", "kills", "surplus") == [("M_7", 7, 1), ("M_7", 8, -1)]
