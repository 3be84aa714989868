import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from match_lake.operators import ordering


@pytest.mark.parametrize("slices", [1, 7, None])
def test_numbers_follow_the_order_however_many_slices(spark, slices):
    df = spark.range(5_000).select(F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("k"))
    numbered = ordering.number_rows(df, ["k"], "pos", slices=slices)
    got = {r["k"]: r["pos"] for r in numbered.collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(got)
    assert sorted(got.values()) == list(range(5_000))


def test_numbers_over_two_columns_with_a_hot_first_one(spark):
    df = spark.range(3_000).select(F.when(F.col("id") < 2_000, 7).otherwise(F.col("id") % 5).alias("a"), F.col("id").cast("string").alias("b"))
    numbered = ordering.number_rows(df, ["a", "b"], "pos", slices=16)
    got = sorted((r["pos"], r["a"], r["b"]) for r in numbered.collect())
    assert [(a, b) for _, a, b in got] == sorted((a, b) for _, a, b in got)
    assert [p for p, _, _ in got] == list(range(3_000))


def test_slices_stay_even(spark):
    df = spark.range(300_000).select(F.format_string("same-long-prefix-%08d", F.xxhash64("id") % 10**8).alias("k"), "id")
    sizes = [r["count"] for r in ordering.sliced(df, ["k", "id"], 32).groupBy("_slice").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 2 * 300_000 / 32


def test_at_most_keeps_the_first_rows(spark):
    df = spark.range(1_000).select((999 - F.col("id")).alias("k"))
    for slices in (1, 10):
        got = ordering.number_rows(df, ["k"], "pos", at_most=40, slices=slices)
        assert rows(got) == sorted([(i, i) for i in range(40)], key=repr)


def test_columns_of_any_name_pass_through(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("_id"), F.col("id").alias("_rows"))
    got = ordering.number_rows(df, ["_id"], "_pos", slices=3)
    assert got.columns == ["_id", "_rows", "_pos"] and all(r["_id"] == r["_pos"] for r in got.collect())


def test_empty_input(spark):
    df = spark.range(0).select(F.col("id").alias("k"))
    assert ordering.number_rows(df, ["k"]).count() == 0


def test_running_total_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BLOCK", 7)
    rng = random.Random(1)
    values = [rng.randint(0, 9) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(values)), "i bigint, v bigint")
    want = [(i, v, sum(values[:i])) for i, v in enumerate(values)]
    assert sorted(tuple(r) for r in ordering.running_total(df, "i", {"v": "before"}).collect()) == want


@pytest.mark.parametrize("n", [3, 2_000])
def test_top_per_key_with_a_hot_key(spark, n):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    got = ordering.top_per_key(df, ["k"], [F.col("id").desc()], n)
    want = {}
    for i in range(9_000):
        want.setdefault(0 if i % 3 else i % 50, []).append(i)
    assert {(r["k"], r["id"]) for r in got.collect()} == {(k, i) for k, v in want.items() for i in sorted(v)[-n:]}


def test_spread_join_equals_a_plain_join(spark):
    facts = spark.range(500).select((F.col("id") % 7).alias("k"), F.col("id").alias("f"))
    keyed = spark.createDataFrame([(0, "a"), (3, "b")], "k bigint, v string")
    for how in ("inner", "left"):
        assert rows(ordering.spread_join(facts, keyed, "k", "f", how)) == rows(facts.join(keyed, "k", how))


def test_first_rows(spark):
    df = spark.range(300).select((299 - F.col("id")).alias("k"))
    assert rows(ordering.first_rows(df, ["k"], 25)) == sorted([(i,) for i in range(25)], key=repr)
