import hashlib
from collections import Counter, defaultdict

import pytest
from corpora import frame, odd_texts
from pyspark.sql import functions as F

from conftest import plan_of
from match_lake.llm import mixing


def size(text):
    return len((text or "").encode().split())


def water_filled(sizes, weights, cap):
    """Share, cap, share the excess again, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        share = {s: cap * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if share[s] > cap * sizes[s]}
        if not over:
            return share
        full |= over


def test_plan(spark):
    rows = odd_texts()
    plan = mixing.plan_mix(frame(spark, rows)).collect()
    sizes, by_source = defaultdict(int), defaultdict(list)
    for r in plan:
        sizes[r.source] += r.size
        by_source[r.source].append(r)
    want = water_filled(sizes, mixing.WEIGHTS, mixing.CAP)
    assert sorted(((r.id, r.size) for r in plan), key=repr) == sorted(((i, size(t)) for i, t in rows), key=repr)
    for source, docs in by_source.items():
        assert all(r.source_size == sizes[source] and r.target == pytest.approx(want[source]) for r in docs)
        assert sum(r.taken for r in docs) == int(docs[0].target)
        assert all(0 <= r.taken <= 3 * r.size for r in docs)
        done = 0
        for r in sorted(docs, key=lambda r: (r.turn, r.before)):
            assert r.turn == hashlib.md5(str("" if r.id is None else r.id).encode()).hexdigest()
            assert r.before == done
            done += r.size
    again = mixing.plan_mix(frame(spark, rows, 5)).collect()
    assert sorted(map(tuple, plan), key=repr) == sorted(map(tuple, again), key=repr)


def test_sources_of_odd_sizes(spark):
    data = [("a", 1000), ("b", 3), (None, 40), ("c", 0), ("Z", 7), ("é", 500)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(data, "source string, size long")).collect()}
    for source, target in water_filled(dict(data), mixing.WEIGHTS, 3).items():
        assert got[source] == pytest.approx(target)
    none = spark.createDataFrame([("a", 0), ("b", 0)], "source string, size long")
    assert {r.target for r in mixing.source_targets(none).collect()} == {0.0}


def test_positions_invert_the_demand(spark):
    for start, end in mixing.RAMPS:
        df = spark.range(0, 1001, 50).select(F.col("id").alias("done"))
        at = df.select("done", mixing.reached_at(F.col("done"), F.lit(1000.0), F.lit(start), F.lit(end)).alias("t")).collect()
        for r in at:
            assert start * r.t + (end - start) * r.t**2 / 2 == pytest.approx(r.done / 1000)


def test_training_order(spark):
    rows = odd_texts()
    docs = frame(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    plan = mixing.plan_mix(docs).collect()
    assert sum(size(r.text) for r in out.collect()) == sum(r.taken for r in plan)
    copies = defaultdict(int)
    for r in out.collect():
        copies[r.doc_id, r.source] += size(r.text)
    taken = defaultdict(int)
    for r in plan:
        taken[r.id, r.source] += r.taken
    assert dict(copies) == {k: v for k, v in taken.items() if v}


def test_all_copies_in_training_order(spark):
    """Every copy has a place and a position of its own, and the documents' columns follow from them."""
    rows = odd_texts()
    plan = mixing.plan_mix(frame(spark, rows))
    told = {(r.source, r.before): r for r in plan.collect() if r["size"]}
    ordered = sorted(mixing.training_order(plan).collect(), key=lambda r: r.place)
    assert [r.place for r in ordered] == list(range(len(ordered)))
    assert [r.position for r in ordered] == sorted(r.position for r in ordered)
    assert {r.copy for r in ordered} == {0, 1, 2}
    words, first = defaultdict(int), {}
    for r in ordered:
        row = told[r.source, r.before]
        done, t = r.copy * row.source_size + r.before, r.position
        assert row.ramp_start * t + (row.ramp_end - row.ramp_start) * t**2 / 2 == pytest.approx(done / row.target)
        words[r.source, r.before] += r.words
        first.setdefault((r.source, r.before), t)
    assert {k: r.taken for k, r in told.items() if r.taken} == dict(words)
    out = mixing.scheduled(plan).collect()
    assert Counter((r.id, r.source, r.size, r.taken) for r in plan.collect()) == Counter((r.id, r.source, r.size, r.taken) for r in out)
    assert [r.first_position for r in out] == sorted(r.first_position for r in out)
    assert all(r.first_position == first[r.source, r.before] for r in out if r.taken)


def test_query_orders_the_copies(spark, tmp_path):
    """The query takes its figures from the copies in training order, not from the plan alone."""
    from match_lake.llm.queries import QUERIES

    frame(spark, odd_texts()).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_curriculum_mix"](spark, str(tmp_path))
    plan = plan_of(found)
    assert "sliced" in plan and "rangepartitioning(first_position" in plan
    starts = [r.first_position for r in found.collect()]
    assert starts == sorted(starts)


def test_repeated_rows_take_their_own_turns(spark):
    """All rows of a source but a few repeat one id, some with another text of the same length."""
    rows = [(3, f"{w} b c d e") for w in ("a", "a", "a", "x")] * 25 + [(6, "f g h i j"), (1, "k l m"), (4, "n o p"), (2, "q " * 700)]
    docs = frame(spark, rows)
    out = mixing.mix(docs).collect()
    plan = mixing.plan_mix(docs).collect()
    budget = {r.source: int(r.target) for r in plan}
    words = defaultdict(int)
    for r in out:
        words[r.source] += size(r.text)
    assert dict(words) == {s: n for s, n in budget.items() if n}
    assert 0 < budget["s1"] < 505
    # no row is taken a turn more often than another of its source, and each as often as it comes
    per_text = Counter(r.text for r in out if r.doc_id == 3)
    rounds = budget["s1"] // sum(size(t) for i, t in rows if i % 3 == 0)
    assert all(rounds * n <= per_text[t] <= (rounds + 1) * n for t, n in Counter(t for i, t in rows if i == 3).items())
    assert Counter(map(tuple, out)) == Counter(map(tuple, mixing.mix(docs.repartition(7)).collect()))


def test_empty_table(spark):
    docs = frame(spark, odd_texts()).limit(0)
    assert mixing.plan_mix(docs).count() == 0 and mixing.mix(docs).count() == 0
    wordless = mixing.plan_mix(frame(spark, [(1, None), (2, "")])).collect()
    assert [(r.size, r.taken, r.target) for r in wordless] == [(0, 0, 0.0)] * 2
