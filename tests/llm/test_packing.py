import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from corpora import frame, odd_texts
from pyspark.sql import functions as F

from match_lake.llm import packing


def test_boundaries_are_optimal():
    rng = random.Random(3)
    for _ in range(60):
        lengths = np.array(sorted(rng.sample(range(200), rng.randrange(1, 9))), dtype=np.int64)
        n = np.array([rng.randrange(1, 30) for _ in lengths], dtype=np.int64)
        k = rng.randrange(1, 6)
        ends, padding = packing.best_boundaries(lengths, n, lengths * n, k)

        def cost(cuts):
            return sum((lengths[max(b - 1, 0)] * n[a:b] - lengths[a:b] * n[a:b]).sum() for a, b in zip((0, *cuts), (*cuts, len(n))))

        least = min(cost(c) for m in range(min(k, len(n))) for c in itertools.combinations(range(1, len(n)), m))
        assert padding == least == cost([e + 1 for e in ends[:-1]]) and ends[-1] == len(n) - 1 and len(ends) <= k


def test_boundaries_of_long_lengths_are_optimal():
    """Hundreds of lengths far beyond any round number, against every last bucket of every end."""
    rng = np.random.default_rng(8)
    for bins, k in ((1, 4), (2, 2), (40, 3), (300, 7), (500, 16)):
        lengths = np.sort(rng.choice(30_000, bins, replace=False)).astype(np.int64)
        n = rng.integers(1, 1000, bins) ** 2
        least = np.full((k + 1, bins + 1), np.iinfo(np.int64).max // 4)
        least[:, 0] = 0
        for b in range(1, k + 1):
            for j in range(1, bins + 1):
                waste = [(n[i:j] * (lengths[j - 1] - lengths[i:j])).sum() for i in range(j)] if bins <= 40 else None
                if waste is None:
                    rows, filled = np.cumsum(n[j - 1 :: -1])[::-1], np.cumsum((n * lengths)[j - 1 :: -1])[::-1]
                    waste = lengths[j - 1] * rows - filled
                least[b, j] = (least[b - 1, :j] + np.array(waste)).min()
        ends, padding = packing.best_boundaries(lengths, n, lengths * n, k)
        assert padding == least[k, bins] and len(ends) <= k and ends[-1] == bins - 1
        starts = [0, *[e + 1 for e in ends[:-1]]]
        assert padding == sum((n[s : e + 1] * (lengths[e] - lengths[s : e + 1])).sum() for s, e in zip(starts, ends))


def test_the_histogram_has_a_bin_for_every_length(spark):
    df = spark.range(3000).select((F.col("id") * F.col("id") % 90_001).alias("length"))
    assert packing.histogram(df).count() == df.distinct().count()


@pytest.mark.parametrize("copies", [5, 400])
def test_a_third_of_all_rows_under_one_id(spark, copies):
    rows = [(i, "w " * (i % 30)) for i in range(2 * copies)] + [(7, "w " * 7)] * copies + [(None, None)] * copies
    out = packing.pack(frame(spark, rows), token_budget=100, n_buckets=4, rows_per_part=16).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in out), key=repr) == sorted(((i, len((t or "").split())) for i, t in rows), key=repr)
    places = [(r.bucket, r.batch, r.place) for r in out]
    assert len(set(places)) == len(rows)
    for bucket in {b for b, _, _ in places}:
        full = max(1, 100 // max(1, max(r.padded_length for r in out if r.bucket == bucket)))
        ranks = sorted(batch * full + place for b, batch, place in places if b == bucket)
        assert ranks == list(range(len(ranks)))


def test_bins_keep_order(spark):
    df = spark.range(0, 200_000, 7).select(F.col("id").alias("length")).withColumn("bin", packing.length_bin(F.col("length"), 64))
    bins = df.groupBy("bin").agg(F.min("length").alias("a"), F.max("length").alias("b")).orderBy("bin").collect()
    assert all(x.b < y.a for x, y in zip(bins, bins[1:])) and len(bins) < 64 + 32 * 13


@pytest.mark.parametrize("budget,per_part", [(1000, 7), (65_536, 16_384), (1, 3)])
def test_batches(spark, budget, per_part):
    rows = odd_texts()
    docs = frame(spark, rows)
    out = packing.pack(docs, token_budget=budget, n_buckets=5, rows_per_part=per_part).collect()
    size = lambda t: len((t or "").encode().split())
    assert sorted(((r.doc_id, r.n_tokens) for r in out), key=repr) == sorted(((i, size(t)) for i, t in rows), key=repr)
    longest, batches = defaultdict(int), defaultdict(list)
    for r in out:
        longest[r.bucket] = max(longest[r.bucket], r.n_tokens)
        batches[r.bucket, r.batch].append(r)
    assert len(longest) == 5
    for (bucket, batch), members in batches.items():
        full = max(1, budget // max(1, longest[bucket]))
        assert all(r.padded_length == longest[bucket] and r.padding == longest[bucket] - r.n_tokens for r in members)
        assert sorted(r.place for r in members) == list(range(len(members)))
        last = max(b for k, b in batches if k == bucket)
        assert len(members) == full or (batch == last and len(members) < full)
    ends = sorted(longest.values())
    assert all(r.n_tokens > (ends[ends.index(longest[r.bucket]) - 1] if ends.index(longest[r.bucket]) else -1) for r in out)
    again = packing.pack(docs.repartition(5), token_budget=budget, n_buckets=5, rows_per_part=per_part).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)


def test_empty_table(spark):
    assert packing.pack(frame(spark, odd_texts()).limit(0)).count() == 0
    only_empty = frame(spark, [(1, None), (2, ""), (None, " ")])
    assert {(r.n_tokens, r.padded_length, r.batch) for r in packing.pack(only_empty).collect()} == {(0, 0, 0)}
