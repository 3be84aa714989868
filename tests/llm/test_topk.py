"""Exact top-k against numpy over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from match_lake.llm import topk


def brute(rows, is_query, k):
    import math

    fit = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in {i: (i, v) for i, v in fit if is_query(i)}.values():
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fit if i != q and len(w) == len(v))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, k=10, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(3)
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 10 == 0, k=k, **options).collect()))


def test_ties_and_small_bins(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.5, 1.0]) for _ in range(3)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5]) for i in range(60)]
    assert run(spark, rows, bins=4, queries_at_once=5) == brute(rows, lambda i: i % 10 == 0, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, None), (20, [nan, 1.0]), (30, [None, 1.0]), (40, [inf, 1.0]), (None, [1.0, 1.0]), (1, [1.0]), (50, [0.1]), (2, [0.3, -0.7]), (2, [0.3, -0.7]), (3, []), (60, [])]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 10)


def test_scores_beyond_doubles(spark):
    rows = [(i, [float(1_000_000 + 7 * i), float(900_000 - 3 * i), 1.0 + i]) for i in range(40)]
    assert run(spark, rows, k=4) == brute(rows, lambda i: i % 10 == 0, 4)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(10, [1.0])]) == []


@pytest.mark.parametrize("name", ["op5_exact_top_k"])
def test_query_over_the_whole_table(spark, name):
    import numpy as np
    from conftest import SF_DIR

    from match_lake.llm.queries import QUERIES

    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    v = np.floor(np.array([r.embedding for r in rows], dtype=np.float32).astype(np.float64) * 1024).astype(np.int64)
    want = []
    for i in np.flatnonzero(ids % 100 == 0):
        scores = v @ v[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:10]
        want += [(int(ids[i]), r, int(ids[j]), int(scores[j])) for r, j in enumerate(order, 1)]
    assert sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect())) == sorted(want)
