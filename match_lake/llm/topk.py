"""Exact top-k by integer inner product: score everything, narrow histograms of scores, filter, break ties.

Components become floor(1024 * x). Queries are taken in blocks of bounded size, by a hash of their ids; each
block is broadcast and scored against all rows in numpy, one multiplication per batch.

1. A pass finds each query's lowest and highest score.
2. Each further pass counts, per query, the scores in `bins` bins of the range known to hold the
   k-th highest score. A task only reports its highest bins up to the one where its own count
   reaches k: the k-th score of all rows cannot lie below that. Counts are summed, the bin of the k-th score is
   the next range, and passes end when every range is one score wide.
3. A last pass keeps all scores above the k-th, and of those equal to it, per task, the k smallest
   ids; a window over what is left ranks by score and id. Spark holds at most k rows per query and task.

Defined cases. Rows whose id or vector is null, or whose vector holds null or non-finite components, take
no part. Vectors meet the queries of their own length only. A query is not a candidate for itself: rows with its id are left
out. Apart from that every row is a candidate, repeated rows each with a rank of their own; a
repeated query row counts once. Fewer than k candidates are all returned. An empty table gives an empty result. Products
are exact as long as a score fits 63 bits: in doubles while sums stay below 2^53, in integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from match_lake.llm.steps import Steps
from match_lake.session import scratch_dir

K = 10
BINS = 1_024
QUERIES_AT_ONCE = 1_024
# Scores held at a time: rows of a batch times queries.
SCORES = 1 << 21
EXACT_DOUBLE = 2.0**53


def quantised(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id, v (array of bigint) of the rows that take part."""
    whole = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * 1024))
    fit = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(f"`{id_col}`").isNotNull() & fit)
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), whole.alias("v"))


def scored(batch: pa.RecordBatch, queries: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row ids, positions of the queries, scores: rows x queries) in blocks. `queries` is by length: positions and vectors."""
    column = batch.column("v")
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy()
    ids = batch.column("id").to_numpy()
    sizes = np.diff(ends)
    for size, (at, matrix) in queries.items():
        rows = np.flatnonzero(sizes == size)
        if not len(rows):
            continue
        per = max(1, SCORES // len(matrix))
        low = np.abs(matrix).sum(axis=1, dtype=np.float64).max() if size else 0.0
        for i in range(0, len(rows), per):
            some = rows[i : i + per]
            v = values[ends[some][:, None] + np.arange(size)]
            if size == 0 or low * np.abs(v).max() < EXACT_DOUBLE:
                scores = (v.astype(np.float64) @ matrix.T.astype(np.float64)).astype(np.int64)
            else:
                scores = v @ matrix.T
            yield ids[some], at, scores


def _by_length(ids: np.ndarray, vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(v) for v in vectors])
    groups = {int(s): np.flatnonzero(sizes == s) for s in np.unique(sizes)}
    return {s: (at, np.array([vectors[i] for i in at], dtype=np.int64).reshape(len(at), s)) for s, at in groups.items()}


def _pass(rows: DataFrame, work, kind: str) -> DataFrame:
    return rows.mapInArrow(work, kind)


def _others(row_ids: np.ndarray, query_ids: np.ndarray) -> np.ndarray:
    return row_ids[:, None] != query_ids[None, :]


def _ranges(rows: DataFrame, ids: np.ndarray, queries: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest score, highest score and number of candidates of each query."""
    top = np.iinfo(np.int64).max

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n = np.full(len(ids), top), np.full(len(ids), -top), np.zeros(len(ids), np.int64)
        for batch in batches:
            for row_ids, at, scores in scored(batch, queries):
                other = _others(row_ids, ids[at])
                low[at] = np.minimum(low[at], np.where(other, scores, top).min(axis=0))
                high[at] = np.maximum(high[at], np.where(other, scores, -top).max(axis=0))
                n[at] += other.sum(axis=0)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(low[met]), pa.array(high[met]), pa.array(n[met])], names=["q", "low", "high", "n"])

    # One row per query of the block.
    found = _pass(rows, work, "q bigint, low bigint, high bigint, n bigint").groupBy("q").agg(F.min("low"), F.max("high"), F.sum("n")).collect()
    low, high, n = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for q, a, b, c in found:
        low[q], high[q], n[q] = a, b, c
    return low, high, n


def kth_scores(rows: DataFrame, ids: np.ndarray, queries: dict, k: int = K, bins: int = BINS) -> np.ndarray:
    """Each query's k-th highest score, or its lowest where it has fewer candidates than k."""
    low, high, n = _ranges(rows, ids, queries)
    high = np.where(n < k, low, high)
    above = np.zeros(len(ids), np.int64)  # candidates known to score above the range
    while np.any(high > low):
        width = (high - low) // bins + 1

        def work(batches: Iterator[pa.RecordBatch], low=low, high=high, width=width, above=above) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((len(ids), bins), np.int64)
            for batch in batches:
                for row_ids, at, scores in scored(batch, queries):
                    inside = _others(row_ids, ids[at]) & (scores >= low[at]) & (scores <= high[at])
                    r, c = np.nonzero(inside)
                    bin_of = (scores[r, c] - low[at][c]) // width[at][c]
                    counts += np.bincount(at[c] * bins + bin_of, minlength=counts.size).reshape(counts.shape)
            # from the highest bin down to the one in which this task's own count reaches k
            seen = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            q, b = np.nonzero((counts > 0) & (seen < (k - above)[:, None]))
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(counts[q, b])], names=["q", "bin", "n"])

        tails = _pass(rows, work, "q bigint, bin bigint, n bigint").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        upper = W.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
        ahead = tails.withColumn("ahead", F.coalesce(F.sum("n").over(upper), F.lit(0)))
        need = F.get(F.array(*[F.lit(int(k - a)) for a in above]), F.col("q").cast("int"))
        hit = ahead.filter((F.col("ahead") < need) & (F.col("ahead") + F.col("n") >= need)).select("q", "bin", "ahead").collect()
        for q, b, more in hit:  # one row per query of the block
            if high[q] > low[q]:
                start = low[q] + b * width[q]
                low[q], high[q], above[q] = start, min(high[q], start + width[q] - 1), above[q] + more
    return low


def _best(rows: DataFrame, ids: np.ndarray, queries: dict, kth: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score of all above the k-th score and, per task, the k smallest ids at it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ties: dict[int, list[int]] = {}
        for batch in batches:
            for row_ids, at, scores in scored(batch, queries):
                other = _others(row_ids, ids[at])
                r, c = np.nonzero(other & (scores > kth[at]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[c]]), pa.array(row_ids[r]), pa.array(scores[r, c])], names=["query_id", "vec_id", "score"])
                r, c = np.nonzero(other & (scores == kth[at]))
                for q in np.unique(at[c]):
                    ties[q] = sorted([*ties.get(q, []), *np.sort(row_ids[r[at[c] == q]])[:k].tolist()])[:k]
        q = [ids[x] for x, found in ties.items() for _ in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array([i for f in ties.values() for i in f], pa.int64()), pa.array([int(kth[x]) for x, f in ties.items() for _ in f], pa.int64())],
            names=["query_id", "vec_id", "score"],
        )

    return _pass(rows, work, "query_id bigint, vec_id bigint, score bigint")


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
    bins: int = BINS, queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """query_id, rank from 1, vec_id, score of every row of `vectors` for which `is_query` holds."""
    spark = vectors.sparkSession
    steps = Steps(spark)
    rows = steps.cut(quantised(vectors, id_col, vector), "vectors")
    wanted = quantised(vectors.filter(is_query), id_col, vector).dropDuplicates(["id"])
    wanted = steps.cut(wanted, "queries")
    blocks = -(-wanted.count() // queries_at_once)
    out = scratch_dir(spark, "ranked")
    kind = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not blocks:
        return spark.createDataFrame([], kind)
    for block in range(blocks):
        # About queries_at_once narrow rows, whatever the table's size.
        part = wanted.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).orderBy("id").collect()
        if not part:
            continue
        ids = np.array([r["id"] for r in part], np.int64)
        queries = _by_length(ids, [np.array(r["v"], np.int64) for r in part])
        kth = kth_scores(rows, ids, queries, k, bins)
        order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        best = _best(rows, ids, queries, kth, k).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        best.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
    steps.remove("vectors", "queries")
    return spark.read.schema(kind).parquet(out)
