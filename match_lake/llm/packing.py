"""Batches of similar length: bucket boundaries by dynamic programming, batches by a token budget.

1. One distributed pass makes the histogram of lengths over all documents, every length a bin of its own: at most as many
   rows as the longest document has tokens, however many documents there are. (A caller who counts something finer than
   tokens may ask for coarser bins with `fine`: one for each length up to it, then 32 for every doubling.)
2. Dynamic programming over the bins finds the `n_buckets` boundaries with the least
   padding in all, when every document is padded to the longest of its bucket. It is
   exact. The best start of a last bucket moves only upwards with its end, so each round is divided at its
   middle and costs bins times the logarithm of bins.
3. Within its bucket each document gets a rank along a hash of its id, and ranks are cut
   into batches of as many documents as the budget holds at the bucket's length. Ranks come
   from the counts of parts of a bucket, so no task holds a bucket. Rows that repeat an id and length are
   one row with a count until they have their ranks.

Defined cases. Null and empty texts have length 0 and are padded like others; a bucket of
only such rows has length 0 and counts as length 1 when its batches are filled. A document
longer than the budget is a batch of its own, never cut. Equal lengths always share a bucket. Null
ids and repeated rows are packed like any others. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from match_lake.llm.words import word_count
from match_lake.session import cut_lineage

STEPS = 32
BUCKETS = 16
TOKEN_BUDGET = 65_536
ROWS_PER_PART = 16_384


def length_bin(length: Column, fine: int | None = None) -> Column:
    """Bins in order of length: one for each (up to `fine`, then STEPS per doubling)."""
    if fine is None:
        return length.cast("bigint")
    above = F.floor(F.log2(F.greatest(length, F.lit(1)) / F.lit(fine)) * STEPS)
    return F.when(length <= fine, length).otherwise(fine + 1 + above).cast("bigint")


def histogram(lengths: DataFrame, fine: int | None = None) -> DataFrame:
    """bin, n, tokens, longest. Combined before the shuffle."""
    return lengths.groupBy(length_bin(F.col("length"), fine).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens"), F.max("length").alias("longest")
    )


def best_boundaries(longest: np.ndarray, n: np.ndarray, tokens: np.ndarray, n_buckets: int) -> tuple[list[int], int]:
    """The last bin of every bucket, and the padding of that choice.

    best[j] after k rounds is the least padding of bins up to j in at most k buckets.
    """
    bins = len(n)
    rows = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    filled = np.concatenate([[0], np.cumsum(tokens)]).astype(np.int64)
    best = np.concatenate([[0], longest * rows[1:] - filled[1:]]).astype(np.int64)
    cut_at = []
    for _ in range(min(n_buckets, bins) - 1):
        now, cuts = best.copy(), np.zeros(bins + 1, dtype=np.int64)
        todo = [(1, bins, 0, bins - 1)]
        while todo:
            low, high, first, last = todo.pop()
            j = (low + high) // 2
            # the last bucket holds bins i + 1 to j, for the i between first and last
            i = slice(first, min(last, j - 1) + 1)
            cost = best[i] + longest[j - 1] * (rows[j] - rows[i]) - (filled[j] - filled[i])
            cuts[j] = first + int(np.argmin(cost))
            now[j] = cost[cuts[j] - first]
            if low < j:
                todo.append((low, j - 1, first, int(cuts[j])))
            if j < high:
                todo.append((j + 1, high, int(cuts[j]), last))
        cut_at.append(cuts)
        best = now
    ends, j = [], bins
    for cuts in reversed(cut_at):
        if j == 0:
            break
        ends.append(j - 1)
        j = int(cuts[j])
    if j:
        ends.append(j - 1)
    return sorted(ends), int(best[bins])


def buckets(lengths: DataFrame, n_buckets: int = BUCKETS, fine: int | None = None) -> list[tuple[int, int, int]]:
    """(last bin, padded length, rows) of each bucket, shortest first. The driver sees one row per bin."""
    bins = histogram(lengths, fine).orderBy("bin").collect()
    if not bins:
        return []
    longest = np.array([b["longest"] for b in bins], dtype=np.int64)
    n = np.array([b["n"] for b in bins], dtype=np.int64)
    tokens = np.array([b["tokens"] for b in bins], dtype=np.int64)
    ends, _ = best_boundaries(longest, n, tokens, n_buckets)
    starts = [0, *[e + 1 for e in ends[:-1]]]
    return [(bins[e]["bin"], int(longest[e]), int(n[s : e + 1].sum())) for s, e in zip(starts, ends)]


def by_bucket(bucket: Column, values: list[int]) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), bucket)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: Column | None = None, n_buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET, fine: int | None = None, rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, bucket, padded_length, batch, place, padding.

    `length` counts a row's tokens; words by default. `batch` counts from 0 within a bucket.
    """
    measured = word_count(text) if length is None else F.coalesce(length, F.lit(0)).cast("bigint")
    # Lengths are read several times and texts are dear to measure: once, into a narrow table.
    lengths = cut_lineage(docs.select(F.col(f"`{id_col}`").alias("id"), measured.alias("length")), "lengths")
    found = buckets(lengths, n_buckets, fine)
    if not found:
        found = [(0, 0, 0)]
    last_bins, padded, rows = zip(*found)
    # The first bucket whose last bin is not below the row's.
    at = sum((F.when(length_bin(F.col("length"), fine) > end, 1).otherwise(0) for end in last_bins[:-1]), F.lit(0))
    parts = [-(-r // rows_per_part) or 1 for r in rows]
    alike = lengths.groupBy("id", "length").agg(F.count(F.lit(1)).alias("_copies"))
    hashed = alike.withColumn("bucket", at.cast("int")).withColumn("_hash", F.xxhash64("id", "length"))
    dealt = hashed.withColumn("_part", F.pmod("_hash", by_bucket(F.col("bucket"), parts)))
    counts = dealt.groupBy("bucket", "_part").agg(F.sum("_copies").alias("_rows"))
    earlier = W.partitionBy("bucket").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("bucket", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    ahead = W.partitionBy("bucket", "_part").orderBy("_hash", "id", "length").rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("_copies").over(ahead), F.lit(0))).join(bases, ["bucket", "_part"])
    # Many copies are counted out in pieces, by many tasks.
    many = placed.filter(F.col("_copies") > rows_per_part).withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(rows_per_part))))
    pieces = many.repartition("id", "length", "_from").unionAll(
        placed.filter(F.col("_copies") <= rows_per_part).withColumn("_from", F.lit(0).cast("bigint"))
    )
    upto = F.least(F.col("_copies"), F.col("_from") + rows_per_part) - 1
    ranked = pieces.withColumn("_copy", F.explode(F.sequence(F.col("_from"), upto)))
    per_batch = by_bucket(F.col("bucket"), [max(1, token_budget // max(1, p)) for p in padded])
    rank = (F.col("_base") + F.col("_inside") + F.col("_copy")).cast("bigint")
    padded_length = by_bucket(F.col("bucket"), list(padded))
    return ranked.withColumns({"_rank": rank, "_per": per_batch, "_padded": padded_length}).select(
        F.col("id").alias(id_col), F.col("length").alias("n_tokens"), "bucket", F.col("_padded").alias("padded_length"),
        F.expr("_rank div _per").alias("batch"), F.pmod("_rank", "_per").cast("int").alias("place"),
        (F.col("_padded") - F.col("length")).alias("padding"),
    )
