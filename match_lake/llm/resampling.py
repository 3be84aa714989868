"""Importance resampling towards a target text distribution, with exact integer weights from bit planes.

Features of a text are all runs of 1 to `longest` consecutive words; each falls into the bucket
crc32 mod BUCKETS of its bytes. A bucket's gain is the scaled logarithm of how much more often the target
holds it, rounded down to an integer.

1. Features per bucket are counted over all documents and over all target texts: counts are added up
   inside each task, then per bucket, so BUCKETS rows reach the driver, whatever the input.
2. The gains become signed bit planes, of BUCKETS bits each: plane i holds bit i of the gains above zero,
   another one bit i of those below.
3. A document's bucket counts become bit planes as well. With A_j its count planes and G_i the
   gain planes, the sum over buckets of count times gain is the sum of 2^(i+j) * popcount(A_j and G_i), positive
   less negative planes: integers throughout, the same in whatever order they are added.
4. Weight plus Gumbel noise from a hash of the id is the score. Documents of enough words are numbered along
   (score, id) range by range, and the first share of them is drawn.

Defined cases. Only A-Z are lower-cased. A word is a run of ASCII digits, letters and anything beyond ASCII. A null or
empty text has no features, weight 0 and is never drawn for want of words. A null id is hashed as an empty
one and comes after all others in a tie; rows that repeat an id and tie come by features, weight and then
place in the table, so each has a rank of its own. Empty tables give no rows; an empty
target gives gains from the smoothing alone. Texts are cut into words block by block, however long they are. Other columns
are not read. A weight is exact as long as it fits 63 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from match_lake.llm.steps import Steps
from match_lake.operators.ordering import number_rows

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
SCALE = 1_000
# Bytes of a text whose words are held at a time.
BLOCK = 1 << 18

_WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TO_WORDS = bytes(b if b in _WORD_BYTES else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def word_blocks(text: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, `size` bytes at a time; a word is never cut."""
    clean = text.translate(_TO_WORDS)
    start = 0
    while start < len(clean):
        stop = clean.find(b" ", start + size)
        stop = len(clean) if stop < 0 else stop
        yield clean[start:stop].split()
        start = stop


def run_buckets(words: list[bytes], first: int, longest: int) -> Iterator[np.ndarray]:
    """The buckets of the runs of 1 to `longest` words that begin at one of the first `first` words.

    The checksum of a run goes on from that of the run without its last word.
    """
    spaced = [b" " + w for w in words]
    sums = list(map(crc32, words[:first]))
    for further in range(1, longest + 1):
        yield np.array(sums, np.uint32) % BUCKETS
        sums = list(map(crc32, spaced[further:], sums))


def bucket_counts(text: bytes, longest: int = LONGEST, size: int = BLOCK) -> tuple[int, np.ndarray]:
    """The number of words, and of features in each bucket. Runs go on from block to block."""
    counts, n_words, held, found = np.zeros(BUCKETS, np.int64), 0, [], []
    for block in word_blocks(text, size):
        n_words += len(block)
        held += block
        ready = max(0, len(held) - longest + 1)
        found += run_buckets(held, ready, longest)
        held = held[ready:]
        if n_words > size:
            counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
            found = []
    found += run_buckets(held, len(held), longest)
    counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
    return n_words, counts


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def feature_counts(rows: DataFrame, text: str = "text", longest: int = LONGEST) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for one in _texts(batch):
                total += bucket_counts(one, longest)[1]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["bucket", "n"])

    counted = rows.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The integer gain of every bucket, from the two tables of feature_counts. Reads BUCKETS rows of each at most."""
    both = []
    for counts in (corpus, target):
        dense = [0] * BUCKETS
        for bucket, n in counts.collect():
            dense[bucket] = n
        both.append(dense)
    s, t = both
    all_s, all_t = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return np.array([math.floor(SCALE * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in range(BUCKETS)], np.int64)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Plane j holds bit j of all values (none below zero), 64 to a word."""
    depth = int(values.max(initial=0)).bit_length()
    bits = (values >> np.arange(depth, dtype=np.int64)[:, None]) & 1
    packed = np.packbits(bits.astype(np.uint8), axis=1)
    whole = np.zeros((depth, -(-packed.shape[1] // 8) * 8), np.uint8)
    whole[:, : packed.shape[1]] = packed
    return whole.view(np.uint64)


def signed_planes(gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes of the gains above zero and of those below, and the signed power of two of each."""
    above, below = bit_planes(np.maximum(gains, 0)), bit_planes(np.maximum(-gains, 0))
    powers = [1 << i for i in range(len(above))] + [-(1 << i) for i in range(len(below))]
    return np.concatenate([above, below]), np.array(powers, np.int64)


def plane_sum(counts: np.ndarray, planes: np.ndarray, powers: np.ndarray) -> int:
    """The sum of counts times gains."""
    total = 0
    for j, plane in enumerate(bit_planes(counts)):
        ones = np.bitwise_count(planes & plane).sum(axis=1, dtype=np.int64)
        total += int(ones @ powers) << j
    return total


def importance(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """id, n_words, n_features, weight of every document."""
    planes, powers = signed_planes(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weights = [], [], []
            for one in _texts(batch):
                n, counts = bucket_counts(one, longest)
                n_words.append(n)
                n_features.append(int(counts.sum()))
                weights.append(plane_sum(counts, planes, powers))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(x, pa.int64()) for x in (n_words, n_features, weights)]],
                names=["id", "n_words", "n_features", "weight"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"id {id_type}, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: str, seed: int = SEED):
    """Gumbel noise of an id in units of the gains, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: the id, n_features, weight, score, and rank (from 1) if drawn.

    Of the N documents of at least `least_words` words the floor(percent * N / 100) highest scores are drawn.
    """
    steps = Steps(docs.sparkSession)
    gains = bucket_gains(feature_counts(docs, text, longest), feature_counts(target, target_text, longest))
    weighed = importance(docs, gains, id_col, text, longest)
    # The place is stored with the row, so it is the same for every reader.
    scored = steps.cut(
        weighed.withColumn("score", F.col("weight") + noise("id", seed)).withColumn("_row", F.monotonically_increasing_id()), "scored"
    )
    fit, unfit = scored.filter(F.col("n_words") >= least_words), scored.filter(F.col("n_words") < least_words)
    draw = fit.count() * percent // 100
    kind = scored.schema["id"].dataType
    ordered = fit.withColumns({"_down": -F.col("score"), "_unnamed": F.col("id").isNull()})
    filler = F.lit("" if kind.simpleString() == "string" else 0).cast(kind)
    ordered = ordered.withColumn("_id", F.coalesce("id", filler))
    numbered = number_rows(ordered, ["_down", "_unnamed", "_id", "n_features", "weight", "_row"], "_pos")
    rank = F.when(F.col("_pos") < draw, F.col("_pos") + 1).cast("bigint")
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return numbered.select(*columns, rank.alias("rank")).unionAll(unfit.select(*columns, F.lit(None).cast("bigint").alias("rank")))
