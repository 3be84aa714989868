"""Order-dependent building blocks that stay distributed.

`row_number() over (order by ...)` without a partition sends every row to one
task. The operators here give the same numbers by cutting the key range into
slices, so that no task sees more than its slice.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from match_lake.session import cut_lineage

BLOCK = 4_096
# fixed value: bits of Spark's monotonically increasing ids that count rows within a partition
ROW_BITS = 33


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: int = 64) -> DataFrame:
    """The first n rows of every key.

    Spark prunes each group to n rows before the shuffle while n is small. Past
    that, rows are first cut to n within `spread` parts of the key, so a key with
    a large share of all rows is sorted by many tasks and the last step sees at
    most n * spread of its rows.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
        df = df.withColumn("_part", part)
        df = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys, "_part").orderBy(*order)))
        df = df.filter(F.col("_rank") <= n).drop("_rank", "_part")
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def sliced(df: DataFrame, order_by: Sequence[str], slices: int | None = None) -> DataFrame:
    """A written copy in order: `_slice`, the range of the order a row lies in, and `_within`, its place there.

    Spark chooses the ranges from a sample. Both are stored with the row, so whatever reads the
    copy, or reads it again after losing an executor, sees the same.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Spark's id counts the rows of a partition in its lower bits and the partitions above them
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(slices, *order_by).sortWithinPartitions(*order_by)
    return cut_lineage(
        ranged.select(
            "*", F.shiftright(place, ROW_BITS).cast("int").alias("_slice"),
            place.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_within"),
        ),
        "sliced",
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str], name: str = "pos", at_most: int | None = None, slices: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row along `order_by`, which must be unique and not NULL.

    One written copy holds the rows in order; a row's position is its place in its slice plus the rows of the slices
    before. The result is a plain scan of the copy, so Spark knows its size. With `at_most`, only the first that many rows are
    kept, and only the slices that hold them are read.
    """
    copy = sliced(df, order_by, slices)
    # one row per slice
    sizes = dict(copy.groupBy("_slice").agg(F.count(F.lit(1))).collect())
    offsets = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0))
    if at_most is not None:
        offsets = offsets[: max(1, bisect_left(offsets, at_most))]
        copy = copy.filter(F.col("_slice") < len(offsets))
    before = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in offsets]), F.col("_slice") + 1)
    numbered = copy.select(*df.columns, (before + F.col("_within")).alias(name))
    return numbered if at_most is None else numbered.filter(F.col(name) < at_most)


def first_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """`order by ... limit n`, without gathering n rows in one task."""
    return number_rows(df, order_by, "_pos", n).drop("_pos")


def running_total(df: DataFrame, index: str, values: dict[str, str]) -> DataFrame:
    """Add, per row, the sum of each value over all rows with a smaller index.

    `index` is a dense 0-based integer and `values` maps a column to the name of its
    running total. Totals are taken per block of indexes first, so the one ordered pass
    over everything sees a row per block.
    """
    blocked = df.withColumn("_block", F.expr(f"`{index}` div {BLOCK}"))
    blocks = blocked.groupBy("_block").agg(*[F.sum(c).alias(f"_sum_{c}") for c in values])
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    bases = blocks.select("_block", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_base_{c}") for c in values])
    inside = W.partitionBy("_block").orderBy(index).rowsBetween(W.unboundedPreceding, -1)
    joined = blocked.join(bases, "_block")
    return joined.select(
        *df.columns,
        *[(F.col(f"_base_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(name) for c, name in values.items()],
    )


def spread_join(facts: DataFrame, keyed: DataFrame, on: str, by: str, how: str = "inner", salts: int = 8) -> DataFrame:
    """Join a large table to one row per key, hot keys spread over `salts` tasks.

    `keyed` must be unique on `on`; it is repeated once per salt, while each fact
    goes to the salt its `by` column hashes to.
    """
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    repeated = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [on, "_salt"], how).drop("_salt")
