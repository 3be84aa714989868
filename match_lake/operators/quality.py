"""Data tests: each returns the offending rows, so no rows means it passed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the tests on the silver match table
SILVER_NOT_NULL = ("match_id", "duration_seconds")
SILVER_UNIQUE = ("match_id",)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, with how often. NULLs are not compared."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counts = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


def run_checks(
    df: DataFrame, not_null_columns: Sequence[str] = SILVER_NOT_NULL, unique_columns: Sequence[str] = SILVER_UNIQUE
) -> DataFrame:
    """One row per test: (test, column, failures, passed).

    All null counts come out of one pass; each uniqueness test counts its values.
    """
    parts = []
    if not_null_columns:
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null_columns])
        each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in not_null_columns])
        parts.append(counts.select(F.inline(each)).select(F.lit("not_null").alias("test"), "column", "failures"))
    for c in unique_columns:
        repeated = unique(df, c).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(repeated.select(F.lit("unique").alias("test"), F.lit(c).alias("column"), "failures"))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)
