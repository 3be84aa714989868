"""Exact copies by progressive refinement: length, then a hash of the beginning, then a hash of everything.

Two texts are equal when they are identical after every run of white space has
become one space; null counts as empty. Each round works only on groups the round
before left with two rows or more, and the last one, the only one to hash whole
texts, reads the texts of those alone.

Defined cases. Empty and null texts form one group. Of a group the row with the
smallest id stays; rows that repeat this id with an equal text are the same document
and all stay. A null id is larger than any other: a group of rows without ids keeps
them all, with a null `keep_id`. Columns of any other name pass through untouched,
and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from match_lake.llm.words import free_names, normalised

PREFIX_CHARS = 256


def full_hash(text: str) -> Column:
    """Lower-case hex SHA-256 of the normalised text in UTF-8."""
    return F.sha2(normalised(text).cast("binary"), 256)


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """text_sha256, keep_id, group_size of every group of two equal texts or more.

    Counts are combined before each shuffle, so a group with a large share of all rows
    costs no task more than another. Which groups are left is joined by AQE's measured
    sizes.
    """
    outline = docs.select(normalised(text).alias("_text")).select(
        F.length("_text").alias("_length"), F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("_prefix")
    )
    lengths = outline.groupBy("_length").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("_length")
    prefixes = (
        outline.join(lengths, "_length", "left_semi")
        .groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1").select("_length", "_prefix")
    )
    texts = docs.select(F.col(id_col).alias("_id"), normalised(text).alias("_text")).select(
        "_id", "_text", F.length("_text").alias("_length"), F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("_prefix")
    )
    left = texts.join(prefixes, ["_length", "_prefix"], "left_semi")
    return (
        left.select("_id", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256"))
        .groupBy("text_sha256").agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256: one row per row of `docs`, without its text."""
    groups = copy_groups(docs, id_col, text)
    hashed = docs.select(F.col(id_col), full_hash(text).alias("text_sha256"))
    found = F.col("group_size").isNotNull()
    return hashed.join(groups, "text_sha256", "left").select(
        id_col,
        F.when(found, F.col("keep_id")).otherwise(F.col(id_col)).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.when(found, F.col(id_col).eqNullSafe(F.col("keep_id"))).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their own columns."""
    digest, keep, size = free_names(docs.columns, "text_sha256", "keep_id", "group_size")
    groups = copy_groups(docs, id_col, text).toDF(digest, keep, size)
    marked = docs.withColumn(digest, full_hash(text)).join(groups, digest, "left")
    stays = F.col(size).isNull() | F.col(id_col).eqNullSafe(F.col(keep))
    return marked.filter(stays).select(*[F.col(f"`{c}`") for c in docs.columns])
