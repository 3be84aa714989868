"""Words as Spark expressions. A word is a run of anything but space and tab to carriage return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def normalised(text: str) -> Column:
    """Text with every run of white space as one space; null as empty."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """Names for helper columns that clash with none of a table's own, in any case."""
    used = {name.lower() for name in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def row_hash(rows: DataFrame) -> Column:
    """64 bits of all columns of a row; nulls count, nested values by their JSON."""
    columns = []
    for name, kind in rows.dtypes:
        value = F.col(f"`{name}`")
        columns += [F.to_json(F.struct(value)) if "<" in kind else value, value.isNull()]
    return F.xxhash64(*columns)


def one_row_each(rows: DataFrame, *by: Column) -> DataFrame:
    """Of the rows that agree in `by` the one with the smallest hash of all columns, chosen before the shuffle within each part."""
    every = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    chosen = rows.groupBy(*[key.alias(f"_{i}") for i, key in enumerate(by)]).agg(F.min_by(every, row_hash(rows)).alias("_row"))
    return chosen.select(*[F.col("_row")[c].alias(c) for c in rows.columns])
