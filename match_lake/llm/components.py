"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from match_lake.llm.steps import Steps


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    around = _both_ways(links)
    lowest = around.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return around.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("_m"))
    moved = down.join(lowest, "a").filter("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return moved.union(lowest.select("a", F.col("_m").alias("b")))


def component_labels(links: DataFrame, steps: Steps, name: str = "labels") -> DataFrame:
    """node, root: every node of a link but the roots, with the smallest node of its component.

    The result is the step `name`; the rounds before it are removed.

    `links` has columns a and b of one type. A round costs four aggregations and joins on
    links, and the number of rounds grows with the logarithm of the components' sizes. Links
    are written to the shared folder after each round, so a lost executor repeats one round
    at most. Minima are combined before each shuffle, and joins bring one row per node to its links.
    """
    links = steps.cut(links.filter("a <> b").select("a", "b").distinct(), name)
    mark = None
    while True:
        before = f"{name}_before"
        steps.rename(name, before)
        links = steps.cut(_small_star(_large_star(links)).filter("a <> b").distinct(), name)
        steps.remove(before)
        found = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (found["n"], found["x"]) == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = (found["n"], found["x"])
