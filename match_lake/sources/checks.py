"""Data tests of the silver table that follow its refreshes, instead of reading it whole each time.

Per ingest, what its rows say is kept beside the table: how many nulls each tested column has, and which ids are
suspect, being twice in it or stored in another ingest as well. Refreshing the tests reads the ingests that are new, groups their
ids once with those of the older ingests which the id indexes name, and adds this up. An id that is suspect in any live ingest is
counted exactly, in the ingests that may hold it. The result is that of `quality.run_checks` over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators import quality
from match_lake.session import cut_lineage
from match_lake.sources import idindex, manifest, store
from match_lake.sources.manifest import INGEST
from match_lake.sources.tables import empty, qualified

ID = "match_id"
# From so many ids on, a part of them is probed first.
MANY = 65_536
# Ids of older ingests are met where they are read, if there are so many to one new id.
FEW = 8
DDL = f"test string, name string, failures bigint, platform string, {INGEST} string"


def refresh_checks(
    spark: SparkSession, database: str, table: str = "silver_by_load", not_null: Sequence[str] = quality.SILVER_NOT_NULL, fmt: str = "parquet"
) -> DataFrame:
    """One row per test, as quality.run_checks: nulls of the columns, and ids that occur more than once."""
    source, name = qualified(database, schemas.MATCHES), qualified(database, table)
    notes = f"{name}_checks"
    if not spark.catalog.tableExists(notes):
        manifest.publish(spark, notes, [])
        empty(spark, DDL).write.format(fmt).partitionBy("platform", INGEST).mode("ignore").saveAsTable(notes)
    for each in (source, name, notes):
        spark.catalog.refreshTable(each)
    now = manifest.resolved(spark, name)
    noted = {(x.platform, x.ingest, x.digest) for x in manifest.resolved(spark, notes)}
    new = [x for x in now if (x.platform, x.ingest, x.digest) not in noted]
    gone = {(p, i) for p, i, _ in noted} - {(x.platform, x.ingest) for x in now}
    if new:
        store.replace_folders(_notes(spark, source, name, now, new, not_null), notes)
    if new or gone:
        manifest.publish(spark, notes, now)
        manifest.drop_ingests(spark, notes, gone)
    found = manifest.live_rows(spark, notes)
    nulls = found.filter("test = 'not_null'").groupBy("test", F.col("name").alias("column")).agg(F.sum("failures").alias("failures"))
    wanted = spark.createDataFrame([("not_null", c) for c in not_null], "test string, column string")
    nulls = wanted.join(nulls, ["test", "column"], "left").select("test", "column", F.coalesce("failures", F.lit(0)).alias("failures"))
    suspects = found.filter("test = 'suspect'").select(F.col("name").alias(ID), "platform", INGEST)
    repeated = quality.unique(_rows_of(spark, source, name, suspects, now), ID).agg(F.count(F.lit(1)).alias("failures"))
    unique = repeated.select(F.lit("unique").alias("test"), F.lit(ID).alias("column"), "failures")
    return nulls.unionByName(unique).withColumn("passed", F.col("failures") == 0)


def _notes(
    spark: SparkSession, source: str, name: str, now: list[manifest.Live], new: list[manifest.Live], not_null: Sequence[str]
) -> DataFrame:
    """What is to be noted of the new ingests. Every one of them gets a row, so it is known to have been read."""
    rows = manifest.of_ingests(spark.table(name), new)
    layout = ["platform", INGEST]
    counts = rows.groupBy(*layout).agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null])
    each = F.array(*[F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("name"), F.col(c).alias("failures")) for c in not_null])
    nulls = counts.select(F.inline(each), *layout)
    suspects = _suspects(spark, source, name, now, new)
    told = suspects.select(F.lit("suspect").alias("test"), F.col(ID).alias("name"), F.lit(1).cast("bigint").alias("failures"), *layout)
    return reduce(DataFrame.unionByName, [nulls, told])


def _suspects(spark: SparkSession, source: str, name: str, now: list[manifest.Live], new: list[manifest.Live]) -> DataFrame:
    """(id, platform, ingest): ids of the new ingests that are twice in one, in two of them, or in a new and an older one.

    New ingests go by number, older ones are 0: one grouping by id tells the rows and the first and last new ingest of each.
    """
    layout = ["platform", INGEST]
    numbers = spark.createDataFrame([(i, x.platform, x.ingest) for i, x in enumerate(new, 1)], f"number int, platform string, {INGEST} string")
    rows = manifest.of_ingests(spark.table(name), new).filter(F.col(ID).isNotNull())
    fresh = rows.join(F.broadcast(numbers), layout).select(ID, "number")
    seen = {(x.platform, x.ingest) for x in new}
    old = [x for x in _indexed(spark, source, now) if (x.platform, x.ingest) not in seen]
    expected = _documents(new)
    hit = idindex.ingests_hit(rows.select(ID), spark, source, old, ID, expected is None or expected >= MANY)
    opened = [x for x in old if x.level is None or (x.platform, x.ingest) in hit]
    known, stored = manifest.of_ingests(spark.table(name), opened).select(ID, F.lit(0).alias("number")), _documents(opened)
    if expected is None or stored is None or expected * FEW <= stored:
        known = known.join(rows.select(ID), ID, "left_semi")
    number = F.col("number")
    met = fresh.unionByName(known).groupBy(ID).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(number > 0, number)).alias("first"), F.max(number).alias("last"),
    ).filter("n > 1 and last > 0")
    if len(new) == 1:
        return met.withColumn("number", F.col("last")).join(F.broadcast(numbers), "number").select(ID, *layout)
    met = cut_lineage(met, "met")
    one = met.filter("first = last").select(ID, F.col("last").alias("number"))
    several = fresh.join(met.filter("first < last"), ID, "left_semi").distinct()
    return one.unionByName(several).join(F.broadcast(numbers), "number").select(ID, *layout)


def _documents(ingests: list[manifest.Live]) -> int | None:
    """How many documents they hold; None if one of them does not tell."""
    return None if any(x.documents is None for x in ingests) else sum(x.documents for x in ingests)


def _indexed(spark: SparkSession, source: str, now: list[manifest.Live]) -> list[manifest.Live]:
    """The documents' entries of these ingests, which know the size of their index."""
    there = {(x.platform, x.ingest): x for x in manifest.resolved(spark, source)}
    return [there.get((x.platform, x.ingest), x) for x in now]


def _rows_of(spark: SparkSession, source: str, name: str, suspects: DataFrame, now: list[manifest.Live]) -> DataFrame:
    """The silver rows of the suspects, from the ingests that may hold them: those with a note of one, and what else their ids hit."""
    live = _indexed(spark, source, now)
    # one row per ingest
    noted = {(r["platform"], r[INGEST]): r["count"] for r in suspects.groupBy("platform", INGEST).count().collect()}
    others = [x for x in live if (x.platform, x.ingest) not in noted] if noted else []
    hit = {*noted, *idindex.ingests_hit(suspects.select(ID), spark, source, others, ID, sum(noted.values()) >= MANY)}
    opened = [x for x in live if (x.platform, x.ingest) in hit or (noted and x.level is None)]
    return manifest.of_ingests(spark.table(name), opened).select(ID).join(suspects.select(ID), ID, "left_semi")
