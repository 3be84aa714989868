"""The latest ladder row of every account, kept up to date snapshot by snapshot.

The history of snapshots grows without end; who is where now takes one row per account and queue. A snapshot is
merged into what is there by taking the later row of each account, so the cost of a run is that of the
accounts and one snapshot, not of all snapshots ever taken. The later of two rows is the same in whatever order they
come, so snapshots may arrive late, twice or in any order: the table equals `latest_per_key` over the whole history.

Laid out by platform and state; a new state replaces the one before in the manifest in one step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.operators.cohort import latest_per_key
from match_lake.sources import manifest, tables
from match_lake.sources.manifest import INGEST, Live

TABLE = "league_latest"
KEYS = ("platform", "queue_type", "puuid")
# Rows of one account and moment: the first along these counts. With all columns in it the order is total.
TIES = ("tier", "league_points", "division", "wins", "losses", "inactive")


def latest_rows(entries: DataFrame) -> DataFrame:
    """The latest row of each account and queue. Rows without an account are left out."""
    named = entries.filter(F.col("puuid").isNotNull() & F.col("platform").isNotNull())
    return latest_per_key(named.select(*tables.stored_columns(schemas.LEAGUE_ENTRIES)), KEYS, "fetched_at", TIES)


def merge_snapshot(entries: DataFrame, database: str, fmt: str = "parquet") -> int:
    """Merge ladder rows into the latest state of their platforms; returns how many accounts those hold then.

    Merging a snapshot again changes nothing, so a run that died can be run again.
    """
    spark = entries.sparkSession
    name, columns = tables.qualified(database, TABLE), tables.stored_columns(schemas.LEAGUE_ENTRIES)
    if not spark.catalog.tableExists(name):
        manifest.publish(spark, name, [])
        ddl = f"{schemas.TABLES[schemas.LEAGUE_ENTRIES]}, {INGEST} string"
        tables.empty(spark, ddl).write.format(fmt).partitionBy("platform", INGEST).mode("ignore").saveAsTable(name)
    spark.catalog.refreshTable(name)
    before = manifest.resolved(spark, name)
    # one row per platform
    platforms = {r[0] for r in entries.select("platform").distinct().collect()}
    replaced = [x for x in before if x.platform in platforms]
    old = manifest.of_ingests(spark.table(name), replaced).select(*columns)
    state, counted = f"state-{uuid.uuid4().hex}", Observation()
    merged = latest_rows(old.unionByName(entries.select(*columns))).observe(counted, F.count(F.lit(1)).alias("rows"))
    merged.withColumn(INGEST, F.lit(state)).write.format(fmt).mode("append").partitionBy("platform", INGEST).saveAsTable(name)
    if counted.get["rows"]:
        written = [p["platform"] for p in manifest.partitions(spark, name) if p[INGEST] == state]
        manifest.publish(spark, name, [*[x for x in before if x not in replaced], *[Live(p, state) for p in written]])
        manifest.drop_ingests(spark, name, {(x.platform, x.ingest) for x in replaced})
    return counted.get["rows"]


def read_latest(spark: SparkSession, database: str, platform: str | None = None) -> DataFrame:
    """The latest row of each account and queue; to be given to the cohort operators in place of the history."""
    name = tables.qualified(database, TABLE)
    if not spark.catalog.tableExists(name):
        return tables.empty(spark, schemas.TABLES[schemas.LEAGUE_ENTRIES])
    return manifest.live_rows(spark, name, platform).select(*tables.stored_columns(schemas.LEAGUE_ENTRIES))
