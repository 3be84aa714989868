"""Reading and appending the stored tables.

Document tables are laid out by platform and by ingest (one append, or one run of a load).
Readers that want one platform read only its folders, and only of the ingests the table's
manifest names: an append, a load or a compaction is seen as a whole or not at all.
Each ingest has an id index beside it. Appends and loads name their ingests
apart, so neither can replace what the other wrote. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.moments import instant
from match_lake.sources import idindex, manifest
from match_lake.sources.manifest import INGEST, Live

LAYOUT = {
    schemas.MATCHES: ("platform", INGEST),
    schemas.TIMELINES: ("platform", INGEST),
    schemas.LEAGUE_ENTRIES: ("platform",),
    schemas.LISTED_ACCOUNTS: ("platform",),
}


def qualified(database: str, table: str) -> str:
    return f"{database}.{table}"


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def stored_columns(table: str) -> list[str]:
    return [c.split()[0] for c in schemas.TABLES[table].split(", ")]


def read_or_empty(spark: SparkSession, database: str, table: str, platform: str | None = None) -> DataFrame:
    """The table with its contract columns; no rows if it does not exist yet."""
    name = qualified(database, table)
    if not spark.catalog.tableExists(name):
        return empty(spark, schemas.TABLES[table])
    return manifest.live_rows(spark, name, platform).select(*stored_columns(table))


def ensure_table(spark: SparkSession, database: str, table: str, fmt: str = "parquet") -> str:
    """Create the table, empty, if it does not exist. Returns its full name."""
    name = qualified(database, table)
    if not spark.catalog.tableExists(name):
        ddl = schemas.TABLES[table]
        if INGEST in LAYOUT[table]:
            ddl += f", {INGEST} string"
            # before the table: what a first write leaves behind when it dies is not taken for an old table
            manifest.publish(spark, name, [])
        empty(spark, ddl).write.format(fmt).partitionBy(*LAYOUT[table]).mode("ignore").saveAsTable(name)
    return name


def document_counts() -> list:
    """What a write of documents observes: how many, their bytes, and a digest that does not depend on their order."""
    each = F.xxhash64("match_id", "fetched_at", "payload")
    return [
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("payload")).alias("bytes"),
        F.bit_xor(each).alias("mixed"), F.sum(each.cast("decimal(38,0)")).alias("total"),
    ]


def digest_of(counted: dict) -> str:
    return f"{counted['rows']}.{counted['mixed']}.{counted['total']}"


def make_live(
    spark: SparkSession, name: str, ingest: str, counted: dict, before: Sequence[Live], load: str | None = None,
    generation: int = 0, index: bool = True, fmt: str = "parquet",
) -> None:
    """Index an ingest that has been written and make it live beside those of `before`."""
    written = [p["platform"] for p in manifest.partitions(spark, name) if p[INGEST] == ingest]
    level = idindex.level_for(counted["rows"]) if index else None
    if written and index:
        idindex.write_index(spark, name, ingest, level, fmt)
    sizes = (counted["rows"], counted["bytes"]) if len(written) == 1 else (None, None)
    new = [Live(p, ingest, load, generation, *sizes, digest_of(counted), level) for p in written]
    manifest.publish(spark, name, [*before, *new])
    spark.catalog.refreshTable(name)


def append_table(df: DataFrame, database: str, table: str, ingest: str | None = None, fmt: str = "parquet") -> int:
    """Append rows and return how many, counted while writing them.

    Documents go under an ingest of their own, named after `ingest` if given.
    """
    spark = df.sparkSession
    name = ensure_table(spark, database, table, fmt)
    rows, counted = df.select(*stored_columns(table)), Observation()
    if INGEST not in LAYOUT[table]:
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        rows.write.format(fmt).mode("append").partitionBy(*LAYOUT[table]).saveAsTable(name)
        return counted.get["rows"]
    before = manifest.resolved(spark, name)
    own = f"append-{ingest + '-' if ingest else ''}{uuid.uuid4().hex}"
    rows = rows.observe(counted, *document_counts()).withColumn(INGEST, F.lit(own))
    rows.write.format(fmt).mode("append").partitionBy(*LAYOUT[table]).saveAsTable(name)
    if counted.get["rows"]:
        make_live(spark, name, own, counted.get, before, fmt=fmt)
    return counted.get["rows"]


def append_bronze(
    matches: DataFrame, timelines: DataFrame, database: str, ingest: str | None = None, fmt: str = "parquet"
) -> dict[str, int]:
    """Append details and timelines; rows written per table.

    Timelines go first: should the second write fail, the leftovers are timelines
    without a match, which no reader takes for a stored match.
    """
    written = {schemas.TIMELINES: append_table(timelines, database, schemas.TIMELINES, ingest, fmt)}
    written[schemas.MATCHES] = append_table(matches, database, schemas.MATCHES, ingest, fmt)
    return written


def append_ladder(entries: DataFrame, database: str, fmt: str = "parquet") -> int:
    """Append a ladder snapshot; earlier snapshots stay."""
    return append_table(entries, database, schemas.LEAGUE_ENTRIES, fmt=fmt)


def append_checkpoint(
    accounts: DataFrame, platform: str, listed_at: datetime | str, database: str, key: str = "puuid", fmt: str = "parquet"
) -> int:
    """Record accounts as listed, whether or not anything was found for them."""
    rows = accounts.select(
        F.col(key).alias("puuid"), F.lit(platform).alias("platform"), instant(listed_at).alias("listed_at")
    )
    return append_table(rows, database, schemas.LISTED_ACCOUNTS, fmt=fmt)


def compact(spark: SparkSession, database: str, table: str, platform: str, fmt: str = "parquet") -> int:
    """Move a platform's documents into one ingest and return how many ingests that replaces.

    Loads leave a folder each, small ones small files. The new folder is complete and indexed before the
    manifest names it instead of the old ones, in one step: readers see every document once, before, during and after,
    and so they do if this stops half-way. What it leaves then goes with `vacuum`. A load
    run again afterwards finds its documents stored and adds nothing.
    """
    name = qualified(database, table)
    before = manifest.resolved(spark, name)
    old = [x for x in before if x.platform == platform]
    if len(old) < 2:
        return 0
    ingest, counted = f"compact-{uuid.uuid4().hex}", Observation()
    spark.catalog.refreshTable(name)
    rows = manifest.of_ingests(spark.table(name), old).observe(counted, *document_counts()).withColumn(INGEST, F.lit(ingest))
    rows.write.format(fmt).mode("append").partitionBy(*LAYOUT[table]).saveAsTable(name)
    make_live(spark, name, ingest, counted.get, [x for x in before if x.platform != platform], fmt=fmt)
    drop_replaced(spark, name, old)
    return len(old)


def drop_replaced(spark: SparkSession, name: str, ingests: Sequence[Live]) -> None:
    """Remove the folders and indexes of ingests that are live no more."""
    gone = {(x.platform, x.ingest) for x in ingests}
    manifest.drop_ingests(spark, name, gone)
    idindex.drop_index(spark, name, gone)


def vacuum(spark: SparkSession, database: str, table: str) -> int:
    """Remove what writes that did not end left of a table; how many folders that was. No write may be under way."""
    name = qualified(database, table)
    live = manifest.resolved(spark, name)
    if spark.catalog.tableExists(idindex.index_table(name)):
        indexed = {(p["platform"], p[INGEST]) for p in manifest.partitions(spark, idindex.index_table(name))}
        idindex.drop_index(spark, name, indexed - {(x.platform, x.ingest) for x in live})
    return manifest.vacuum(spark, name)


def rebuild(df: DataFrame, database: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Write a derived table anew and return it."""
    name = qualified(database, table)
    df.write.format(fmt).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
