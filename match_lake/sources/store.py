"""Storing documents once, however often the same load is run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.moments import instant
from match_lake.session import cut_lineage
from match_lake.sources import idindex, manifest
from match_lake.sources.landing import document_id
from match_lake.sources.manifest import INGEST, Live
from match_lake.sources.tables import document_counts, drop_replaced, empty, ensure_table, make_live, qualified

KINDS = (schemas.MATCHES, schemas.TIMELINES)
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def check_kind(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"kind is one of {', '.join(KINDS)}")
    return kind


# fixed values: what a dead letter can be
NOT_JSON, NO_ID = "not_json", "no_id"
DEAD_LETTERS = "match_id string, file_path string, reason string, fetched_at timestamp, payload string"


def load_name(ingest: str, generation: int = 1) -> str:
    """The ingest a load writes when it is stored for the n-th time; no append and no other load bears such a name."""
    return f"load-{ingest}" if generation == 1 else f"load{generation}-{ingest}"


def dead_letter_table(kind: str) -> str:
    return f"{check_kind(kind)}_dead_letters"


def own_ingests(live: list[Live], platform: str, ingest: str) -> list[Live]:
    """What the load has stored; in a table without a manifest, by the name alone."""
    mine = load_name(ingest)
    return [x for x in live if x.platform == platform and (x.load == mine or (x.load is None and x.ingest == mine))]


def replace_folders(rows: DataFrame, name: str) -> None:
    """Write rows in place of the folders they go to; all others stay."""
    spark = rows.sparkSession
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def replace_load(
    rows: DataFrame, name: str, platform: str, ingest: str, live: list[Live], index: bool = True, fmt: str = "parquet"
) -> None:
    """Store rows as what the load holds from now on.

    They go to a new folder, a failed attempt at which is replaced, and become live in one step instead of what
    the load held before.
    """
    spark = rows.sparkSession
    own = own_ingests(live, platform, ingest)
    generation = max((max(1, x.generation) for x in own), default=0) + 1
    folder, counted = load_name(ingest, generation), Observation()
    named = rows.observe(counted, *document_counts()).withColumns({"platform": F.lit(platform), INGEST: F.lit(folder)})
    replace_folders(named, name)
    if not counted.get["rows"]:
        manifest.drop_ingests(spark, name, {(platform, folder)})
    if counted.get["rows"] or own:
        rest = [x for x in live if x not in own]
        make_live(spark, name, folder, counted.get, rest, load_name(ingest), generation, index, fmt)
        drop_replaced(spark, name, own)


def store_new(
    documents: DataFrame,
    database: str,
    kind: str,
    platform: str,
    ingest: str,
    fetched_at: datetime | str | None = None,
    whole_files: bool = True,
    fmt: str = "parquet",
) -> None:
    """Store the documents whose match is not stored yet, under the load's name `ingest`.

    `documents` holds (value, file_path, file_name). Of several documents of one
    match the first by file path is kept. What an earlier attempt stored under the
    same name does not count as stored and is replaced, so a load that died half-way
    can be run again as it is; a load that lacks a match stored under that name is
    another load and is refused. Which documents are new is settled on ids alone, read from
    the ingests whose index hits, and a document is shuffled only if its line occurs twice in one file.

    Documents without an id go to the kind's dead letters (see `dead_letters`), under the same load.
    """
    check_kind(kind)
    spark = documents.sparkSession
    table = ensure_table(spark, database, kind, fmt)
    spark.catalog.refreshTable(table)
    stamp = F.current_timestamp() if fetched_at is None else instant(fetched_at)
    origin = F.struct("file_path") if whole_files else F.struct("file_path", F.sha2("value", 256).alias("digest"))
    everything = documents.select(
        document_id("value", "file_name" if whole_files else None).alias("match_id"),
        origin.alias("origin"),
        F.col("value").alias("payload"),
    )
    rows = everything.filter(F.col("match_id").isNotNull())
    counted = everything.groupBy("match_id", "origin").agg(F.count(F.lit(1)).alias("copies"))
    # documents without an id are counted along: one row, if there are any
    met = cut_lineage(counted.groupBy("match_id").agg(F.min(F.struct("origin", "copies")).alias("first")), "arrived")
    arrived, nameless = met.filter(F.col("match_id").isNotNull()), not met.filter(F.col("match_id").isNull()).isEmpty()
    live = manifest.resolved(spark, table)
    own = own_ingests(live, platform, ingest)
    if own and not manifest.of_ingests(spark.table(table), own).select("match_id").join(arrived, "match_id", "left_anti").isEmpty():
        raise ValueError(f"{ingest} names another load, which stored matches that are not in this one")
    stored = idindex.stored_ids(arrived, table, platform, [x for x in live if x not in own])
    new = cut_lineage(arrived.join(stored, "match_id", "left_anti").select("match_id", "first.*"), "new")

    def picked(which: DataFrame) -> DataFrame:
        return rows.join(which.select("match_id", "origin"), ["match_id", "origin"], "left_semi")

    out = picked(new.filter("copies = 1"))
    if not whole_files:
        out = out.union(picked(new.filter("copies > 1")).dropDuplicates(["match_id"]))
    lost = everything.filter(F.col("match_id").isNull())
    store_dead_letters(lost, nameless, database, kind, platform, ingest, stamp, fmt)
    replace_load(out.select("match_id", stamp.alias("fetched_at"), "payload"), table, platform, ingest, live, fmt=fmt)


def store_dead_letters(
    lost: DataFrame, any_lost: bool, database: str, kind: str, platform: str, ingest: str, stamp: Column, fmt: str = "parquet"
) -> None:
    """Store the documents a load brought without an id, in place of what it stored before. The table is made with the first of them."""
    spark = lost.sparkSession
    name = qualified(database, dead_letter_table(kind))
    there = spark.catalog.tableExists(name)
    if not any_lost and not (there and own_ingests(manifest.resolved(spark, name), platform, ingest)):
        return
    if not there:
        manifest.publish(spark, name, [])
        layout = ["platform", INGEST]
        empty(spark, f"{DEAD_LETTERS}, platform string, {INGEST} string").write.format(fmt).partitionBy(*layout).mode("ignore").saveAsTable(name)
    reason = F.when(F.get_json_object("payload", "$").isNull(), NOT_JSON).otherwise(NO_ID)
    rows = lost.select("match_id", F.col("origin.file_path").alias("file_path"), reason.alias("reason"), stamp.alias("fetched_at"), "payload")
    replace_load(rows, name, platform, ingest, manifest.resolved(spark, name), False, fmt)


def dead_letters(spark: SparkSession, database: str, kind: str, platform: str | None = None) -> DataFrame:
    """(platform, file_path, reason, fetched_at, payload) of all documents that arrived without an id."""
    name = qualified(database, dead_letter_table(kind))
    columns = ["platform", "file_path", "reason", "fetched_at", "payload"]
    if not spark.catalog.tableExists(name):
        return empty(spark, f"{DEAD_LETTERS}, platform string").select(*columns)
    return manifest.live_rows(spark, name, platform).select(*columns)
