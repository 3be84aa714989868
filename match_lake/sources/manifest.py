"""Which ingests of a table are live.

A table laid out by ingest has a companion `<table>_live` with one row per live ingest, rewritten as a new version by
every load, append or compaction. A version is one file, so it is there as a whole or not at all, and the highest
one counts. Folders of the table that it does not name are leftovers of writes that did not end, or of
ingests that were replaced: readers leave them out and `vacuum` removes them.

A table without a companion was written by something else: all its ingests count as live. A table has one
writer at a time; readers need no lock.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST = "ingest"
VERSION = "version"
# Versions kept for readers that resolved one a moment ago.
VERSIONS_KEPT = 3
DDL = "platform string, ingest string, load string, generation int, documents bigint, bytes bigint, digest string, level int"


class Live(NamedTuple):
    """One live ingest of a platform.

    load: the load that wrote it, if one did, and its generation: how often that load has been stored.
    documents, bytes: what the write counted; null where one write served several platforms.
    digest: of the documents, whatever their order.
    level: size of its id index, null if it has none.
    """

    platform: str
    ingest: str
    load: str | None = None
    generation: int = 0
    documents: int | None = None
    bytes: int | None = None
    digest: str | None = None
    level: int | None = None


def companion(name: str) -> str:
    return f"{name}_live"


def partitions(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """The partitions a table has in the catalog. Nothing is scanned."""
    found = [r["partition"] for r in spark.sql(f"show partitions {name}").collect()]
    return [{k: unquote(v) for k, v in (part.split("=", 1) for part in row.split("/"))} for row in found]


def _versions(spark: SparkSession, name: str) -> list[int]:
    return sorted(int(p[VERSION]) for p in partitions(spark, companion(name)))


def live(spark: SparkSession, name: str) -> list[Live] | None:
    """The live ingests, a row each; None for a table without a companion."""
    if not spark.catalog.tableExists(companion(name)):
        return None
    spark.catalog.refreshTable(companion(name))
    versions = _versions(spark, name)
    if not versions:
        return []
    rows = spark.table(companion(name)).filter((F.col(VERSION) == versions[-1]) & F.col(INGEST).isNotNull())
    # one row per live ingest
    return sorted((Live(**r.asDict()) for r in rows.drop(VERSION).collect()), key=lambda x: (x.platform, x.ingest))


def resolved(spark: SparkSession, name: str) -> list[Live]:
    """The live ingests, also of a table without a companion."""
    found = live(spark, name)
    if found is not None:
        return found
    return [Live(p["platform"], p[INGEST]) for p in partitions(spark, name)]


def of_ingests(rows: DataFrame, ingests: Collection[Live]) -> DataFrame:
    """Rows of these ingests. The filter is on the layout, so no other folder is listed or read."""
    by_platform: dict[str, set[str]] = {}
    for x in ingests:
        by_platform.setdefault(x.platform, set()).add(x.ingest)
    each = [(F.col("platform") == p) & F.col(INGEST).isin(sorted(names)) for p, names in sorted(by_platform.items())]
    return rows.filter(reduce(or_, each) if each else F.lit(False))


def live_rows(spark: SparkSession, name: str, platform: str | None = None) -> DataFrame:
    """The rows readers are to see, with their ingest."""
    # files may have been replaced since this session last looked
    spark.catalog.refreshTable(name)
    rows = spark.table(name)
    if platform is not None:
        rows = rows.filter(F.col("platform") == platform)
    ingests = live(spark, name)
    return rows if ingests is None else of_ingests(rows, [x for x in ingests if platform in (None, x.platform)])


def publish(spark: SparkSession, name: str, ingests: Sequence[Live]) -> None:
    """Make these the live ingests, in one step."""
    target = companion(name)
    if not spark.catalog.tableExists(target):
        empty = spark.createDataFrame([], f"{DDL}, {VERSION} bigint")
        empty.write.partitionBy(VERSION).mode("ignore").saveAsTable(target)
    spark.catalog.refreshTable(target)
    old = _versions(spark, name)
    version = old[-1] + 1 if old else 1
    # no live ingest at all is a version too: a row that names none
    rows = spark.createDataFrame([tuple(x) for x in ingests] or [(None,) * len(Live._fields)], DDL)
    whole = rows.withColumn(VERSION, F.lit(version).cast("bigint")).coalesce(1)
    whole.write.partitionBy(VERSION).mode("append").saveAsTable(target)
    for gone in old[: max(0, len(old) - VERSIONS_KEPT + 1)]:
        spark.sql(f"alter table {target} drop if exists partition ({VERSION} = {gone})")


def drop_ingests(spark: SparkSession, name: str, ingests: Collection[tuple[str, str]]) -> None:
    """Remove folders of ingests, given as (platform, ingest)."""
    for platform, ingest in sorted(ingests):
        spark.sql(f"alter table {name} drop if exists partition (platform = :p, {INGEST} = :i)", {"p": platform, "i": ingest})
    spark.catalog.refreshTable(name)


def vacuum(spark: SparkSession, name: str) -> int:
    """Remove every folder that is not live, and return how many there were. No write may be under way."""
    found = live(spark, name)
    if found is None:
        return 0
    seen = {(x.platform, x.ingest) for x in found}
    dead = {(p["platform"], p[INGEST]) for p in partitions(spark, name)} - seen
    drop_ingests(spark, name, dead)
    return len(dead)
