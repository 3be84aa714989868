"""Which ingests may hold an id, without reading any of them.

Every ingest has a blocked Bloom filter beside it: an id goes to one of 2^level blocks by its hash, and sets PROBES of the
32,768 bits of that block, which Spark's bitmap functions collect. An id that is stored always hits; one that
is not hits an ingest with a probability of about 0.2%, at BLOCK_IDS ids to a block. What hits is then
tested exactly, on the ids of the ingests that were hit and no others.

The index is a table `<table>_ids`, laid out by platform and ingest like the documents. An ingest without an index
counts as hit.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake.sources import manifest

DDL = "block bigint, bits binary, platform string, ingest string"
BLOCK_IDS = 2_048
PROBES = 4
# Of many candidates, one in so many is probed before the others.
PARTS = 64
# fixed value: bits of one block, as Spark's bitmap functions have them
BLOCK_BITS = 32_768


def index_table(name: str) -> str:
    return f"{name}_ids"


def level_for(ids: int) -> int:
    """Blocks, as a power of two, for so many ids."""
    return max(0, (max(1, ids) - 1) // BLOCK_IDS).bit_length()


def _block(id_col: str, level: Column | int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level).cast("bigint"))


def _places(id_col: str) -> list[Column]:
    """The bits an id sets in its block: 15 bits each of a second hash."""
    second = F.xxhash64(F.lit("place"), F.col(id_col))
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]


def filter_blocks(ids: DataFrame, level: int, id_col: str = "match_id") -> DataFrame:
    """(block, bits) of the Bloom filter of the ids. Bits are combined before the shuffle."""
    known = ids.filter(F.col(id_col).isNotNull())
    places = known.select(_block(id_col, level).alias("block"), F.explode(F.array(*_places(id_col))).alias("place"))
    return places.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def _is_set(bits: str, place: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(place, F.lit(8)))), F.lit(2)) == 1


def write_index(spark: SparkSession, name: str, ingest: str, level: int, fmt: str = "parquet") -> None:
    """Index the ids of an ingest that has been written, per platform; from the stored ids, not from their documents."""
    target = index_table(name)
    if not spark.catalog.tableExists(target):
        spark.createDataFrame([], DDL).write.format(fmt).partitionBy("platform", manifest.INGEST).mode("ignore").saveAsTable(target)
    # of an attempt that died
    drop_index(spark, name, {(p["platform"], ingest) for p in manifest.partitions(spark, target) if p[manifest.INGEST] == ingest})
    spark.catalog.refreshTable(name)
    own = [p["platform"] for p in manifest.partitions(spark, name) if p[manifest.INGEST] == ingest]
    for platform in own:
        stored = spark.table(name).filter((F.col("platform") == platform) & (F.col(manifest.INGEST) == ingest))
        blocks = filter_blocks(stored.select("match_id"), level)
        rows = blocks.select("block", "bits", F.lit(platform).alias("platform"), F.lit(ingest).alias(manifest.INGEST))
        rows.write.format(fmt).mode("append").partitionBy("platform", manifest.INGEST).saveAsTable(target)


def drop_index(spark: SparkSession, name: str, ingests: Collection[tuple[str, str]]) -> None:
    if spark.catalog.tableExists(index_table(name)):
        manifest.drop_ingests(spark, index_table(name), ingests)


def probe(candidates: DataFrame, spark: SparkSession, name: str, ingests: Collection[manifest.Live], id_col: str = "match_id") -> DataFrame:
    """(id, platform, ingest): every indexed ingest that may hold a candidate.

    A candidate meets, per size of index, the one block its hash falls into.
    """
    indexed = [x for x in ingests if x.level is not None]
    if not indexed:
        return candidates.select(id_col, F.lit("").alias("platform"), F.lit("").alias(manifest.INGEST)).limit(0)
    levels = spark.createDataFrame(sorted({(x.platform, x.ingest, x.level) for x in indexed}), "platform string, ingest string, level int")
    wanted = candidates.select(id_col).filter(F.col(id_col).isNotNull()).distinct()
    sizes = sorted({x.level for x in indexed})
    probes = wanted.withColumn("level", F.explode(F.array(*map(F.lit, sizes)))).withColumn("block", _block(id_col, F.col("level")))
    spark.catalog.refreshTable(index_table(name))
    blocks = manifest.of_ingests(spark.table(index_table(name)), indexed).join(levels, ["platform", manifest.INGEST])
    # taken of the id where it meets its block, so that probes move without them
    hit = reduce(and_, [_is_set("bits", place) for place in _places(id_col)])
    return blocks.join(probes, ["level", "block"]).filter(hit).select(id_col, "platform", manifest.INGEST)


def ingests_hit(
    candidates: DataFrame, spark: SparkSession, name: str, ingests: Collection[manifest.Live], id_col: str = "match_id", many: bool = False
) -> set[tuple[str, str]]:
    """(platform, ingest) of the indexed ingests that may hold a candidate.

    Of `many` candidates some hit almost any ingest, be it by chance. One in PARTS of them, told by their hash, is probed
    first then; all meet the ingests that these did not hit. The result is the same either way.
    """
    hit: set[tuple[str, str]] = set()
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(id_col)), F.lit(PARTS)) == 0
    for some in [candidates.filter(part), candidates] if many else [candidates]:
        left = [x for x in ingests if x.level is not None and (x.platform, x.ingest) not in hit]
        if left:
            # at most one row per ingest
            hit |= {tuple(r) for r in probe(some, spark, name, left, id_col).select("platform", manifest.INGEST).distinct().collect()}
    return hit


def stored_ids(
    candidates: DataFrame, name: str, platform: str | None = None, ingests: Collection[manifest.Live] | None = None,
    id_col: str = "match_id",
) -> DataFrame:
    """Distinct candidate ids that are stored in the live ingests (or in those given), read from the ones that may hold them.

    Ingests that are hit are named to the scan, one literal each; their ids are semi-joined with the candidates.
    """
    spark = candidates.sparkSession
    ingests = manifest.resolved(spark, name) if ingests is None else ingests
    ingests = [x for x in ingests if platform in (None, x.platform)]
    named = ingests_hit(candidates, spark, name, ingests, id_col)
    opened = [x for x in ingests if x.level is None or (x.platform, x.ingest) in named]
    rows = manifest.of_ingests(spark.table(name), opened).select(id_col)
    return rows.join(candidates.select(id_col).distinct(), id_col, "left_semi").distinct()


def unseen_ids(candidates: DataFrame, name: str, platform: str | None = None, id_col: str = "match_id") -> DataFrame:
    """Candidate rows whose id no live ingest holds; duplicates, rows without id and other columns are kept."""
    return candidates.join(stored_ids(candidates, name, platform, id_col=id_col), id_col, "left_anti")
