"""The account listing stored by account, so that a join of accounts to their matches leaves it where it is.

The listing is the largest table a crawl reads, and who is to be listed can be too many to broadcast. Here it lies in
buckets of (account, part), sorted: the accounts are dealt into the same buckets and merged with it, and the
listing has no exchange of its own. `part` splits an account's matches by a hash of the match, so an account with a
large share of all rows fills PARTS buckets, not one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.sources.tables import empty, qualified

TABLE = "account_listing"
PART = "part"
PARTS = 16
COLUMNS = [c.split()[0] for c in schemas.LISTING.split(", ")]


def append_listing(listing: DataFrame, database: str, buckets: int | None = None, fmt: str = "parquet") -> None:
    """Append (account, match_id, played_at, queue_id). The number of buckets is settled by the first append.

    A bucket is written by one task, so an append adds one file per bucket. Rows without account or match are left out.
    """
    spark = listing.sparkSession
    name = qualified(database, TABLE)
    known = _buckets(spark, name) if spark.catalog.tableExists(name) else None
    buckets = known or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = listing.filter(F.col("account").isNotNull() & F.col("match_id").isNotNull()).select(*COLUMNS, _part().alias(PART))
    dealt = rows.repartition(buckets, "account", PART)
    dealt.write.format(fmt).bucketBy(buckets, "account", PART).sortBy("account", PART, "match_id").mode("append").saveAsTable(name)


def _part():
    return F.pmod(F.xxhash64("match_id"), F.lit(PARTS)).cast("int")


def _buckets(spark: SparkSession, name: str) -> int:
    told = spark.sql(f"describe table extended {name}").filter("col_name = 'Num Buckets'").first()
    return int(told["data_type"])


def read_listing(spark: SparkSession, database: str) -> DataFrame:
    """The listing with its `part`, by which the crawl's operators join it in place; no rows if nothing is stored."""
    name = qualified(database, TABLE)
    if not spark.catalog.tableExists(name):
        return empty(spark, f"{schemas.LISTING}, {PART} int")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def by_part(accounts: DataFrame) -> DataFrame:
    """Each account once for every part its matches are split into."""
    return accounts.withColumn(PART, F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
