"""Native tables and documents derived, row by row, from the generated tables.

Nothing here groups or collects: each document is built from one input row, so
the stand-ins grow with the tables and cost no shuffle but that of the rows they are built from.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.moments import instant
from match_lake.session import pin_utc, scratch_dir

PLATFORM = "br1"
AS_OF = "2024-01-30 12:00:00"
FETCHED_AT = "2024-02-01 06:00:00"

# event type -> platform code; the last one is no platform
EVENT_PLATFORMS = {"view": "br1", "click": "na1", "purchase": "kr", "signup": "euw1", "error": "xx9"}
FLAG_QUEUES = {"R": 420, "A": 440, "N": 450}
POSITIONS = ("TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY")
OTHER_EVENTS = ("ITEM_PURCHASED", "WARD_PLACED", "CHAMPION_KILL", "LEVEL_UP")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, per_core: int = 1) -> DataFrame:
    """Rows that are about to grow into documents, dealt evenly over all cores.

    How many parts a scan has tells nothing: a row group goes to one of them whole, and a file may hold all its rows in one.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(per_core * cores, df.rdd.getNumPartitions()))


def lookup(mapping: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[key]


def prefixed(prefix: str, key: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(key) if isinstance(key, str) else key).cast("string"))


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def ladder(spark: SparkSession, sf_dir: str, platform: str | None = PLATFORM) -> DataFrame:
    """league_entries: every event is one account's row in a snapshot."""
    tier = F.element_at(schemas.string_array(schemas.TIERS), F.pmod(prop_k(), F.lit(10)) + 1)
    division = F.element_at(schemas.string_array(schemas.DIVISIONS), F.pmod("event_id", F.lit(4)).cast("int") + 1)
    return table(spark, sf_dir, "events").select(
        prefixed("acct-", "user_id").alias("puuid"),
        (lookup(EVENT_PLATFORMS, F.col("event_type")) if platform is None else F.lit(platform)).alias("platform"),
        F.lit("RANKED_SOLO_5x5").alias("queue_type"),
        tier.alias("tier"),
        F.when(tier.isin(*schemas.APEX_TIERS), F.lit(schemas.APEX_DIVISION)).otherwise(division).alias("division"),
        F.floor("value").cast("int").alias("league_points"),
        prop_k().alias("wins"),
        (F.lit(100) - prop_k()).alias("losses"),
        F.lit(False).alias("inactive"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )


def checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """listed_accounts: an account was listed whenever it viewed something."""
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "view").select(
        prefixed("acct-", "user_id").alias("puuid"),
        F.lit(PLATFORM).alias("platform"),
        F.col("ts").cast("timestamp").alias("listed_at"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which part (account) appears in which order (match)."""
    return table(spark, sf_dir, "lineitem").select(
        prefixed("acct-", "l_partkey").alias("account"),
        prefixed("M_", "l_orderkey").alias("match_id"),
        F.col("l_shipdate").cast("timestamp").alias("played_at"),
        lookup(FLAG_QUEUES, F.col("l_returnflag")).alias("queue_id"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(prefixed("acct-", "p_partkey").alias("puuid"))


def stored_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids already stored: the finished orders."""
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        prefixed("M_", "o_orderkey").alias("match_id"), F.lit(PLATFORM).alias("platform")
    )


def stored_timelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As stored_matches, the urgent ones missing."""
    finished = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
    return table(spark, sf_dir, "orders").filter(finished).select(
        prefixed("M_", "o_orderkey").alias("match_id"), F.lit(PLATFORM).alias("platform")
    )


def _player(seat: Column, rendition: str) -> Column:
    order, customer = F.col("o_orderkey"), F.col("o_custkey")

    def number(expr: Column, below: int) -> Column:
        return F.pmod(expr, F.lit(below)).cast("int")

    return F.struct(
        prefixed("player", customer * 10 + seat).alias("riotIdGameName"),
        F.lit("BR1").alias("riotIdTagline"),
        F.concat(F.lit(f"{rendition}-"), order.cast("string"), F.lit("-"), seat.cast("string")).alias("puuid"),
        F.concat(F.lit(f"s-{rendition}-"), order.cast("string")).alias("summonerId"),
        F.when(seat <= 5, 100).otherwise(200).alias("teamId"),
        F.element_at(schemas.string_array(POSITIONS), (F.pmod(seat - 1, F.lit(5)) + 1).cast("int")).alias("teamPosition"),
        number(customer + seat, 160).alias("championId"),
        prefixed("Champion", number(customer + seat, 160)).alias("championName"),
        number(order + seat, 17).alias("kills"),
        number(order * 3 + seat, 13).alias("deaths"),
        number(order * 5 + seat, 19).alias("assists"),
        number(order * 7 + seat, 301).alias("totalMinionsKilled"),
        (F.floor("o_totalprice") + seat).cast("int").alias("goldEarned"),
        (F.floor("o_totalprice") * 2 + seat).cast("int").alias("totalDamageDealtToChampions"),
        number(order * 11 + seat, 97).alias("visionScore"),
        ((seat <= 5) == (F.col("o_orderstatus") == "F")).alias("win"),
    )


def match_info(participants: Column | None = None) -> Column:
    fields = [
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("gameCreation"),
        (F.pmod("o_custkey", F.lit(1800)) + 900).alias("gameDuration"),
        F.when(F.col("o_orderstatus") == "F", 420).otherwise(450).alias("queueId"),
        (F.pmod("o_orderkey", F.lit(3)) + 10).cast("int").alias("mapId"),
        F.concat(F.lit("14."), F.month("o_orderdate").cast("string")).alias("gameVersion"),
    ]
    return F.struct(*fields, *([] if participants is None else [participants.alias("participants")]))


# Parts a core has of documents with players or minutes, so that a slow core does not hold up the others.
PARTS = 4


def _bronze(df: DataFrame, match_id: Column, payload: Column, per_core: int = 1) -> DataFrame:
    return spread(df, per_core).select(
        match_id.alias("match_id"), F.lit(PLATFORM).alias("platform"), instant(FETCHED_AT).alias("fetched_at"),
        payload.alias("payload"),
    )


_STORED: dict[tuple, str] = {}
# How they are written. A reader holds up to 4,096 rows of a row group at once, so a group is kept to few documents, whatever they weigh.
STORED_AS = {"compression": "zstd", "parquet.block.row.count.limit": 128, "parquet.block.size": 2 << 20, "parquet.page.size.row.check.min": 4}


def stored_once(build):
    """Documents written once per application and table, so that queries over them measure their operator."""
    @functools.wraps(build)
    def read(spark: SparkSession, sf_dir: str, *args, **options) -> DataFrame:
        key = (spark.sparkContext.applicationId, build.__name__, sf_dir, args, tuple(options.items()))
        if key not in _STORED:
            path = scratch_dir(spark, build.__name__)
            build(spark, sf_dir, *args, **options).write.options(**STORED_AS).parquet(path)
            _STORED[key] = path
        return spark.read.parquet(_STORED[key])

    return read


def match_docs(spark: SparkSession, sf_dir: str, rendition: str = "k1", players: int = 10) -> DataFrame:
    """Bronze matches: an order is a match; `rendition` is the key it was fetched with.

    Not stored: the documents are some 25 times the size of their orders.
    """
    seats = F.sequence(F.lit(1), F.lit(players))
    people = F.transform(seats, lambda seat: _player(seat, rendition))
    names = F.transform(seats, lambda seat: F.concat(F.lit(f"{rendition}-"), seat.cast("string")))
    match_id = prefixed("M_", "o_orderkey")
    meta = F.struct(match_id.alias("matchId"), names.alias("participants"))
    return _bronze(
        table(spark, sf_dir, "orders"), match_id,
        F.to_json(F.struct(meta.alias("metadata"), match_info(people).alias("info"))), PARTS,
    )


def match_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze matches without their players."""
    match_id = prefixed("M_", "o_orderkey")
    doc = F.to_json(F.struct(F.struct(match_id.alias("matchId")).alias("metadata"), match_info().alias("info")))
    return _bronze(table(spark, sf_dir, "orders"), match_id, doc)


def damaged_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As match_headers, with text for a duration where the order is pending and a cut-off end where it is open."""
    match_id = prefixed("M_", "o_orderkey")
    whole = F.to_json(F.struct(F.struct(match_id.alias("matchId")).alias("metadata"), match_info().alias("info")))
    # Out of a generator: a filter on documents would otherwise be pushed below the dealing out, and they be built where their file is read.
    built = F.explode(F.array(F.struct(F.col("o_orderstatus").alias("status"), whole.alias("doc"))))
    status, doc = F.col("payload.status"), F.col("payload.doc")
    payload = (
        F.when(status == "P", F.regexp_replace(doc, r'"gameDuration":\d+', '"gameDuration":"n/a"'))
        .when(status == "O", F.substr(doc, F.lit(1), F.length(doc) - 1))
        .otherwise(doc)
    )
    return _bronze(table(spark, sf_dir, "orders"), match_id, built).withColumn("payload", payload)


def _frame(word: Column, minute: Column) -> Column:
    size = F.length(word)
    seats = F.sequence(F.lit(1), F.when(size == 1, 9).otherwise(10))
    stats = F.map_from_entries(F.transform(seats, lambda p: F.struct(
        p.cast("string").alias("key"),
        F.struct(
            (minute * 100 + size * p + 500).alias("totalGold"),
            (minute * p).alias("xp"),
            F.pmod(size + p, F.lit(7)).alias("minionsKilled"),
        ).alias("value"),
    )))

    def event(kind: Column, nth: int) -> Column:
        kill = kind == schemas.CHAMPION_KILL

        def seat(ahead: int) -> Column:
            return F.pmod(minute + ahead, F.lit(10)) + 1

        return F.struct(
            kind.alias("type"),
            (minute.cast("bigint") * 60000 + nth).alias("timestamp"),
            F.when(kill, seat(0)).alias("killerId"),
            F.when(kill, seat(5)).alias("victimId"),
            F.when(kill, F.array(seat(1), seat(2))).alias("assistingParticipantIds"),
            F.when(kill, F.struct((minute * 10).alias("x"), (size * 10).alias("y"))).alias("position"),
        )

    first = event(F.element_at(schemas.string_array(OTHER_EVENTS), F.pmod(size, F.lit(4)) + 1), 0)
    second = event(F.lit(schemas.CHAMPION_KILL), 1)
    none, one, two = F.slice(F.array(first), 1, 0), F.array(first), F.array(first, second)
    happened = F.when(size == 0, none).when(size > 6, two).otherwise(one)
    return F.struct(stats.alias("participantFrames"), happened.alias("events"))


@stored_once
def timeline_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze timelines: a turn of a conversation is a match, each of its words a minute."""
    match_id = prefixed("M_", F.col("conv_id") * 10 + F.col("turn"))
    frames = F.transform(F.split("text", " "), lambda word, minute: _frame(word, minute))
    doc = F.struct(F.struct(match_id.alias("matchId")).alias("metadata"), F.struct(frames.alias("frames")).alias("info"))
    return _bronze(table(spark, sf_dir, "conversations"), match_id, F.to_json(doc), PARTS)


def ladder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ladder pages of two entries, the second holding nothing but its account."""
    tier = F.element_at(schemas.string_array(schemas.TIERS), F.pmod(prop_k(), F.lit(10)) + 1)
    full = F.struct(
        prefixed("acct-", "event_id").alias("puuid"),
        F.lit("RANKED_SOLO_5x5").alias("queueType"),
        tier.alias("tier"),
        F.lit("I").alias("rank"),
        F.floor("value").cast("int").alias("leaguePoints"),
        prop_k().alias("wins"),
        F.col("user_id").cast("int").alias("losses"),
        (F.col("event_type") == "error").alias("inactive"),
    )
    bare = F.struct(
        prefixed("bare-", "event_id").alias("puuid"),
        *[F.lit(None).cast(t).alias(n) for n, t in (
            ("queueType", "string"), ("tier", "string"), ("rank", "string"), ("leaguePoints", "int"),
            ("wins", "int"), ("losses", "int"), ("inactive", "boolean"),
        )],
    )
    return table(spark, sf_dir, "events").select(F.to_json(F.array(full, bare)).alias("value"))


def id_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account texts as typed by people: two names, blanks around them, one entry empty."""
    name, tag = F.col("c_name"), F.col("c_mktsegment")
    spec = F.concat(
        name, F.lit("#"), tag, F.lit(" , other "), F.col("c_custkey").cast("string"), F.lit("#A#B,,no tag "),
        F.col("c_nationkey").cast("string"),
    )
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("request"), spec.alias("spec"))
