"""Documents that arrive as files: match details, timelines, ladder pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake import schemas
from match_lake.functions.moments import instant

MATCH_ID = "$.metadata.matchId"


def read_documents(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """(value, file_path, file_name) for every document below a folder.

    One document per file, or one per line. Many small files cost a listing and a
    task's time each, so producers that can should write lines.
    """
    files = spark.read.text(path, wholetext=whole_files, recursiveFileLookup=True)
    return files.select("value", *file_columns())


def file_columns() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")]


def document_id(value: str | Column = "value", file_name: str | Column | None = "file_name") -> Column:
    """The match id the document names, else the name of its file without extension."""
    named = F.get_json_object(value, MATCH_ID)
    if file_name is None:
        return named
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return F.coalesce(named, F.nullif(stem, F.lit("")))


def to_bronze(
    documents: DataFrame, platform: str, fetched_at: datetime | str | None = None, id_from_file: bool = True
) -> DataFrame:
    """(match_id, platform, fetched_at, payload), the text kept as it arrived.

    One fetch time for the whole call. Documents without an id are left to
    landing_rejects.
    """
    stamp = F.current_timestamp() if fetched_at is None else instant(fetched_at)
    rows = documents.select(
        document_id("value", "file_name" if id_from_file else None).alias("match_id"),
        F.lit(platform).alias("platform"),
        stamp.alias("fetched_at"),
        F.col("value").alias("payload"),
    )
    return rows.filter(F.col("match_id").isNotNull())


def landing_rejects(documents: DataFrame, id_from_file: bool = True) -> DataFrame:
    return documents.filter(document_id("value", "file_name" if id_from_file else None).isNull())


def land_payloads(
    spark: SparkSession,
    path: str,
    platform: str,
    fetched_at: datetime | str | None = None,
    whole_files: bool = True,
) -> DataFrame:
    return to_bronze(read_documents(spark, path, whole_files), platform, fetched_at, id_from_file=whole_files)


def parse_ladder_page(
    pages: DataFrame, platform: str, fetched_at: datetime | str | None = None, value: str = "value"
) -> DataFrame:
    """Ladder pages (JSON arrays) to league_entries rows, one per entry.

    Only the account id is required; entries without one are left to
    ladder_rejects, and pages that are no ladder page to page_rejects. An empty page, the end
    of a bucket, gives nothing.
    """
    stamp = F.current_timestamp() if fetched_at is None else instant(fetched_at)
    entries = _entries(pages, value).withColumnsRenamed(schemas.LADDER_RENAMES)
    entries = entries.withColumns({"platform": F.lit(platform), "fetched_at": stamp})
    columns = [c.split()[0] for c in schemas.TABLES[schemas.LEAGUE_ENTRIES].split(", ")]
    return entries.filter(F.col("puuid").isNotNull()).select(*columns)


def ladder_rejects(pages: DataFrame, value: str = "value") -> DataFrame:
    return _entries(pages, value).filter(F.col("puuid").isNull())


def page_rejects(pages: DataFrame, value: str = "value") -> DataFrame:
    """Pages that are not JSON ("malformed") or hold values of the wrong type ("wrong type"), with the reason."""
    columns = schemas.LADDER_PAGE.removeprefix("array<struct<").removesuffix(">>")
    names = [c.split(":")[0] for c in columns.split(", ")]
    loose = f"array<struct<{', '.join(f'{n}: string' for n in names)}>>"

    def given(entries: Column) -> Column:
        return F.transform(entries, lambda e: F.array(*[e[n].isNotNull() for n in names]))

    # In generators, so that the filter does not read pages once more; what is no JSON is not read as a page at all.
    is_json = F.coalesce(F.try_parse_json(value).isNotNull(), F.lit(False))
    read = pages.withColumn("_is_json", F.explode(F.array(is_json)))
    both = F.struct(F.from_json(value, loose).alias("texts"), F.from_json(value, schemas.LADDER_PAGE).alias("typed"))
    read = read.withColumn("_read", F.explode(F.array(F.when(F.col("_is_json"), both))))
    texts, typed = F.col("_read.texts"), F.col("_read.typed")
    reason = F.when(texts.isNull(), F.lit("malformed")).when(typed.isNull() | (given(texts) != given(typed)), F.lit("wrong type"))
    return read.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_is_json", "_read")


def _entries(pages: DataFrame, value: str) -> DataFrame:
    return pages.select(F.inline(F.from_json(value, schemas.LADDER_PAGE)))
