"""New files to stored documents, resumable and safe to repeat."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from match_lake.sources.landing import file_columns
from match_lake.sources.store import KINDS, check_kind, store_new
from match_lake.sources.tables import ensure_table


def read_landing_stream(
    spark: SparkSession, path: str, whole_files: bool = True, files_per_batch: int = 1_000
) -> DataFrame:
    """(value, file_path, file_name) of documents as they arrive."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    files = reader.text(path, wholetext=whole_files, recursiveFileLookup=True)
    return files.select("value", *file_columns())


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id kept beside a stream's checkpoint: made once, then the same for every run from that checkpoint."""
    path = f"{checkpoint.rstrip('/')}/landing_id"
    try:
        return spark.read.text(path).first()["value"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    made = uuid.uuid4().hex
    spark.range(1, numPartitions=1).selectExpr(f"'{made}' as value").write.text(path)
    return made


def stream_land(
    documents: DataFrame,
    database: str,
    kind: str,
    platform: str,
    checkpoint: str,
    name: str | None = None,
    fetched_at: datetime | str | None = None,
    whole_files: bool = True,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Store every document of a stream whose match is not stored yet, then stop.

    One stream per kind (matches, timelines), each with a checkpoint folder of its
    own. A batch is stored under the id kept in that folder and the number of the batch;
    run again after a crash it sees the same files and the same earlier batches, so
    it replaces what it wrote and the table ends up as if it had run once. A stream
    with another checkpoint has another id, so it never replaces anything of this one.

    The look-back is everything stored, not a watermark.
    """
    ensure_table(documents.sparkSession, database, check_kind(kind), fmt)
    stream = name or f"{kind}-{platform}"
    own = stream_id(documents.sparkSession, checkpoint)

    def store(batch: DataFrame, number: int) -> None:
        store_new(batch, database, kind, platform, f"{own}-{number}", fetched_at, whole_files, fmt)

    return (
        documents.writeStream.queryName(stream)
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_folders(
    spark: SparkSession, root: str, database: str, platform: str, state: str, whole_files: bool = True, **options
) -> dict[str, StreamingQuery]:
    """One stream for each of root/matches and root/timelines, by kind."""
    return {
        kind: stream_land(
            read_landing_stream(spark, f"{root}/{kind}", whole_files), database, kind, platform,
            f"{state}/{kind}", whole_files=whole_files, **options,
        )
        for kind in KINDS
    }
