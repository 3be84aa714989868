"""Session helpers: sane defaults, UTC, a shared scratch folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Timeline documents run to hundreds of KB: smaller splits keep the number
    # of parsed documents held by one task low.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "match_lake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, which the cluster names in spark.checkpoint.dir.

    Where the setting is missing, a session whose executor is this very process gets a
    temporary folder of its own; on a cluster the setting is asked for, since a folder
    of one machine is of no use to the others.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        root = tempfile.mkdtemp(prefix="match_lake-")
        context.setCheckpointDir(root)
        _LOCAL_ROOTS[context.applicationId] = root
    return _LOCAL_ROOTS[context.applicationId]


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the shared scratch folder."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str = "step") -> DataFrame:
    """Write an intermediate that several later steps read, and read it back.

    The copy lies in the shared folder, so it outlives lost executors.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
