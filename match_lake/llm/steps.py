"""Intermediate tables of one operator in the shared folder, removed as soon as nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from match_lake.session import remove_folder, scratch_dir

# Shuffle files go when the table they were made for is written, not when the driver next collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Steps:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back; a lost executor costs nothing that was done before."""
        self.paths[name] = scratch_dir(self.spark, name)
        before = self.spark.conf.get(CLEAN_UP, "false")
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.parquet(self.paths[name])
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        return self.spark.read.schema(df.schema).parquet(self.paths[name])

    def rename(self, name: str, new: str) -> None:
        """Keep the table under another name; its folder stays where it is."""
        self.paths[new] = self.paths.pop(name)

    def remove(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, self.paths.pop(name))
