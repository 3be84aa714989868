import pyarrow as pa
import pyarrow.parquet as pq
from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

from workload import standins


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """A scan may have many parts and all rows in one of them; documents are built in all."""
    turns = {"conv_id": list(range(4000)), "turn": [1] * 4000, "role": ["user"] * 4000, "text": [f"word {i} again" for i in range(4000)]}
    pq.write_table(pa.table(turns), f"{tmp_path}/conversations.parquet")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4k")
    try:
        scanned = standins.table(spark, str(tmp_path), "conversations")
        assert scanned.rdd.getNumPartitions() > 4
        assert scanned.groupBy(F.spark_partition_id()).count().count() == 1
        dealt = standins.spread(scanned).groupBy(F.spark_partition_id().alias("part")).count().collect()
    finally:
        spark.conf.set(size, before)
    assert len(dealt) >= 4
    assert max(r["count"] for r in dealt) <= 2 * 4000 / len(dealt)


def test_documents_that_are_filtered_are_built_after_they_are_dealt_out(spark):
    again = standins.damaged_headers(spark, SF_DIR).filter(F.get_json_object("payload", "$.info.gameDuration") == "n/a")
    built, _, scanned = plan_of(again).partition("Exchange")
    assert "json" in built.lower() and "json" not in scanned.lower()


def row_groups(df):
    """(rows, bytes) of every row group of the files a table is read from."""
    files = [pq.read_metadata(f.removeprefix("file://")) for f in df.inputFiles()]
    return [(m.row_group(i).num_rows, m.row_group(i).total_byte_size) for m in files for i in range(m.num_row_groups)]


def test_stored_documents_are_read_a_few_at_a_time(spark, tmp_path):
    """A batch of the reader is 4,096 rows or a row group, whatever they weigh."""
    n = 6000
    turns = {"conv_id": list(range(n)), "turn": [1] * n, "role": ["user"] * n, "text": [f"word {i}" for i in range(n)]}
    pq.write_table(pa.table(turns), f"{tmp_path}/conversations.parquet")
    docs = standins.timeline_docs(spark, str(tmp_path))
    assert max(rows for rows, _ in row_groups(docs)) <= 128
    assert docs.count() == docs.select("match_id").distinct().count() == n


def test_stored_documents_of_any_length_are_read_a_few_at_a_time(spark, tmp_path):
    @standins.stored_once
    def long_documents(spark, sf_dir):
        part = lambda i: F.sha2(F.concat_ws("-", "id", i), 512)
        return spark.range(0, 40, 1, 1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8000)), part), "").alias("payload"))

    docs = long_documents(spark, str(tmp_path))
    assert sum(rows for rows, _ in row_groups(docs)) == 40
    assert max(size for _, size in row_groups(docs)) < 16 << 20
