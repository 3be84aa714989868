"""From raw documents to packed training batches, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes to the
shared folder as Parquet and reads again for the next one. All but the last return the
columns of documents.

1. quality: documents whose score is below 0.3 go. Trained on the labels beside the documents.
2. exact_dedup: of texts equal up to white space the one with the smallest doc_id stays, with the
   rows that repeat it.
3. near_dedup: of documents linked by a Jaccard similarity of 0.8 on five-word shingles the one
   with the smallest doc_id stays, and of rows that repeat a doc_id and text a single one.
4. mixing: each source's documents come as often as its target asks, in training order.
5. packing: every row gets its length bucket, batch and place.

A classifier, components of links and batches are beyond SQL, so ORACLE_SQL is None; the
stages are tested against brute force in tests/llm.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from match_lake.llm import exact_dedup, jaccard, mixing, packing, quality  # noqa: E402
from match_lake.session import cut_lineage  # noqa: E402

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.filter(quality.score(model, F.col("text")) >= quality.KEEP_FROM)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_similar(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
