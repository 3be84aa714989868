"""Each operator as a query over its whole table: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake.llm import exact_dedup, jaccard, licenses, linededup, mixing, packing, pii, quality, resampling, secrets, substring, topk, whitening
from match_lake.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, words=secrets.count_words(docs))
    return secrets.digests(found, secrets.BASE)


@query
def op2_length_buckets(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op3_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal(docs, pii.train(docs))
    return secrets.digests(found, pii.BASE)


@query
def op4_ngram_jaccard(spark, sf_dir):
    found = jaccard.similar_components(table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op5_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


@query
def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


@query
def op7_byte_convolution_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.is_held_out("doc_id").alias("held_out"), quality.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= quality.KEEP_FROM, 1).otherwise(0))


@query
def op8_lempel_ziv_repeats(spark, sf_dir):
    return substring.repeats(table(spark, sf_dir, "documents")).drop("factors")


@query
def op9_license_notices(spark, sf_dir):
    return licenses.summary(licenses.find_licenses(table(spark, sf_dir, "documents"), windows=True))


@query
def op10_curriculum_mix(spark, sf_dir):
    # narrow, and read for the copies and for the documents
    plan = cut_lineage(mixing.plan_mix(table(spark, sf_dir, "documents")), "plan")
    return mixing.scheduled(plan).select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "taken", "first_position"
    )


@query
def op11_importance_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = linededup.drop_common_lines(docs, batches=linededup.file_batches(docs))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


@query
def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
