"""Every stage on what the stage before it kept, against brute force."""

import re
from collections import Counter, defaultdict

import pytest
from conftest import SF_DIR
from corpora import frame, odd_texts

import corpus_pipeline
from match_lake.llm import quality
from tests_of import near_components, size


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's output, written and read again."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    odd = frame(spark, [(None if i is None else i + 10_000, t) for i, t in odd_texts()]).select(*real.columns)
    spark.read.parquet(f"{SF_DIR}/documents.parquet").union(odd).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    out = {"documents": spark.read.parquet(f"{folder}/documents.parquet")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    out["folder"] = folder
    return out


def test_quality(spark, stages):
    model = quality.train(stages["documents"], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scored = stages["documents"].select("doc_id", "text", quality.score(model, stages["documents"]["text"]).alias("s")).collect()
    assert Counter(rows_of(stages["quality"])) == Counter((r.doc_id, r.text) for r in scored if r.s >= 0.3)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {i for i, _ in rows_of(stages["quality"])}
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.95 * sum(labels.values())


def test_exact_dedup(stages):
    groups = defaultdict(list)
    before = rows_of(stages["quality"])
    for i, t in before:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((i, t))
    want = Counter()
    for members in groups.values():
        lowest = min((i for i, _ in members if i is not None), default=None)
        want.update(members if len(members) == 1 else [m for m in members if m[0] == lowest])
    assert Counter(rows_of(stages["exact_dedup"])) == want


def test_near_dedup(stages):
    before = set(rows_of(stages["exact_dedup"]))
    left = set(rows_of(stages["near_dedup"]))
    assert left <= before
    for members in near_components(before, 5, 80):
        assert len(members & left) == 1
        ids = [i for i, _ in members if i is not None]
        assert not ids or next(iter(members & left))[0] == min(ids)


def test_mixing(stages):
    before, after = stages["near_dedup"].collect(), stages["mixing"].collect()
    sources = defaultdict(int)
    for r in before:
        sources[r.source] += size(r.text)
    taken, per_doc = defaultdict(int), defaultdict(int)
    for r in after:
        taken[r.source] += size(r.text)
        per_doc[r.doc_id] += size(r.text)
    own = defaultdict(int)
    for r in before:
        own[r.doc_id] += size(r.text)
    assert all(n <= 3 * own[i] for i, n in per_doc.items())
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    assert abs(sum(taken.values()) - sum(sources.values())) <= len(names)
    assert stages["mixing"].columns == stages["documents"].columns


def test_packing(stages):
    packed = stages["packing"].collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in packed), key=repr) == sorted(((i, size(t)) for i, t in rows_of(stages["mixing"])), key=repr)
    batches = defaultdict(list)
    for r in packed:
        batches[r.bucket, r.batch].append(r)
    assert all(len(b) * max(1, b[0].padded_length) <= max(65_536, b[0].padded_length) for b in batches.values())


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, stages["folder"])
    assert Counter((r.doc_id, r.n_tokens) for r in out.collect()) == Counter((r.doc_id, r.n_tokens) for r in stages["packing"].collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
