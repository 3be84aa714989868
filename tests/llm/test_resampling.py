"""Importance weights and draws against plain counting."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from corpora import frame, odd_texts

from match_lake.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=5, least=20):
    def by_bucket(texts):
        return Counter(crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])

    s, t = by_bucket(x for _, x in rows), by_bucket(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, text in rows:
        n, found = features(text)
        weight = sum(gain[crc32(f.encode()) % 10000] for f in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = {id(r): k for k, r in enumerate(fit[: len(fit) * percent // 100], 1)}
    return sorted(((*r[:4], drawn.get(id(r))) for r in out), key=repr)


def run(spark, rows, target, **options):
    wanted = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "doc_id long, text string")
    found = resampling.resample(frame(spark, rows), wanted, **options)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_odd_texts(spark):
    rows = odd_texts()
    rows += [(1000, "Ünïcode WORDS é_è a-b 3.5 x\x00y\x7fz İ K"), (1001, "word " * 5000), (1002, "\U0001f600 " * 40)]
    target = [rows[3][1], rows[9][1], None, "", "of the of the"]
    for percent in (5, 60):
        assert run(spark, rows, target, percent=percent) == brute(rows, target, percent)


def test_draws_with_ties(spark):
    text = "some words that are the same in every one of these documents " * 3
    rows = [(7, text)] * 40 + [(i, text) for i in range(20)] + [(None, text)] * 3
    got, want = run(spark, rows, [text], percent=50), brute(rows, [text], 50)
    assert got == want and sum(r[4] is not None for r in got) == 31


def test_empty_tables(spark):
    rows = odd_texts()
    assert run(spark, rows, []) == brute(rows, [])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(empty, frame(spark, rows)).count() == 0


def test_bit_planes_give_the_plain_sum():
    rng = np.random.default_rng(3)
    for deep in (1, 2, 9, 40_000):
        counts, gains = rng.integers(0, deep, 10_000), rng.integers(-deep, deep, 10_000)
        assert resampling.plane_sum(counts, *resampling.signed_planes(gains)) == int(counts @ gains)
    assert resampling.plane_sum(np.zeros(10_000, np.int64), *resampling.signed_planes(gains)) == 0


def test_blocks_do_not_cut_runs():
    rng = random.Random(5)
    text = " ".join(rng.choice(["a", "bb", "ccc", "dd-e", "é"]) for _ in range(500)).encode()
    n, whole = resampling.bucket_counts(text)
    for size in (1, 2, 7, 64, 10_000):
        words, counts = resampling.bucket_counts(text, size=size)
        assert words == n and (counts == whole).all()
    assert n == len(WORD.findall(text.decode()))
