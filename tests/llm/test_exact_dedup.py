import hashlib
import re
from collections import defaultdict

from corpora import frame, odd_texts

from match_lake.llm import exact_dedup


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[normal(t)]
        keep = i if len(ids) == 1 else min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_marks(spark):
    rows = odd_texts()
    assert sorted(map(tuple, exact_dedup.mark_copies(frame(spark, rows)).collect()), key=repr) == expected(rows)


def test_equal_beginnings_are_told_apart(spark):
    rows = [(i, "x" * 300 + c) for i, c in enumerate("abab")] + [(9, "x" * 300)]
    assert sorted(map(tuple, exact_dedup.mark_copies(frame(spark, rows)).collect()), key=repr) == expected(rows)


def test_drop_keeps_columns(spark):
    rows = odd_texts()
    docs = frame(spark, rows)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((i, t) for (i, t) in rows if i == dict_keep(rows)[normal(t)]), key=repr)


def dict_keep(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    return {t: ids[0] if len(ids) == 1 else min((x for x in ids if x is not None), default=None) for t, ids in groups.items()}


def test_empty_table(spark):
    docs = frame(spark, odd_texts()).limit(0)
    assert exact_dedup.mark_copies(docs).count() == 0 and exact_dedup.drop_copies(docs).count() == 0
