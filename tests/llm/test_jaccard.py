import random
from collections import Counter, defaultdict

import pytest
from corpora import edited, frame, odd_texts, sentence
from pyspark.sql import functions as F

from match_lake.llm import jaccard
from match_lake.llm.components import component_labels
from match_lake.llm.steps import Steps


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def expected(rows, k, percent):
    """(id, n, component) by testing every pair of sets."""
    sets = [shingle_set(t, k) for _, t in rows]
    kinds = list({s for s in sets if s})
    parent = {s: s for s in kinds}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if len(a & b) * 100 >= percent * len(a | b):
                parent[root(a)] = root(b)
    lowest = defaultdict(list)
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            lowest[root(s)].append(i)
    return sorted(((i, len(s), min(lowest[root(s)], default=None) if s else i) for (i, _), s in zip(rows, sets)), key=repr)


def found(docs, **options):
    rows = jaccard.similar_components(docs, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (2, 60)])
def test_against_all_pairs(spark, k, percent):
    rows = odd_texts()
    assert found(frame(spark, rows), k=k, percent=percent) == expected(rows, k, percent)


def test_large_group_of_near_copies_and_a_common_passage(spark):
    rng = random.Random(8)
    center, passage = sentence(rng, 100), sentence(rng, 30)
    texts = [edited(rng, center, rng.randrange(0, 12)) for _ in range(250)]
    texts += [f"{sentence(rng, rng.randrange(5, 90))} {passage}" for _ in range(120)]
    texts += [" ".join(center.split()[: 100 - i]) for i in range(12)]
    rows = list(enumerate(texts))
    assert found(frame(spark, rows), k=3, percent=90) == expected(rows, 3, 90)
    assert found(frame(spark, rows), k=3, percent=90, extra=30, deepest=1) == expected(rows, 3, 90)


def test_one_of_each_group_stays(spark):
    rows = odd_texts()
    docs = frame(spark, rows)
    kept = jaccard.drop_similar(docs)
    assert kept.columns == docs.columns
    components = defaultdict(set)
    by_id = {(r[0], r[1]): r for r in found(docs)}
    left = Counter((r.doc_id, r.text) for r in kept.collect())
    assert set(left) <= set(rows)
    for i, t in set(rows):
        n = len(shingle_set(t, 5))
        component = by_id[(i, n)][2]
        if n:
            components[component].add((i, t))
        else:
            assert (i, t) in left
    for component, members in components.items():
        if component is not None:
            stay = [m for m in members if m in left]
            assert [m[0] for m in stay] == [component] or len({m[0] for m in members}) == 1, members


def test_one_of_repeated_rows_stays(spark):
    rng = random.Random(9)
    texts = [sentence(rng, 40) for _ in range(4)]
    rows = [(1, texts[0])] * 30 + [(2, texts[0])] * 2 + [(3, texts[1])] + [(None, texts[2])] * 3 + [(4, ""), (4, ""), (5, texts[3]), (5, texts[3])]
    docs = frame(spark, rows)
    other = docs.filter("doc_id = 5").limit(1).withColumn("lang", F.lit("xx"))
    docs = docs.unionAll(other)
    left = jaccard.drop_similar(docs)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(1, texts[0]), (3, texts[1]), (None, texts[2]), (4, ""), (5, texts[3])])
    again = jaccard.drop_similar(docs.repartition(7))
    assert Counter(map(tuple, left.collect())) == Counter(map(tuple, again.collect()))
    assert all(tuple(r) in set(map(tuple, docs.collect())) for r in left.collect())


def test_empty_table(spark):
    docs = frame(spark, odd_texts()).limit(0)
    assert found(docs) == [] and jaccard.drop_similar(docs).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    labels = dict(map(tuple, component_labels(spark.createDataFrame(links, "a long, b long"), Steps(spark)).collect()))
    assert labels == {x: root(x) for x in parent if root(x) != x}
