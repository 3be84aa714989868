"""Small corpora with every odd case: nulls, empties, repeats, long texts, near copies, shared passages."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, component_id string, _text string"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 7))) for _ in range(n))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10**6))
    return " ".join(words)


def odd_texts(seed=1):
    """(doc_id, text) rows: ids in no order, some null, some repeated with equal and unequal texts."""
    rng = random.Random(seed)
    passage, line = sentence(rng, 45), "this line is in very many of the documents here"
    texts = [None, "", " \t\n", "a", "a b", "A b", "a b", "a  b\tc", "a b c ", "a b c", "of " * 300, "of " * 290]
    base = [sentence(rng, rng.randrange(30, 120)) for _ in range(8)]
    texts += base + [base[0], base[0].upper(), base[1].replace(" ", "\n  ")]
    texts += [edited(rng, rng.choice(base), rng.randrange(0, 6)) for _ in range(50)]
    texts += [f"{sentence(rng, rng.randrange(0, 60))} {passage} {line}\n{sentence(rng, rng.randrange(0, 60))}".strip() for _ in range(12)]
    texts += [f"{passage} {passage}", sentence(rng, 18), sentence(rng, 19), sentence(rng, 20), sentence(rng, 21), sentence(rng, 20_000), "é" * 50 + " " + passage]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    rows += [(None, base[2]), (None, None), (None, sentence(rng, 40)), rows[5], rows[20], (rows[3][0], "another text under an id that is taken"), (-7, base[3])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, partitions=3):
    """A table of documents with the rows, and other columns whose names the operators use as well."""
    wide = [(i, t, "en", ["s1", "s2", None][(i or 0) % 3], len(t or ""), 5, "c", "t") for i, t in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(partitions)
