"""Secrets: base spans against the plain patterns, the guess-cost program against all segmentations."""

import hashlib
import random
import re

import pytest

from match_lake.llm import secrets

PLAIN = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def plain(text):
    out = []
    for i, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text, re.A):
            size = len(m.group(2)) if kind == "assign" else len(m.group())
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), i, m.end()))
    return [(s, list(PLAIN)[i], e) for s, i, e in sorted(out)]


PIECES = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "ſecret", "toKen", "=", ":", " ", '"', "'", "é", "AKIA",
          "ABCDEFGH12345678", "abcdef0123456789abcdef0123456789", "hunter2hunter", "x", "\n", "deadbeef", "0" * 40]


def test_base_spans_are_the_patterns():
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(14)))
        assert [s[:3] for s in secrets.find_spans(text) if s[1] != "guess"] == plain(text), text


def cheapest(value, words=secrets.FIXED):
    """Over all ways to cut the value into patterns and brute-force spans."""
    found = list(secrets.segments(value, words))

    def best(i, in_brute):
        if i == len(value):
            return 0.0
        brute = secrets.char_bits(value[i]) + (0 if in_brute else secrets.SEGMENT) + best(i + 1, True)
        return min([brute, *[bits + secrets.SEGMENT + best(j, False) for a, j, bits, _ in found if a == i]])

    return best(0, False)


@pytest.mark.parametrize("value", ["password", "P4ssw0rd1", "qwerty", "aaaaaaa", "2021-03-04", "abcabcabc", "x9$Tq", "admin1234", "zxcv1999", "Zebra7"])
def test_guess_bits_is_the_cheapest_segmentation(value):
    assert secrets.guess_bits(value) <= cheapest(value) + 1.0 + 1e-9
    assert secrets.guess_bits(value) >= cheapest(value) - 1e-9


def test_placeholders_cost_less_than_keys():
    for weak in ("password123", "changeme", "qwertyuiop", "2021-01-01", "aaaaaaaaaaaaaaaaaaaaaaaa", "yoursecretkeyhere"):
        assert secrets.guess_bits(weak) < secrets.MIN_BITS, weak
    for strong in ("f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda", "Xk9$mQ2z!Lw7pR", "hV8fjW0qLz3Tn"):
        assert secrets.guess_bits(strong) >= secrets.MIN_BITS, strong


def test_guess_spans():
    (span,) = [s for s in secrets.find_spans("auth: Xk9$mQ2z!Lw7pR, ok") if s[1] == "guess"]
    assert span[0] == 6 and span[2] == 20


def test_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "token = abcdefgh", "c"), (3, "é token = abcdefgh", "d"), (3, "é token = abcdefgh", "d"), (4, "x " * 200_000 + "AKIA" + "Z" * 20, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = secrets.digests(secrets.find_secrets(docs), secrets.BASE)
    got = sorted((r.doc_id or 0, r.n_assign, r.n_access, r.n_hex, r.spans, r.base_sha256) for r in out.collect())
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1] == (1, 0, 0, 0, "", empty) and got[2] == (2, 0, 0, 0, "", empty)
    assert got[0][4] == "assign:0:16" and got[3] == got[4] and got[3][4] == "assign:2:18"
    assert got[3][5] == hashlib.sha256(b"assign:2:18").hexdigest()
    assert got[5][4] == "access:400000:400024"
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_query_over_the_whole_table(spark):
    from conftest import SF_DIR

    from match_lake.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    out = QUERIES["op1_secrets"](spark, SF_DIR).collect()
    assert {r.doc_id for r in out} == set(docs)
    for r in out:
        base = plain(docs[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, k, _ in base) for x in secrets.BASE]


def test_words_are_counted_over_the_documents(spark):
    prose = ["Authentication of the intermediate correct horse", "battery, staple; HORSE authentication", "the staple battery was correct", None, ""]
    rows = [(i, t) for i, t in enumerate(prose * 6)] + [(99, "token: qzvhxkwplmtr qzvhxkwplmtr qzvhxkwplmtr qzvhxkwplmtr qzvhxkwplmtr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = secrets.count_words(docs)
    counted = list(words.rank)[len(secrets.FIXED.rank):]
    # in twelve documents, then in six; the fixed ones are not repeated, nor is a word of one document only
    assert counted == ["authentication", "battery", "correct", "horse", "staple", "intermediate", "was"]
    assert list(secrets.count_words(docs, at_most=2).rank)[-1] == "battery" and secrets.count_words(docs.limit(0)) == secrets.FIXED
    for text in ("auth: authentication", "token: intermediate", "token: 'correcthorse'"):
        assert [s[1] for s in secrets.find_spans(text, words=words) if s[1] == "guess"] == [], text
    (span,) = [s for s in secrets.find_spans("token: qzvhxkwplmtr", words=words) if s[1] == "guess"]
    assert span[3] > 50


def test_quoted_values_run_to_the_closing_quote():
    words = secrets.ranked([*secrets.COMMON, "correct", "horse", "battery", "staple", *(f"w{i}" for i in range(5000))])
    text = 'password = "correct horse battery staple" and more'
    for known in (secrets.FIXED, words):
        (span,) = [s for s in secrets.find_spans(text, words=known) if s[1] == "guess"]
        assert text[span[0] : span[2]] == "correct horse battery staple"
    plain = {kind for _, _, _, kind in secrets.segments("correct horse battery staple", words)}
    assert plain == {"word"} and secrets.guess_bits("correct horse battery staple", words) < secrets.guess_bits("correct horse battery staple")
    assert [s for s in secrets.find_spans('secret: "the test"', words=words) if s[1] == "guess"] == []
    assert [s for s in secrets.find_spans('secret: "open\nsecond line with more words"', words=words) if s[1] == "guess"] == []


@pytest.mark.parametrize("value", ["correct horse", "horsebattery9", "St4ple!horse", "battery staple 2021"])
def test_guess_bits_with_counted_words(value):
    words = secrets.ranked([*secrets.COMMON, "correct", "horse", "battery", "staple", "ple", "hor"])
    assert cheapest(value, words) - 1e-9 <= secrets.guess_bits(value, words) <= cheapest(value, words) + 1.0 + 1e-9
