import re
from collections import Counter

from corpora import frame, odd_texts

from match_lake.llm import licenses


def matches(text, percent=80):
    """Every unit against every template, without pruning."""
    plain = re.sub(r"[^\w\n]+|_+", " ", (text or "").lower())
    lines = [re.sub(r" +", " ", line).strip() for line in plain.split("\n")]
    units = [(i, line) for i, line in enumerate(lines, 1)]
    if len(lines) > 1:
        units.append((0, " ".join(line for line in lines if line)))
    out = set()
    for line, unit in units:
        words = unit.split()
        own = Counter(zip(words, words[1:]))
        for name, template in licenses.TEMPLATES:
            w = licenses.template_words(template)
            theirs = Counter(zip(w, w[1:]))
            score = 200 * sum((own & theirs).values()) // (sum(own.values()) + sum(theirs.values()))
            if score >= percent:
                out.add((name, line, score))
    return sorted(out)


def texts():
    mit = dict((n, t) for n, t in licenses.TEMPLATES if len(t) > 300)["MIT"]
    words = mit.split()
    return [
        (1, mit), (2, mit.upper()), (3, "Copyright 2020 A. B.\n\n" + mit), (4, " ".join(words[:60] + words[75:])),
        (5, "prose\nReleased under the MIT license\nmore prose"), (6, "Licensed under CC BY-NC 4.0."), (7, "licensed under cc by"),
        (8, "under the MIT"), (9, f"{mit} {mit}"), (10, "the of and " * 500), (11, "\n\n\n"), (12, "Licensed\nunder CC\nBY 4.0"),
    ]


def test_against_unpruned_comparison(spark):
    rows = [(i + 1000, t) for i, t in texts()] + odd_texts()
    got = licenses.find_licenses(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, [tuple(m) for m in r.matches]) for r in got), key=repr) == sorted(((i, matches(t)) for i, t in rows), key=repr)
    found = {r.doc_id: [m.license for m in r.matches] for r in got if (r.doc_id or 0) > 1000}
    assert all("MIT" in found[i] for i in (1001, 1002, 1003, 1004, 1005))


def wrapped(text, n=12):
    words = text.split()
    return "\n".join(" * " + " ".join(words[i : i + n]) for i in range(0, len(words), n))


def test_licences_within_longer_texts(spark):
    mit, zlib = (max((t for n, t in licenses.TEMPLATES if n == name), key=len) for name in ("MIT", "Zlib"))
    prose = "some words of prose about the software and its licence as is\n" * 40
    rows = [
        (1, f"/*\n{wrapped(mit)}\n */\n{prose}"), (2, f"{prose}{wrapped(zlib)}\n{prose}"), (3, f"{mit} {mit}"), (4, f"{wrapped(mit)}\n{prose}{wrapped(mit)}"),
        (5, "(c) 2020 X. Released under the MIT License. See LICENSE for more details."),
        (6, f"{prose}{wrapped(mit.replace('sublicense', 'sublicense or even rent'))}\n{prose}"), (7, prose), (8, "under the MIT, or so " * 9),
        (9, "prose\nReleased under the MIT license\nmore prose"), (10, mit), (11, None),
    ]
    docs = frame(spark, rows)
    got = {r.doc_id: [(m.license, m.line) for m in r.matches] for r in licenses.find_licenses(docs, windows=True).collect()}
    assert got == {
        1: [("MIT", 2)], 2: [("Zlib", 41)], 3: [("MIT", 1), ("MIT", 9)], 4: [("MIT", 1), ("MIT", got[4][1][1])], 5: [("MIT", 1)], 6: [("MIT", 41)], 7: [], 8: [],
        9: [("MIT", 2)], 10: [("MIT", 0)], 11: [],
    }
    plain = {r.doc_id: r.matches for r in licenses.find_licenses(docs).collect()}
    assert sorted(i for i in plain if plain[i]) == [9, 10]


def test_known_texts():
    assert all(matches(t) for i, t in texts() if i in (1, 2, 3, 4, 5, 6, 12))
    assert not any(matches(t) for i, t in texts() if i in (8, 9, 10, 11))


def test_empty_table(spark):
    assert licenses.summary(licenses.find_licenses(frame(spark, odd_texts()).limit(0))).count() == 0
