"""Common lines against plain counting, batch by batch."""

import random
from collections import Counter, defaultdict

import pytest
from corpora import frame, odd_texts

from conftest import plan_of
from match_lake.llm import linededup

ASCII = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(ASCII)


def common_keys(rows, least, least_chars=1):
    counts = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    return {k for k, n in counts.items() if n >= least and len(k) >= least_chars}


def brute(rows, least, least_chars=1):
    gone, out = common_keys(rows, least, least_chars), []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in gone]
        out.append((i, None if text is None else "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def lined_rows(seed=2):
    rng = random.Random(seed)
    pool = [f"Line {i} É" for i in range(60)] + ["", " ", "\t", "x", "é", "tail\r", " padded ", " "]
    rows = odd_texts()
    for i in range(200):
        lines = [rng.choice(pool) for _ in range(rng.randrange(0, 9))]
        lines = [rng.choice([x, x.upper(), f"  {x}\t", f"{x}\x0b"]) for x in lines]
        rows.append((1000 + i, "\n".join(lines + ["the same line in all"] * rng.randrange(0, 3))))
    rows += [rows[-1]] * 12 + [(None, "line 1 É\nnobody"), (5000, "\n".join(f"line {i % 50} É" for i in range(5000))), (5001, "\n\n\n")]
    return rows


def result(df):
    return sorted(map(tuple, df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


@pytest.mark.parametrize("least", [2, 10])
def test_in_one_batch(spark, least):
    rows = lined_rows()
    assert result(linededup.drop_common_lines(frame(spark, rows), least=least)) == brute(rows, least)


def test_in_many_batches(spark):
    rows = lined_rows(3)
    parts = [rows[i::7] for i in range(7)]
    batches = [frame(spark, part) for part in parts]
    got = linededup.drop_common_lines(frame(spark, rows), least=10, batches=batches, fanout=2)
    assert result(got) == brute(rows, 10)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_short_keys_stay(spark):
    rows = lined_rows()
    assert result(linededup.drop_common_lines(frame(spark, rows), least=2, least_chars=3)) == brute(rows, 2, 3)


def test_runs_by_level(spark):
    rows = lined_rows(4)
    runs = linededup.LineRuns(spark, least=4, fanout=3, buckets=4)
    seen = []
    for n, part in enumerate([rows[i::11] for i in range(11)], 1):
        runs.add(frame(spark, part))
        seen += part
        assert [len(level) for level in runs.levels[::-1]] == [(n // 3**k) % 3 for k in range(len(runs.levels))][::-1]
        if n in (3, 4, 11):
            assert {bytes(r.key) for r in runs.common().collect()} == {linededup.line_key(k.encode()) for k in common_keys(seen, 4)}
    per_run = [spark.table(name) for name in runs.runs()]
    assert "Exchange hashpartitioning" not in plan_of(runs.common())
    held = defaultdict(list)
    for at, run in enumerate(per_run):
        for r in run.collect():
            held[bytes(r.key)].append((at, r.docs))
    # once a run knows a key to be common, later runs leave it out
    assert all(sum(d >= 4 for _, d in found) <= 1 for found in held.values())
    runs.remove()


@pytest.mark.parametrize("codegen", ["true", "false"])
def test_keys_spread_over_batches(spark, codegen):
    """Keys that no single run knows to be common, with whole-stage code as outside of the tests."""
    rows = [(i, f"line {i % 40}\nline {i % 7} of seven\nown {i}") for i in range(480)]
    batches = [frame(spark, rows[i * 80 : i * 80 + 80], 1) for i in range(6)]
    spark.conf.set("spark.sql.codegen.wholeStage", codegen)
    try:
        assert result(linededup.drop_common_lines(frame(spark, rows), least=10, batches=batches)) == brute(rows, 10)
        runs = linededup.LineRuns(spark, least=10)
        for batch in batches:
            runs.add(batch)
        assert [len(level) for level in runs.levels] == [2, 1]
        held = [bytes(r.key) for r in spark.table(runs.levels[1][0]).collect()]
        assert len(held) == len(set(held))
        runs.remove()
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")


def test_clashing_columns_and_empty_table(spark):
    rows = lined_rows()
    docs = frame(spark, rows).withColumnRenamed("bucket", "N_lines").withColumnRenamed("component_id", "key")
    got = linededup.drop_common_lines(docs)
    assert got.columns == [*docs.columns, "_n_lines", "n_dropped"]
    assert sorted((r["_n_lines"], r.n_dropped) for r in got.collect()) == sorted(r[2:] for r in brute(rows, 10))
    assert linededup.drop_common_lines(docs.limit(0)).count() == 0
    assert linededup.drop_common_lines(docs.limit(0), batches=[]).count() == 0
