import hashlib

from corpora import frame, odd_texts

from match_lake.llm import substring


def expected(rows, window=20):
    """(id, words, removed, hash of the kept) by looking every window up among all earlier ones."""
    import xxhash

    def order(row):
        h = xxhash.xxh64((row[1] or "").encode(), seed=42).intdigest()
        h = 42 if row[1] is None else h - (1 << 64) if h >= 1 << 63 else h
        return row[0] is not None, row[0] or 0, h

    seen, out = set(), {}
    for row in sorted(set(rows), key=order):
        words = (row[1] or "").encode().split()
        stays = [True] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                stays[i : i + window] = [False] * window
            seen.add(key)
        kept = [w for w, s in zip(words, stays) if s]
        out[row] = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode())
    return out


def test_against_all_windows(spark):
    for seed in (1, 2):
        rows = odd_texts(seed)
        want = expected(rows)
        got = substring.repeats(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *want[r][:3]) for r in rows), key=repr)


def test_other_windows(spark):
    rows = odd_texts(3)
    want = expected(rows, 7)
    got = substring.repeats(frame(spark, rows), window=7, gram=2).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *want[r][:3]) for r in rows), key=repr)


def test_factors_read_on_from_their_reference(spark):
    rows = [(i, t) for i, t in odd_texts() if i is not None]
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add((t or "").strip())
    out = substring.repeats(frame(spark, rows)).collect()
    seen = 0
    for r in out:
        own = next(iter(texts[r.doc_id])).split()
        if len(texts[r.doc_id]) > 1:
            continue
        for f in r.factors:
            if len(texts[f.ref_id]) == 1:
                ref = next(iter(texts[f.ref_id])).split()
                assert own[f.start : f.start + f.words] == ref[f.ref_start : f.ref_start + f.words] and f.words >= 20
                assert (f.ref_id, f.ref_start) < (r.doc_id, f.start)
                seen += 1
    assert seen > 20


def test_remove(spark):
    rows = odd_texts()
    want = expected(rows)
    docs = frame(spark, rows)
    out = substring.remove_repeats(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        ((r[0], want[r][3] if want[r][1] else r[1]) for r in rows), key=repr
    )


def test_empty_table(spark):
    docs = frame(spark, odd_texts()).limit(0)
    assert substring.repeats(docs).count() == 0 and substring.remove_repeats(docs).count() == 0
