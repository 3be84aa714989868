import random

import numpy as np
import pyarrow as pa
import pytest

from match_lake.llm import wordhash


@pytest.mark.parametrize("piece", [4, 7, 64, 1 << 18])
def test_words_of_batches(monkeypatch, piece):
    monkeypatch.setattr(wordhash, "PIECE", piece)
    rng, known = random.Random(piece), {}
    for _ in range(150):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("abAB  \n\té\x0b") for _ in range(rng.choice([0, 1, 3, 30, 80]))) for _ in range(rng.randrange(7))]
        lower = rng.random() < 0.5
        column = pa.array(["skipped", *texts], pa.string()).slice(1)
        seen = 0
        for lo, hi, words in wordhash.word_groups(column, lower, rng.choice([1, 10, 100])):
            assert lo == seen
            seen = hi
            for r in range(lo, hi):
                data = (texts[r] or "").encode()
                i, j = words.first[r - lo], words.first[r - lo + 1]
                found = [bytes(words.data[s:e]) for s, e in zip(words.start[i:j], words.end[i:j])]
                assert found == data.split()
                for word, value in zip(found, words.hash[i:j]):
                    word = word.lower() if lower else word
                    assert known.setdefault(word, int(value)) == int(value)
        assert seen == len(texts)
    assert len(set(known.values())) == len(known)


def test_shingles_tell_order_and_length():
    h = wordhash.mixed(np.arange(1, 5, dtype=np.uint64))
    assert len(wordhash.shingles(h, 5)) == 0
    assert wordhash.shingles(h, 2)[0] != wordhash.shingles(h[::-1].copy(), 2)[-1]
