"""Secrets in whole texts: three patterns, and credential values by what guessing them would cost.

Patterns, leftmost and without overlap per kind:
- assign: a credential name, a colon or equals sign and a value of 8 characters or more;
- access: AKIA and capitals or digits, 16 characters or more in all;
- hex: 32 lower-case hexadecimal digits or more.

On top, the values that stand in a credential context (a wider list of names, any printable value; in quotes up to the
closing quote on the line, blanks included) are
segmented at the least cost in bits by dynamic programming over words, dates, repeats, keyboard
walks and brute-force characters. A value of `min_bits` or more is a span of kind guess; a
placeholder such as `password123` or `2021-01-01` is not. The program is linear in the value's length for a given word list.

A word costs the logarithm of its rank. Frequent passwords and placeholders come first; behind them `count_words` puts the
WORDS most frequent words of all documents, counted by Spark, of those found in LEAST_DOCUMENTS or more,
so that a secret does not become a word by standing in its own document.

Defined cases. Null counts as empty; an empty text has no spans. Offsets are code points, ends exclusive.
Ids may be null or repeat, every row is scanned by itself, and other columns are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from match_lake.operators.ordering import first_rows

# The patterns of the three base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")
BASE = KINDS[:3]

CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?|bearer)"""
    r"""["']?\x20*(?::|=>|=)\x20*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"',;]+))""",
    re.I | re.A,
)
# Every context holds one of these.
HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer")
MIN_BITS = 40.0
# Words taken from the documents, and how many documents must hold one.
WORDS = 50_000
LEAST_DOCUMENTS = 5
# Words a task holds before it hands on what it counted.
HELD = 1 << 18

# Frequent passwords and placeholder words, most frequent first.
COMMON = (
    "password pass admin user login welcome qwerty letmein monkey dragon master shadow sunshine princess football baseball "
    "iloveyou trustno superman batman secret token key test testing example sample demo dummy default changeme change "
    "guest root system server database service client access private public master hello world summer winter spring "
    "autumn monday friday january december love money dog cat house computer internet google none null true false "
    "your my the and value string insert here todo redacted hidden placeholder enter replace"
).split()
_LETTERS = re.compile(r"[a-z]{3,}")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("4@301!$57", "aaeoiisst")


class Words(NamedTuple):
    """Ranks from 1, and the length of the longest word."""

    rank: dict[str, int]
    longest: int


def ranked(words: Iterable[str]) -> Words:
    rank: dict[str, int] = {}
    for word in words:
        rank.setdefault(word, len(rank) + 1)
    return Words(rank, max(map(len, rank), default=0))


FIXED = ranked(COMMON)
_STEP = {a: (r, i) for r, row in enumerate(ROWS) for i, a in enumerate(row)}
_DATE = re.compile(
    r"(?:(?:19|20)[0-9]{2}([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([-/._]?)(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2}|(?:19|20)[0-9]{2})"
)
# A new segment costs a bit: where it starts.
SEGMENT = 1.0


def char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    return math.log2(26) if c.isalpha() and c.isascii() else math.log2(33)


def _near(a: str, b: str) -> bool:
    """Neighbours on the keyboard, or in the alphabet or the digits."""
    p, q = _STEP.get(a), _STEP.get(b)
    if p and q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1:
        return True
    return a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1


def segments(value: str, words: Words = FIXED) -> Iterator[tuple[int, int, float, str]]:
    """(start, end, bits, kind) of words, dates, walks and repeats within a value."""
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    for i in range(n):
        for j in range(i + 2, min(n, i + words.longest) + 1):
            rank = words.rank.get(low[i:j]) or words.rank.get(plain[i:j])
            if rank:
                part = value[i:j]
                changed = (part != low[i:j]) + (low[i:j] != plain[i:j]) * 2
                yield i, j, math.log2(rank + 1) + changed, "word"
        date = _DATE.match(value, i)
        if date:
            full = date.end() - i > 4
            yield i, date.end(), math.log2(200 * 365) + 2 if full else math.log2(200), "date"
    i = 0
    while i < n - 1:  # keyboard walks and alphabet runs, as long as they go
        j, turns, way = i + 1, 0, None
        while j < n and _near(low[j - 1], low[j]):
            step = (ord(low[j]) - ord(low[j - 1]))
            turns += way is not None and step != way
            way = step
            j += 1
        if j - i >= 4:
            yield i, j, math.log2(47 * (j - i)) + 2.2 * turns + (value[i:j] != low[i:j]), "walk"
        i = max(i + 1, j - 1)
    for unit in (1, 2, 3, 4):  # a unit and how often it comes
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while j < n and value[j] == value[j - unit]:
                j += 1
            times = (j - i) // unit
            if times >= 2 and j - i >= 3:
                end = i + times * unit
                yield i, end, sum(map(char_bits, value[i : i + unit])) + math.log2(times), "repeat"
                i = max(i + 1, end - unit)
            else:
                i += 1


def guess_bits(value: str, words: Words = FIXED) -> float:
    """Bits of the cheapest segmentation; everything not in a pattern is brute force, character by character."""
    ending: list[list[tuple[int, float]]] = [[] for _ in range(len(value) + 1)]
    for i, j, bits, _ in segments(value, words):
        ending[j].append((i, bits))
    best, brute = [0.0], [False]
    for j, c in enumerate(value, 1):
        low = best[j - 1] + char_bits(c) + (0.0 if brute[j - 1] else SEGMENT)
        by_brute = True
        for i, bits in ending[j]:
            if best[i] + bits + SEGMENT < low:
                low, by_brute = best[i] + bits + SEGMENT, False
        best.append(low)
        brute.append(by_brute)
    return best[-1]


def find_spans(text: str, min_bits: float = MIN_BITS, words: Words = FIXED) -> list[tuple[int, str, int, float | None]]:
    """(start, kind, end, bits) by start, then kind; bits for values only."""
    out = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                out.append((m.start(), 0, m.end(), guess_bits(m.group(2), words)))
        for m in CONTEXT.finditer(text):
            group = m.lastindex
            bits = guess_bits(m.group(group), words)
            if bits >= min_bits:
                out.append((m.start(group), 3, m.end(group), bits))
    if "AKIA" in text:
        out.extend((m.start(), 1, m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16)
    out.extend((m.start(), 2, m.end(), None) for m in HEX.finditer(text))
    out.sort(key=lambda s: s[:3])
    return [(start, KINDS[kind], end, bits) for start, kind, end, bits in out]


SPAN = "array<struct<kind string, start int, end int, bits double>>"


def count_words(docs: DataFrame, text: str = "text", at_most: int = WORDS, least_documents: int = LEAST_DOCUMENTS) -> Words:
    """The fixed words, then the most frequent ones of all documents: letters a to z in either case, three or more.

    Documents holding a word are counted, first inside each task; ties by the alphabet. At most `at_most` words reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for value in batch.column("text"):
                held.update(set(_LETTERS.findall((value.as_py() or "").lower())))
                if len(held) >= HELD:
                    yield handed_on()
                    held.clear()
        yield handed_on()

    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "word string, n bigint")
    common = counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_documents)
    # cut in ranges of the order: no task and not the driver meets more than the words that are wanted
    top = first_rows(common.withColumn("_down", -F.col("n")), ["_down", "word"], at_most).collect()
    return ranked([*COMMON, *(r["word"] for r in sorted(top, key=lambda r: (-r["n"], r["word"])))])


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_bits: float = MIN_BITS, words: Words = FIXED
) -> DataFrame:
    """One row per row of `docs`: id, spans by start, then kind. `words` come from count_words, or are the fixed ones."""
    def scan(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("bits", pa.float64())]))
        for texts in column:
            found = (find_spans(t.as_py() or "", min_bits, words) for t in texts)
            yield pa.array([[{"kind": k, "start": s, "end": e, "bits": b} for s, k, e, b in f] for f in found], kind)

    scan.__annotations__ = {"column": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.select(F.col(f"`{id_col}`"), F.arrow_udf(scan, SPAN)(F.col(f"`{text}`")).alias("spans"))


def digests(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """Counts of base kinds, the hash of base spans and all spans as text, from spans in their order."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    names = F.array(*[F.lit(k) for k in base])
    base_spans = F.filter("spans", lambda s: F.array_contains(names, s["kind"]))
    return found.select(
        *[c for c in found.columns if c != "spans"], *[count(k) for k in base], F.sha2(joined(base_spans).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
