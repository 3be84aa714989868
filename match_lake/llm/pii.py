"""Personal data in whole texts: strict patterns, and looser spans chosen by boosted trees.

Patterns, leftmost and without overlap per kind, failing matches dropped without another try:
email; ip with four parts up to 255; card with 16 to 19 digits that pass the Luhn test; phone
with a plus sign and 8 to 15 digits.

On top, generators with high recall propose spans that overlap: every stretch of whole digit groups, within a run of
digits and separators, whose number of digits fits a kind, and from every word start an e-mail address with a written or
plain at and at least one written or plain dot. Features describe the format (digits,
groups, separators, Luhn, octets, letters, length) and the context (cue words before the span, neighbouring
characters and digit groups, the share of digits around). Boosted trees score them, Platt scaling calibrates, and spans at or
above a threshold set for `precision` on rows kept aside become redactions of kind soft_..., best first, unless
they overlap a strict span or a better one.

There are no labels for personal data, so the trees learn from a bounded sample: `sample` documents, the first by a
hash of their ids, one row each, and of all their spans and candidates the first `contexts` by a hash. Strict spans in their
real contexts, rewritten in the looser formats (cue words put before some, another one put beside some), are
positive, and only from end to end: candidates that cover part of one or reach beyond it are negative, as are
candidates of the sample that no strict pattern accepts and spans with digits changed so that they fail. What is chosen beyond the
strict spans is thus a matter of looser format, not of new kinds of data, and the precision is that on the candidates
the documents really hold.

Defined cases. A group of more than 19 digits is in no candidate: no kind has so many. Null counts as empty; an empty text has no spans. Offsets are code points, ends exclusive. Without a strict
span in the sample no tree is grown and nothing is added. Ids may be null or repeat; other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from match_lake.llm import boosting

KINDS = ("email", "ip", "card", "phone", "soft_email", "soft_ip", "soft_card", "soft_phone")
BASE = KINDS[:4]
SAMPLE = 6_000
CONTEXTS = 12_000
PRECISION = 0.995
AROUND = 40

# The strict patterns. Possessive repeats and the look-behind leave out attempts that
# cannot succeed, from within a run of digits or back over one, so long runs cost linear time.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# High-recall generators: runs of digit groups, and addresses written out, tried from the start of each word.
_RUN = re.compile(r"[0-9]++(?:[\x20().:/-]{0,2}[0-9]++)*+")
_GROUP = re.compile(r"[0-9]+")
_WRITTEN = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?=([A-Za-z0-9._%+-]++(?:\x20?[\[({]at[\])}]\x20?|\x20at\x20|@)"
    r"[A-Za-z0-9-]++(?:(?:\x20?[\[({]dot[\])}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)++))", re.I | re.A
)
# How many digits a kind has.
DIGITS = {6: (13, 19), 7: (7, 15)}
CUES = {
    "email": ("mail", "e-mail", "contact", "write"), "phone": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "card": ("card", "visa", "mastercard", "credit", "account"), "ip": ("ip", "host", "server", "address"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The characters before an @ settle where a match can begin, so each is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            domain = _DOMAIN.match(text, at + 1)
            if domain:
                end = domain.end()
                yield start, end
        at = text.find("@", at + 1)


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind as listed, then start."""
    out = [(0, start, end) for start, end in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(octet, m.group().split(".")))]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(soft kind, start, end); spans may overlap, and one span may be proposed as several kinds.

    Of a run of digit groups every stretch of whole groups is tried that has no more digits than a card, so the number of
    candidates is linear in the text.
    """
    out = []
    low = text.lower()
    if " at " in low or "@" in text or "at)" in low or "at]" in low or "at}" in low:
        out += [(4, *m.span(1)) for m in _WRITTEN.finditer(text)]
    if _DIGIT.search(text):
        for run in _RUN.finditer(text):
            groups = [g.span() for g in _GROUP.finditer(text, *run.span())]
            for i, (start, _) in enumerate(groups):
                if text[start - 1 : start].isalpha() and start:
                    continue
                led = start - 1 if start and text[start - 1] in "+(" else start
                n = 0
                for j in range(i, len(groups)):
                    n += groups[j][1] - groups[j][0]
                    if n > 19:
                        break
                    end = groups[j][1]
                    out += [(kind, led, end) for kind, (least, most) in DIGITS.items() if least <= n <= most]
                    if j == i + 3 and n <= 12 and all("." in text[groups[x][1] : groups[x + 1][0]] for x in range(i, j)):
                        out.append((5, start, end))
    return out


_DIGITS_BEFORE = re.compile(r"[0-9][\x20().:/+-]{0,2}$")
_DIGITS_AFTER = re.compile(r"[\x20().:/-]{0,2}[0-9]")


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    groups = re.findall(r"[0-9]+", span)
    before = text[max(0, start - AROUND) : start].lower()
    after = text[end : end + AROUND]
    around = before + after
    parts = re.split(r"[.\x20()\[\]{}]+", span)
    return [
        kind, len(span), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        span.count(" "), span.count("-"), span.count("."), span.count("(") + span.count("["), span.startswith("+"), "@" in span,
        bool(re.search(r"[\[({\x20]at[\])}\x20]", span, re.I)), bool(re.search(r"[\[({\x20]dot[\])}\x20]", span, re.I)),
        luhn(digits) if digits else 0, len(groups) - sum(map(octet, groups)), len(groups) == 4 and all(map(octet, groups)), len(parts[-1]), sum(c.isalpha() for c in span),
        *[any(cue in before for cue in cues) for cues in CUES.values()],
        before[-1:].isalnum(), after[:1].isalnum(), before[-1:] in ":=", bool(_DIGITS_BEFORE.search(before)), bool(_DIGITS_AFTER.match(after)), sum(c.isdigit() for c in around) / max(1, len(around)),
    ]


@dataclass
class Chooser:
    model: boosting.Boosted
    threshold: float

    def choose(self, text: str, strict: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Soft spans at or above the threshold, best first, none across a strict or a better one."""
        taken = sorted((s, e) for _, s, e in strict)
        found = [c for c in candidates(text) if not any(s < c[2] and c[1] < e for s, e in taken)]
        if not found:
            return []
        p = self.model.probability(np.array([features(text, *c) for c in found], float))
        out: list[tuple[int, int, int]] = []
        for i in sorted(np.flatnonzero(p >= self.threshold), key=lambda i: (-p[i], found[i])):
            if not any(s < found[i][2] and found[i][1] < e for _, s, e in out):
                out.append(found[i])
        return sorted(out)


def rewritten(kind: int, span: str, rng: random.Random) -> str:
    """A strict span in a looser format of the same data."""
    if kind == 0:
        name, _, host = span.partition("@")
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "(dot)")])
        return name + at + host.replace(".", dot)
    digits = "".join(_DIGIT.findall(span))
    if kind == 1:
        return rng.choice([" . ", ". ", " ."]).join(span.split("."))
    if kind == 2:
        sizes = rng.choice([4, 4, len(digits)])
        return rng.choice([".", "/", " ", "-"]).join(digits[i : i + sizes] for i in range(0, len(digits), sizes))
    local = digits[-10:]
    return rng.choice([f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}", f"00{digits[:-7]} {digits[-7:-4]} {digits[-4:]}"])


def spoiled(kind: int, span: str, rng: random.Random) -> str:
    """The same characters with digits that make the span something else."""
    if kind == 0:
        return span.replace("@", " ").replace(".", " ")
    if kind == 1:
        return ".".join(str(int(p[-3:] or 0) + 256 + rng.randrange(700)) for p in span.split("."))
    if kind == 2:
        digits = "".join(str(rng.randrange(10)) for _ in _DIGIT.findall(span))
        return digits[:-1] + str((int(digits[-1]) + 1) % 10) if luhn(digits) else digits
    if rng.random() < 0.5:  # versions, dates, ranges
        return rng.choice([".", "/", "-"]).join(str(rng.randrange(1, 5000)) for _ in range(rng.choice([3, 4, 4, 5])))
    return "".join(str(rng.randrange(10)) for _ in range(rng.choice([5, 6, 7, 9, 11, 12, 16])))


def training_rows(contexts: list[tuple[int, str, str, str]], seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels from (kind, before, span, after); kind -1 is a candidate no pattern accepts."""
    rng = random.Random(seed)
    x, y = [], []
    spans = {kind: [c[2] for c in contexts if c[0] == kind] for kind in range(4)}

    def add(before: str, span: str, after: str, kind: int | None = None) -> None:
        """All candidates across the span: the one from end to end of the kind is positive."""
        text = before + span + after
        first, last = len(before), len(before) + len(span)
        strict = strict_spans(text) if kind is not None else []
        for c in candidates(text):
            exact = kind is not None and c == (kind, first, last)
            if c[1] < last and first < c[2] and (exact or not any(s < c[2] and c[1] < e for _, s, e in strict)):
                x.append(features(text, *c))
                y.append(int(exact))

    for kind, before, span, after in contexts:
        if kind < 0:
            add(before, span, after)
            continue
        cue = rng.choice(list(CUES.values())[("email", "phone", "card", "ip").index(("email", "ip", "card", "phone")[kind])])
        led = before + rng.choice(["", "", f"{cue}: ", f"{cue} "])
        other = rewritten(kind, rng.choice(spans[kind]), rng)
        # in its context, beside another one, and in a bare list
        for left, right in ((led, after), (led, f" {other}{after}"), (f"{led}{other} ", after), ("", f" {other}"), (f"{other} ", "")):
            add(left, rewritten(kind, span, rng), right, kind + 4)
        for wrong in (kind, 3):
            add(before, spoiled(wrong, span, rng), after)
    return np.array(x, float).reshape(len(y), len(x[0]) if x else 1), np.array(y, float)


def train(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE, precision: float = PRECISION, contexts: int = CONTEXTS
) -> Chooser | None:
    """Trees from at most `contexts` spans and candidates of a bounded sample of documents."""
    picked = docs.select(F.col(f"`{id_col}`").alias("id")).filter("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    # At most `sample` ids; of rows that repeat one, a single one.
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(picked), "id")
    texts = texts.groupBy("id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("text"):
                body = value.as_py() or ""
                strict = strict_spans(body)
                loose = [(-1, s, e) for _, s, e in candidates(body) if not any(a < e and s < b for _, a, b in strict)]
                rows = [
                    {"kind": k, "before": body[max(0, s - AROUND) : s], "span": body[s:e], "after": body[e : e + AROUND]}
                    for k, s, e in sorted({*strict, *loose})
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("kind", pa.int32()), ("before", pa.string()), ("span", pa.string()), ("after", pa.string())]))

    found = texts.select("text").mapInArrow(read, "kind int, before string, span string, after string").distinct()
    found = found.orderBy(F.xxhash64("kind", "before", "span", "after")).limit(contexts).collect()
    x, y = training_rows(sorted((r["kind"], r["before"], r["span"], r["after"]) for r in found))
    aside = np.arange(len(y)) % 3 == 0
    if min(y[aside].sum(), (1 - y[aside]).sum(), y[~aside].sum(), (1 - y[~aside]).sum()) < 5:
        return None
    model = boosting.fit(x[~aside], y[~aside])
    boosting.calibrate(model, x[aside], y[aside])
    return Chooser(model, max(0.5, boosting.threshold_for(model.probability(x[aside]), y[aside], precision)))


SPAN = "array<struct<kind string, start int, end int>>"


def find_personal(docs: DataFrame, chooser: Chooser | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: id, spans by kind, then start."""
    return docs.select(F.col(f"`{id_col}`"), spans(chooser, F.col(f"`{text}`")).alias("spans"))


def spans(chooser: Chooser | None, text: Column) -> Column:
    def scan(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for texts in column:
            out = []
            for value in texts:
                body = value.as_py() or ""
                strict = strict_spans(body)
                every = strict + (chooser.choose(body, strict) if chooser else [])
                out.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in every])
            yield pa.array(out, kind)

    scan.__annotations__ = {"column": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scan, SPAN)(text)
