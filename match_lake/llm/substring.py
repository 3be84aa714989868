"""Repeated passages by relative Lempel-Ziv parsing against an index of all documents.

Every document is parsed against everything that starts before it: documents with a smaller
id, and its own earlier words. A factor is a longest stretch of words that reads on from one
earlier place; factors of `window` words or more are duplicates.

1. Index. Each window of `window` words picks an anchor, the smallest hash among its `gram`-word
   grams, the first of equals. Equal windows pick equal anchors at equal distances. A run of
   windows with one anchor is a fragment; about every ninth word starts one. The index is dealt by
   anchor into reference blocks, one per partition, and holds one entry per fragment.
2. Fragments whose anchor occurs once in all documents can match nothing and drop out.
   A fragment that reads like an earlier one of its own document is settled at once, without the index.
3. Factors. A fragment that reads exactly like an earlier one continues a factor through
   all its windows. Only the first of equal fragments goes on.
4. Boundaries. A factor ends inside a fragment. So where first fragments of one anchor differ, their
   windows are looked up one by one, read again from the texts, and each joins the factor
   that contains its first occurrence. A window thus lies in a factor exactly when its words
   start earlier as well.
5. A document's pieces are read left to right; a piece that reads on from the same earlier
   place lengthens the factor, any other starts a new one.

Counts and minima are combined before each shuffle; the joins that bring them back to rows can be
split by AQE where a passage is in a large share of all rows. No step pairs up occurrences.

Defined cases. Words are runs of anything but space and tab to carriage return, unchanged. Texts
with fewer than `window` words, empty or null have no windows and lose nothing. A null id comes
before all others. Rows that share id and text are the same document, and all get what the one
document gets; of rows that share only the id, those with the smaller text hash come first.
Other columns pass through `remove_repeats` untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from match_lake.llm import wordhash
from match_lake.llm.steps import Steps
from match_lake.llm.words import free_names

WINDOW = 20
GRAM = 4
GROUP = 1 << 21


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the first smallest of values[i : i + width], for every i."""
    at = np.arange(len(values))
    low, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = low[:-step], low[step:]
        take_right = right < left
        at = np.where(take_right, at[step:], at[:-step])
        low = np.where(take_right, right, left)
        covered += step
    return at


def fragments(words: wordhash.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """row, start (word within the row), windows, anchor hash, fragment hash of every fragment."""
    n = len(words.hash) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    grams = wordhash.shingles(words.hash, gram)
    picked = first_smallest(grams, window - gram + 1)
    whole = words.row[:n] == words.row[window - 1 :]
    starts = whole.copy()
    starts[1:] &= ~whole[:-1] | (picked[1:] != picked[:-1]) | (words.row[1:n] != words.row[: n - 1])
    first = np.flatnonzero(starts)
    at_end = np.concatenate([whole[1:] & ~starts[1:], [False]])
    last = np.flatnonzero(whole & ~at_end)
    count = last - first + 1
    up, down = wordhash.powers(len(words.hash) + 1)
    total = np.zeros(len(words.hash) + 1, dtype=np.uint64)
    np.cumsum(words.hash * up[: len(words.hash)], out=total[1:])
    read = (total[last + window] - total[first]) * down[first]
    row = words.row[first]
    return row, first - words.first[row], count, grams[picked[first]], wordhash.mixed(read + count.astype(np.uint64))


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Id and the hash of the text name a row."""
    words = F.col(f"`{text}`")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(words).alias("text_hash"), words.alias("text"))


def _split(rows: np.ndarray, n: int, *values: pa.Array) -> list[pa.ListArray]:
    """Values of ascending rows as one list per row."""
    ends = pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, v) for v in values]


def own_repeats(row: np.ndarray, start: np.ndarray, count: np.ndarray, read: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Which fragments read like an earlier one of their document, and these as stretches: row, start, words, ref_start.

    Each refers to the one before that reads alike, so the repeats of a repeated phrase form one stretch.
    """
    order = np.lexsort((start, read, row))
    again = np.zeros(len(row), dtype=bool)
    before = np.full(len(row), -1)
    same = (row[order][1:] == row[order][:-1]) & (read[order][1:] == read[order][:-1])
    again[order[1:][same]] = True
    before[order[1:][same]] = start[order[:-1][same]]
    at = np.flatnonzero(again)
    r, s, e, ref = row[at], start[at], start[at] + count[at] + window - 1, before[at]
    joins = np.zeros(len(at), dtype=bool)
    joins[1:] = (r[1:] == r[:-1]) & (s[1:] - ref[1:] == s[:-1] - ref[:-1]) & (s[1:] <= e[:-1])
    first = np.flatnonzero(~joins)
    last = np.append(first[1:] - 1, len(at) - 1) if len(at) else first
    return again, r[first], s[first], e[last] - s[first], ref[first]


def _index(docs: DataFrame, id_col: str, text: str, window: int, gram: int) -> DataFrame:
    """id, text_hash, anchors, reads, starts, counts, own: one row per document with a window."""
    own_kind = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_start", pa.int32())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words in wordhash.word_groups(batch.column("text"), group=GROUP):
                row, start, count, anchor, read = fragments(words, window, gram)
                again, *own = own_repeats(row, start, count, read, window)
                new = ~again
                lists = _split(
                    row[new], hi - lo, pa.array(anchor[new].view(np.int64)), pa.array(read[new].view(np.int64)),
                    pa.array(start[new].astype(np.int32)), pa.array(count[new].astype(np.int16)),
                )
                stretches = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in own[1:]], fields=list(own_kind))
                lists += _split(own[0], hi - lo, stretches)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("text_hash").slice(lo, hi - lo), *lists],
                    names=["id", "text_hash", "anchors", "reads", "starts", "counts", "own"],
                )

    rows = _rows(docs, id_col, text)
    id_type = rows.schema["id"].dataType.simpleString()
    kinds = (
        "anchors array<bigint>, reads array<bigint>, starts array<int>, counts array<smallint>, "
        "own array<struct<start int, words int, ref_start int>>"
    )
    return rows.mapInArrow(index, f"id {id_type}, text_hash bigint, {kinds}").filter(F.size("anchors") > 0)


def _window_hashes(docs: DataFrame, wanted: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    """id, text_hash, start, hash of the windows of the wanted fragments (id, text_hash, start, count)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch.column("pieces")
            ends = pieces.offsets.to_numpy()
            starts = pieces.flatten().field("start").to_numpy()
            counts = pieces.flatten().field("count").to_numpy()
            ends = ends - ends[0]
            for lo, hi, words in wordhash.word_groups(batch.column("text"), group=GROUP):
                hashes = wordhash.shingles(words.hash, window)
                n_of = counts[ends[lo] : ends[hi]].astype(np.int64)
                rows = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                inside = np.arange(n_of.sum()) - np.repeat(np.cumsum(n_of) - n_of, n_of)
                at = np.repeat(starts[ends[lo] : ends[hi]].astype(np.int64), n_of) + inside
                row = np.repeat(rows, n_of)
                lists = _split(row, hi - lo, pa.array(at.astype(np.int32)), pa.array(hashes[words.first[row] + at].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("text_hash").slice(lo, hi - lo), *lists],
                    names=["id", "text_hash", "starts", "hashes"],
                )

    # A list holds pieces of one document.
    lists = wanted.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "count")).alias("pieces"))
    rows = _rows(docs, id_col, text).alias("row")
    chosen = lists.hint("shuffle_hash").alias("chosen")
    same = F.col("row.id").eqNullSafe(F.col("chosen.id")) & (F.col("row.text_hash") == F.col("chosen.text_hash"))
    found = rows.join(chosen, same).select("row.id", "row.text_hash", "text", "pieces")
    id_type = found.schema["id"].dataType.simpleString()
    kinds = "starts array<int>, hashes array<bigint>"
    read_again = found.mapInArrow(read, f"id {id_type}, text_hash bigint, {kinds}")
    return read_again.select("id", "text_hash", F.explode(F.arrays_zip("starts", "hashes")).alias("w")).select(
        "id", "text_hash", F.col("w.starts").alias("start"), F.col("w.hashes").alias("hash")
    )


def duplicate_pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """id, text_hash, pieces (start, words, ref_id, ref_hash, ref_start) of every document that repeats something."""
    steps = Steps(docs.sparkSession)
    index = steps.cut(_index(docs, id_col, text, window, gram), "index")
    repeated = (
        index.select(F.explode("anchors").alias("anchor")).groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("anchor")
    )
    entries = index.select(
        "id", "text_hash", F.explode(F.arrays_zip("anchors", "reads", "starts", "counts")).alias("e")
    ).select("id", "text_hash", F.col("e.anchors").alias("anchor"), F.col("e.reads").alias("read"),
             F.col("e.starts").alias("start"), F.col("e.counts").alias("count"))
    matched = steps.cut(entries.join(repeated, "anchor", "left_semi"), "matched")
    here = [F.col("id").alias("ref_id"), F.col("text_hash").alias("ref_hash")]
    own = steps.cut(
        index.filter(F.size("own") > 0).select("id", "text_hash", F.explode("own").alias("o"), *here)
        .select("id", "text_hash", "o.start", "o.words", "ref_id", "ref_hash", "o.ref_start"), "own",
    )
    steps.remove("index")
    place = F.struct("id", "text_hash", "start")
    firsts = steps.cut(
        matched.groupBy("anchor", "read").agg(F.min(place).alias("ref"), F.min("count").alias("count"), F.count(F.lit(1)).alias("n")),
        "firsts",
    )
    several = firsts.filter("n > 1").select("anchor", "read", "ref")
    factors = matched.join(several, ["anchor", "read"]).filter(~place.eqNullSafe(F.col("ref"))).select(
        "id", "text_hash", "start", (F.col("count") + (window - 1)).cast("int").alias("words"), "ref"
    )
    split = firsts.groupBy("anchor").agg(F.min("read").alias("low"), F.max("read").alias("high")).filter("low <> high")
    ends = firsts.join(split.select("anchor"), "anchor", "left_semi").select(
        F.col("ref.id").alias("id"), F.col("ref.text_hash").alias("text_hash"), F.col("ref.start").alias("start"), "count"
    )
    windows = steps.cut(_window_hashes(docs, ends, id_col, text, window).distinct(), "windows")
    earliest = windows.groupBy("hash").agg(F.min(place).alias("ref"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash", "ref")
    boundary = windows.join(earliest, "hash").filter(~place.eqNullSafe(F.col("ref"))).select(
        "id", "text_hash", "start", F.lit(window).alias("words"), "ref"
    )
    found = factors.union(boundary).select(
        "id", "text_hash", "start", "words", F.col("ref.id").alias("ref_id"), F.col("ref.text_hash").alias("ref_hash"),
        F.col("ref.start").alias("ref_start"),
    )
    # A list holds pieces of one document.
    piece = F.struct("start", "words", "ref_id", "ref_hash", "ref_start")
    pieces = steps.cut(found.union(own).groupBy("id", "text_hash").agg(F.collect_list(piece).alias("pieces")), "pieces")
    steps.remove("matched", "own", "firsts", "windows")
    return pieces


def parse(pieces: list[dict]) -> list[dict]:
    """Greedy factors from the pieces of one document, in order of their start.

    A piece lengthens the factor before it where both read on from one earlier place.
    """
    out: list[dict] = []
    for p in sorted(pieces, key=lambda p: (p["start"], -p["words"])):
        end = p["start"] + p["words"]
        if out:
            f = out[-1]
            same = (f["ref_id"], f["ref_hash"], f["ref_start"] - f["start"]) == (p["ref_id"], p["ref_hash"], p["ref_start"] - p["start"])
            if same and p["start"] <= f["start"] + f["words"]:
                f["words"] = max(f["words"], end - f["start"])
                continue
        out.append(dict(p))
    return out


def _read_with_factors(
    docs: DataFrame, id_col: str, text: str, window: int, gram: int, keep: list[str],
    kind: str, make: Callable[[list[bytes], np.ndarray, list[dict]], dict],
) -> DataFrame:
    """`make` of each row's words, which of them stay, and its factors, beside the columns of `keep`."""
    lists = duplicate_pieces(docs, id_col, text, window, gram).hint("shuffle_hash").alias("found")
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text"), *own).alias("row")
    same = F.col("row.id").eqNullSafe(F.col("found.id")) & (F.col("row.text_hash") == F.col("found.text_hash"))
    joined = rows.join(lists, same, "left").select(*[f"c{i}" for i in range(len(keep))], "text", "pieces")
    made_names = [part.split()[0] for part in kind.split("; ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for value, found in zip(batch.column("text"), batch.column("pieces")):
                words = (value.as_py() or "").encode().split()
                stays = np.ones(len(words), dtype=bool)
                factors = parse(found.as_py() or [])
                for f in factors:
                    stays[f["start"] : f["start"] + f["words"]] = False
                made.append(make(words, stays, factors))
            columns = [pa.array([m[name] for m in made], schema.field(name).type) for name in made_names]
            yield pa.RecordBatch.from_arrays([*[batch.column(f"c{i}") for i in range(len(keep))], *columns], schema=schema_of(batch))

    def schema_of(batch: pa.RecordBatch) -> pa.Schema:
        return pa.schema([batch.schema.field(f"c{i}") for i in range(len(keep))] + [schema.field(name) for name in made_names])

    made_type = StructType.fromDDL(kind.replace("; ", ", "))
    schema = to_arrow_schema(made_type)
    full = StructType([*joined.schema.fields[: len(keep)], *made_type.fields])
    out = joined.mapInArrow(apply, full)
    return out.toDF(*keep, *made_names)


def repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of `docs`: id, n_words, n_removed, kept_sha256, factors (start, words, ref_id, ref_start)."""
    def make(words: list[bytes], stays: np.ndarray, factors: list[dict]) -> dict:
        kept = words if stays.all() else [w for w, s in zip(words, stays) if s]
        return {
            "n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": sha256(b" ".join(kept)).hexdigest(),
            "factors": [{k: f[k] for k in ("start", "words", "ref_id", "ref_start")} for f in factors],
        }

    id_type = docs.schema[id_col].dataType.simpleString()
    kind = f"n_words bigint; n_removed bigint; kept_sha256 string; factors array<struct<start int, words int, ref_id {id_type}, ref_start int>>"
    return _read_with_factors(docs, id_col, text, window, gram, [id_col], kind, make)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """`docs` with the words outside duplicates as text, one space between them. Texts that lose nothing stay as they are."""
    def make(words: list[bytes], stays: np.ndarray, factors: list[dict]) -> dict:
        return {new: None if stays.all() else b" ".join(w for w, s in zip(words, stays) if s).decode()}

    (new,) = free_names(docs.columns, "_kept")
    out = _read_with_factors(docs, id_col, text, window, gram, docs.columns, f"{new} string", make)
    return out.select(*[F.coalesce(F.col(f"`{new}`"), F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
