"""Line deduplication against levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z in lower case. A key found in
`least` documents or more is common, and all lines of common keys go, in every document.

1. A run is a table of (key, docs), bucketed and sorted by key: how many documents of some batches hold the key.
   Keys are 128-bit hashes of lines; two different lines are taken for one with a probability of about 2^-128 a pair.
2. A new batch counts each key once a document, combined inside the task that reads it, and is shuffled into the
   buckets of the runs. There it is merge-anti-joined with the keys that a run already knows to be
   common, and what is left becomes a run of its own on level 0. Runs have the same buckets, so they never move again.
3. `fanout` runs of one level are merged into one of the next, counts added up. A key is rewritten once a level, and the
   number of runs grows with the logarithm of the number of batches.
4. The runs together give the common keys; a document's keys are semi-joined with them, salted by the place of the
   document, and the common ones travel to its text.

Defined cases. A null or empty text is one empty line; a null text stays null. Keys of fewer than `least_chars` code
points are never common, so empty lines stay. Each row is a document, also one that repeats another, and counts a key
once however often it has the line. Rows without id take part. A text all of whose lines go is empty. Nothing but \n
ends a line. Other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from match_lake.llm.steps import Steps
from match_lake.llm.words import free_names
from match_lake.session import remove_folder, scratch_dir

LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
FANOUT = 4
# Batches a stored table is read in.
BATCHES = 8
# Keys a task holds before it hands on what it counted.
HELD = 1 << 18
# Parts the documents with one common key are spread over.
SALTS = 32

BLANKS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """The hash of a line's key; None for a key too short to be common."""
    key = line.strip(BLANKS).lower()
    # no code point takes more than four bytes
    if len(key) < least_chars or (len(key) < 4 * least_chars and len(key.decode("utf-8", "replace")) < least_chars):
        return None
    return blake2b(key, digest_size=16).digest()


def text_keys(text: str | None, least_chars: int) -> set[bytes]:
    keys = {line_key(line, least_chars) for line in set((text or "").encode().split(b"\n"))}
    keys.discard(None)
    return keys


def counted_keys(docs: DataFrame, text: str, least_chars: int) -> DataFrame:
    """(key, docs) of a batch, combined inside each task but not yet across tasks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["key", "docs"]
            )

        for batch in batches:
            for one in batch.column("text"):
                held.update(text_keys(one.as_py(), least_chars))
                if len(held) >= HELD:
                    yield handed_on()
                    held.clear()
        yield handed_on()

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "key binary, docs bigint")


class LineRuns:
    """Levelled sorted runs of line keys. Runs are tables in the current database, their files in the shared folder."""

    def __init__(
        self, spark: SparkSession, least: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS, fanout: int = FANOUT,
        buckets: int | None = None,
    ):
        self.spark, self.least, self.least_chars, self.fanout = spark, least, least_chars, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}
        # all runs as partitions of one bucketed table, over the files of their own tables
        self.all_runs: str | None = None

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Count a batch of documents."""
        batch = counted_keys(docs, text, self.least_chars).repartition(self.buckets, "key")
        batch = batch.groupBy("key").agg(F.sum("docs").alias("docs"))
        for name in self.runs():
            batch = batch.join(self.spark.table(name).filter(F.col("docs") >= self.least), "key", "left_anti")
        self._store(batch, 0)

    def _store(self, entries: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = scratch_dir(self.spark, name)
        writer = entries.write.bucketBy(self.buckets, "key").sortBy("key").option("path", self.paths[name])
        writer.saveAsTable(name)
        self._enlist(name)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            self._store(self._merged(old), level + 1)
            self.levels[level] = []
            self._drop(old)

    def _enlist(self, name: str) -> None:
        if self.all_runs is None:
            self.all_runs = f"line_levels_{uuid.uuid4().hex}"
            self.paths[self.all_runs] = scratch_dir(self.spark, self.all_runs)
            self.spark.sql(
                f"create table {self.all_runs} (key binary, docs bigint, run string) using {self._format()} partitioned by (run) "
                f"clustered by (key) into {self.buckets} buckets location '{self.paths[self.all_runs]}'"
            )
        self.spark.sql(f"alter table {self.all_runs} add partition (run = '{name}') location '{self.paths[name]}'")

    def _format(self) -> str:
        return self.spark.conf.get("spark.sql.sources.default")

    def _merged(self, names: Sequence[str]) -> DataFrame:
        """Runs merged bucket by bucket, counts added up.

        One scan reads a bucket of all the runs in one task. A union of their tables would not do: Spark may take
        it for bucketed like its parts and still run it part by part, so a key in several runs would stay apart.
        """
        both = self.spark.table(self.all_runs).filter(F.col("run").isin(list(names)))
        return both.groupBy("key").agg(F.sum("docs").alias("docs"))

    def common(self) -> DataFrame:
        """The keys found in at least `least` documents, with how many were counted until that was known."""
        if not self.runs():
            return self.spark.createDataFrame([], "key binary, docs bigint")
        return self._merged(self.runs()).filter(F.col("docs") >= self.least)

    def _drop(self, names: Sequence[str]) -> None:
        for name in names:
            self.spark.sql(f"alter table {self.all_runs} drop if exists partition (run = '{name}')")
            self.spark.sql(f"drop table if exists {name}")
            remove_folder(self.spark, self.paths.pop(name))

    def remove(self) -> None:
        """Remove all runs."""
        self._drop(self.runs())
        self.levels = []
        if self.all_runs is not None:
            self.spark.sql(f"drop table if exists {self.all_runs}")
            remove_folder(self.spark, self.paths.pop(self.all_runs))
            self.all_runs = None


def file_batches(docs: DataFrame, at_most: int = BATCHES) -> list[DataFrame]:
    """A stored table as batches of whole files. `docs` is a plain read of Parquet files."""
    files = sorted(docs.inputFiles())
    size = -(-len(files) // at_most) or 1
    reader = docs.sparkSession.read.schema(docs.schema)
    return [reader.parquet(*files[i : i + size]) for i in range(0, len(files), size)]


def drop_keys(
    docs: DataFrame, common: DataFrame, id_col: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, salts: int = SALTS,
    steps: Steps | None = None,
) -> DataFrame:
    """`docs` without the lines whose key is in `common`, and n_lines, n_dropped of every document.

    The two columns take free names, should the table have such columns: _n_lines, _n_dropped.
    """
    steps = steps or Steps(docs.sparkSession)

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            rows, keys, parts = [], [], []
            for at, one in enumerate(batch.column("text")):
                own = text_keys(one.as_py(), least_chars)
                rows += [at] * len(own)
                keys += own
                parts += [place % salts] * len(own)
                place += 1
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("digest").take(at), pa.array(keys, pa.binary()), pa.array(parts, pa.int32())],
                names=["id", "digest", "key", "part"],
            )

    # Rows that agree in id and text have the same lines.
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text}`").alias("digest"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    held = rows.mapInArrow(keys_of, f"id {id_type}, digest bigint, key binary, part int")
    wanted = common.select("key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("part"))
    # Sorted and merged: the salted side is larger than its table lets Spark guess.
    found = held.join(wanted.hint("merge"), ["key", "part"], "left_semi")
    marks = steps.cut(found.groupBy("id", "digest").agg(F.collect_set("key").alias("gone")), "marks")

    n_lines, n_dropped, left, gone_id, gone_digest, gone = free_names(
        docs.columns, "n_lines", "n_dropped", "_left", "_gone_id", "_gone_digest", "_gone"
    )

    @F.pandas_udf("text string, n_lines bigint, n_dropped bigint")
    def strip(texts: pd.Series, common_keys: pd.Series) -> pd.DataFrame:
        out = []
        for one, drop in zip(texts, common_keys):
            lines = (one or "").encode().split(b"\n")
            stay = lines
            if drop is not None and len(drop):
                common_here = set(drop)
                stay = [line for line in lines if line_key(line, least_chars) not in common_here]
            out.append((None if one is None else b"\n".join(stay).decode(), len(lines), len(lines) - len(stay)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    named = marks.select(F.col("id").alias(gone_id), F.col("digest").alias(gone_digest), F.col("gone").alias(gone))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(gone_id)) & (F.xxhash64(f"`{text}`") == F.col(gone_digest))
    done = docs.join(named, same, "left").withColumn(left, strip(F.col(f"`{text}`"), F.col(gone)))
    columns = [F.col(left)["text"].alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*columns, F.col(left)["n_lines"].alias(n_lines), F.col(left)["n_dropped"].alias(n_dropped))


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS,
    batches: Sequence[DataFrame] | None = None, fanout: int = FANOUT,
) -> DataFrame:
    """`docs` without common lines, with n_lines and n_dropped. `batches` are the documents part by part (one part if not given)."""
    steps = Steps(docs.sparkSession)
    runs = LineRuns(docs.sparkSession, least, least_chars, fanout)
    for batch in [docs] if batches is None else batches:
        runs.add(batch, text)
    common = steps.cut(runs.common().select("key"), "common")
    runs.remove()
    out = drop_keys(docs, common, id_col, text, least_chars, steps=steps)
    steps.remove("common")
    return out
