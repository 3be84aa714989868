"""Quality score of whole texts: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into chunks of CHUNK bytes that overlap by OVERLAP, the last one
filled up with a symbol of its own, so every byte is read. In each chunk learned filters, WIDTH
bytes wide and moved by STEP, are applied to learned byte vectors; the highest response of
every filter in the chunk goes through a rectifier into one logit per chunk. A text's score
is a logistic function of the mean, the lowest and the highest logit of its chunks.

Training runs on the driver, on a bounded sample: at most `sample` labelled rows of each label, the
first by a hash of their ids. A fifth of them is set aside. Filters are trained on chunks of the others, cut out on
the executors, both labels weighing the same: all of them, or where these are more than `chunks_per_doc` a row on
average, the same share of every text, evenly spread over the whole of it. The final three weights are fitted on the rows
set aside, on the features that scoring computes, over all chunks of their whole texts, labels
weighing as in all labelled rows. Seeds are
fixed and rows ordered, so reruns agree. Scoring covers all rows, chunk by chunk, in memory
bounded by a fixed number of chunks.

Defined cases. A null or empty text is one chunk of filling. Labels that are null, and labelled
rows without a document, train nothing. Without labels the score is 0.5 for all, with labels of one kind that label.
A null id counts as the empty text in the split into training and held-out rows. Of rows that repeat an id one trains; they
score alike where their texts do; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from match_lake.llm.wordhash import text_groups

CHUNK = 512
OVERLAP = 32
STEP = 4
WIDTH = 2 * STEP
DIMS = 4
FILTERS = 32
FILLING = 256
SAMPLE = 1_500
CHUNKS_PER_DOC = 6
EPOCHS = 8
BLOCK = 256
HELD_OUT_PARTS = 5
# Texts with a lower score are rejected.
KEEP_FROM = 0.3


@dataclass
class Network:
    """vectors (257, DIMS); filters (WIDTH * DIMS, FILTERS); the rest in order of use."""

    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    mix: np.ndarray

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, positions, filters). A window is two neighbouring steps, so each step is multiplied once per half."""
        half = STEP * DIMS
        steps = self.vectors[chunks].reshape(len(chunks), CHUNK // STEP, half)
        halves = steps @ np.concatenate([self.filters[:half], self.filters[half:]], axis=1)
        return halves[:, :-1, :FILTERS] + halves[:, 1:, FILTERS:]

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(chunks).max(axis=1) + self.bias, 0)
        return pooled @ self.weights + self.offset


def chunk_starts(size: int) -> np.ndarray:
    """Where chunks begin in a text of that many bytes: at least one, together covering all."""
    return np.arange(max(1, -(-(size - OVERLAP) // (CHUNK - OVERLAP)))) * (CHUNK - OVERLAP)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The chunks at `starts`, filled up beyond `ends`."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    if not len(data):
        return np.full(at.shape, FILLING, dtype=np.int16)
    return np.where(inside, data[np.minimum(at, len(data) - 1)], np.int16(FILLING)).astype(np.int16)


def doc_features(net: Network, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean, lowest and highest chunk logit of each text."""
    per_doc = [chunk_starts(int(b - a)) for a, b in zip(bounds[:-1], bounds[1:])]
    n = np.array([len(p) for p in per_doc])
    starts = np.concatenate([p + a for p, a in zip(per_doc, bounds[:-1])])
    ends = np.repeat(bounds[1:], n)
    logits = np.concatenate([
        net.logits(cut(data, starts[i : i + BLOCK], ends[i : i + BLOCK])) for i in range(0, len(starts), BLOCK)
    ])
    first = np.cumsum(n) - n
    return np.stack([np.add.reduceat(logits, first) / n, np.minimum.reduceat(logits, first), np.maximum.reduceat(logits, first)], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.state = rate, 0, {}

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        m, v = self.state.get(name, (np.zeros_like(value), np.zeros_like(value)))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient * gradient
        self.state[name] = m, v
        return value - self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)


def train_filters(chunks: np.ndarray, labels: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Network:
    """Chunk-wise logistic loss; through the maximum only the window that won is learned from."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (257, DIMS)).astype(np.float32), rng.normal(0, 0.25, (WIDTH * DIMS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32), rng.normal(0, 0.2, FILTERS).astype(np.float32), 0.0, np.array([0, 1, 0, 0], np.float64),
    )
    adam = Adam(0.01)
    batch = 64
    for epoch in range(epochs):
        adam.rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(chunks))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            x, y, w = chunks[rows], labels[rows], weight[rows]
            r = net.responses(x)
            best = r.argmax(axis=1)
            top = np.take_along_axis(r, best[:, None], axis=1)[:, 0] + net.bias
            pooled = np.maximum(top, 0)
            miss = (w * (sigmoid(pooled @ net.weights + net.offset) - y) / len(rows)).astype(np.float32)
            back = miss[:, None] * net.weights * (top > 0)
            window = x[np.arange(len(rows))[:, None, None], best[..., None] * STEP + np.arange(WIDTH)]
            seen = net.vectors[window].reshape(len(rows), FILTERS, WIDTH * DIMS)
            g_filters = np.einsum("kf,kfd->df", back, seen)
            g_seen = (back[..., None] * net.filters.T).reshape(-1, DIMS)
            g_vectors = np.stack([np.bincount(window.ravel(), g_seen[:, d], 257) for d in range(DIMS)], axis=1)
            adam.t += 1
            net.filters = adam.step("filters", net.filters, g_filters).astype(np.float32)
            net.vectors = adam.step("vectors", net.vectors, g_vectors.astype(np.float32)).astype(np.float32)
            net.bias = adam.step("bias", net.bias, back.sum(axis=0)).astype(np.float32)
            net.weights = adam.step("weights", net.weights, miss @ pooled).astype(np.float32)
            net.offset = float(adam.step("offset", np.float64(net.offset), np.float64(miss.sum())))
    return net


def fit_mix(features: np.ndarray, labels: np.ndarray, weight: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Ridge logistic regression by Newton steps: offset and one weight per feature."""
    x = np.concatenate([np.ones((len(features), 1)), features], axis=1).astype(np.float64)
    beta = np.array([0.0, 1.0, 0.0, 0.0])
    ridge = penalty * np.diag([0.0, 1.0, 1.0, 1.0])
    for _ in range(25):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (p - labels)) + ridge @ beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge + 1e-9 * np.eye(4)
        beta = beta - np.linalg.solve(curve, slope)
    return beta


def is_held_out(id_col: str) -> Column:
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % HELD_OUT_PARTS == 0


def sampled_texts(
    docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, sample: int
) -> tuple[DataFrame, dict[int, int]]:
    """id, text, label, aside of the sample, and the number of labelled rows per label."""
    usable = labels.filter(F.col(f"`{label}`").isin(0, 1) & ~is_held_out(id_col)).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")
    )
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    turn = [F.xxhash64("id"), F.col("id")]
    picked = usable.filter("label = 0").orderBy(*turn).limit(sample).unionAll(usable.filter("label = 1").orderBy(*turn).limit(sample))
    picked = picked.withColumn("aside", F.pmod(F.xxhash64("id", F.lit("aside")), F.lit(5)) == 0)
    # At most 2 * sample narrow rows; of rows that repeat an id, a single one.
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(picked), "id")
    return texts.groupBy("id", "label", "aside").agg(F.min_by("text", F.xxhash64("text")).alias("text")), counts


def n_chunks(text: str) -> Column:
    """The number of chunks of a text."""
    return F.greatest(F.lit(1), F.ceil((F.coalesce(F.octet_length(text), F.lit(0)) - OVERLAP) / (CHUNK - OVERLAP)))


def training_chunks(texts: DataFrame, share: float) -> list[tuple]:
    """That share of the chunks of every text, at least one, as (id, label, chunk bytes) in a fixed order."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, chunks = [], [], []
            for value, one, kind in zip(batch.column("text"), batch.column("id"), batch.column("label")):
                data = np.frombuffer((value.as_py() or "").encode(), np.uint8)
                starts = chunk_starts(len(data))
                n = max(1, round(share * len(starts)))
                if n < len(starts):
                    starts = starts[((np.arange(n) + 0.5) * len(starts) / n).astype(int)]
                for start in starts:
                    ids.append(one.as_py())
                    kinds.append(kind.as_py())
                    chunks.append(data[start : start + CHUNK].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("id").type), pa.array(kinds, pa.int32()), pa.array(chunks, pa.binary())], names=["id", "label", "chunk"])

    id_type = texts.schema["id"].dataType.simpleString()
    rows = texts.select("id", "label", "text").mapInArrow(read, f"id {id_type}, label int, chunk binary")
    return sorted((r["id"], r["label"], bytes(r["chunk"])) for r in rows.collect())


def whole_features(net: Network, texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The features of whole texts as scoring computes them, and their labels, in a fixed order: three numbers a row."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [doc_features(net, data, bounds) for _, _, data, bounds in text_groups(batch.column("text"))]
            columns = np.concatenate([np.empty((0, 3)), *every]).astype(np.float64).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), *[pa.array(np.ascontiguousarray(c)) for c in columns]], names=["id", "label", "mean", "low", "high"]
            )

    id_type = texts.schema["id"].dataType.simpleString()
    rows = sorted(map(tuple, texts.select("id", "label", "text").mapInArrow(read, f"id {id_type}, label int, mean double, low double, high double").collect()))
    return np.array([r[2:] for r in rows], float).reshape(len(rows), 3), np.array([r[1] for r in rows], float)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, chunks_per_doc: int = CHUNKS_PER_DOC, epochs: int = EPOCHS,
) -> Network | float:
    """The network, or a constant score where the labels are of one kind."""
    texts, counts = sampled_texts(docs, labels, id_col, text, label, sample)
    sizes = texts.groupBy("label", "aside").agg(F.count(F.lit(1)).alias("rows"), F.sum(n_chunks("text")).alias("chunks")).collect()
    kinds = {r["label"] for r in sizes}
    if len(kinds) < 2:
        return float(kinds.pop()) if kinds else 0.5
    filters_on = aside = texts
    if len(sizes) == 4:  # both labels on both sides
        filters_on, aside = texts.filter("not aside"), texts.filter("aside")
        sizes = [r for r in sizes if not r["aside"]]
    share = min(1.0, chunks_per_doc * sum(r["rows"] for r in sizes) / sum(r["chunks"] for r in sizes))
    rows = training_chunks(filters_on, share)
    data = np.frombuffer(b"".join(c for _, _, c in rows), np.uint8)
    ends = np.cumsum([len(c) for _, _, c in rows])
    chunks = cut(data, ends - np.array([len(c) for _, _, c in rows]), ends)
    y = np.array([kind for _, kind, _ in rows], np.float32)
    good = y.mean()
    weight = np.where(y == 1, 0.5 / good, 0.5 / (1 - good)).astype(np.float32)
    net = train_filters(chunks, y, weight, epochs)
    features, truth = whole_features(net, aside)
    natural = counts[1] / (counts[0] + counts[1])
    weigh = np.where(truth == 1, natural / truth.mean(), (1 - natural) / (1 - truth.mean()))
    net.mix = fit_mix(features, truth, weigh)
    return net


def score(model: Network | float, text: Column) -> Column:
    """The score of whole texts, between 0 and 1."""
    if not isinstance(model, Network):
        return F.lit(float(model))

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            out = [np.empty(0)]
            for _, _, data, bounds in text_groups(column):
                features = doc_features(model, data, bounds)
                out.append(sigmoid(model.mix[0] + features.astype(np.float64) @ model.mix[1:]))
            yield pa.array(np.concatenate(out), pa.float64())

    scored.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scored, "double")(text)
