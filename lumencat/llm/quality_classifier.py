"""Quality classifier: random-indexing word vectors, pooled, into a two-layer numpy network.

Random indexing: every document of the corpus is a context with a sparse random
ternary vector, drawn from a hash of its own units; a word's vector is the sum
of the vectors of the documents that hold it. The sums are whole numbers, added
up in each task and then in a tree of merges, so they do not depend on
partitions. Units are letter runs in small letters, numbers as one unit, runs of
other characters by their first character and length class, and a mark for
all-capital words. Units are hashed; a unit has a row of the table as soon as a
document holds it, so the table grows with the vocabulary up to BUCKETS rows of
DIMENSIONS bytes (16 MB), the proven bound of its broadcast. A document is the
mean of its units' vectors plus a few ratios. The network has one tanh layer;
its logit is divided by a temperature fitted on rows that the training did not
see.

The network and its temperature are fitted on at most MAX_TRAIN labelled rows
(chosen by a hash of their id), the documented bound; word vectors come from
all documents, and the score covers every whole text. Language, source, id and
label are no inputs.

Defined results: null and empty texts get the score of a document without
units; labels that are null or neither 0 nor 1 do not train; of repeated labels
of an id the lowest counts; without labels of both kinds every score is the
share of label 1 (0.5 without any); empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import LETTER, NUMBER, code_tables, windows
from .common import release_memory, small_batches

MAX_TRAIN = 12_000
BUCKETS = 1 << 18
DIMENSIONS = 64
#: Entries that are not zero in a context's vector: one of each DIMENSIONS / PARTS.
PARTS = 8
#: Characters cut into units together, and units pooled at once.
GROUP_CHARS = 1 << 20
SLICE = 1 << 15
#: Rows of the table that travel together, and partial tables that meet in one merge.
BLOCK = 1 << 11
FAN_IN = 32
NUMBERS, CAPITALS, MULTIPLIER = 1, 2, 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Hashes spread over all 64 bits."""
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _pieces_units(pieces: list[str]) -> list[np.ndarray]:
    """Buckets of the units of each piece of text."""
    lower, kinds = code_tables()
    codes = np.frombuffer("\n".join([*pieces, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    until = np.cumsum(np.fromiter((len(p) + 1 for p in pieces), np.int64, len(pieces)))
    small, kind = lower[codes], kinds[codes]
    start = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
    size = np.diff(np.append(start, len(codes)))
    power = np.multiply.accumulate(np.full(int(size.max()), MULTIPLIER, np.uint64))
    place = np.arange(len(codes)) - np.repeat(start, size)
    own = np.add.reduceat((small.astype(np.uint64) + np.uint64(1)) * power[place], start)
    capital = (np.add.reduceat((codes != small).astype(np.int64), start) == size) & (size > 1)
    kind = kind[start]
    other = small[start].astype(np.uint64) * np.uint64(4) + np.minimum(size, 3).astype(np.uint64) + np.uint64(8)
    units = np.where(kind == LETTER, own, np.where(kind == NUMBER, np.uint64(NUMBERS), other))
    word = kind > 0
    start, units, capital = start[word], units[word], (capital & (kind == LETTER))[word]
    # a word in capitals is followed by their mark
    count = 1 + capital
    end = np.cumsum(count)
    units = np.repeat(units, count)
    units[end[capital] - 1] = CAPITALS
    buckets = (mixed(units) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int32)
    cut = np.concatenate(([0], end))[np.searchsorted(start, until)]
    return [buckets[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist(), strict=True)]


def text_units(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The units of each whole text, texts taken together in groups of GROUP_CHARS; a longer one passes in windows."""
    group: list[str] = []
    size = 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if size + len(text) > GROUP_CHARS and group:
            yield from _pieces_units(group)
            group, size = [], 0
        if len(text) > GROUP_CHARS:
            yield np.concatenate([_pieces_units([w])[0] for w in windows(text, GROUP_CHARS)])
            continue
        group.append(text)
        size += len(text)
    if group:
        yield from _pieces_units(group)


def pooled(units: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Input row of the network."""
    n = len(units)
    if not n:
        return np.zeros(DIMENSIONS + 4, np.float32)
    total = sum(vectors[units[i : i + SLICE]].sum(axis=0, dtype=np.int64) for i in range(0, n, SLICE))
    mean = total / (127 * n)
    distinct = len(np.unique(units))
    return np.concatenate([mean, [np.log1p(n) / 10, distinct / n, np.log1p(n / distinct) / 3, np.linalg.norm(mean)]]).astype(np.float32)


def context_vectors(units: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(columns, signs) of the PARTS entries of each document's ternary vector, fixed by its distinct units."""
    seeds = np.array([int(mixed(np.unique(u).astype(np.uint64) + np.uint64(1)).sum(dtype=np.uint64)) for u in units], np.uint64)
    drawn = mixed(seeds[:, None] + np.uint64(MULTIPLIER) * np.arange(1, PARTS + 1, dtype=np.uint64))
    width = DIMENSIONS // PARTS
    columns = (drawn % np.uint64(width)).astype(np.int64) + width * np.arange(PARTS)
    return columns, np.where(drawn >> np.uint64(63), 1, -1).astype(np.int32)


@dataclass
class Network:
    """Standardised inputs, one tanh layer, a logit over a temperature."""

    centre: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4) -> Network:
    """Adam on the logistic loss; every eighth row is kept for the temperature."""
    rng = np.random.default_rng(7)
    share = float(y.mean()) if len(y) else 0.5
    net = Network(x.mean(axis=0) if len(x) else np.zeros(x.shape[1]), x.std(axis=0) + 1e-3 if len(x) else np.ones(x.shape[1]), rng.normal(0, 0.3, (x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    share = min(max(share, 1e-3), 1 - 1e-3)
    net.b2 = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return net
    held = np.arange(len(x)) % 8 == 0
    a, t = (x[~held] - net.centre) / net.spread, y[~held]
    names = ("w1", "b1", "w2", "b2")
    m, v = {k: 0.0 for k in names}, {k: 0.0 for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(a))
        for i in range(0, len(a), 256):
            at = order[i : i + 256]
            h = np.tanh(a[at] @ net.w1 + net.b1)
            error = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40))) - t[at]) / len(at)
            back = np.outer(error, net.w2) * (1 - h**2)
            grads = {"w1": a[at].T @ back + decay * net.w1, "b1": back.sum(axis=0), "w2": h.T @ error + decay * net.w2, "b2": error.sum()}
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g**2
                setattr(net, k, getattr(net, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
    logits, t = net.logit(x[held]), y[held]
    losses = {c: float(np.mean(np.logaddexp(0, np.where(t == 1, -logits, logits) / c))) for c in np.geomspace(0.5, 8, 25)}
    net.temperature = float(min(losses, key=losses.get))
    return net


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, most: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, quality, text) of at most ``most`` labelled ids."""
    chosen = labels.where(F.col("quality").isin(0, 1) & F.coalesce(usable, F.lit(False))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), "text")  # most rows of 16 bytes


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of unit vectors (bytes, 127 for length 1) over all documents.

    A task sums its documents into one table and sends its blocks compressed;
    blocks meet FAN_IN at a time, so no merge grows with the number of tasks.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS * DIMENSIONS, np.int32)
        for batch in batches:
            units = [*text_units(batch.column(0).to_pylist())]
            if not units:
                continue
            columns, signs = context_vectors(units)
            distinct = [np.unique(u) for u in units]
            count = [len(u) for u in distinct]
            at = np.concatenate(distinct).astype(np.int64) * DIMENSIONS
            for j in range(PARTS):
                np.add.at(table, at + np.repeat(columns[:, j], count), np.repeat(signs[:, j], count))
        yield from blocks(table.reshape(-1, BLOCK * DIMENSIONS))
        del table
        release_memory()

    def blocks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, block in enumerate(table):
            if block.any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "task": pa.array([task], pa.int64()), "block": pa.array([_packed(block)], pa.binary())})

    def merge(key: tuple, found: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK * DIMENSIONS, np.int64)
        for b in found["block"]:
            total += _unpacked(b.as_py())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int64()), "block": pa.array([_packed(total)], pa.binary())})

    kind = "part int, task bigint, block binary"
    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(partial, kind)
    left = found.rdd.getNumPartitions()
    while True:
        left = -(-left // FAN_IN)
        found = found.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("part", "task").applyInArrow(merge, kind)
        if left <= 1:
            break
    table = np.zeros((BUCKETS, DIMENSIONS), np.int8)
    for r in found.select("part", "block").toLocalIterator():  # BUCKETS * DIMENSIONS numbers, block by block
        sums = _unpacked(r["block"]).reshape(BLOCK, DIMENSIONS).astype(np.float64)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        unit = np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)
        table[r["part"] * BLOCK : (r["part"] + 1) * BLOCK] = np.rint(127 * unit)
    return table


def _packed(block: np.ndarray) -> bytes:
    """A block's numbers, narrow where they fit, compressed."""
    narrow = block.astype(np.int16)
    kind = b"s" if (narrow == block).all() else b"l"
    raw = (narrow if kind == b"s" else block.astype(np.int64)).tobytes()
    return kind + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    data = pa.decompress(raw[9:], int.from_bytes(raw[1:9], "little"), codec="zstd")
    return np.frombuffer(data, np.int16 if raw[:1] == b"s" else np.int64)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, most: int = MAX_TRAIN) -> tuple[np.ndarray, Network]:
    """Word vectors of all docs, and the network of the labelled rows for which usable (over doc_id) holds."""
    small_batches(docs.sparkSession)
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pooled(u, shared.value).tobytes() for u in text_units(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.binary())], names=["doc_id", "quality", "x"])
        release_memory()

    rows = training_rows(docs, labels, usable, most)
    found = rows.mapInArrow(inputs, "doc_id bigint, quality int, x binary").toPandas()  # most rows of 272 bytes
    shared.unpersist()
    found = found.sort_values(["doc_id", "x"], kind="stable")
    x = np.array([np.frombuffer(b, np.float32) for b in found["x"]]).reshape(-1, DIMENSIONS + 4).astype(np.float64)
    return vectors, train(x, found["quality"].to_numpy(np.float64))


def scored(docs: DataFrame, model: tuple[np.ndarray, Network], text: str = "text", name: str = "score") -> DataFrame:
    """docs with the column name: the probability of label 1 of every whole text."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(texts):
        vectors, net = shared.value
        x = np.array([pooled(u, vectors) for u in text_units(texts.tolist())], np.float64).reshape(-1, DIMENSIONS + 4)
        release_memory()
        return pd.Series(net.score(x))

    return docs.withColumn(name, score(F.col(text).cast("string")))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor
