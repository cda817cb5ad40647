"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class k holds pieces of
floor(capacity / k) tokens, and k of them fill a bin. A document is cut into
whole bins, then greedily into pieces of exact class length down to SHORT
tokens; the rest, under SHORT tokens, is a piece of its own length r with
floor(capacity / r) to a bin. Every worker fills the bins of each class on its
own, in one pass, without a shuffle. What stays in its open bins (fewer than
one bin for each class) is sent on: the leftovers of FAN_IN workers meet in one
task, whose rows are bounded by classes * capacity * FAN_IN, and best-fit
decreasing packs them. Bins that this leaves half empty are cut at powers of
two where that pads less.

Ids are the tokenizers library's, made by the encoder of ``bpe``.

Defined results: null or empty text: the end-of-document id alone; repeated
rows: each packed on its own; order in a sequence: offset, gapless from 0;
empty table: no pieces. A text is held whole as ids (4 bytes a token) in one
worker.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoded_rows, encoder
from .common import checkpointed, small_batches

#: Pieces under so many tokens form classes by exact length.
SHORT = 64
#: Workers whose leftovers are packed together.
FAN_IN = 8

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def class_lengths(capacity: int, short: int = SHORT) -> list[int]:
    """Piece lengths of the reciprocal classes, longest first."""
    out = [capacity // k for k in range(1, capacity + 1) if capacity // k >= short]
    return [*dict.fromkeys(out)]


def cuts(total: int, capacity: int, lengths: list[int]) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces, in order."""
    out, start = [], 0
    rising = lengths[::-1]
    while total - start >= capacity:
        out.append((start, capacity))
        start += capacity
    while start < total:
        left = total - start
        fits = bisect_left(rising, left + 1)
        out.append((start, length := rising[fits - 1] if fits else left))
        start += length
    return out


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of positions in sizes), by best-fit decreasing."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if free > sizes[i]:
            insort(room, (free - sizes[i], b))
    return bins


def trimmed(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Split a bin under half full into runs whose total is a power of two, where that pads less."""
    out = []
    for b in bins:
        while b and sum(sizes[i] for i in b) <= capacity // 2:
            run, total, best = [], 0, 0
            for n, i in enumerate(b, 1):
                total += sizes[i]
                if total & (total - 1) == 0:
                    best = n
            run, b = b[:best], b[best:]
            if not run:
                break
            out.append(run)
        if b:
            out.append(b)
    return out


def harmonic_pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    lengths = class_lengths(capacity)
    per_bin = {n: capacity // n for n in {*lengths, *range(1, SHORT)}}

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, worker = encoder(tokenizer), TaskContext.get().partitionId()
        bins = 0
        open_bins: dict[int, list[tuple]] = defaultdict(list)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=out_schema)

        for part in encoded_rows(enc, batches, 1):
            done = []
            for (key,), ids in part:
                ids = np.append(ids, np.uint32(end_id))
                total = len(ids)
                for start, length in cuts(total, capacity, lengths):
                    piece = key, start, length, zlib.crc32(ids[start : start + length]), total
                    waiting = open_bins[length]
                    waiting.append(piece)
                    if len(waiting) == per_bin[length]:
                        done += [(*p, worker << 32 | bins, i * length, worker) for i, p in enumerate(waiting)]
                        bins += 1
                        waiting.clear()
            if done:
                yield rows(done)
        left = [(*p, None, None, worker) for length in sorted(open_bins) for p in open_bins[length]]
        for i in range(0, len(left), 10_000):
            yield rows(left[i : i + 10_000])

    out_schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "worker")])
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    filled = checkpointed(source.mapInArrow(fill, f"{PIECE}, sequence_id bigint, offset bigint, worker bigint"))

    def close(key: tuple, left: pa.Table) -> pa.Table:
        left = left.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        sizes = left["length"].to_pylist()
        sequence, offset = np.zeros(len(sizes), "int64"), np.zeros(len(sizes), "int64")
        for n, b in enumerate(trimmed(best_fit(sizes, capacity), sizes, capacity)):
            at = 0
            for i in b:
                sequence[i], offset[i] = -1 - (key[0].as_py() << 32 | n), at
                at += sizes[i]
        return left.select(columns[:5]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    full = filled.where(F.col("sequence_id").isNotNull()).select(columns)
    rest = (
        filled.where(F.col("sequence_id").isNull())
        .withColumn("group", F.floor(F.col("worker") / FAN_IN).cast("bigint"))
        .groupBy("group")
        .applyInArrow(close, f"{PIECE}, sequence_id bigint, offset bigint")
    )
    return full.unionByName(rest)
