"""Ranked lexical search by buckets of impact vectors ordered by length (after LEMP).

A document is the vector of its terms' impacts, (10^9 * tf) div (1000 * tf + 12 * m),
an item the vector of its terms' weights times their repeats; a score is their
inner product, all in 64-bit integers. Items are the queries: they are taken in
blocks of about BLOCK_TERMS distinct (item, term) pairs, and each block meets
all documents where they are read, so neither texts nor vectors are shuffled.

A task orders the vectors of each Arrow batch by their length (Euclidean norm)
and cuts them into buckets, longest first. With theta the k-th score that an
item has found in this task so far:

1. Cauchy-Schwarz: an item whose norm times the bucket's greatest length stays
   under theta skips the bucket (and all later ones of the batch).
2. Coordinate bounds of the bucket: the inner product with the greatest impact
   of each term in the bucket is an upper bound as well.
3. Coordinate bounds of a vector: exact on the item's FOCUS heaviest terms,
   Cauchy-Schwarz on what is left of both vectors.
4. Survivors are scored exactly in integers.

Bounds have a margin for rounding and only drop what is strictly under theta,
so ties stay. A task hands on at most k rows of each item. Counts (documents,
terms, documents of each query term) come from a pass over all texts before,
summed in each task first.

Defined results: null text: no terms; rows of one item_id (null is one, too)
are one item with all their terms; every row of documents is a document, also
where ids repeat; a null doc_id ranks after all others of its score; an item
without a matching document, and empty tables: no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, release_memory, small_batches

#: (item, term) pairs of a block of items: some 30 MB in a worker.
BLOCK_TERMS = 200_000
#: Vectors of a bucket, and most cells of its dense form.
BUCKET_ROWS = 256
BUCKET_CELLS = 1 << 21
#: Heaviest terms of an item whose part of a score is taken exactly before the rest is bounded.
FOCUS = 6
#: Bytes of a text that are cut into terms at once.
CHUNK = 1 << 20
MARGIN = 1 + 1e-9

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_FOLD = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_counts(text: bytes | None) -> Counter[bytes]:
    """How often each term of a text occurs: ASCII letters and digits and all else beyond ASCII, A-Z lower-cased."""
    folded, counts, at = (text or b"").translate(_FOLD), Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + CHUNK)
        end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, term (binary), repeats: the terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, t, n) for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for t, n in term_counts(x.as_py()).items()]
            ids, terms, repeats = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary()), pa.array(repeats, pa.int64())], names=["item_id", "term", "repeats"])

    rows = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, "item_id bigint, term binary, repeats bigint").groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats"))


@dataclass
class CorpusCounts:
    """Documents with a term, all their terms, and the documents holding each term of a vocabulary."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        """floor(1000 * ln((2N + 2) / (2df + 1))) of each term."""
        n = self.documents
        return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(df) + 1))) for df in self.holding], np.int64)


def corpus_counts(texts: DataFrame, vocabulary: dict[bytes, int]) -> CorpusCounts:
    """Counts over all rows of texts (column text, binary); a task sums its own before they are added up."""
    width = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = term_counts(text.as_py())
                if counts:
                    total[width] += 1
                    total[width + 1] += counts.total()
                    total[[vocabulary[t] for t in counts.keys() & vocabulary.keys()]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])
        release_memory()

    out = np.zeros(width + 2, np.int64)
    for r in texts.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow().to_pylist():  # one row for each term of the block
        out[r["at"]] = r["n"]
    return CorpusCounts(int(out[width]), int(out[width + 1]), out[:width])


@dataclass
class Items:
    """The weight vectors of a block of items: those of item i lie from start[i] on, heaviest first."""

    ids: list[int | None]
    start: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    norms: np.ndarray
    rest: np.ndarray

    @staticmethod
    def build(block: list[tuple[int | None, int, int]], weights: np.ndarray) -> Items:
        """From (item_id, term number, repeats)."""
        vectors: dict[int | None, list[tuple[int, int]]] = {}
        for item, term, repeats in block:
            vectors.setdefault(item, []).append((-repeats * int(weights[term]), term))
        ordered = [sorted(v) for v in vectors.values()]
        sizes = np.array([len(v) for v in ordered], np.int64)
        own = [np.array([-w for w, _ in v], np.int64) for v in ordered]
        length = lambda w: math.sqrt((w.astype(float) ** 2).sum())
        return Items(
            [*vectors],
            np.concatenate(([0], np.cumsum(sizes))),
            np.array([t for v in ordered for _, t in v], np.int64),
            np.concatenate(own) if own else np.zeros(0, np.int64),
            np.array([length(w) for w in own]),
            np.array([length(w[FOCUS:]) for w in own]),
        )


class Ranking:
    """The k best documents that each item has met so far; theta is what a score needs to matter."""

    def __init__(self, items: Items, k: int) -> None:
        self.items, self.k = items, k
        self.theta = np.ones(len(items.ids), np.int64)
        self.best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, i: int, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        if i in self.best:
            score, null, doc = (np.concatenate(x) for x in zip(self.best[i], (score, null, doc), strict=True))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.best[i] = score[order], null[order], doc[order]
        if len(order) == self.k:
            self.theta[i] = max(1, score[order[-1]])

    def search(self, doc: np.ndarray, null: np.ndarray, start: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        """Meet the documents whose vectors (term numbers, impacts) lie from start[i] on."""
        squares = np.concatenate(([0.0], np.cumsum(impacts.astype(float) ** 2)))
        squares = squares[start[1:]] - squares[start[:-1]]
        lengths = np.sqrt(np.maximum(squares, 0))
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < len(order):
            rows = order[at : at + BUCKET_ROWS]
            active = np.flatnonzero(self.items.norms * lengths[rows[0]] * MARGIN >= self.theta)
            if not len(active):
                return  # all that follow are no longer
            at += self._bucket(rows, active, doc, null, start, terms, impacts)

    def _bucket(self, rows: np.ndarray, active: np.ndarray, doc: np.ndarray, null: np.ndarray, start: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> int:
        """Score a bucket for the active items; the number of rows that it took."""
        items = self.items
        while True:
            cells = np.concatenate([np.arange(start[r], start[r + 1]) for r in rows])
            found, column = np.unique(terms[cells], return_inverse=True)
            if len(rows) * len(found) <= BUCKET_CELLS or len(rows) == 1:
                break
            rows = rows[: len(rows) // 2]
        dense = np.zeros((len(found) + 1, len(rows)), np.int64)  # the last row stands for terms that the bucket has not
        dense[column, np.repeat(np.arange(len(rows)), start[rows + 1] - start[rows])] = impacts[cells]
        peak = dense.max(axis=1)
        squares = (dense.astype(float) ** 2).sum(axis=0)
        place = np.minimum(np.searchsorted(found, items.terms), len(found) - 1)
        place = np.where(found[place] == items.terms, place, len(found))
        bound = np.add.reduceat(items.weights * peak[place], items.start[:-1])
        for i in active[bound[active] >= self.theta[active]].tolist():
            own, weights = place[items.start[i] : items.start[i + 1]], items.weights[items.start[i] : items.start[i + 1]]
            head = dense[own[:FOCUS]]
            left = np.sqrt(np.maximum(squares - (head.astype(float) ** 2).sum(axis=0), 0) + 1)
            at = np.flatnonzero(weights[:FOCUS] @ head + items.rest[i] * left * MARGIN >= self.theta[i])
            if len(at):
                score = weights @ dense[np.ix_(own, at)]
                good = score >= self.theta[i]
                if good.any():
                    self.add(i, score[good], null[rows[at[good]]], doc[rows[at[good]]])
        return len(rows)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for i, (score, null, doc) in self.best.items():
            item = pa.array([self.items.ids[i]] * len(doc), pa.int64())
            yield pa.RecordBatch.from_arrays([item, pa.array(doc, mask=null), pa.array(score)], names=["item_id", "doc_id", "score"])


def _block_ranking(texts: DataFrame, block: list[dict], k: int) -> DataFrame:
    """item_id, doc_id, score: what each task found for the items of one block."""
    vocabulary = {t: n for n, t in enumerate(sorted({r["term"] for r in block}))}
    counts = corpus_counts(texts.select("text"), vocabulary)
    items = Items.build([(r["item_id"], vocabulary[r["term"]], r["repeats"]) for r in block], counts.weights())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = Ranking(items, k)
        for batch in batches:
            sizes, terms, tf, m = [], [], [], []
            for text in batch.column(1):
                found = term_counts(text.as_py())
                own = found.keys() & vocabulary.keys()
                sizes.append(len(own))
                terms += [vocabulary[t] for t in own]
                tf += [found[t] for t in own]
                m.append(75 + 25 * found.total() * counts.documents // max(counts.terms, 1))
            tf, start = np.array(tf, np.int64), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            impacts = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(np.array(m, np.int64), sizes))
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            some = np.flatnonzero(np.diff(start))  # documents without a term of any item have no score
            if len(some):
                ids = batch.column(0).fill_null(0).to_numpy()
                ranking.search(ids[some], null[some], np.append(start[some], start[-1]), np.array(terms, np.int64), impacts)
        yield from ranking.rows()
        release_memory()

    return texts.select("doc_id", "text").mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 of each item."""
    small_batches(docs.sparkSession)
    wanted = checkpointed(item_terms(items, item_id, text))
    blocks = -(-wanted.count() // block_terms)
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    found = docs.sparkSession.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for b in range(blocks):
        # a block of the stated queries, about block_terms rows, meets all documents
        block = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow().to_pylist()
        if block:
            found = found.unionByName(_block_ranking(texts, block, k))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
