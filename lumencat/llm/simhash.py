"""SimHash near-duplicates, found with vantage-point trees over the fingerprints.

A vantage-point tree splits points by their Hamming distance d to a vantage
point at a radius mu; a query within r of a point on the other side has
|d - mu| <= r, so branches outside are pruned and boundary-overlapping ones are
visited. On all 64 bits and r = 4 that prunes nothing: distances of unrelated
fingerprints lie at 32 +- 4, and nearly every point overlaps every boundary
(measured: a tree of 8 levels would copy each fingerprint into some 70 of 256
shards). So the distance of a tree is taken on one band of bits at a time. If
two fingerprints differ in at most r bits, then on one of ``bands`` disjoint
bands they differ in at most r // bands; each band has a tree of its own, whose
shards overlap by that radius. A fingerprint goes to every shard that some
point of it may lie within that radius of; inside a shard, whole fingerprints
at home there are compared with all others, again only where the triangle bound
on the distance to a vantage point allows it. BANDS = 3 leaves bands of 21 bits and radius 1: wide bands keep
shards apart when there are many fingerprints.

The trees are built on the driver from SAMPLE fingerprints (chosen by a hash),
whatever the input; they only say where to cut, and every fingerprint is routed.
A shard of more than BLOCK_ROWS is cut into blocks, and all pairs of blocks are
searched as tasks of their own: bounded memory, no pair lost. Each task returns
a spanning forest of its links, never all pairs.

Defined results: null and empty texts have fingerprint 0 and link like any
other; copies of a row share its fingerprint; null doc_id: the row has a
fingerprint and its class' id, but never names a class; empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, release_memory, small_batches
from .components import components

#: Disjoint bands of bits, and fingerprints that the trees are built from.
BANDS = 3
SAMPLE = 1 << 16
#: Rows that a shard is to hold, where its band has another value to split by.
SHARD_ROWS = 2048
#: Most rows of a block of an overfull shard.
BLOCK_ROWS = 60_000
#: Shingles whose bits are counted at once.
CHUNK = 1 << 15
#: Parts of a class' fingerprints when they get its name, and of a hot fingerprint's rows when they get their class.
SALTS = 32
#: A fingerprint is hot if more than one of so many rows have it: no more than these can be.
HOT_SHARE = 1000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed integer."""
    words = (text or "").encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    total = len(words) - size + 1
    first, last = starts[:total].tolist(), ends[size - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, total, CHUNK):
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(first[i : i + CHUNK], last[i : i + CHUNK], strict=True)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, fp (bigint) and the bigint columns carry of every row: one pass, no shuffle."""
    carry = carry or {}
    names = ["doc_id", "fp", *carry]
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), *batch.columns[2:]], names=names)
        release_memory()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *[c.alias(k) for k, c in carry.items()])
    return rows.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


@dataclass
class VPTree:
    """A vantage-point tree over the values of one band, with Hamming distance."""

    leaf: int = -1
    vantage: int = 0
    mu: int = 0
    near: VPTree | None = None
    far: VPTree | None = None
    leaves: int = field(default=1)

    @staticmethod
    def build(values: np.ndarray, weights: np.ndarray, most: int, first: int = 0) -> VPTree:
        """Split until a leaf weighs at most ``most`` or holds one value."""
        if weights.sum() <= most or len(values) < 2:
            return VPTree(leaf=first)
        vantage = int(values[np.argmax(weights)])
        d = np.bitwise_count(values ^ vantage).astype(int)
        by = np.bincount(d, weights)
        mu = int(np.argmin(np.abs(2 * np.cumsum(by)[: d.max()] - by.sum())))  # below the largest distance: no side is empty
        inside = d <= mu
        near = VPTree.build(values[inside], weights[inside], most, first)
        far = VPTree.build(values[~inside], weights[~inside], most, first + near.leaves)
        return VPTree(-1, vantage, mu, near, far, near.leaves + far.leaves)

    def reach(self, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions of the values that some point of the leaf may lie within radius of)."""
        stack = [(self, np.arange(len(values)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if node.leaf >= 0:
                yield node.leaf, at
                continue
            d = np.bitwise_count(values[at] ^ node.vantage).astype(int)
            stack.append((node.near, at[d - radius <= node.mu]))
            stack.append((node.far, at[d + radius > node.mu]))


def band_bits(bands: int) -> list[tuple[int, int]]:
    """(shift, width) of each band."""
    edges = [64 * i // bands for i in range(bands + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def links(fps: np.ndarray, home: np.ndarray, distance: int, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (root, member) of a shard's distinct fingerprints under the links that have an end at home in it.

    Both ends of a link meet where either is at home, so visitors need not be
    compared with each other. Points are sorted by their distance to a vantage
    point: a link's ends differ there by at most ``distance``, so each block
    meets a window only. Points without a partner drop out first; the rest are
    reached outward from a root, and a point once reached is not compared again.
    """
    none = np.zeros(0, fps.dtype)
    if len(fps) < 2 or not home.any():
        return none, none
    d0 = np.bitwise_count(fps ^ fps[0]).astype(np.int16)
    order = np.argsort(d0, kind="stable")
    x, d0, home = fps[order], d0[order], home[order]

    def window(lo: int, hi: int) -> slice:
        return slice(np.searchsorted(d0, lo - distance), np.searchsorted(d0, hi + distance, "right"))

    linked = np.zeros(len(x), bool)
    at_home = np.flatnonzero(home)
    for i in range(0, len(at_home), block):
        part = at_home[i : i + block]
        w = window(d0[part[0]], d0[part[-1]])
        near = np.bitwise_count(x[part, None] ^ x[None, w]) <= distance
        partners = near.sum(axis=1) > 1
        linked[part] |= partners
        linked[w] |= near[partners].any(axis=0)
    x, d0, home = x[linked], d0[linked], home[linked]
    left, roots, members = np.ones(len(x), bool), [], []
    for seed in range(len(x)):
        if not left[seed]:
            continue
        left[seed], found, at = False, [seed], 0
        while at < len(found):
            front = np.array(found[at : at + block])
            at += len(front)
            w = window(d0[front].min(), d0[front].max())
            open_ = w.start + np.flatnonzero(left[w])
            if len(open_):
                near = np.bitwise_count(x[front, None] ^ x[None, open_]) <= distance
                hit = open_[(near & (home[front, None] | home[None, open_])).any(axis=0)]
                left[hit] = False
                found += hit.tolist()
        if len(found) > 1:
            group = x[found]
            roots.append(np.full(len(group) - 1, group[0]))
            members.append(group[1:])
    return (np.concatenate(roots), np.concatenate(members)) if roots else (none, none)


def sampled_trees(distinct: DataFrame, bands: int) -> list[VPTree]:
    """A tree for each band, cut where a shard of the whole table would hold about SHARD_ROWS."""
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").toArrow()["fp"].to_numpy().view(np.uint64)
    most = max(1, SHARD_ROWS * len(sample) // max(total, 1))
    trees = []
    for shift, width in band_bits(bands):
        values, counts = np.unique(band_values(sample, shift, width), return_counts=True)
        trees.append(VPTree.build(values, counts, most) if len(values) else VPTree(leaf=0))
    return trees


def band_values(fps: np.ndarray, shift: int, width: int) -> np.ndarray:
    return ((fps.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)


def fingerprint_links(distinct: DataFrame, distance: int = 4, bands: int = BANDS) -> DataFrame:
    """(a, b): links among distinct fingerprints (column fp) that connect all within ``distance``."""
    layout, radius = band_bits(bands), distance // bands
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = distinct.select("fp").repartition(parts, "fp")
    trees = sampled_trees(distinct, bands)

    def reached(fp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, positions of the fingerprints that go there, whether they are at home)."""
        for band, (shift, width) in enumerate(layout):
            values = band_values(fp, shift, width)
            own = np.empty(len(fp), np.int64)
            for leaf, at in trees[band].reach(values, 0):
                own[at] = leaf
            for leaf, at in trees[band].reach(values, radius):
                yield band << 32 | leaf, at, own[at] == leaf

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(shard, len(at)) for shard, at, _ in reached(batch.column(0).to_numpy())]
            yield pa.RecordBatch.from_pydict({"shard": pa.array([s for s, _ in found], pa.int64()), "n": pa.array([n for _, n in found], pa.int64())})

    # one row for each shard, and there are no more shards than sampled values
    weight = distinct.mapInArrow(weigh, "shard bigint, n bigint").groupBy("shard").agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK_ROWS).collect()
    blocks = {r["shard"]: -(-r["n"] // BLOCK_ROWS) for r in weight}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            out = []
            for shard, at, home in reached(fp):
                own, g = fp[at], blocks.get(shard, 1)
                mine = (own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % g
                out += [(np.full(len(at), shard), np.minimum(mine, other) * g + np.maximum(mine, other), own, home) for other in range(g)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["shard", "task", "fp", "home"])
        release_memory()

    def search(shard: pa.Table) -> pa.Table:
        # unsigned: counting the bits of a negative number would count those of its magnitude
        a, b = links(shard["fp"].to_numpy().view(np.uint64), shard["home"].to_numpy(), distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = distinct.mapInArrow(route, "shard bigint, task bigint, fp bigint, home boolean")
    return routed.groupBy("shard", "task").applyInArrow(search, "a bigint, b bigint").distinct()


def rooted(docs: DataFrame, distance: int = 4, shingle: int = 4, doc_id: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, fp, carry, component_id and root of every row: the least fingerprint that its own reaches, never null."""
    rows = checkpointed(fingerprints(docs, shingle, doc_id, text, carry))
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(fingerprint_links(distinct, distance)).select(F.col("node").alias("fp"), "root")
    linked = distinct.join(roots, "fp")
    # a class of very many fingerprints is named in SALTS parts
    names = linked.groupBy("root").agg(F.min("least").alias("name")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(names, ["root", "salt"]).select("fp", "root", "name")
    classes = distinct.join(named, "fp", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("name")).alias("component_id"), F.coalesce("root", "fp").alias("root")
    )
    total = distinct.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(distinct.where(F.col("n") * HOT_SHARE > total).select("fp", F.lit(SALTS).alias("parts")))  # HOT_SHARE rows at most
    parted = rows.join(hot, "fp", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.coalesce("parts", F.lit(1))).cast("int"))
    classes = classes.join(hot, "fp", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    return parted.join(classes.drop("parts"), ["fp", "salt"]).select(*rows.columns, "component_id", "root")


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest doc_id that its fingerprint reaches."""
    return rooted(docs, distance, shingle, doc_id, text).select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
