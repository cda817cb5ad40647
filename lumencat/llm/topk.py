"""Exact top-k inner products by a Voronoi kNN join.

Vectors are integers floor(scale * x). With M the largest norm among the
candidates, a vector x is lifted to (x, sqrt(M^2 - |x|^2)) and a query q to
(q, 0): squared distance is then |q|^2 + M^2 - 2 q.x, so the nearest lifted
vectors are those of the highest inner product. Queries and vectors are grouped
by their nearest of a bounded number of pivots. Summaries alone (for each group
its largest distance to its pivot, for each vector group its k smallest
distances) give each query group a bound on the distance of its k-th
neighbour; a vector is sent to a query group only if its distance to its own
pivot does not rule it out by the triangle inequality. Neighbouring query cells
are merged into groups of about GROUP_QUERIES queries, so a vector is copied at
most once for each such group. Groups are solved locally, in blocks, and
partial results are merged.

A group that holds a large share of the vectors or queries is cut into blocks
of about BLOCK_ROWS, each its own task. All bounds have a margin for rounding;
scores are exact integers. Vectors with a component so large that sums of
doubles would not be exact are rare outliers that would spoil the bounds: they
form a cell of their own, meet everything, and are multiplied as Python integers.

Defined results: vectors that are null or hold null or non-finite components,
and rows with a null id, take no part; a shorter vector counts as padded with
zeros; of rows with one id the smallest vector counts; fewer than k candidates:
all of them; ties go to the smaller id; a score beyond 64 bits is given as the
nearest that fits; empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import checkpointed

#: Pivots grow with the root of the table between these numbers.
PIVOTS = (48, 1024)
BLOCK_ROWS = 20_000
GROUP_QUERIES = 4096
MARGIN = 1e-6
#: Integers of which each, and their sums, are exact as doubles.
EXACT = 1 << 53
#: The largest double: scaled components beyond it are taken as it.
MOST = 1.7976931348623157e308


def quantised(vector: Column, scale: int = 256) -> Column:
    """Whole numbers as doubles: a double of 2^52 or more is whole already."""

    def one(x: Column) -> Column:
        y = F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(MOST)), F.lit(-MOST))
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to width."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes]) if len(sizes) else []] = flat
    return out


def exact_dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of whole numbers as Python integers, cut to 64 bits."""
    whole = lambda m: np.array([[int(v) for v in row] for row in m], object).reshape(m.shape)
    scores = whole(x) @ whole(y).T
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(max(v, low), high) for v in row] for row in scores], np.int64).reshape(len(x), len(y))


def dot(x: np.ndarray, y: np.ndarray, limit: float) -> np.ndarray:
    """Exact inner products of all rows; rows with a component beyond limit are multiplied as integers."""
    big_x, big_y = ((np.abs(m) > limit).any(axis=1) for m in (x, y))
    out = np.empty((len(x), len(y)), np.int64)
    out[np.ix_(~big_x, ~big_y)] = np.rint(x[~big_x] @ y[~big_y].T).astype(np.int64)
    if big_x.any():
        out[big_x] = exact_dot(x[big_x], y)
    if big_y.any():
        out[:, big_y] = exact_dot(x, y[big_y])
    return out


def voronoi_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", pivots: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k candidates of highest inner product."""
    base = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
    base = base.select(F.col(vec_id).cast("bigint").alias("id"), quantised(F.col(vector), scale).alias("w"), F.coalesce(is_query, F.lit(False)).alias("q"))
    base = checkpointed(base.groupBy("id").agg(F.min("w").alias("w"), F.max("q").alias("q")))
    width, total = base.agg(F.max(F.size("w")), F.count("*")).first()
    if not total:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(int(width), 1)
    limit = float(np.floor(np.sqrt(EXACT / width)))
    large = F.exists("w", lambda x: F.abs(x) > limit)
    # narrow integers travel; only outliers stay doubles
    base = base.select("id", F.when(~large, F.col("w").cast("array<int>")).alias("v"), F.when(large, F.col("w")).alias("w"), "q")
    usual = base.where(F.col("v").isNotNull())
    most = float(usual.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()[0] or 0.0)
    number = pivots or min(max(int(total**0.5), PIVOTS[0]), PIVOTS[1])
    chosen = usual.orderBy(F.xxhash64("id"), "id").limit(number).select("v").toArrow()["v"]
    centre = _matrix(chosen, width)
    lift = np.sqrt(np.maximum(most - (centre**2).sum(axis=1), 0))
    centre = np.column_stack([centre, lift])
    outliers = len(centre)  # the cell of large vectors

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            normal = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            asked = batch.column(3).to_numpy(zero_copy_only=False)
            own = np.flatnonzero(normal)
            x = _matrix(batch.column(1).take(pa.array(own)), width)
            norm = (x**2).sum(axis=1)
            for query in (False, True):
                at = np.flatnonzero(asked[own]) if query else np.arange(len(own))
                if len(at):
                    y = np.column_stack([x[at], np.zeros(len(at)) if query else np.sqrt(np.maximum(most - norm[at], 0))])
                    d = np.sqrt(np.maximum((y**2).sum(axis=1)[:, None] + (centre**2).sum(axis=1) - 2 * y @ centre.T, 0))
                    cell = d.argmin(axis=1)
                    yield _placed(batch, own[at], query, cell, d[np.arange(len(at)), cell])
                rest = np.flatnonzero(~normal & asked) if query else np.flatnonzero(~normal)
                if len(rest):
                    yield _placed(batch, rest, query, np.full(len(rest), outliers), np.zeros(len(rest)))

    placed = checkpointed(base.mapInArrow(assign, "id bigint, v array<int>, w array<double>, q boolean, cell int, d double"))
    # Summaries: one row for each side and cell; the k smallest distances of each cell of vectors.
    sides = {(r["q"], r["cell"]): r for r in placed.groupBy("q", "cell").agg(F.max("d").alias("far"), F.count("*").alias("n")).collect()}
    nearest = Window.partitionBy("cell", "part").orderBy("d")
    small = placed.where(~F.col("q") & (F.col("cell") < outliers)).withColumn("part", F.spark_partition_id()).withColumn("no", F.row_number().over(nearest)).where(F.col("no") <= k + 1)
    small = small.withColumn("no", F.row_number().over(Window.partitionBy("cell").orderBy("d"))).where(F.col("no") <= k + 1)
    close = small.select("cell", "d").toPandas()  # at most pivots * (k + 1) rows
    between = np.sqrt(np.maximum(((centre[:, None] - centre[None]) ** 2).sum(axis=2), 0))
    queries = {c: r for (q, c), r in sides.items() if q}
    data = {c: r for (q, c), r in sides.items() if not q}
    slack = MARGIN * (1 + np.sqrt(most))
    theta = {}
    for i, r in queries.items():
        if i < outliers:
            # k + 1: one of the neighbours may be the query itself
            bound = np.sort(r["far"] + between[i, close["cell"]] + close["d"].to_numpy())
            theta[i] = bound[k] if len(bound) > k else np.inf
    groups = _grouped({i: r["n"] for i, r in queries.items() if i < outliers}, between)
    if outliers in queries:
        groups[outliers] = len(groups)
    members = {g: [i for i in groups if groups[i] == g] for g in {*groups.values()}}

    def least(j: int, g: int) -> float:
        """Least distance to its own pivot that a vector of cell j needs to matter to group g; outliers meet everything."""
        if j == outliers or outliers in members[g]:
            return -np.inf
        return min(between[i, j] - queries[i]["far"] - theta[i] - slack for i in members[g])

    reach = {(j, g): least(j, g) for g in members for j in data}
    blocks_q = {g: -(-sum(queries[i]["n"] for i in own) // BLOCK_ROWS) for g, own in members.items()}
    blocks_d = {j: -(-r["n"] // BLOCK_ROWS) for j, r in data.items()}
    # small cells of vectors share a task
    shared = {j: n * BLOCK_ROWS for n, js in enumerate(_batched({j: r["n"] for j, r in data.items()})) for j in js}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query to each block of its own group; a vector to the groups that its distance allows."""
        for batch in batches:
            ids, cell, d = batch.column(0).to_numpy(), batch.column(4).to_numpy(), batch.column(5).to_numpy()
            query = batch.column(3).to_numpy(zero_copy_only=False)
            mixed = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            for c in np.unique(cell).tolist():
                own = np.flatnonzero((cell == c) & ~query)
                asked = np.flatnonzero((cell == c) & query)
                for g in members:
                    if len(own) and len(at := own[d[own] >= reach[c, g]]):
                        for b in range(blocks_q[g]):
                            yield _sent(batch, at, g, b, shared[c] + mixed[at] % blocks_d[c])
                if len(asked):
                    g = groups[c]
                    for task in sorted({shared[j] + b for j in data for b in range(blocks_d[j])}):
                        yield _sent(batch, asked, g, mixed[asked] % blocks_q[g], np.full(len(asked), task))

    def solve(found: pa.Table) -> pa.Table:
        asked = found["q"].to_numpy()
        qs, xs = found.filter(pa.array(asked)), found.filter(pa.array(~asked))
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(qs) and len(xs):
            x, ids = _vectors(xs, width), xs["id"].to_numpy()
            for i in range(0, len(qs), 256):
                part = qs.slice(i, 256)
                scores = dot(_vectors(part, width), x, limit)
                for q, row in zip(part["id"].to_numpy(), scores, strict=True):
                    at = np.flatnonzero(ids != q)
                    if len(at) > k:
                        bar = np.partition(row[at], len(at) - k)[len(at) - k]
                        at = at[row[at] >= bar]
                    at = at[np.lexsort((ids[at], ~row[at]))][:k]  # ~: falling, and defined for every integer
                    out["query_id"].append(np.full(len(at), q))
                    out["vec_id"].append(ids[at])
                    out["score"].append(row[at])
        return pa.table({c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()})

    sent = placed.mapInArrow(send, "id bigint, v array<int>, w array<double>, q boolean, cell int, qblock bigint, dblock bigint")
    parts = sent.groupBy("cell", "qblock", "dblock").applyInArrow(solve, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _vectors(rows: pa.Table, width: int) -> np.ndarray:
    """The rows' vectors, from the narrow column or, for outliers, the wide one."""
    normal = rows["v"].is_valid().to_numpy()
    out = np.empty((len(rows), width))
    out[normal] = _matrix(rows["v"].filter(pa.array(normal)), width)
    if not normal.all():
        out[~normal] = _matrix(rows["w"].filter(pa.array(~normal)), width)
    return out


def _placed(batch: pa.RecordBatch, at: np.ndarray, query: bool, cell: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    part = batch.take(pa.array(at))
    return pa.RecordBatch.from_arrays(
        [part.column(0), part.column(1), part.column(2), pa.array(np.full(len(at), query)), pa.array(cell.astype(np.int32)), pa.array(np.asarray(d, float))], names=["id", "v", "w", "q", "cell", "d"]
    )


def _grouped(sizes: dict[int, int], between: np.ndarray) -> dict[int, int]:
    """Group of each query cell: cells are chained to their nearest free neighbour until a group is full."""
    out: dict[int, int] = {}
    left, group = sorted(sizes), 0
    while left:
        at, total = left[0], 0
        while left and total < GROUP_QUERIES:
            out[at] = group
            total += sizes[at]
            left.remove(at)
            at = min(left, key=lambda i, at=at: between[at, i], default=at)
        group += 1
    return out


def _batched(sizes: dict[int, int]) -> list[list[int]]:
    """Cells of vectors, joined while they fit one block."""
    out: list[list[int]] = []
    room = 0
    for j, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if n > room:
            out.append([])
            room = max(BLOCK_ROWS, n)
        out[-1].append(j)
        room -= n
    return out


def _sent(batch: pa.RecordBatch, at: np.ndarray, cell: int, qblock: int | np.ndarray, dblock: np.ndarray) -> pa.RecordBatch:
    part = batch.take(pa.array(at))
    n = len(at)
    keys = [pa.array(np.full(n, cell, np.int32)), pa.array(np.broadcast_to(qblock, n).astype(np.int64)), pa.array(np.broadcast_to(dblock, n).astype(np.int64))]
    return pa.RecordBatch.from_arrays([*part.columns[:4], *keys], names=["id", "v", "w", "q", "cell", "qblock", "dblock"])
