"""Nearest neighbours of large tables: cells cut from a sample of the reference, and local sensitive hashing.

Every reference row lies in one cell and is shuffled once; nothing of the
reference passes through the driver but a bounded sample and one row for each
cell. A vector visits the cells that its bound on the distance reaches: the distance
found in its home cell, at most the given radius, so a search takes two rounds. Cells are

* k-d boxes for few dimensions: cuts along the principal axis of the widest spread,
* Voronoi cells of sampled pivots for many: the triangle inequality with each
  cell's greatest distance to its pivot, and the half-space between two pivots.

A cell of many rows is cut into blocks that every visitor meets, and the
visitors of a cell into parts that each meet all of it. A task takes the rows
of one (cell, block, part) as they are sorted: the reference first, which is
held, then the visitors group by group, which are not.

Within a radius (``nearest_rows``) whole rows go to their home cell, once; what is found
there bounds them, and only the vectors of rows whose bound reaches other cells go on.
Otherwise (``nearest_by_cells``) the vectors that visit are distinct, and results are keyed by
vector: a vector that a third of all rows share is solved once. Ids may repeat or be
missing in both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import checkpointed

#: Rows that a cell is to hold, cells at most, sampled rows for each cell.
CELL_ROWS = 50_000
MOST_CELLS = 16_384
MOST_PIVOTS = 1024
SAMPLED = 16
#: Most numbers of a sample.
SAMPLE_VALUES = 8_000_000
#: Rows of a block that a task holds, and visitors from which a cell is split into parts.
BLOCK_ROWS = 100_000
PART_ROWS = 1_000_000
#: Within a radius cells and blocks may be so many times larger, up to so many numbers: an index passes most of a cell by, and few bounds leave it.
LARGER, CELL_VALUES = 8, 4_000_000
#: Visitors below which a cell is not split for the sake of idle cores.
LEAST_PART = 20_000
#: Numbers of the visitors that a task searches at a time.
GROUP_VALUES = 2_000_000
#: Dimensions up to which boxes keep rows apart.
BOX_DIMENSIONS = 12
#: Components beyond this count as missing: their squares would not be finite.
LARGEST = 1e150
MARGIN = 1 + 1e-9


def finite(vector: Column) -> Column:
    """Whether a vector is there and has only numbers that can be squared."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False))), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The rows of a list column of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def spread_axes(rows: np.ndarray) -> np.ndarray:
    """Orthogonal axes (columns) of rows, the widest spread first; the attributes' own where squares are not finite."""
    with np.errstate(all="ignore"):
        spread = np.cov(rows.T).reshape(rows.shape[1], -1) if len(rows) > 1 else np.eye(rows.shape[1])
    return np.linalg.eigh(spread)[1][:, ::-1] if np.isfinite(spread).all() else np.eye(rows.shape[1])


def turned(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """x along the axes; summed in order, as matrix products round a row differently from batch to batch."""
    out = np.zeros((len(x), axes.shape[1]))
    for c, axis in zip(x.T, axes, strict=True):
        out += c[:, None] * axis
    return out


class KdCells:
    """Boxes of a k-d tree along the axes of a sample's spread, cut at medians until a leaf has at most ``most`` sampled rows."""

    def __init__(self, sample: np.ndarray, most: int) -> None:
        self.axes = spread_axes(sample)
        self.axis: list[int] = []
        self.cut: list[float] = []
        self.sides: list[tuple[int, int]] = []
        self.leaf: list[int] = []
        self.count = 0
        self._grow(turned(sample, self.axes), most)

    def _grow(self, rows: np.ndarray, most: int) -> int:
        node = len(self.leaf)
        spread = np.ptp(rows, axis=0) if len(rows) else np.zeros(1)
        self.axis.append(int(spread.argmax()))
        self.cut.append(0.0)
        self.sides.append((-1, -1))
        self.leaf.append(-1)
        if len(rows) <= most or not spread.max() > 0:
            self.leaf[node] = self.count
            self.count += 1
            return node
        values = rows[:, self.axis[node]]
        cut = float(np.median(values))
        if not (values < cut).any():
            cut = float(values[values > cut].min())
        self.cut[node] = cut
        self.sides[node] = self._grow(rows[values < cut], most), self._grow(rows[values >= cut], most)
        return node

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's cell, and a zero: boxes need no distance."""
        out = np.empty(len(x), np.int64)
        for leaf, at in self.reach(x, np.full(len(x), -1.0)):
            out[at] = leaf
        return out, np.zeros(len(x))

    def bounded(self, far: dict[int, float]) -> None:
        """Boxes know their bounds."""

    def reach(self, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, positions of the rows that may lie within their bound of something in it); a negative bound reaches the home cell only."""
        # turned coordinates are off by some 1e-15 of the vector's size
        limit = np.where(bound < 0, -1.0, (bound * MARGIN + 1e-13 * np.abs(x).sum(axis=1)) ** 2)
        x = turned(x, self.axes)
        stack = [(0, np.arange(len(x)), np.zeros(len(x)), np.zeros(x.shape))]
        while stack:
            node, at, d2, gap = stack.pop()
            if not len(at):
                continue
            if self.leaf[node] >= 0:
                yield self.leaf[node], at
                continue
            axis = self.axis[node]
            off = x[at, axis] - self.cut[node]
            beyond = d2 - gap[:, axis] ** 2 + off**2
            for side, near in zip(self.sides[node], (off < 0, off >= 0), strict=True):
                go = near | (beyond <= limit[at])
                gaps = gap[go]
                gaps[:, axis] = np.where(near[go], gaps[:, axis], np.abs(off[go]))
                stack.append((side, at[go], np.where(near, d2, beyond)[go], gaps))


class PivotCells:
    """Voronoi cells of pivots; far is the greatest distance of a cell's rows to its pivot."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots, self.count = pivots, len(pivots)
        self.between = self._distance(pivots)
        self.far = np.full(len(pivots), np.inf)

    def _distance(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * x @ self.pivots.T, 0))

    def bounded(self, far: dict[int, float]) -> None:
        self.far = np.array([far.get(i, -np.inf) for i in range(self.count)])

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self._distance(x)
        at = d.argmin(axis=1)
        return at, np.sqrt(((x - self.pivots[at]) ** 2).sum(axis=1))

    def reach(self, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        d = self._distance(x)
        own = d.argmin(axis=1)
        # distances by matrix products are off by some 1e-7 of the norms
        slack = 1e-6 * (1 + np.sqrt((x**2).sum(axis=1)) + np.sqrt((self.pivots**2).sum(axis=1).max()))
        limit = np.where(bound < 0, -np.inf, bound * MARGIN + slack)
        with np.errstate(all="ignore"):
            half = (d**2 - d[np.arange(len(x)), own][:, None] ** 2) / (2 * self.between[own])
        go = (d - self.far <= limit[:, None]) & ~(half > limit[:, None])
        go[np.arange(len(x)), own] = True
        for cell in range(self.count):
            at = np.flatnonzero(go[:, cell])
            if len(at):
                yield cell, at


def cells_of(ref: DataFrame, width: int, total: int, larger: int = 1) -> KdCells | PivotCells:
    """Cells for the reference (column _v, and _tie) from a sample chosen by a hash."""
    boxes = width <= BOX_DIMENSIONS
    wanted = min(max(-(-total // (CELL_ROWS * larger)), 1), MOST_CELLS if boxes else MOST_PIVOTS)
    rows = min(wanted * SAMPLED if boxes else wanted, max(SAMPLE_VALUES // width, 1))
    share = max(total // (2 * rows), 1)
    picked = ref.where(F.pmod(F.xxhash64("_v", "_tie"), F.lit(share)) == 0).select("_v").limit(4 * rows)
    sample = matrix(picked.toArrow()["_v"], width)
    if boxes:
        return KdCells(sample, max(len(sample) // wanted, 1))
    return PivotCells(np.unique(sample, axis=0)[:wanted] if len(sample) else np.zeros((1, width)))


def _placed(ref: DataFrame, cells: KdCells | PivotCells, width: int) -> DataFrame:
    @F.pandas_udf("_cell bigint, _far double")
    def place(x):
        import pandas as pd

        at, far = cells.home(np.stack(x.to_numpy()).astype(float) if len(x) else np.zeros((0, width)))
        return pd.DataFrame({"_cell": at, "_far": far})

    return ref.withColumn("_place", place("_v")).select("_place.*", "_v", "_ref", "_tie", "_best")


def _spread(x: np.ndarray) -> np.ndarray:
    """A number of each row's content, to deal rows to parts."""
    bits = np.ascontiguousarray(x).view(np.uint64)
    out = np.zeros(len(x), np.uint64)
    for c in bits.T:
        out = (out + c) * np.uint64(0x9E3779B97F4A7C15)
    return out >> np.uint64(33)


def part_rows(spark: SparkSession, total: int) -> int:
    """Visitors of a part: four parts for each core, if they are not too small or too large."""
    return min(PART_ROWS, max(total // (4 * spark.sparkContext.defaultParallelism), LEAST_PART))


def _visits(vectors: DataFrame, cells: KdCells | PivotCells, width: int, blocks: dict[int, int], home_only: bool, others_only: bool, radius: bool = False) -> tuple[DataFrame, dict[int, int]]:
    """(_cell, _block, _part, _v, _bound) of every visit of vectors (_v, _bound), and the parts of each cell (radius: of all; else of those with several).

    others_only: what the home cell holds has been met; radius: one block of it.
    """

    def reached(x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        own = cells.home(x)[0] if others_only or home_only else None
        if home_only:
            for cell in np.unique(own):
                yield int(cell), np.flatnonzero(own == cell)
            return
        for cell, at in cells.reach(x, bound):
            at = at[own[at] != cell] if others_only and not (radius and blocks.get(cell, 1) > 1) else at
            if len(at) and cell in blocks:
                yield int(cell), at

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(c, len(at)) for c, at in reached(matrix(batch.column(0), width), batch.column(1).to_numpy())]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], names=["cell", "n"])

    weight = vectors.select("_v", "_bound").mapInArrow(weigh, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    weight = (weight if radius else weight.where(F.col("n") > PART_ROWS)).collect()  # one row for each cell, or hot cell
    most = part_rows(vectors.sparkSession, sum(r["n"] for r in weight)) if radius else PART_ROWS
    parts = {r["cell"]: -(-r["n"] // most) for r in weight}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), width)
            mixed = _spread(x)
            for cell, at in reached(x, batch.column(1).to_numpy()):
                part = (mixed[at] % np.uint64(parts.get(cell, 1))).astype(np.int32)
                own = batch.column(0).take(pa.array(at))
                reach = batch.column(1).take(pa.array(at))
                for block in range(blocks.get(cell, 0)):
                    keys = [pa.array(np.full(len(at), cell)), pa.array(np.full(len(at), block, np.int32)), pa.array(part)]
                    yield pa.RecordBatch.from_arrays([*keys, own, reach], names=["_cell", "_block", "_part", "_v", "_bound"])

    return vectors.select("_v", "_bound").mapInArrow(send, "_cell bigint, _block int, _part int, _v array<double>, _bound double"), parts


def _numbered(spark: SparkSession, blocks: dict[int, int], parts: dict[int, int]) -> tuple[DataFrame, int]:
    """(_cell, _blocks, _parts, _first) of the visited cells: a task for each block and part, numbered from _first; and the tasks' number."""
    rows, first = [], 0
    for cell, n in sorted(parts.items()):
        rows.append((int(cell), int(blocks.get(cell, 1)), int(n), first))
        first += rows[-1][1] * rows[-1][2]
    return spark.createDataFrame(rows, "_cell bigint, _blocks int, _parts int, _first int"), max(first, 1)


def _shared(placed: DataFrame, numbers: DataFrame) -> DataFrame:
    """The reference's rows for each task of their cell, by its number _id."""
    met = placed.join(F.broadcast(numbers), "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return met.withColumn("_id", F.col("_first") + F.pmod(F.xxhash64("_v", "_tie"), "_blocks").cast("int") * F.col("_parts") + F.col("_part"))


def _groups(batches: Iterator[pa.RecordBatch], keys: int, width: int) -> Iterator[tuple[list[pa.RecordBatch], pa.Table]]:
    """(reference rows, some visitors) of one key after the other; rows come sorted by the keys, then the side. The list is one object for all groups of a key."""
    key, held, waiting, count = None, [], [], 0
    for batch in batches:
        marks = np.column_stack([batch.column(i).to_numpy() for i in range(keys + 1)])
        starts = np.flatnonzero(np.concatenate(([True], (marks[1:] != marks[:-1]).any(axis=1)))) if len(marks) else []
        for start, end in zip(starts, [*starts[1:], len(marks)], strict=True):
            own, side = tuple(marks[start, :keys]), marks[start, keys]
            if own != key:
                if waiting:
                    yield held, pa.Table.from_batches(waiting)
                key, held, waiting, count = own, [], [], 0
            rows = batch.slice(start, end - start)
            if side == 0:
                held.append(rows)
                continue
            waiting.append(rows)
            count += len(rows)
            if count * width >= GROUP_VALUES:
                yield held, pa.Table.from_batches(waiting)
                waiting, count = [], 0
    if waiting:
        yield held, pa.Table.from_batches(waiting)


def _solved(placed: DataFrame, visits: DataFrame, blocks: dict[int, int], parts: dict[int, int], width: int, nearest: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]], radius: bool = False) -> DataFrame:
    """(_v, _d2, _ref, _tie, _best) of each visit's nearest row; nearest(points) finds positions of rows within their bounds, the first on ties, -1 for none.

    blocks and parts name the hot cells; all others have one of each. radius: parts
    names all visited cells, and each (cell, block, part) is a task of its own.
    """
    spark = placed.sparkSession
    kind = {f.name: f.dataType for f in placed.schema}
    nothing = [F.lit(None).cast(kind[c]).alias(c) for c in ("_ref", "_tie", "_best")]
    if radius:
        keys = ["_id"]
        numbers, tasks = _numbered(spark, blocks, parts)
        dealt = _shared(placed, numbers)
        visits = visits.join(F.broadcast(numbers), "_cell").withColumn("_id", F.col("_first") + F.col("_block") * F.col("_parts") + F.col("_part"))
    else:
        keys = ["_cell", "_block", "_part"]
        hot = [(int(c), int(blocks.get(c, 1)), int(parts.get(c, 1))) for c in {*blocks, *parts} if blocks.get(c, 1) > 1 or parts.get(c, 1) > 1]
        many = spark.createDataFrame(hot, "_cell bigint, _blocks int, _parts int")  # no more than rows / PART_ROWS and rows / BLOCK_ROWS
        block = F.pmod(F.xxhash64("_v", "_tie"), F.coalesce("_blocks", F.lit(1))).cast("int")
        dealt = placed.join(F.broadcast(many), "_cell", "left").withColumn("_block", block).withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    both = dealt.select(*keys, F.lit(0).alias("_side"), "_v", "_ref", "_tie", "_best", F.lit(0.0).alias("_bound"))
    both = both.unionByName(visits.select(*keys, F.lit(1).alias("_side"), "_v", *nothing, "_bound"))
    both = both.repartitionById(tasks, F.col("_id")) if radius else both.repartition(*keys)
    both = both.sortWithinPartitions(*keys, "_side", F.asc_nulls_last("_ref"), "_tie")
    names = ["_v", "_d2", "_ref", "_tie", "_best"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, find, points, table = None, None, None, None
        for held, rows in _groups(batches, len(keys), width):
            if not held:
                continue
            if held is not now:
                now, table = held, pa.Table.from_batches(held).combine_chunks()
                points = matrix(table["_v"], width)
                find = nearest(points)
            x = matrix(rows["_v"], width)
            at = find(x, rows["_bound"].to_numpy())
            hit = np.flatnonzero(at >= 0)
            if len(hit):
                d2 = ((x[hit] - points[at[hit]]) ** 2).sum(axis=1)
                taken = table.select(["_ref", "_tie", "_best"]).take(pa.array(at[hit]))
                columns = [c.combine_chunks() for c in (rows["_v"].take(pa.array(hit)), *taken.columns)]
                yield pa.RecordBatch.from_arrays([columns[0], pa.array(d2), *columns[1:]], names=names)

    schema = placed.select("_v", F.lit(0.0).alias("_d2"), "_ref", "_tie", "_best").schema
    return both.mapInArrow(run, schema)


def best_of(found: DataFrame) -> DataFrame:
    """_v, _best of each vector's least distance, the smallest id (null last) on ties."""
    order = F.struct("_d2", F.col("_ref").isNull().alias("none"), "_ref", "_tie")
    return found.groupBy("_v").agg(F.min_by("_best", order).alias("_best"), F.min("_d2").alias("_d2"))


def best_of_rows(found: DataFrame) -> DataFrame:
    """The best row of each vector, whole."""
    row = F.struct("_d2", "_ref", "_tie", "_best")
    order = F.struct("_d2", F.col("_ref").isNull().alias("none"), "_ref", "_tie")
    return found.groupBy("_v").agg(F.min_by(row, order).alias("_row")).select("_v", "_row.*")


def nearest_by_cells(vectors: DataFrame, ref: DataFrame, width: int, total: int, nearest: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]], cells: KdCells | PivotCells | None = None) -> DataFrame:
    """_v, _best, _d2 of the nearest of ref (_v, _ref, _tie, _best; ``total`` rows) for every distinct row of vectors (_v)."""
    cells = cells or cells_of(ref, width, total)
    placed, blocks = _filled_cells(ref, cells, width, BLOCK_ROWS)
    distinct = checkpointed(vectors.select("_v").distinct().withColumn("_bound", F.lit(0.0)))
    visits, parts = _visits(distinct, cells, width, blocks, True, False)
    first = checkpointed(best_of_rows(_solved(placed, visits, blocks, parts, width, nearest)))
    # a cell without a row of its own gives no bound: such a vector visits all
    bound = distinct.select("_v").join(first.select("_v", F.sqrt("_d2").alias("_bound")), "_v", "left").na.fill(float("inf"), ["_bound"])
    visits, parts = _visits(bound, cells, width, blocks, False, True)
    return best_of(first.unionByName(_solved(placed, visits, blocks, parts, width, nearest)))


def _filled_cells(ref: DataFrame, cells: KdCells | PivotCells, width: int, block_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """The reference in its cells, and the blocks of each cell; the cells learn how far their rows lie."""
    placed = checkpointed(_placed(ref, cells, width))
    summary = placed.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_far").alias("far")).collect()  # one row for each cell
    cells.bounded({r["_cell"]: r["far"] for r in summary})
    return placed, {r["_cell"]: -(-r["n"] // block_rows) for r in summary}


def nearest_rows(sim: DataFrame, vector: Column, ref: DataFrame, width: int, total: int, nearest: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]], r_max: float) -> DataFrame:
    """sim with _best of the nearest of ref (_v, _ref, _tie, _best; ``total`` rows) closer than r_max; null without one, or without a vector.

    sim is stored with its rows' cells, as cells are weighed before rows are sent. A row
    goes to its home cell whole and is stored with what it found there; the
    vectors of those whose bound reaches further visit the other cells and are joined.
    """
    spark = sim.sparkSession
    larger = min(LARGER, max(CELL_VALUES // (width * CELL_ROWS), 1))
    cells = cells_of(ref, width, total, larger)
    placed, blocks = _filled_cells(ref, cells, width, BLOCK_ROWS * larger)

    @F.arrow_udf("bigint")
    def home(x: pa.Array) -> pa.Array:
        out, there = np.full(len(x), -1, np.int64), np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False))
        if len(there):
            out[there] = cells.home(matrix(x.drop_null(), width))[0]
        return pa.array(out)

    stored = checkpointed(sim.withColumn("_cell", home(vector)))
    keyed = stored.select(F.struct(*sim.columns).alias("_row"), vector.alias("_v"), "_cell")
    load = keyed.groupBy("_cell").agg(F.count("*").alias("n")).collect()  # one row for each cell
    most = part_rows(spark, sum(r["n"] for r in load))
    numbers, tasks = _numbered(spark, blocks, {r["_cell"]: -(-r["n"] // (most * blocks.get(r["_cell"], 1))) for r in load})
    kind = {f.name: f.dataType for f in placed.schema} | {f.name: f.dataType for f in keyed.schema}
    none = lambda *names: [F.lit(None).cast(kind[n]).alias(n) for n in names]
    # rows that share a vector go to one block, but to any part
    content = F.xxhash64(F.lit(1), *[f"_row.`{f.name}`" for f in sim.schema if "map<" not in f.dataType.simpleString()])
    number = F.col("_first") + F.pmod(F.xxhash64("_v"), "_blocks").cast("int") * F.col("_parts") + F.pmod(content, "_parts").cast("int")
    dealt = _shared(placed, numbers).select("_id", F.lit(0).alias("_side"), "_cell", "_v", "_ref", "_tie", "_best", *none("_row"))
    rows = keyed.join(F.broadcast(numbers), "_cell", "left").select(number.alias("_id"), F.lit(1).alias("_side"), "_cell", "_v", *none("_ref", "_tie", "_best"), "_row")
    both = dealt.unionByName(rows).repartitionById(tasks, F.col("_id")).sortWithinPartitions("_id", "_side", F.asc_nulls_last("_ref"), "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, find, points, table = None, None, None, None
        for held, rows in _groups(batches, 1, width):
            v = rows["_v"].combine_chunks()
            there = np.flatnonzero(v.is_valid().to_numpy(zero_copy_only=False))
            at, d2, onward = np.full(len(v), -1, np.int64), np.full(len(v), float(r_max) ** 2), np.zeros(len(v), bool)
            if len(there):
                x = matrix(v.drop_null(), width)
                if held and held is not now:
                    now, table = held, pa.Table.from_batches(held).combine_chunks()
                    points = matrix(table["_v"], width)
                    find = nearest(points)
                if held:
                    at[there] = find(x)
                    hit = at[there] >= 0
                    d2[there[hit]] = ((x[hit] - points[at[there[hit]]]) ** 2).sum(axis=1)
                cell = rows["_cell"][0].as_py()
                for other, reached in cells.reach(x, np.sqrt(d2[there])):
                    if other in blocks and (other != cell or blocks[other] > 1):
                        onward[there[reached]] = True
            best = [pa.nulls(len(v), rows.schema.field(c).type) for c in ("_ref", "_tie", "_best")]
            if held and len(there):
                best = [c.combine_chunks() for c in table.select(["_ref", "_tie", "_best"]).take(pa.array(at, mask=at < 0)).columns]
            kept = v.take(pa.array(np.arange(len(v)), mask=~onward))
            yield pa.RecordBatch.from_arrays([rows["_row"].combine_chunks(), pa.array(d2), *best, kept], names=["_row", "_d2", "_ref", "_tie", "_best", "_v"])

    schema = both.select("_row", F.lit(0.0).alias("_d2"), "_ref", "_tie", "_best", "_v").schema
    first = checkpointed(both.mapInArrow(run, schema))
    onward = first.where(F.col("_v").isNotNull())
    bounds = checkpointed(onward.groupBy("_v").agg(F.sqrt(F.min("_d2")).alias("_bound")))
    visits, parts = _visits(bounds, cells, width, blocks, False, True, True)
    other = best_of_rows(_solved(placed, visits, blocks, parts, width, nearest, True))
    order = lambda side: F.struct(f"{side}._d2", F.col(f"{side}._ref").isNull().alias("none"), f"{side}._ref", f"{side}._tie")
    farther = F.col("b._best").isNull() | (F.col("a._best").isNotNull() & (order("a") <= order("b")))
    joined = onward.alias("a").join(other.alias("b"), "_v", "left").select("a._row", F.when(farther, F.col("a._best")).otherwise(F.col("b._best")).alias("_best"))
    return first.where(F.col("_v").isNull()).select("_row", "_best").unionByName(joined).select("_row.*", "_best")


# --- approximate: hashed projections -----------------------------------------


class Projections:
    """``tables`` hash tables of ``length`` random projections each, cut at multiples of ``step``."""

    def __init__(self, width: int, tables: int, length: int, step: float, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        self.axes = draw.normal(size=(width, tables * length))
        self.shift = draw.uniform(size=tables * length)
        self.tables, self.length, self.step = tables, length, step

    def keys(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        cells = np.floor(x @ self.axes / self.step + self.shift).astype(np.int64).astype(np.uint64).reshape(len(x), self.tables, self.length)
        out = np.broadcast_to(np.arange(self.tables, dtype=np.uint64), cells.shape[:2]).copy()
        for i in range(self.length):
            out = (out ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)

    def recall(self, x: np.ndarray, near: np.ndarray) -> float:
        """The share of rows of x that meet their neighbour (the same row of near) in one table at least."""
        return float((self.keys(x) == self.keys(near)).any(axis=1).mean()) if len(x) else 1.0


def fitted_projections(x: np.ndarray, near: np.ndarray, other: np.ndarray, recall: float, tables: int = 16) -> Projections:
    """The longest keys whose tables reach the recall on pairs (x, near) of true neighbours; steps follow their distances.

    other: the same vectors beside random rows; a step is widened until the
    recall is reached, longer keys keep strangers apart.
    """
    spread = float(np.median(np.sqrt(((x - near) ** 2).sum(axis=1)))) if len(x) else 0.0
    spread = spread or float(np.median(np.sqrt(((x - other) ** 2).sum(axis=1)))) or 1.0 if len(x) else 1.0
    best: tuple[float, Projections] | None = None
    for length in (2, 4, 6, 8, 12):
        for widening in (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 9.0, 13.0, 20.0):
            made = Projections(x.shape[1], tables, length, spread * widening)
            if made.recall(x, near) >= recall:
                strangers = made.recall(x, other)
                if best is None or strangers < best[0]:
                    best = strangers, made
                break
    return best[1] if best else Projections(x.shape[1], tables, 1, spread * 50)


def bucketed(rows: DataFrame, made: Projections, width: int, keep: list[str]) -> DataFrame:
    """_key for each table, and the columns keep, of rows with a vector _v."""

    @F.pandas_udf("array<bigint>")
    def keys(x):
        import pandas as pd

        return pd.Series([*made.keys(np.stack(x.to_numpy()).astype(float))] if len(x) else [], dtype=object)

    return rows.select(*keep, F.explode(keys("_v")).alias("_key"))


def sampled_neighbours(vectors: DataFrame, ref: DataFrame, width: int, rows: int = 400, seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to ``rows`` vectors chosen by a hash, their true neighbours from a scan of the whole reference, and random reference rows."""
    spark: SparkSession = vectors.sparkSession
    total = max(vectors.count() // (2 * rows), 1)
    x = matrix(vectors.where(F.pmod(F.xxhash64("_v", F.lit(seed)), F.lit(total)) == 0).select("_v").limit(rows).toArrow()["_v"], width)
    shared = spark.sparkContext.broadcast(x)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest row of this task for each sampled vector: a bounded number of rows."""
        own = shared.value
        least, at = np.full(len(own), np.inf), np.zeros((len(own), width))
        for batch in batches:
            points = matrix(batch.column(0), width)
            for i in range(0, len(points), 4096):
                part = points[i : i + 4096]
                d2 = (own**2).sum(axis=1)[:, None] + (part**2).sum(axis=1) - 2 * own @ part.T
                first = d2.argmin(axis=1)
                value = d2[np.arange(len(own)), first]
                better = value < least
                least[better], at[better] = value[better], part[first[better]]
        found = np.flatnonzero(np.isfinite(least))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(least[found]), pa.array([*at[found]], pa.list_(pa.float64()))], names=["i", "d2", "v"])

    best = ref.select("_v").mapInArrow(scan, "i bigint, d2 double, v array<double>").groupBy("i").agg(F.min_by("v", "d2").alias("v")).orderBy("i").toArrow()
    found = np.array(best["i"].to_pylist(), np.int64)
    count = max(ref.count() // (2 * rows), 1)
    other = matrix(ref.where(F.pmod(F.xxhash64("_tie", F.lit(seed)), F.lit(count)) == 0).select("_v").limit(rows).toArrow()["_v"], width)
    other = np.resize(other, (len(found), width)) if len(other) else np.zeros((len(found), width))
    return x[found], matrix(best["v"], width) if len(found) else np.zeros((0, width)), other


def nearest_by_buckets(vectors: DataFrame, ref: DataFrame, width: int, nearest: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]], made: Projections) -> DataFrame:
    """_v, _best, _d2 of the nearest row among those that share a bucket with a vector; vectors without one are absent."""
    placed = checkpointed(bucketed(ref, made, width, ["_v", "_ref", "_tie", "_best"]).withColumnRenamed("_key", "_cell"))
    visits = bucketed(vectors.select("_v").distinct(), made, width, ["_v"]).withColumnRenamed("_key", "_cell")
    count = lambda rows, most: {r["_cell"]: -(-r["n"] // most) for r in rows.groupBy("_cell").agg(F.count("*").alias("n")).where(F.col("n") > most).collect()}  # hot buckets
    blocks, parts = count(placed, BLOCK_ROWS), count(visits, PART_ROWS)
    many = vectors.sparkSession.createDataFrame([(int(c), int(blocks.get(c, 1)), int(parts.get(c, 1))) for c in {*blocks, *parts}], "_cell bigint, _blocks int, _parts int")
    visits = visits.join(F.broadcast(many), "_cell", "left").withColumn("_part", F.pmod(F.xxhash64("_v"), F.coalesce("_parts", F.lit(1))).cast("int"))
    visits = visits.select("_cell", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1)).alias("_block"), "_part", "_v", F.lit(float("inf")).alias("_bound"))
    return best_of(_solved(placed, visits, blocks, parts, width, nearest))
