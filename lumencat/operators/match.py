"""Nearest-neighbour transfer of properties between catalogues."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import checkpointed
from . import neighbours

#: Most numbers (rows times attributes) of a reference that every task gets: 64 MB.
BROADCAST_VALUES = 8_000_000
#: Most bytes of its properties, as text.
BROADCAST_BYTES = 64 << 20
#: Attributes by which cells are formed; each neighbouring cell is looked up.
CELL_DIMENSIONS = 3
#: First radii of a search, in distances between neighbours.
WIDER = (1.0, 1.4, 2.0)
#: Every so many points are searched for a bound on the distance to all of FEW or more.
SPARSE, FEW = 16, 2_000
#: Pairs of rows whose distances a task holds at a time.
PAIRS = 2_000_000
#: Points of a leaf of boxes and, in levels above it, of the node in which a row is searched first; distances of one product.
LEAF, FIRST_LEVELS, PRODUCT = 256, 2, 1 << 17


def _checked(sim_attrs: Sequence[str], ref_attrs: Sequence[str], props: Mapping[str, str], fallback: Mapping[str, object] | None) -> None:
    if len(sim_attrs) != len(ref_attrs) or not sim_attrs:
        raise ValueError("both sides need the same number of attributes")
    if missing := {*(fallback or {})} - {*props}:
        raise KeyError(f"fallback for unknown properties: {sorted(missing)}")


def nearest_property(
    sim: DataFrame,
    ref: DataFrame,
    sim_attrs: Sequence[str],
    ref_attrs: Sequence[str],
    props: Mapping[str, str],
    ref_id: str,
    r_max: float,
    fallback: Mapping[str, object] | None = None,
    row_id: str = "unique_gal_id",
    broadcast_values: int | None = None,
) -> DataFrame:
    """sim with props (reference column: new name) of the nearest reference row closer than r_max.

    A reference of up to broadcast_values (BROADCAST_VALUES) numbers and BROADCAST_BYTES of
    properties goes to every task, which solves its batches of sim cell by
    cell: sim is read once and not shuffled. A larger one is cut into k-d boxes
    to which sim's rows are shuffled (neighbours.py). Both give the same rows, whatever the ids of sim (row_id is
    not looked at): a neighbour belongs to a row's attributes. Ties go to the
    smallest ref_id (null last), then to a hash of the properties; a property
    without a neighbour is its fallback. Rows with a missing attribute (null,
    NaN, infinite) have no neighbour and are none.
    """
    _checked(sim_attrs, ref_attrs, props, fallback)
    width = len(ref_attrs)
    found = _reference(ref, F.array(*[F.col(a).cast("double") for a in ref_attrs]), ref_id, props)
    rows = _small(found, width, broadcast_values)
    vector = F.array(*[F.col(a).cast("double") for a in sim_attrs])
    index = lambda points: (LeafIndex if width > CELL_DIMENSIONS else CellIndex)(points, r_max).nearest
    if rows is not None:
        return _filled(_by_broadcast(sim, found, rows, vector, width, index), ref, props, fallback or {}, sim.columns)
    own = F.when(neighbours.finite(vector), vector)
    return _filled(neighbours.nearest_rows(sim, own, found, width, found.count(), index, r_max), ref, props, fallback or {}, sim.columns)


class CellIndex:
    """Reference points within r_max, searched by widening radii: one that finds a point has found the nearest.

    The first radii are about a point's distance to its own neighbour, so a
    search meets a few points however many lie within r_max. A row that lies
    off the points would meet very many at once when its radius reaches them:
    the nearest of every SPARSEth point bounds its radius first. Points are
    turned to the axes of their widest spread (``neighbours.spread_axes``) to
    sift pairs; what is left is measured in the attributes themselves.
    """

    def __init__(self, points: np.ndarray, r_max: float):
        self.r_max, self.points, self.raw = r_max, points, np.ascontiguousarray(points.T)
        self.centre = np.median(points, axis=0) if len(points) else np.zeros(points.shape[1])
        with np.errstate(all="ignore"):
            self.far = float(np.sqrt(((points - self.centre) ** 2).sum(axis=1)).max()) if len(points) else 0.0
        # turned coordinates of points this near are right to 1e-6 r_max
        tame = self.far < 1e8 * r_max
        self.axes = neighbours.spread_axes(points[:: max(len(points) // 10_000, 1)] - self.centre) if tame and len(points) else np.eye(points.shape[1])
        self.centre = self.centre if tame else np.zeros(points.shape[1])
        self.slack = 1e-5 if tame else 0.0
        self.turned = neighbours.turned(points - self.centre, self.axes)
        self.least = self._least() if len(points) else r_max
        self.levels: dict[int, _Level] = {}
        self.sparse: CellIndex | None = None

    def _least(self, sampled: int = 64) -> float:
        """A radius that holds most points' own neighbours, by an even sample."""
        n = len(self.turned)
        own = self.turned[:: max(n // sampled, 1)][:sampled]
        least = np.full(len(own), np.inf)
        for i in range(0, n, PAIRS // sampled):
            part = self.turned[i : i + PAIRS // sampled]
            with np.errstate(all="ignore"):
                d2 = (own**2).sum(axis=1)[:, None] + (part**2).sum(axis=1) - 2 * own @ part.T
            # the point itself and its copies say nothing of the others
            least = np.minimum(least, np.where(d2 > 1e-12 * (own**2).sum(axis=1)[:, None], d2, np.inf).min(axis=1))
        least = np.sqrt(least[np.isfinite(least)])
        return min(max(float(np.quantile(least, 0.6)), self.r_max / 4096), self.r_max) if len(least) else self.r_max

    def nearest(self, x: np.ndarray, bound: np.ndarray | None = None) -> np.ndarray:
        """Position of the nearest reference point closer than r_max (and within the row's bound, if given), the first on ties; -1 without one."""
        at = np.full(len(x), -1, np.int64)
        if not len(self.points):
            return at
        limit = np.full(len(x), self.r_max) if bound is None else np.minimum(bound * neighbours.MARGIN, self.r_max)
        with np.errstate(all="ignore"):
            off = np.sqrt(((x - self.centre) ** 2).sum(axis=1))
        rows = np.flatnonzero(np.isfinite(x).all(axis=1) & (off <= (self.far + self.r_max) * (1 + 1e-9))) if self.slack else np.flatnonzero(np.isfinite(x).all(axis=1))
        turned = np.zeros(x.shape)
        turned[rows] = neighbours.turned(x[rows] - self.centre, self.axes)
        for radius in [r for w in WIDER if (r := w * self.least) < self.r_max]:
            at[rows] = self._within(x[rows], turned[rows], np.minimum(limit[rows], radius), radius)
            rows = rows[(at[rows] < 0) & (limit[rows] > radius)]
        if len(rows):
            at[rows] = self._within(x[rows], turned[rows], self._bounded(x[rows], limit[rows]), self.r_max)
        return at

    def _bounded(self, x: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The distance to a point near each row, at most limit."""
        if len(self.points) < FEW:
            return limit
        if self.sparse is None:
            self.sparse = CellIndex(self.points[::SPARSE], self.r_max)
        at = self.sparse.nearest(x, limit)
        hit = np.flatnonzero(at >= 0)
        out = limit.copy()
        out[hit] = np.minimum(limit[hit], np.sqrt(((x[hit] - self.sparse.points[at[hit]]) ** 2).sum(axis=1)) * neighbours.MARGIN)
        return out

    def _within(self, x: np.ndarray, turned: np.ndarray, reach: np.ndarray, radius: float) -> np.ndarray:
        """Position of each row's nearest point closer than radius if one lies within its reach; -1 for none."""
        at = np.full(len(x), -1, np.int64)
        with np.errstate(all="ignore"):
            doublings = np.ceil(np.log2(np.maximum(reach / self.least, 1))).astype(np.int64)
        for level in np.unique(doublings):
            if level not in self.levels:
                self.levels[level] = _Level(self.turned, self.least * 2.0**level, self.slack * self.r_max)
            rows = np.flatnonzero(doublings == level)
            # in the order of the points: one row after the other reads what lies near in memory
            rows = rows[np.argsort(self.levels[level].place(turned[rows]))]
            at[rows] = self._nearest_within(self.levels[level], x[rows], turned[rows], reach[rows], radius)
        return at

    def _nearest_within(self, level: _Level, x: np.ndarray, turned: np.ndarray, reach: np.ndarray, radius: float) -> np.ndarray:
        best, at = np.full(len(x), np.inf), np.full(len(x), -1, np.int64)
        columns = np.ascontiguousarray(x.T)
        for pair, position in level.pairs(turned, reach * (1 + 1e-9) + self.slack * self.r_max):
            d2 = np.zeros(len(pair))
            for column, points in zip(columns, self.raw, strict=True):
                d2 += (column[pair] - points[position]) ** 2
            near = d2 < radius**2
            pair, position, d2 = pair[near], position[near], d2[near]
            if not len(pair):
                continue
            begin = np.flatnonzero(np.diff(pair, prepend=-1))
            least = np.minimum.reduceat(d2, begin)
            first = np.where(d2 == np.repeat(least, np.diff(np.append(begin, len(pair)))), position, np.iinfo(np.int64).max)
            first = np.minimum.reduceat(first, begin)
            own = pair[begin]
            better = (least < best[own]) | ((least == best[own]) & (first < at[own]))
            best[own[better]], at[own[better]] = least[better], first[better]
        return at


class _Level:
    """Points sorted by columns of cells in all indexed axes but the last and, inside a column, by slices of the last.

    A column is as wide as a ball, so a ball meets two at most in each
    direction; where that shows a point too many others, it is a quarter of
    that. Columns are numbered row by row, so points that are searched in this
    order (``place``) read the stored ones in theirs. Cells are clipped at
    CLIP around the median: what lies beyond shares the last ones and is told
    apart by distance.
    """

    SLICE_BITS = 22
    CLIP = 1 << 19
    #: Points that a wide column may show to a point on average.
    SHOWN = 48

    def __init__(self, points: np.ndarray, radius: float, slack: float):
        self.dims, ball = min(CELL_DIMENSIONS, points.shape[1]), radius * (1 + 1e-9) + slack
        self.low, self.thick = points[:, self.dims - 1].min(), ball / 8
        own = points[:: max(len(points) // 256, 1)]
        for self.width in (2 * ball, ball / 2):
            self.middle = np.floor(np.median(points[:, : self.dims - 1], axis=0) / self.width)
            keys = self.place(points)
            self.order = np.argsort(keys, kind="stable")
            self.keys = keys[self.order]
            if sum(len(seen) and int((last - first).sum()) for seen, first, last in self._stretches(own, np.full(len(own), ball))) <= self.SHOWN * len(own):
                break
        self.points = np.ascontiguousarray(points[self.order].T)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Rising numbers along the order of the points."""
        return self._column(self._cells(x)) | self._slice(x[:, self.dims - 1])

    def _cells(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(x[:, : self.dims - 1] / self.width) - self.middle, -self.CLIP, self.CLIP - 1).astype(np.int64)

    def _column(self, cells: np.ndarray) -> np.ndarray:
        number = np.zeros(len(cells), np.int64)
        for c in cells.T:
            number = number * (2 * self.CLIP) + c + self.CLIP
        return number << self.SLICE_BITS

    def _slice(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.low) / self.thick, 0, (1 << self.SLICE_BITS) - 1).astype(np.int64)

    def _stretches(self, x: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows of x, first and last of a stretch of points) that hold all points within the rows' reach."""
        plane, last_axis = x[:, : self.dims - 1], x[:, self.dims - 1]
        # roundings keep the order: no point within the reach has a cell outside these
        start, end = self._cells(x - reach[:, None]), self._cells(x + reach[:, None])
        low, high = self._slice(last_axis - reach), self._slice(last_axis + reach)
        clipped = ((start == -self.CLIP) | (end == self.CLIP - 1)).any(axis=1)  # their cells have no borders
        for shift in product(*[range(n + 1) for n in (end - start).max(axis=0, initial=0)]):
            cells = start + np.array(shift, np.int64)
            edge = (cells + self.middle) * self.width
            gap = np.maximum(np.maximum(edge - plane, plane - edge - self.width), 0)
            near = (gap**2).sum(axis=1) <= reach**2 * (1 + 1e-6)
            seen = np.flatnonzero((cells <= end).all(axis=1) & (near | clipped))
            number = self._column(cells[seen])
            yield seen, np.searchsorted(self.keys, number | low[seen]), np.searchsorted(self.keys, number | high[seen], "right")

    def pairs(self, x: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of x, position of a point) of pairs that may lie within the row's reach, rows rising, no more than PAIRS before sifting (one row at least)."""
        columns, limit = np.ascontiguousarray(x.T), reach**2
        for seen, first, last in self._stretches(x, reach):
            count = last - first
            busy = np.flatnonzero(count)
            ends = np.cumsum(count[busy])
            done = 0
            while done < len(busy):
                upto = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + max(PAIRS // 8, 1), "right")), done + 1)
                part = busy[done:upto]
                done = upto
                n = count[part]
                begin = np.cumsum(n) - n
                ref = np.repeat(first[part] - begin, n) + np.arange(int(n.sum()))
                pair, d2 = np.repeat(seen[part], n), np.zeros(len(ref))
                for column, points in zip(columns, self.points, strict=True):
                    # pairs that one axis after the other puts too far apart drop out
                    d2 = d2 + (column[pair] - points[ref]) ** 2
                    near = d2 <= limit[pair]
                    pair, ref, d2 = pair[near], ref[near], d2[near]
                if len(pair):
                    yield pair, self.order[ref]


class LeafIndex:
    """Reference points within r_max in a k-d tree, for many attributes: leaves meet all rows that reach them in one matrix product.

    Every node knows the box of its points along the axes of their widest spread. A
    row is searched in the node it falls into, some leaves wide, then in those leaves
    whose box lies within the distance found. Products leave the points whose distance
    lies within rounding of the least; these are measured in the attributes themselves.
    A product pays for many rows: callers pass some 100,000 at a time.
    """

    def __init__(self, points: np.ndarray, r_max: float):
        n, width = points.shape
        self.r_max, self.raw = r_max, np.ascontiguousarray(points.T)
        self.centre = np.median(points, axis=0) if n else np.zeros(width)
        with np.errstate(all="ignore"):
            self.far = float(np.sqrt(((points - self.centre) ** 2).sum(axis=1)).max()) if n else 0.0
        # points farther off would lose too much by turning: the attributes' own axes
        self.tame = self.far < 1e8 * r_max
        self.axes = neighbours.spread_axes(points[:: max(n // 10_000, 1)] - self.centre) if self.tame and n else np.eye(width)
        self.lost = 1e-14 * width * (self.far + r_max) if self.tame else 0.0
        self.points, self.order = self._turned(points), np.arange(n)
        self.depth = max(int(np.ceil(np.log2(max(n, 1) / LEAF))), 0)
        self.first = max(self.depth - FIRST_LEVELS, 0)
        self.edges = [np.array([n * i >> level for i in range((1 << level) + 1)]) for level in range(self.depth + 1)]
        self.axis = [np.zeros(1 << level, np.int64) for level in range(self.depth)]
        self.cut = [np.zeros(1 << level) for level in range(self.depth)]
        for level in range(self.depth):
            for node in range(1 << level):
                self._halve(level, node)
        low = [np.minimum.reduceat(self.points, e[:-1]) if n else np.zeros((1, width)) for e in self.edges]
        high = [np.maximum.reduceat(self.points, e[:-1]) if n else np.zeros((1, width)) for e in self.edges]
        self.middle = [a + (b - a) / 2 for a, b in zip(low, high, strict=True)]
        self.half = [np.maximum(b - m, m - a) * (1 + 1e-15) + 2 * self.lost for a, b, m in zip(low, high, self.middle, strict=True)]

    def _turned(self, x: np.ndarray) -> np.ndarray:
        return neighbours.turned(x - self.centre, self.axes) if self.tame else x.copy()

    def _halve(self, level: int, node: int) -> None:
        start, end, middle = self.edges[level][node], self.edges[level][node + 1], self.edges[level + 1][2 * node + 1]
        rows = self.points[start:end]
        axis = int(np.ptp(rows[:: max(len(rows) // 512, 1)], axis=0).argmax())
        by = np.argpartition(rows[:, axis], middle - start)
        self.points[start:end], self.order[start:end] = rows[by], self.order[start:end][by]
        self.axis[level][node], self.cut[level][node] = axis, self.points[middle, axis]

    def nearest(self, x: np.ndarray, bound: np.ndarray | None = None) -> np.ndarray:
        """Position of the nearest reference point closer than r_max (and within the row's bound, if given), the first on ties; -1 without one."""
        at, best = np.full(len(x), -1, np.int64), np.full(len(x), float(self.r_max) ** 2)
        if bound is not None:
            best = np.minimum((bound * neighbours.MARGIN) ** 2, best)
        with np.errstate(all="ignore"):
            there = np.isfinite(x).all(axis=1) & (np.sqrt(((x - self.centre) ** 2).sum(axis=1)) <= (self.far + self.r_max) * (1 + 1e-9))
        rows = np.flatnonzero(there)
        if not len(self.order) or not len(rows):
            return at
        turned, home = self._turned(x[rows]), np.zeros(len(rows), np.int64)
        for level in range(self.first):
            home = 2 * home + (turned[np.arange(len(rows)), self.axis[level][home]] >= self.cut[level][home])
        # in the order of their nodes: rows that meet the same points lie side by side in memory
        by = np.argsort(home, kind="stable")
        rows, home, turned = rows[by], home[by], np.ascontiguousarray(turned[by].T)
        columns, least, found = np.ascontiguousarray(x[rows].T), best[rows], at[rows]
        starts = np.flatnonzero(np.diff(home, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(rows)], strict=True):
            self._meet(self.first, int(home[start]), np.arange(start, end), columns, turned, least, found)
        stack = [(0, 0, np.arange(len(rows)))]
        while stack:
            level, node, own = stack.pop()
            if level == self.first:
                own = own[home[own] != node]
            if not len(own):
                continue
            if level == self.depth:
                self._meet(level, node, own, columns, turned, least, found)
                continue
            place, limit = turned[:, own], least[own] * (1 + 1e-9)
            for child in (2 * node, 2 * node + 1):
                gap = place - self.middle[level + 1][child][:, None]
                np.abs(gap, out=gap)
                gap -= self.half[level + 1][child][:, None]
                np.maximum(gap, 0, out=gap)
                gap *= gap
                stack.append((level + 1, child, own[gap.sum(axis=0) <= limit]))
        at[rows] = found
        return at

    def _meet(self, level: int, node: int, rows: np.ndarray, x: np.ndarray, turned: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        """Measure rows (columns of x and turned) against all points of a node; best and at hold the least squared distance and its point."""
        start, end, middle = self.edges[level][node], self.edges[level][node + 1], self.middle[level][node]
        points, order = self.points[start:end] - middle, self.order[start:end]
        squares = (points**2).sum(axis=1)
        factor = np.concatenate([-2 * points, squares[:, None]], axis=1)
        largest, step = squares.max(), max(PRODUCT // len(points), 1)
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            own = np.empty((len(turned) + 1, len(part)))
            np.subtract(turned[:, part], middle[:, None], out=own[:-1])
            square = (own[:-1] ** 2).sum(axis=0)
            own[-1] = 1.0
            product = factor @ own
            # what the product and turning may have lost
            rounding = 1e-13 * (square + largest) + 16 * self.lost * (np.sqrt(square) + np.sqrt(largest) + self.lost)
            least, limit = product.min(axis=0), best[part] - square
            near = np.flatnonzero(least <= limit + rounding)
            if not len(near):
                continue
            limit = np.minimum(least, limit) + 2 * rounding
            if 2 * len(near) < len(part):
                product, part, limit = product[:, near], part[near], limit[near]
            found = np.flatnonzero(product <= limit)
            place = found // len(part)
            pair, position = found - place * len(part), order[place]
            row = part[pair]
            d2 = np.zeros(len(row))
            for column, point in zip(x, self.raw, strict=True):
                d2 += (column[row] - point[position]) ** 2
            by = np.lexsort((position, d2, pair))
            first = by[np.diff(pair[by], prepend=-1) > 0]
            row, d2, position = row[first], d2[first], position[first]
            better = (d2 < self.r_max**2) & ((d2 < best[row]) | ((d2 == best[row]) & ((position < at[row]) | (at[row] < 0))))
            best[row[better]], at[row[better]] = d2[better], position[better]


def _reference(ref: DataFrame, vector: Column, ref_id: str, props: Mapping[str, str]) -> DataFrame:
    """_v, _ref, _tie and the properties as one column _best, of the rows that can be neighbours.

    Stored, as it is read several times, and filtered only then: the filter would
    move below the attributes' own formulas and compute them again for each use.
    """
    best = F.struct(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(props)])
    rows = ref.select(F.when(neighbours.finite(vector), vector).alias("_v"), F.col(ref_id).alias("_ref"), F.xxhash64(F.to_json(best)).alias("_tie"), best.alias("_best"))
    return checkpointed(rows).where(F.col("_v").isNotNull())


def _small(found: DataFrame, width: int, most: int | None) -> pa.Table | None:
    """The reference in order of its ids, if it is small enough to go to every task."""
    count, size = found.agg(F.count("*"), F.sum(F.length(F.to_json("_best")))).first()
    if count * width > (BROADCAST_VALUES if most is None else most) or (size or 0) > BROADCAST_BYTES:
        return None
    rows = found.toArrow()
    return rows.sort_by([("_ref", "ascending"), ("_tie", "ascending")])


def _by_broadcast(sim: DataFrame, found: DataFrame, rows: pa.Table, vector: Column, width: int, index: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """sim and _best; rows: the whole reference, in order."""
    spark = sim.sparkSession
    shared = spark.sparkContext.broadcast(neighbours.matrix(rows["_v"], width) if rows.num_rows else np.zeros((0, width)))
    kind = found.select("_best", F.lit(0).cast("bigint").alias("_at")).schema
    values = spark.createDataFrame(rows.select(["_best"]).append_column("_at", [np.arange(rows.num_rows)]), kind) if rows.num_rows else spark.createDataFrame([], kind)
    search = uuid.uuid4().hex
    made: dict[int, Callable[[np.ndarray], np.ndarray]] = {}

    def solved(group: list[pa.Array]) -> Iterator[pa.Array]:
        x = pa.chunked_array(group).combine_chunks()
        at, there = np.full(len(x), -1, np.int64), np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False))
        if len(there) and len(shared.value):
            if 0 not in made:
                made[0] = held(search, lambda: index(shared.value))
            at[there] = made[0](neighbours.matrix(x.drop_null(), width))
        for part in np.split(at, np.cumsum([len(g) for g in group])[:-1]):
            yield pa.array(part)

    @F.arrow_udf("bigint")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        group: list[pa.Array] = []
        for x in batches:
            # many rows at a time: an index meets each of its parts with all of them
            group.append(x)
            if sum(len(g) for g in group) * width >= neighbours.GROUP_VALUES:
                yield from solved(group)
                group = []
        if group:
            yield from solved(group)

    usable = F.when((F.size(vector) == width) & neighbours.finite(vector), vector)
    # never null: a filter on the properties would infer one on the position, and search a second time below the projection
    return sim.withColumn("_at", F.coalesce(nearest(usable), F.lit(-1).cast("bigint"))).join(F.broadcast(values), "_at", "left")


#: The index of a worker's latest search, by the search.
_HELD: dict[str, Callable[[np.ndarray], np.ndarray]] = {}


def held(search: str, make: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> Callable[[np.ndarray], np.ndarray]:
    """The search's index, made once in a worker: its tasks follow one another."""
    if search not in _HELD:
        _HELD.clear()
        _HELD[search] = make()
    return _HELD[search]


def _by_vector(sim: DataFrame, vector: Column, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """sim and _best, from a search over its distinct vectors; every row is kept, whatever its id."""
    keyed = sim.withColumn("_v", F.when(neighbours.finite(vector), vector))
    best = search(keyed.where(F.col("_v").isNotNull()).select("_v")).select("_v", "_best")
    return keyed.join(best, "_v", "left")


def _filled(out: DataFrame, ref: DataFrame, props: Mapping[str, str], fallback: Mapping[str, object], columns: Sequence[str]) -> DataFrame:
    def value(i: int, prop: str) -> Column:
        found = F.col(f"_best._p{i}")
        return F.when(F.col("_best").isNotNull(), found).otherwise(F.lit(fallback[prop]).cast(ref.schema[prop].dataType)) if prop in fallback else found

    return out.select(*columns, *[value(i, p).alias(name) for i, (p, name) in enumerate(props.items())])


def nearest_vectors(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Position of each row's nearest point, the first on ties.

    Matrix products leave the points whose distance lies within rounding of the
    least; these are measured exactly.
    """
    at = np.empty(len(x), np.int64)
    squares, scale = (points**2).sum(axis=1), 1e-9
    for i in range(0, len(x), max(1, PAIRS // max(len(points), 1))):
        part = x[i : i + max(1, PAIRS // max(len(points), 1))]
        own = (part**2).sum(axis=1)
        d2 = own[:, None] + squares - 2 * part @ points.T
        row, ref = np.nonzero(d2 <= d2.min(axis=1)[:, None] + scale * (own[:, None] + squares.max()))
        exact = ((part[row] - points[ref]) ** 2).sum(axis=1)
        order = np.lexsort((ref, exact, row))
        first = order[np.concatenate(([True], np.diff(row[order]) > 0))]
        at[i : i + len(part)] = ref[first]
    return at


def nearest_unbounded(
    sim: DataFrame, ref: DataFrame, vector: str, ref_vector: str, props: Mapping[str, str], ref_id: str, row_id: str = "unique_gal_id", recall: float | None = None, broadcast_values: int | None = None
) -> DataFrame:
    """sim with props of the nearest reference row by Euclidean distance of vector columns, without a bound.

    A reference of up to broadcast_values (BROADCAST_VALUES) numbers goes to every task, where
    batches of sim meet it by matrix products. A larger one is cut into cells
    (neighbours.py): the distance found in a vector's home cell bounds which
    others it has to visit. With ``recall`` a larger one is searched in hashed
    buckets instead, whose number and width are fitted so that at least this
    share of a sample's true neighbours (from a scan) is met; vectors that meet
    no row are searched exactly.

    Ties go to the smallest ref_id (null last), then to a hash of the
    properties. Vectors that are null, hold a null, NaN or infinite component
    or are of another length than the reference's longest have no neighbour
    and are none. Ids of sim may repeat or be missing.
    """
    _checked([vector], [ref_vector], props, None)
    found = _reference(ref, F.col(ref_vector).cast("array<double>"), ref_id, props)
    width = found.agg(F.max(F.size("_v"))).first()[0] or 0
    found = found.where(F.size("_v") == width)
    own = F.when(F.size(vector) == width, F.col(vector).cast("array<double>"))
    rows = _small(found, max(width, 1), broadcast_values) if width else None
    index = lambda points: lambda x, bound=None: nearest_vectors(x, points)
    if not width:
        return _filled(sim.withColumn("_best", F.lit(None).cast(found.schema["_best"].dataType)), ref, props, {}, sim.columns)
    if rows is not None:
        return _filled(_by_broadcast(sim, found, rows, own, width, index), ref, props, {}, sim.columns)

    def search(vectors: DataFrame) -> DataFrame:
        if recall is None:
            return neighbours.nearest_by_cells(vectors, found, width, found.count(), index)
        return approximate_neighbours(vectors, found, width, recall)[0]

    return _filled(_by_vector(sim, own, search), ref, props, {}, sim.columns)


def approximate_neighbours(vectors: DataFrame, found: DataFrame, width: int, recall: float) -> tuple[DataFrame, float]:
    """_v, _best, _d2 by hashed buckets, and the recall measured on the sample that they were fitted to."""
    x, near, other = neighbours.sampled_neighbours(vectors, found, width)
    made = neighbours.fitted_projections(x, near, other, recall)
    index = lambda points: lambda v, bound=None: nearest_vectors(v, points)
    met = checkpointed(neighbours.nearest_by_buckets(vectors, found, width, index, made))
    missed = vectors.select("_v").distinct().join(met.select("_v"), "_v", "left_anti")
    if not missed.isEmpty():
        met = met.unionByName(neighbours.nearest_by_cells(missed, found, width, found.count(), index))
    return met, made.recall(x, near)
