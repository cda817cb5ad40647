"""Nearest neighbours against brute force: both paths, hostile rows, cells, blocks, buckets."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumencat.operators import match, neighbours

NAN, INF = float("nan"), float("inf")


def usable(x):
    return x is not None and all(v is not None and math.isfinite(v) for v in x)


def brute(sim, ref, r_max=math.inf):
    """The multiset of (vector, property) that a search has to give; rows are (id, vector[, property])."""
    out = []
    refs = [(r, v, p) for r, v, p in ref if usable(v)]
    for _, v in sim:
        best = None
        if usable(v):
            near = [(sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), r is None, r or 0, p) for r, w, p in refs if len(w) == len(v)]
            best = min(near, default=None)
            best = best if best and best[0] < r_max**2 else None
        out.append((str(v), best[3] if best else None))
    return sorted(out, key=str)


def hostile(rng, width, n_sim, n_ref):
    """Rows with missing components, ids that repeat or are null, and one vector many times."""
    sim = [(i % 7 if i % 5 == 0 else i, [float(x) for x in rng.random(width)]) for i in range(n_sim)]
    sim += [(None, [0.25] * width), (None, [0.75] * width), (3, None)] + [(9, [0.5] * width)] * 25
    ref = [(i, [float(x) for x in rng.random(width)], f"p{i}") for i in range(n_ref)]
    for bad in (NAN, INF, -INF, None):
        sim.append((5, [bad] + [0.5] * (width - 1)))
        ref.append((10_000, [0.5] * (width - 1) + [bad], "never"))
    ref += [(None, [0.3] * width, "of no id"), (10_001, [0.75] * width, "later"), (10_000, [0.75] * width, "first")]
    return sim, ref


def small_cells(monkeypatch, **more):
    sizes = {"CELL_ROWS": 15, "BLOCK_ROWS": 8, "PART_ROWS": 10} | more
    for name, value in sizes.items():
        monkeypatch.setattr(neighbours, name, value)


@pytest.mark.parametrize("width, small", [(2, True), (2, False), (9, True), (9, False)])
def test_property_within_a_radius(spark, monkeypatch, width, small):
    if not small:
        monkeypatch.setattr(match, "BROADCAST_VALUES", 10)
    small_cells(monkeypatch)
    sim, ref = hostile(np.random.default_rng(width), width, 150, 120)
    names = [f"a{i}" for i in range(width)]
    kind = ", ".join(f"{n} double" for n in names)
    s = spark.createDataFrame([(i, *(v or [None] * width)) for i, v in sim], f"unique_gal_id bigint, {kind}").repartition(5)
    r = spark.createDataFrame([(i, *v, p) for i, v, p in ref], f"rid bigint, {kind}, p string").repartition(3)
    radius = 0.15 if width == 2 else 0.9
    found = match.nearest_property(s, r, names, names, {"p": "q"}, "rid", radius).collect()
    got = sorted([(str(None if all(x[n] is None for n in names) else [x[n] for n in names]), x["q"]) for x in found], key=str)
    assert got == brute(sim, ref, radius)


@pytest.mark.parametrize("width, small", [(3, True), (3, False), (20, False)])
def test_nearest_without_a_radius(spark, monkeypatch, width, small):
    if not small:
        monkeypatch.setattr(match, "BROADCAST_VALUES", 10)
    small_cells(monkeypatch)
    sim, ref = hostile(np.random.default_rng(width), width, 120, 90)
    sim.append((1, [0.5] * (width + 1)))
    ref.append((2, [0.1] * (width - 1), "short"))
    s = spark.createDataFrame(sim, "i bigint, v array<double>").repartition(4)
    r = spark.createDataFrame(ref, "j bigint, w array<double>, p string").repartition(3)
    found = match.nearest_unbounded(s, r, "v", "w", {"p": "q"}, "j").collect()
    assert sorted([(str(x["v"]), x["q"]) for x in found], key=str) == brute(sim, ref)


def test_empty_sides(spark):
    s = spark.createDataFrame([(1, [0.5]), (2, None)], "i bigint, v array<double>")
    none = spark.createDataFrame([], "j bigint, w array<double>, p string")
    assert [x["q"] for x in match.nearest_unbounded(s, none, "v", "w", {"p": "q"}, "j").collect()] == [None, None]
    r = spark.createDataFrame([(1, [0.5], "a")], "j bigint, w array<double>, p string")
    assert match.nearest_unbounded(s.limit(0), r, "v", "w", {"p": "q"}, "j").count() == 0
    columns = spark.createDataFrame([], "rid bigint, c double, p int")
    assert match.nearest_property(spark.createDataFrame([(1, 0.0)], "unique_gal_id bigint, a double"), columns, ["a"], ["c"], {"p": "q"}, "rid", 1.0, {"p": 4}).first()["q"] == 4


@pytest.mark.parametrize("make", [lambda x: neighbours.KdCells(x, 20), lambda x: neighbours.PivotCells(x[:12])])
def test_cells_reach_all_that_is_near(make):
    """No row within the bound lies in a cell that is not reached, and most cells are not."""
    rng = np.random.default_rng(1)
    rows, x = rng.random((600, 3)) ** 3, rng.random((80, 3))
    cells = make(rows)
    own, far = cells.home(rows)
    cells.bounded({int(c): float(far[own == c].max()) for c in np.unique(own)})
    reached = {(c, i) for c, at in cells.reach(x, np.full(len(x), 0.1)) for i in at}
    near = {(own[j], i) for i in range(len(x)) for j in np.flatnonzero(((rows - x[i]) ** 2).sum(axis=1) < 0.01)}
    assert near <= reached and len(reached) < 0.6 * len(x) * cells.count
    assert all(sum(c == own[j] for c, at in cells.reach(rows[j : j + 1], np.array([-1.0])) for _ in at) == 1 for j in range(50))


@pytest.mark.parametrize("width, most", [(3, 60), (9, 2000)])
def test_radius_does_not_set_the_work(monkeypatch, width, most):
    """All 20,000 points lie within r_max of every row; a row is measured against a few."""
    rng = np.random.default_rng(3)
    points, x = rng.random((20_000, width)), rng.random((200, width))
    measured, pairs = [0], match._Level.pairs

    def counted(self, *args):
        for pair, position in pairs(self, *args):
            measured[0] += len(pair)
            yield pair, position

    monkeypatch.setattr(match._Level, "pairs", counted)
    found = match.CellIndex(points, 4.0).nearest(x)
    assert (found == [((points - v) ** 2).sum(axis=1).argmin() for v in x]).all()
    assert measured[0] < most * len(x)


@pytest.mark.parametrize("far", [0.0, 1e5, 1e14, 1e140])
def test_widening_radii_equal_brute_force(far):
    """Dense and thin regions, copies, and reference rows so far off that axes are not turned; the bound is inclusive, the radius is not."""
    rng = np.random.default_rng(4)
    points = np.vstack([rng.random((300, 3)) * 0.01, rng.random((300, 3)) * 4, [[9.0, 9.0, 9.0]] * 30, [[far, 0.0, -far]]])
    x = np.vstack([rng.random((100, 3)) * 0.01, rng.random((200, 3)) * 4, [[9.0, 9.0, 9.5], [9.0, 9.0, 9.25], [far, 0.25, -far], [-far, far, 50.0], [math.nan, 0.0, 0.0]]])
    with np.errstate(all="ignore"):
        d2 = np.array([((points - v) ** 2)[:, 0] + ((points - v) ** 2)[:, 1] + ((points - v) ** 2)[:, 2] for v in x])
    d2[-1] = np.inf
    want = np.where(d2.min(axis=1) < 0.25, d2.argmin(axis=1), -1)
    index = match.CellIndex(points, 0.5)
    assert (index.nearest(x) == want).all() and len({*want}) > 100
    assert (index.nearest(x, np.sqrt(d2.min(axis=1))) == want).all()


def test_buckets_reach_their_recall(spark, monkeypatch):
    """Clustered vectors: the measured recall holds on all vectors, not only on the sample it was fitted to."""
    monkeypatch.setattr(match, "BROADCAST_VALUES", 10)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 12)) * 4
    ref = [(i, (centres[i % 60] + rng.normal(size=12) * 0.3).tolist(), i) for i in range(900)]
    sim = [(i, (centres[i % 60] + rng.normal(size=12) * 0.3).tolist()) for i in range(400)]
    s = spark.createDataFrame(sim, "i bigint, v array<double>")
    r = spark.createDataFrame(ref, "j bigint, w array<double>, p bigint")
    found = {x["i"]: x["q"] for x in match.nearest_unbounded(s, r, "v", "w", {"p": "q"}, "j", recall=0.9).collect()}
    points = np.array([w for _, w, _ in ref])
    exact = {i: int(((points - np.array(v)) ** 2).sum(axis=1).argmin()) for i, v in sim}
    assert len(found) == 400 and None not in found.values()
    assert sum(found[i] == exact[i] for i in exact) >= 0.87 * len(exact)
    reference = match._reference(r, F.col("w"), "j", {"p": "q"})
    assert match.approximate_neighbours(s.select(F.col("v").alias("_v")), reference, 12, 0.9)[1] >= 0.9


def test_rows_off_the_points_meet_few(monkeypatch):
    """Rows beside 50,000 points, at distances far above those between points; the nearest of a sparse sample bounds them."""
    rng = np.random.default_rng(5)
    points, x = rng.random((50_000, 3)), rng.random((100, 3)) + [0.0, 0.0, 1.0] + np.linspace(0.1, 0.9, 100)[:, None] * [0.0, 0.0, 1.0]
    measured, pairs = [0], match._Level.pairs

    def counted(self, *args):
        for pair, position in pairs(self, *args):
            measured[0] += len(pair)
            yield pair, position

    monkeypatch.setattr(match._Level, "pairs", counted)
    found = match.CellIndex(points, 4.0).nearest(x)
    assert (found == [((points - v) ** 2).sum(axis=1).argmin() for v in x]).all()
    assert measured[0] < 400 * len(x)


@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_bounded_search_equals_brute_force(width):
    """Enough points for a sparse index, clusters and rows on all sides of them, with and without a bound."""
    rng = np.random.default_rng(6)
    points = np.vstack([rng.normal(size=(3_000, width)) * 0.05, rng.normal(size=(3_000, width)), [[3.0] * width] * 500])
    x = np.vstack([rng.normal(size=(200, width)) * 0.05, rng.normal(size=(200, width)) * 2, [[3.0] * width], [[-40.0] * width]])
    d2 = np.array([sum((points[:, i] - v[i]) ** 2 for i in range(width)) for v in x])
    want = np.where(d2.min(axis=1) < 1, d2.argmin(axis=1), -1)
    index = match.CellIndex(points, 1.0)
    assert (index.nearest(x) == want).all() and index.sparse is not None
    assert (index.nearest(x, np.sqrt(d2.min(axis=1))) == want).all()


def test_a_filter_on_the_property_does_not_repeat_the_search(spark):
    """The join becomes an inner one; a condition on its key must not be inferred below the search."""
    sim = spark.range(20).select("id", (F.col("id") / 2).alias("x"))
    ref = spark.range(10).select(F.col("id").alias("j"), F.col("id").cast("double").alias("y"), (F.col("id") - 3).cast("double").alias("p"))
    out = match.nearest_property(sim, ref, ["x"], ["y"], {"p": "q"}, "j", 0.4, {"p": 0.0}).where(F.col("q") > 0)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(out.select("id", "q").collect()) == [(2 * i, float(i - 3)) for i in range(4, 10)]


@pytest.mark.parametrize("far", [0.0, 1e5, 1e14, 1e140])
@pytest.mark.parametrize("width", [1, 4, 9])
def test_leaves_equal_brute_force(width, far):
    """Clusters, more copies than a leaf holds, rows off the points and points so far off that axes are not turned; the bound is inclusive, the radius is not."""
    rng = np.random.default_rng(7)
    points = np.vstack([rng.random((1_500, width)) * 0.05, rng.random((1_500, width)) * 2, [[9.0] * width] * 600, [[far] + [0.0] * (width - 1)]])
    x = np.vstack([rng.random((150, width)) * 0.05, rng.random((150, width)) * 2.5, [[9.0] * width, [9.5] + [9.0] * (width - 1), [9.25] * width, [far] + [0.25] * (width - 1), [-far] * width, [math.nan] * width]])
    with np.errstate(all="ignore"):
        d2 = sum((x[:, None, i] - points[None, :, i]) ** 2 for i in range(width))
    d2[-1] = np.inf
    want = np.where(d2.min(axis=1) < 0.25, d2.argmin(axis=1), -1)
    index = match.LeafIndex(points, 0.5)
    assert (index.nearest(x) == want).all() and len({*want}) > 100 and index.depth > 3
    assert (index.nearest(x, np.sqrt(d2.min(axis=1))) == want).all()
    assert (index.nearest(x, np.sqrt(d2.min(axis=1)) * 0.999) == np.where(d2.min(axis=1) == 0, want, -1)).all()


def test_nine_attributes_meet_few_points(monkeypatch):
    """Magnitudes that rise together and a redshift: a row is measured against a small share of the points, all in products."""
    rng = np.random.default_rng(8)
    make = lambda n: 8 * np.sqrt(rng.random((n, 1))) + np.cumsum(rng.random((n, 9)), axis=1)
    points, x = make(60_000), make(3_000)
    measured, meet = [0], match.LeafIndex._meet

    def counted(self, level, node, rows, *args):
        measured[0] += len(rows) * int(self.edges[level][node + 1] - self.edges[level][node])
        meet(self, level, node, rows, *args)

    monkeypatch.setattr(match.LeafIndex, "_meet", counted)
    found = match.LeafIndex(points, 1.2).nearest(x)
    assert (found[:200] == match.CellIndex(points, 1.2).nearest(x[:200])).all()
    assert measured[0] < 0.2 * len(points) * len(x)


@pytest.mark.parametrize("width", [2, 9])
def test_rows_are_solved_at_home_or_sent_on(spark, monkeypatch, width):
    """Many cells, some of several blocks, a vector that fills parts, ids that repeat: all columns of all rows come back once."""
    small_cells(monkeypatch, LARGER=1, LEAST_PART=1)
    monkeypatch.setattr(match, "BROADCAST_VALUES", 10)
    sim, ref = hostile(np.random.default_rng(10 + width), width, 150, 160)
    ref += [(20_000 + i, [0.625] * width, f"copy {i}") for i in range(30)]
    sim += [(i, [0.625] * width) for i in range(20)]
    names = [f"a{i}" for i in range(width)]
    kind = ", ".join(f"{n} double" for n in names)
    s = spark.createDataFrame([(i, *(v or [None] * width), {"k": n}) for n, (i, v) in enumerate(sim)], f"unique_gal_id bigint, {kind}, more map<string, int>").repartition(5)
    r = spark.createDataFrame([(i, *v, p) for i, v, p in ref], f"rid bigint, {kind}, p string").repartition(3)
    radius = 0.15 if width == 2 else 0.9
    found = match.nearest_property(s, r, names, names, {"p": "q"}, "rid", radius).collect()
    assert sorted(x["more"]["k"] for x in found) == [*range(len(sim))]
    got = sorted([(str(None if all(x[n] is None for n in names) else [x[n] for n in names]), x["q"]) for x in found], key=str)
    assert got == brute(sim, ref, radius)
    assert all(x["unique_gal_id"] == sim[x["more"]["k"]][0] for x in found)


@pytest.mark.parametrize("most", [10, 8_000_000])
def test_attributes_are_computed_once(spark, monkeypatch, most):
    """No filter on derived attributes moves below their formulas: each is computed once for a row of either side."""
    monkeypatch.setattr(match, "BROADCAST_VALUES", most)
    calls = {"sim": spark.sparkContext.accumulator(0), "ref": spark.sparkContext.accumulator(0)}

    def attribute(side):
        @F.udf("double")
        def value(i):
            calls[side].add(1)
            return float(i)

        return value

    s = spark.range(40).select(F.col("id").alias("unique_gal_id"), attribute("sim")("id").alias("x"))
    r = spark.range(40).select(F.col("id").alias("rid"), attribute("ref")("id").alias("y"), (F.col("id") * 10).alias("p"))
    s, r = s.withColumn("x2", F.col("x") * 2), r.withColumn("y2", F.col("y") * 2)
    found = match.nearest_property(s, r, ["x", "x2"], ["y", "y2"], {"p": "q"}, "rid", 0.5).collect()
    assert {x["unique_gal_id"]: x["q"] for x in found} == {i: 10 * i for i in range(40)}
    assert {side: n.value for side, n in calls.items()} == {"sim": 40, "ref": 40}


def test_a_worker_holds_one_index():
    made = []
    make = lambda name: lambda: made.append(name) or name
    assert [match.held(n, make(n)) for n in ("a", "a", "b", "a")] == ["a", "a", "b", "a"]
    assert made == ["a", "b", "a"] and len(match._HELD) == 1
    match._HELD.clear()
