"""Seeded samplers. Draws are keyed by seed and row id, so results never depend on partitions."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rng import uniform
from ..functions.spline import Curve, quadratic
from ..sources.storage import checkpointed
from .ranges import ranged
from .stats import binned_kde

#: Bound of the rate on its grid: any above 1 keeps every row, and infinities do not interpolate.
MOST_RATE = 1e6

#: Published success rates. Of R in bins of 0.2 from 18.9; of I in bins of 0.5 from 17; of redshift at the given nodes for I <= 22.5 and I > 22.5.
DEEP2_RATES = (
    0.931, 0.931, 0.918, 0.918, 0.931, 0.930, 0.956, 0.897, 0.907, 0.859, 0.907, 0.915, 0.892,
    0.899, 0.890, 0.861, 0.839, 0.827, 0.816, 0.809, 0.739, 0.710, 0.663, 0.607, 0.567, 0.533,
)
VVDS_I_RATES = (0.993, 0.980, 0.980, 0.977, 0.950, 0.960, 0.960, 0.944, 0.934, 0.917, 0.891, 0.854, 0.785, 0.685)
VVDS_BRIGHT = (
    (0.0, 0.996), (0.239, 0.958), (0.345, 0.979), (0.447, 0.975), (0.539, 0.981), (0.640, 0.983), (0.741, 0.992), (0.843, 0.979), (0.940, 0.985),
    (1.046, 0.983), (1.143, 0.945), (1.240, 0.861), (1.346, 0.838), (1.444, 0.686), (1.541, 0.568), (1.647, 0.604), (1.741, 1.0),
)
VVDS_DEEP = (
    (0.0, 0.888), (0.251, 0.897), (0.343, 0.920), (0.454, 0.945), (0.550, 0.962), (0.647, 0.964), (0.749, 0.954), (0.850, 0.933), (0.947, 0.912),
    (1.053, 0.901), (1.150, 0.872), (1.251, 0.869), (1.353, 0.869), (1.445, 0.867), (1.546, 0.851), (1.652, 0.861), (1.749, 0.836), (1.851, 0.722),
    (1.953, 0.678), (2.050, 0.691), (2.151, 0.686), (2.248, 0.617), (2.354, 0.691), (2.450, 0.697), (2.552, 0.657), (2.653, 0.678), (2.754, 0.764),
    (2.851, 0.802), (2.952, 0.905), (3.049, 0.876), (3.150, 0.844), (3.252, 0.789), (3.353, 0.787), (3.451, 0.640), (4.003, 0.752),
)


#: Sample sizes that one task may gather.
FEW = 10_000


def bin_curve(rates: tuple[float, ...], first_edge: float, step: float) -> Curve:
    """Curve of binned rates: nodes at bin centres, the first rate below, none above."""
    edges = first_edge + step * np.arange(len(rates) + 1)
    return quadratic((edges[1:] + edges[:-1]) / 2, rates, above=0.0)


@cache
def deep2_curve() -> Curve:
    return bin_curve(DEEP2_RATES, 18.9, 0.2)


@cache
def vvds_curves() -> tuple[Curve, Curve, Curve]:
    """Of I, of redshift for bright and for deep objects."""
    bright, deep = (np.array(t).T for t in (VVDS_BRIGHT, VVDS_DEEP))
    return bin_curve(VVDS_I_RATES, 17.0, 0.5), quadratic(*bright, above=1.0), quadratic(*deep, above=0.0)


def accepted(x: Column, curve: Curve, seed: str, stream: str, row_id: Column) -> Column:
    """Draw below the curve's rate at x; a missing x is not accepted."""
    return F.coalesce(uniform(seed, stream, row_id) < curve.column(x), F.lit(False))


def accepted_by_class(x: Column, is_first: Column, first: Curve, second: Curve, seed: str, stream: str, row_id: Column) -> Column:
    """One draw against the curve of the row's class."""
    rate = F.when(is_first, first.column(x)).otherwise(second.column(x))
    return F.coalesce(uniform(seed, stream, row_id) < rate, F.lit(False))


def deep2_success(mag, z: Column, seed: str, row_id: Column) -> Column:
    return accepted(mag("R"), deep2_curve(), seed, "success", row_id)


def vvds_success(mag, z: Column, seed: str, row_id: Column) -> Column:
    """Independent draws in magnitude and, by brightness, in redshift."""
    by_mag, bright, deep = vvds_curves()
    i = mag("I")
    return accepted(i, by_mag, seed, "success_mag", row_id) & accepted_by_class(z, i <= 22.5, bright, deep, seed, "success_z", row_id)


def with_surface_rate(df: DataFrame, x: Column, y: Column, surface: DataFrame, name: str) -> DataFrame:
    """Add the bilinear rate at (x, y) of a uniform grid surface (x, y, rate); the nearest edge outside.

    The grid is one row of an array, some 70,000 numbers for published
    surfaces; its size is checked before it is broadcast.
    """
    shape = surface.agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.countDistinct("x").alias("nx"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.countDistinct("y").alias("ny"), F.count("*").alias("n")
    ).first()
    nx, ny = shape["nx"], shape["ny"]
    if nx < 2 or ny < 2 or shape["n"] != nx * ny:
        raise ValueError("the surface must be a full grid of two or more points each way")
    if shape["n"] > 1_000_000:
        raise ValueError("the surface is too large to broadcast")
    rates = surface.agg(F.transform(F.sort_array(F.collect_list(F.struct("x", "y", "rate"))), lambda s: s["rate"]).alias("_rates"))

    def place(v: Column, low: float, high: float, n: int) -> Column:
        return F.least(F.greatest((v - low) / ((high - low) / (n - 1)), F.lit(0.0)), F.lit(float(n - 1)))

    u, v = place(x, shape["x0"], shape["x1"], nx), place(y, shape["y0"], shape["y1"], ny)
    i, j = F.least(F.floor(u), F.lit(nx - 2)).cast("int"), F.least(F.floor(v), F.lit(ny - 2)).cast("int")

    def at(di: int, dj: int) -> Column:
        return F.get("_rates", (i + di) * ny + j + dj)

    fu, fv = u - i, v - j
    rate = (1 - fu) * ((1 - fv) * at(0, 0) + fv * at(0, 1)) + fu * ((1 - fv) * at(1, 0) + fv * at(1, 1))
    return df.crossJoin(F.broadcast(rates)).withColumn(name, rate).drop("_rates")  # one row


def sample_n(df: DataFrame, n: int, seed: str, row_id: str = "unique_gal_id") -> DataFrame:
    """Exactly min(n, count) rows, uniformly: those of the smallest keyed uniforms.

    A few rows are a top-n. For many, the count of rows gives thresholds below
    which there are surely fewer, and above which surely more than n; the exact
    cut is made on the small band between, so neither a full sort nor one task
    of n rows is needed.
    """
    if n <= 0:
        return df.limit(0)
    keyed = df.withColumn("_u", uniform(seed, "sample", F.col(row_id)))
    if n <= FEW:
        return keyed.orderBy("_u", row_id).limit(n).drop("_u")
    total = df.count()
    if total <= n:
        return df
    spread = 6 * (n * (1 - n / total)) ** 0.5 + 10
    low, high = max(0.0, (n - spread) / total), min(1.0, (n + spread) / total)
    under, until = keyed.agg(F.count_if(F.col("_u") < low), F.count_if(F.col("_u") < high)).first()
    if not under <= n <= until:  # an unlikely draw, or ids that repeat
        low, high, under = 0.0, 2.0, 0
    band = keyed.where((F.col("_u") >= low) & (F.col("_u") < high)).orderBy("_u", row_id).limit(n - under)
    return keyed.where(F.col("_u") < low).unionByName(band).drop("_u")


def sample_n_per_stratum(df: DataFrame, n: int | Column, stratum: str, seed: str, row_id: str = "unique_gal_id") -> DataFrame:
    """At most n rows of each stratum, uniformly."""
    w = Window.partitionBy(stratum).orderBy(uniform(seed, "stratum", F.col(row_id)), row_id)
    return df.withColumn("_no", F.row_number().over(w)).where(F.col("_no") <= n).drop("_no")


def target_count(n: int, area_data: float, area_mock: float, chunks: int = 1) -> int:
    """A sample size scaled by area and shared by chunks."""
    return int(n / area_data * area_mock / chunks)


def dense_row_index(df: DataFrame, order: str, name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Add 0, 1, 2... in the order of a column, without a single-task window.

    One range exchange, checkpointed, numbers the rows inside its parts; the
    parts' counts (one row each) give the offsets. Nulls come first; rows of
    one value are ordered by a hash of the row.
    """
    numbered = ranged(df, order, partitions)
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    return numbered.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_local") + F.col("_offset")).select(*df.columns, name)


def sparse_every(df: DataFrame, n: int, order: str) -> DataFrame:
    """Rows 0, n, 2n... in the order of a column."""
    return dense_row_index(df, order, "_row").where(F.col("_row") % n == 0).drop("_row")


def sample_systematic(df: DataFrame, n: int, order: str) -> DataFrame:
    """About n evenly spaced rows; the first is always kept."""
    share = n / max(df.count(), 1)
    row = F.col("_row")
    keep = (row == 0) | (F.floor(row * share) > F.floor(row * share - share))
    return dense_row_index(df, order, "_row").where(keep).drop("_row")


def _bounds(df: DataFrame, x: str) -> tuple:
    """min, max, standard deviation and count of the values that are numbers."""
    number = F.when(F.abs(F.col(x).cast("double")) < float("inf"), F.col(x).cast("double"))
    return tuple(df.select(number.alias("x")).agg(F.min("x"), F.max("x"), F.stddev_samp("x"), F.count("x")).first())


def _placed(x: str, low: float, step: float, cells: int) -> tuple[Column, Column]:
    """A value's place on the grid in cells, and its cell."""
    place = (F.col(x) - low) / step
    return place, F.least(F.floor(place), F.lit(cells - 1)).cast("int")


def match_distribution(df: DataFrame, x: str, target: DataFrame, target_x: str, seed: str, row_id: str = "unique_gal_id", factor: float = 0.05, cells: int = 2000) -> DataFrame:
    """Thin df so that the distribution of x follows the target's.

    A row is kept with probability min(1, k_t(x) N_t / (k_s(x) N_s)), both
    densities being Gaussian kernel estimates on one grid (at most ``cells``
    cells, far finer than the bandwidth), linearly interpolated. The source's
    density is that of all its rows, not of an evenly spaced share. Where it
    vanishes the rate is 1. Values that are null, NaN or infinite count nowhere,
    and such rows of df are not kept. No target: no rows; a source or target
    without spread, or an empty source: df as it is.
    """
    # the bounds and the density read one column each
    values, wanted_values = checkpointed(df.select(x)), checkpointed(target.select(target_x))
    (s0, s1, s_std, n_s), (t0, t1, t_std, n_t) = _bounds(values, x), _bounds(wanted_values, target_x)
    if not n_s or not n_t or not s_std or not t_std:
        return df.limit(0) if not n_t else df
    low, high = min(s0, t0), max(s1, t1)
    step = (high - low) / cells
    source = binned_kde(values, x, low, step, cells, factor * s_std)
    wanted = binned_kde(wanted_values, target_x, low, step, cells, factor * t_std)
    ratio = source.join(wanted.withColumnRenamed("density", "wanted"), "cell").select("cell", F.least(F.coalesce(F.try_divide(F.col("wanted") * n_t, F.col("density") * n_s), F.lit(1.0)), F.lit(MOST_RATE)).alias("r"))
    grid = ratio.agg(F.transform(F.sort_array(F.collect_list(F.struct("cell", "r"))), lambda s: s["r"]).alias("_grid"))
    place, cell = _placed(x, low, step, cells)
    rate = F.get("_grid", cell) + (place - cell) * (F.get("_grid", cell + 1) - F.get("_grid", cell))
    number = F.abs(F.col(x).cast("double")) < float("inf")
    kept = df.where(number).crossJoin(F.broadcast(grid)).where(1 - F.least(F.lit(1.0), rate) < uniform(seed, "match", F.col(row_id)))  # one row of cells + 1 numbers
    return kept.select(*df.columns)


def match_distribution_by_stratum(
    df: DataFrame, x: str, stratum: str, target: DataFrame, target_x: str, seed: str, row_id: str = "unique_gal_id", factor: float = 0.05, cells: int = 2000
) -> DataFrame:
    """``match_distribution`` in every stratum at once, each with a kernel estimate of its own rows; one target for all.

    The grid is common to all strata. The rows pass once into (stratum, cell)
    sums; a stratum's cells + 1 sums become its rates in one small group, and
    rows meet the rates of their own stratum and cell by an equi-join.
    """
    # the bounds and the sums read two columns, those of the target one
    values, target = checkpointed(df.select(stratum, x)), checkpointed(target.select(target_x))
    (s0, s1, _, n_s), (t0, t1, t_std, n_t) = _bounds(values, x), _bounds(target, target_x)
    if not n_s or not n_t or not t_std:
        return df.limit(0) if not n_t else df
    low, high = min(s0, t0), max(s1, t1)
    step = (high - low) / cells or 1.0
    wanted = binned_kde(target, target_x, low, step, cells, factor * t_std).toPandas().sort_values("cell")["density"].to_numpy()  # cells + 1 numbers
    number = F.abs(F.col(x).cast("double")) < float("inf")
    place, cell = _placed(x, low, step, cells)
    shares = F.inline(F.array(F.struct(cell.alias("cell"), (1 - (place - cell)).alias("w")), F.struct((cell + 1).alias("cell"), (place - cell).alias("w"))))
    numbers = values.where(number)
    sums = numbers.select(stratum, shares).groupBy(stratum, "cell").agg(F.sum("w").alias("w"))
    spread = numbers.groupBy(stratum).agg(F.stddev_samp(x).alias("std"), F.count("*").alias("n"))
    kind = df.schema[stratum].dataType

    def rates(rows: pa.Table) -> pa.Table:
        """Rates at the cells of one stratum: r at its start, d to the next; 1 everywhere without a spread."""
        std, n = rows["std"][0].as_py(), rows["n"][0].as_py()
        mass = np.zeros(cells + 1)
        mass[rows["cell"].to_numpy()] = rows["w"].to_numpy()
        rate = np.ones(cells + 1)
        if std:
            width = factor * std
            kernel = np.exp(-0.5 * (np.arange(-cells, cells + 1) * (step / width)) ** 2)
            density = np.array([mass @ kernel[cells - k : 2 * cells + 1 - k] for k in range(cells + 1)]) / (mass.sum() * width * np.sqrt(2 * np.pi))
            with np.errstate(all="ignore"):
                rate = np.where(density > 0, np.minimum(wanted * n_t / (density * n), MOST_RATE), 1.0)
        used = np.unique(np.minimum(np.flatnonzero(mass), cells - 1))
        return pa.table({stratum: pa.repeat(rows[stratum][0], len(used)), "_cell": pa.array(used.astype(np.int32)), "_r": rate[used], "_d": rate[used + 1] - rate[used]})

    schema = T.StructType([T.StructField(stratum, kind), T.StructField("_cell", T.IntegerType()), T.StructField("_r", T.DoubleType()), T.StructField("_d", T.DoubleType())])
    found = sums.join(spread, stratum).groupBy(stratum).applyInArrow(rates, schema)
    placed = df.where(number).withColumns({"_cell": cell, "_part": place - cell})
    kept = placed.join(found, [stratum, "_cell"]).where(1 - F.least(F.lit(1.0), F.col("_r") + F.col("_part") * F.col("_d")) < uniform(seed, "match", F.col(row_id)))
    return kept.select(*df.columns)
