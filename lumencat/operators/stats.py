"""Histograms, percentiles, kernel densities and photo-z quality as grouped aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lookup import among
from ..functions.magnitudes import not_sentinel, redshift_error
from ..functions.rng import uniform
from ..sources.storage import checkpointed
from .ranges import ranged


#: Accuracy of the sketches that bracket exact quantiles.
SKETCH = 20_000
#: Groups whose brackets (some 100 bytes each) go to every task.
FEW_GROUPS = 100_000


def bin_index(x: Column, edges: Sequence[float], closed: bool = True) -> Column:
    """0-based bin of x; null outside, for NaN and null. closed: the last bin holds its upper edge."""
    inside = (x >= edges[0]) & (x <= edges[-1] if closed else x < edges[-1]) & ~F.isnan(x)
    return F.when(inside, among(x, edges[:-1], F.lit))


def uniform_bin(x: Column, low: float, step: float, n: int, closed: bool = True) -> Column:
    """Bin of a uniform grid by arithmetic."""
    i = F.floor((x - low) / step)
    top = low + n * step
    inside = (x >= low) & (x <= top if closed else x < top) & ~F.isnan(x)
    return F.when(inside, F.least(i, F.lit(n - 1)).cast("int"))


def bins_of(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return df.sparkSession.createDataFrame(rows, "bin int, low double, high double")


def histogram(df: DataFrame, column: str, edges: Sequence[float], density: bool = False, weight: str | None = None, rescale: float = 1.0) -> DataFrame:
    """bin, low, high, value of every bin: count or weight, or their density, times rescale."""
    value = F.sum(weight) if weight else F.count("*")
    counted = df.select(bin_index(F.col(column), edges).alias("bin"), *([weight] if weight else [])).where(F.col("bin").isNotNull()).groupBy("bin").agg(value.cast("double").alias("value"))
    out = bins_of(df, edges).join(F.broadcast(counted), "bin", "left").na.fill(0.0, ["value"])  # one row for each bin
    if density:
        total = F.sum("value").over(Window.partitionBy())
        out = out.withColumn("value", F.try_divide(F.col("value"), total * (F.col("high") - F.col("low"))))
    return out.withColumn("value", F.col("value") * rescale)


def histogram_per_filter(df: DataFrame, columns: Sequence[str], edges: Sequence[float], sample: str | None = None, weight: str | None = None) -> DataFrame:
    """filter, (sample,) bin, value: counts or weights of many columns in one pass."""
    keys = [sample] if sample else []
    carried = keys + ([weight] if weight else [])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("filter"), bin_index(F.col(c), edges).alias("bin")) for c in columns])).alias("cell")
    rows = df.select(*carried, cells).select(*carried, "cell.*").where(F.col("bin").isNotNull())
    return rows.groupBy("filter", *keys, "bin").agg((F.sum(weight) if weight else F.count("*").cast("double")).alias("value"))


def exact_quantiles(rows: DataFrame, keys: Sequence[str], x: str, shares: Sequence[float], picked: Column | None = None, stored: bool = False) -> DataFrame:
    """keys and ``values``: the interpolated quantiles of x at shares in each group, null for none.

    picked: an expression of the keys, the two positions of shares that the
    group needs; its values are those two alone. stored: rows read a stored
    table, and are not checkpointed again.

    Sketches bracket each quantile; what lies below a bracket is counted, and only
    the values inside, some 1e-3 of the rows, are tallied and ordered. No group's
    values meet in one buffer. The counts tell whether every bracket holds its
    quantile (merged sketches may be off by more than their nominal error);
    until they do, brackets are widened.
    """
    keys, x_, every = [*keys], F.col(x), range(len(shares) if picked is None else 2)
    margin = 8.0 / SKETCH
    rows = rows.where(x_.isNotNull()).select(*keys, x)
    rows = rows if stored else checkpointed(rows)  # three passes over two or three columns
    at = F.array(*map(F.lit, range(len(shares)))) if picked is None else picked
    match = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    # interpolation may want the value next to the bracket on either side
    outside = (
        F.array(*[F.count_if(x_ < F.col("_low")[i]) for i in every]).alias("_below"),
        F.array(*[F.count_if(x_ <= F.col("_high")[i]) for i in every]).alias("_upto"),
        F.array(*[F.max(F.when(x_ < F.col("_low")[i], x_)) for i in every]).alias("_before"),
        F.array(*[F.min(F.when(x_ > F.col("_high")[i], x_)) for i in every]).alias("_after"),
        F.transform(F.first("_shares"), lambda s: s * (F.first("_n") - 1)).alias("_rank"),
    )
    while True:
        # one sketch gives both ends
        ends = F.percentile_approx(x, F.array(*[F.lit(min(max(s + side * margin, 0.0), 1.0)) for side in (-1, 1) for s in shares]), SKETCH)
        three = [F.transform(at, lambda i: F.get("_ends", i)).alias("_low"), F.transform(at, lambda i: F.get("_ends", i + len(shares))).alias("_high")]
        three.append(F.transform(at, lambda i: F.get(F.array(*map(F.lit, map(float, shares))), i)).alias("_shares"))
        bracket = checkpointed(rows.groupBy(*keys).agg(ends.alias("_ends"), F.count("*").alias("_n")).select(*keys, F.struct(*three).alias("_three"), "_n").select(*keys, "_three.*", "_n"))
        hint = F.broadcast if bracket.count() <= FEW_GROUPS else lambda groups: groups  # one row for each group
        joined = rows.join(hint(bracket.withColumnsRenamed({k: f"_k_{k}" for k in keys})), match)
        below = checkpointed(joined.groupBy(*keys).agg(*outside))
        lost = [(F.floor(F.col("_rank")[i]) < F.col("_below")[i] - 1) | (F.ceil(F.col("_rank")[i]) > F.col("_upto")[i]) for i in every]
        if margin >= 1 or below.where(reduce(or_, lost)).isEmpty():
            break
        margin *= 16
    below = below.drop("_upto", "_rank")
    inside = F.array(*[F.when((x_ >= F.col("_low")[i]) & (x_ <= F.col("_high")[i]), F.lit(i)) for i in every])
    tally = joined.where(F.size(F.array_compact(inside)) > 0).select(*keys, "_n", "_shares", x_.alias("_x"), F.explode(F.array_compact(inside)).alias("_i")).groupBy(*keys, "_n", "_shares", "_i", "_x").agg(F.count("*").alias("_c"))
    tally = tally.join(hint(below.withColumnsRenamed({k: f"_k_{k}" for k in keys})), match)
    own = lambda c: F.element_at(c, F.col("_i") + 1)
    until = own("_below") + F.sum("_c").over(Window.partitionBy(*keys, "_i").orderBy("_x"))
    placed = tally.withColumns({"_until": until, "_at": own("_shares") * (F.col("_n") - 1)})
    placed = placed.select(*keys, "_i", "_at", "_x", "_until", own("_below").alias("_below"), own("_before").alias("_before"), own("_after").alias("_after"))

    def ranked(rank: Column) -> Column:
        return F.when(rank < F.first("_below"), F.first("_before")).otherwise(F.coalesce(F.min(F.when(F.col("_until") > rank, F.col("_x"))), F.first("_after")))

    found = placed.groupBy(*keys, "_i", "_at").agg(ranked(F.floor("_at")).alias("_a"), ranked(F.ceil("_at")).alias("_b"))
    part = F.col("_at") - F.floor("_at")
    found = found.withColumn("_v", F.when(part == 0, F.col("_a")).otherwise((1 - part) * F.col("_a") + part * F.col("_b")))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_v"))), lambda s: s["_v"])  # one item for each share
    return found.groupBy(*keys).agg(ordered.alias("values"))


def quantiles(rows: DataFrame, keys: Sequence[str], x: str, shares: Sequence[float], exact: bool) -> DataFrame:
    """keys and ``values``: quantiles of x in each group, exact ones interpolated, others from a sketch."""
    if exact:
        return exact_quantiles(rows, keys, x, shares)
    return rows.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.percentile_approx(x, F.array(*map(F.lit, map(float, shares))), 10_000).cast("array<double>").alias("values"))


def percentile_limits(df: DataFrame, columns: Sequence[str], low: float, high: float, sample: str | None = None, exact: bool = False, guard: float | None = 90.0) -> DataFrame:
    """filter, low, high: percentiles of detected values; over samples the lowest low and the highest high.

    From sketches (relative rank error 1e-4) unless exact.
    """
    keys = [sample] if sample else []
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).cast("double").alias("x")) for c in columns])).alias("cell")
    rows = df.select(*keys, cells).select(*keys, "cell.*")
    rows = rows.where(not_sentinel(F.col("x"), guard)) if guard else rows.where(F.col("x").isNotNull())
    each = quantiles(rows, ["filter", *keys], "x", [low / 100.0, high / 100.0], exact)
    return each.groupBy("filter").agg(F.min(F.col("values")[0]).alias("low"), F.max(F.col("values")[1]).alias("high"))


def binned_kde(df: DataFrame, x: str, low: float, step: float, cells: int, bandwidth: float, first: int = 0, stride: int = 1, points: int | None = None) -> DataFrame:
    """cell, density on grid points (all cells + 1 of them, or ``points`` from ``first`` by ``stride``): a Gaussian kernel estimate of x.

    Each value is shared linearly between its two grid points, so the data pass
    once into cells + 1 sums; only these meet the grid points asked for.
    """
    place = (F.col(x) - low) / step
    left = F.greatest(F.lit(0), F.least(F.floor(place), F.lit(cells - 1))).cast("int")
    right = place - left
    parts = F.inline(F.array(F.struct(left.alias("at"), (1 - right).alias("w")), F.struct((left + 1).alias("at"), right.alias("w"))))
    sums = df.where(F.abs(F.col(x).cast("double")) < float("inf")).select(parts).groupBy("at").agg(F.sum("w").alias("w"))
    masses = sums.agg(F.collect_list(F.struct("at", "w")).alias("masses"), F.sum("w").alias("n"))
    grid = df.sparkSession.range(cells + 1 if points is None else points).select((F.col("id") * stride + first).cast("int").alias("cell"))
    z = lambda s: (F.col("cell") - s["at"]) * (step / bandwidth)
    total = F.aggregate("masses", F.lit(0.0), lambda a, s: a + s["w"] * F.exp(-0.5 * z(s) * z(s)))
    return grid.crossJoin(F.broadcast(masses)).select("cell", (total / (F.col("n") * bandwidth * math.sqrt(2 * math.pi))).alias("density"))  # one row


def kde_1d(df: DataFrame, x: str, low: float, high: float, points: int = 251, factor: float | str = "scott", times_n: bool = False, refine: int = 64) -> DataFrame:
    """z, density at ``points`` even points; bandwidth: factor (or n^(-1/5)) times the standard deviation.

    Values that are null, NaN or infinite count nowhere. Without a spread (no
    rows, one row, a constant) the density is null.
    """
    df = df.where(F.abs(F.col(x).cast("double")) < float("inf"))
    std, n = df.agg(F.stddev_samp(x), F.count(x)).first()
    if not std:
        grid = df.sparkSession.range(points)
        return grid.select((low + F.col("id") * ((high - low) / (points - 1))).alias("z"), F.lit(None).cast("double").alias("density"))
    width = std * (n ** (-0.2) if factor == "scott" else factor)
    step = (high - low) / (points - 1) / refine
    lead = math.ceil(8 * width / step)  # values just outside still reach the grid
    cells = (points - 1) * refine + 2 * lead
    start = low - lead * step
    inside = df.where(F.col(x).between(start, start + cells * step))
    out = binned_kde(inside, x, start, step, cells, width, lead, refine, points)
    share = inside.agg(F.count(x).alias("inside"))
    scale = F.col("inside") / F.lit(1.0 if times_n else float(n))
    return out.crossJoin(F.broadcast(share)).select((start + F.col("cell") * step).alias("z"), (F.col("density") * scale).alias("density"))  # one row


def grid_step(df: DataFrame, x: str) -> DataFrame:
    """step: half the mean of the distinct differences of consecutive sorted unique values.

    Differences are taken inside range parts, and between the edges of
    neighbouring parts (one row each).
    """
    unique = df.where(F.col(x).isNotNull()).select(F.col(x).alias("v")).distinct()
    parted = ranged(unique, "v").select("v", F.col("_part").alias("part"))
    inside = parted.select((F.col("v") - F.lag("v").over(Window.partitionBy("part").orderBy("v"))).alias("d"))
    edges = parted.groupBy("part").agg(F.min("v").alias("first"), F.max("v").alias("last"))
    between = edges.select((F.col("first") - F.lag("last").over(Window.orderBy("part"))).alias("d"))
    return inside.unionByName(between).where(F.col("d").isNotNull()).distinct().agg((F.avg("d") / 2).alias("step"))


def jitter_discrete(df: DataFrame, x: str, seed: str, row_id: str, name: str) -> DataFrame:
    """Add x with uniform noise of plus or minus the half grid step."""
    noise = (2 * uniform(seed, "jitter", F.col(row_id)) - 1) * F.col("_step")
    return df.crossJoin(F.broadcast(grid_step(df, x).withColumnRenamed("step", "_step"))).withColumn(name, F.col(x) + noise).drop("_step")  # one row


def _binned(df: DataFrame, by: str, z_phot: str, z_true: str, edges: Sequence[float]) -> DataFrame:
    bin_ = bin_index(F.col(by), edges, closed=False) if len(edges) > 1 else F.lit(None).cast("int")
    return df.select(bin_.alias("bin"), F.col(by).alias("by"), redshift_error(F.col(z_phot), F.col(z_true)).alias("dz")).where(F.col("bin").isNotNull())


def photoz_statistics(df: DataFrame, by: str, z_phot: str, z_true: str, edges: Sequence[float], n: float = 3.0, sigma: float = 0.15, exact: bool = False) -> DataFrame:
    """bin, center, middle, n, bias, mad, nmad_fraction, outlier_fraction of each half-open bin.

    center: mean of the binning value; middle: middle of the bin; mad: scaled
    median deviation from the bin's mean, from a sketch unless exact. Empty bins
    have nulls; fewer than two edges make no bins.
    """
    rows = checkpointed(_binned(df, by, z_phot, z_true, edges))  # three numbers a row, read by every statistic
    means = rows.groupBy("bin").agg(F.avg("dz").alias("bias"), F.avg("by").alias("center"), F.count("*").alias("n"), F.avg((F.abs("dz") > sigma).cast("double")).alias("outlier_fraction"))
    off = rows.join(F.broadcast(means.select("bin", "bias")), "bin").withColumn("off", F.abs(F.col("dz") - F.col("bias")))  # one row for each bin
    mads = quantiles(off, ["bin"], "off", [0.5], exact).select("bin", (1.4826 * F.col("values")[0]).alias("mad"))
    far = rows.join(F.broadcast(mads), "bin").groupBy("bin").agg(F.avg((F.abs("dz") > n * F.col("mad")).cast("double")).alias("nmad_fraction"))
    out = bins_of(df, edges).join(means, "bin", "left").join(mads, "bin", "left").join(far, "bin", "left")
    count = F.coalesce("n", F.lit(0)).alias("n")
    return out.select("bin", "center", ((F.col("low") + F.col("high")) / 2).alias("middle"), count, "bias", "mad", "nmad_fraction", "outlier_fraction")


def photoz_bias(df: DataFrame, by: str, z_phot: str, z_true: str, edges: Sequence[float]) -> DataFrame:
    return _binned(df, by, z_phot, z_true, edges).groupBy("bin").agg(F.avg("by").alias("center"), F.avg("dz").alias("bias"))


def percentile_edges(df: DataFrame, by: str, first: float = 0.5, last: float = 96.5, count: int = 25, exact: bool = False) -> list[float]:
    """Automatic bin edges at even percentiles; a list of ``count`` numbers, none for no rows."""
    steps = [(first + (last - first) * i / (count - 1)) / 100 for i in range(count)]
    found = quantiles(df.select(F.lit(0).alias("all"), F.col(by).cast("double").alias("x")), ["all"], "x", steps, exact).first()
    return found["values"] if found else []


def outlier_envelope(mad_low: float, mad_high: float, z_max: float, z_split: float = 0.9) -> list[tuple[str, float, float]]:
    """Points (line, z_true, z_phot) of the outlier region's border for two redshift ranges."""
    out = []
    for side, s in (("upper", 1), ("lower", -1)):
        out += [(side, 0.0, -s * mad_low)]
        for z, m in ((z_split, mad_low), (z_split, mad_high), (z_max, mad_high)):
            out.append((side, (z + s * m) / (1 - s * m), z))
    return out


def median_default(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """filter, median of detected values: stands in where one of two samples is absent."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).cast("double").alias("x")) for c in columns])).alias("cell")
    rows = df.select(cells).select("cell.*").where(not_sentinel(F.col("x")))
    return quantiles(rows, ["filter"], "x", [0.5], exact).select("filter", F.col("values")[0].alias("median"))


def data_vs_sim(data: DataFrame, sim: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both tables' columns with the label ``sample``, for shared statistics."""
    return data.select(F.lit("data").alias("sample"), *columns).unionByName(sim.select(F.lit("sim").alias("sample"), *columns))
