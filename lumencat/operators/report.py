"""Quality reports: every family of statistics of two samples from one pass over their rows.

A family bins some value and may average another in each bin: magnitudes,
colours and apertures are counted, errors and properties are averaged against
magnitude, photo-z errors against redshift. All families' cells leave a row at
once and meet in one aggregate over grouping sets (bins, and totals of all
bins), so neither the number of families nor of filters adds a scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.magnitudes import clean, not_sentinel, redshift_error
from ..sources.storage import checkpointed
from .stats import bin_index, exact_quantiles, quantiles

#: Percentiles that give a family's automatic limits in the published reports.
LIMITS = {"magnitude": (0.5, 99.5), "colour": (2.5, 97.5), "error": (0.0, 95.0), "property": (0.25, 99.75), "photo_z": (0.0, 99.75)}


@dataclass(frozen=True)
class Family:
    """Bins of a family, and for each label the value that is binned and the value that is averaged (or None).

    A null or NaN value to be binned counts nowhere; ``limits`` are the
    percentiles of what ``limited`` names: the binned value (0) or the other (1).
    """

    name: str
    edges: Sequence[float]
    values: Mapping[str, tuple[Column, Column | None]]
    limits: tuple[float, float] | None = None
    limited: int = 0


def magnitudes(columns: Sequence[str], edges: Sequence[float]) -> Family:
    seen = {c: (F.when(not_sentinel(F.col(c)), F.col(c)), None) for c in columns}
    return Family("magnitude", edges, seen, LIMITS["magnitude"])


def colours(columns: Sequence[str], edges: Sequence[float]) -> Family:
    """Differences of consecutive filters where both are detected."""
    pairs = zip(columns, columns[1:], strict=False)
    seen = {f"{a}-{b}": (F.when(not_sentinel(F.col(a)) & not_sentinel(F.col(b)), F.col(a) - F.col(b)), None) for a, b in pairs}
    return Family("colour", edges, seen, LIMITS["colour"])


def errors(pairs: Mapping[str, str], edges: Sequence[float]) -> Family:
    """Mean error (value) in bins of the detected magnitude (key)."""
    seen = {m: (F.when(not_sentinel(F.col(m)), F.col(m)), F.when(not_sentinel(F.col(m)), F.col(e))) for m, e in pairs.items()}
    return Family("error", edges, seen, LIMITS["error"], 1)


def apertures(columns: Sequence[str], edges: Sequence[float]) -> Family:
    return Family("aperture", edges, {c: (F.col(c), None) for c in columns})


def properties(name: str, columns: Sequence[str], edges: Sequence[float]) -> Family:
    """Mean of a transferred property in bins of detected magnitudes."""
    seen = {c: (F.when(not_sentinel(F.col(c), 99.0), F.col(c)), F.col(name)) for c in columns}
    return Family("property", edges, seen, LIMITS["property"], 1)


def photo_z(z_phot: str, z_true: str, edges: Sequence[float], sigma: float = 0.15) -> Family:
    """Distribution and bias in bins of the estimate, bias in bins of the truth, and the share of outliers in both."""
    dz = redshift_error(F.col(z_phot), F.col(z_true))
    far = (F.abs(dz) > sigma).cast("double")
    seen = {"estimate": (F.col(z_phot), dz), "truth": (F.col(z_true), dz), "estimate_outliers": (F.col(z_phot), far), "truth_outliers": (F.col(z_true), far)}
    return Family("photo_z", edges, seen, LIMITS["photo_z"])


def _cells(both: DataFrame, families: Sequence[Family], sample: str) -> DataFrame:
    """sample, family, label, bin, x, y: a row for each family and label of every row.

    Values leave the row first and are binned after, so a value's expression
    is not repeated at every edge.
    """
    number = lambda c: clean(c) if c is not None else F.lit(None).cast("double")
    cells = [
        F.struct(F.lit(i).alias("no"), F.lit(f.name).alias("family"), F.lit(label).alias("label"), number(x).alias("x"), number(y).alias("y"))
        for i, f in enumerate(families)
        for label, (x, y) in f.values.items()
    ]
    rows = both.select(F.col(sample).alias("sample"), F.inline(F.array(*cells)))
    bin_ = F.coalesce(*[F.when(F.col("no") == i, bin_index(F.col("x"), f.edges)) for i, f in enumerate(families)])
    return rows.select("sample", "family", "label", bin_.alias("bin"), "x", "y")


def report(both: DataFrame, families: Sequence[Family], sample: str = "sample") -> DataFrame:
    """family, label, sample, bin, n, mean of every bin that holds rows, and with a null bin of all bins together."""
    rows = _cells(both, families, sample).where(F.col("bin").isNotNull())
    keys = [F.col("family"), F.col("label"), F.col("sample")]
    return rows.groupingSets([[*keys, F.col("bin")], keys], *keys, F.col("bin")).agg(F.count("*").alias("n"), F.avg("y").alias("mean"))


def limits(both: DataFrame, families: Sequence[Family], sample: str = "sample", exact: bool = False) -> DataFrame:
    """family, label, low, high: automatic limits that all samples share, from one pass of quantiles.

    Exact ones read the values three times: these are stored as one row of
    numbers for each row, and dealt to families as they are read. A family's
    groups are bracketed at its own two limits.
    """
    asked = [f for f in families if f.limits]
    shares = sorted({s / 100 for f in asked for s in f.limits})
    labels = [(f, label, pair[f.limited]) for f in asked for label, pair in f.values.items()]
    values = both.select(F.col(sample).alias("sample"), *[clean(v).alias(f"_{i}") for i, (_, _, v) in enumerate(labels)])
    values = checkpointed(values) if exact else values
    rows = values.select("sample", F.inline(F.array(*[F.struct(F.lit(i).alias("no"), F.col(f"_{i}").alias("v")) for i in range(len(labels))])))
    of_label = lambda of: F.array(*[of(f, label) for f, label, _ in labels])
    places = of_label(lambda f, _: F.array(*[F.lit(shares.index(s / 100)) for s in f.limits]))
    if exact:
        found = exact_quantiles(rows, ["no", "sample"], "v", shares, F.get(places, F.col("no")), stored=True)
        pick = lambda end: F.col("values")[end]
    else:
        found = quantiles(rows, ["no", "sample"], "v", shares, False)
        pick = lambda end: F.get("values", F.get(F.get(places, F.col("no")), F.lit(end)))
    each = found.groupBy("no").agg(F.min(pick(0)).alias("low"), F.max(pick(1)).alias("high"))
    return each.select(F.get(of_label(lambda f, _: F.lit(f.name)), F.col("no")).alias("family"), F.get(of_label(lambda _, label: F.lit(label)), F.col("no")).alias("label"), "low", "high")
