"""Photometric redshifts by Bayesian template fitting on a (template, redshift) grid of fluxes.

With weights 1/err^2, a model's amplitude is marginalised analytically: chi2 =
FF - FT^2 / TT, likelihood exp(-chi2 / 2) / sqrt(TT), flat over templates. The
prior is exp(-(z / z0)^2), z0 rising with the prior magnitude. Over a batch of
rows FT and TT are matrix products with the grid, so this runs in an
Arrow-batched numpy function: the same sums as array expressions in the JVM
are not compiled and took some hundred times as long.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Points (templates * redshifts) of a model grid that is sent to the tasks.
MOST_POINTS = 500_000


def grid_arrays(model: DataFrame, bands: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Redshifts, and fluxes by (redshift, template, band), from (template, z, band, flux) of checked size."""
    cells = [F.max(F.when(F.col("band") == b, F.col("flux"))).alias(f"f{i}") for i, b in enumerate(bands)]
    points = model.groupBy("z", "template").agg(*cells).na.drop()
    found = points.limit(MOST_POINTS + 1).toPandas().sort_values(["z", "template"])
    if len(found) > MOST_POINTS:
        raise ValueError("the model grid is too large for a broadcast")
    zs, templates = found["z"].unique(), found["template"].unique()
    if len(found) != len(zs) * len(templates) or not len(found):
        raise ValueError("the model grid needs every template at every redshift")
    return zs, found[[f"f{i}" for i in range(len(bands))]].to_numpy(float).reshape(len(zs), len(templates), len(bands))


def posterior(flux: np.ndarray, err: np.ndarray, prior: np.ndarray, zs: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Unnormalised posterior by (row, redshift)."""
    w = 1 / err**2
    flat = model.reshape(-1, model.shape[2])
    ff, ft, tt = (w * flux**2).sum(axis=1), (w * flux) @ flat.T, w @ (flat**2).T
    like = np.exp(-0.5 * (ff[:, None] - np.maximum(ft, 0) ** 2 / tt)) / np.sqrt(tt)
    z0 = np.maximum(0.2, 0.5 + 0.15 * (prior - 22.0))
    return like.reshape(len(flux), len(zs), -1).sum(axis=2) * np.exp(-((zs / z0[:, None]) ** 2))


def photoz_grid_fit(
    df: DataFrame, mags: Mapping[str, str], errs: Mapping[str, str], model: DataFrame, prior_band: str, z_min: float = 0.01, z_max: float = 2.0, keep: str | None = None
) -> DataFrame:
    """df with Z_B (the redshift of the highest posterior, the lowest on ties) and M_0 (the prior magnitude).

    keep names a column for the posterior, and ``<keep>_z`` for its redshifts.
    A non-detection (99) enters as zero flux with its limit as error; a missing
    magnitude gives a null Z_B.
    """
    zs, grid = grid_arrays(model.where(F.col("z").between(z_min, z_max)), [*mags])
    kinds = [T.StructField("z", T.DoubleType())] + [T.StructField("p", T.ArrayType(T.DoubleType()))] * bool(keep)

    @F.pandas_udf(T.StructType(kinds))
    def fit(fluxes: pd.Series, errors: pd.Series, prior: pd.Series) -> pd.DataFrame:
        out = [np.stack(x).astype(float) if len(x) else np.zeros((0, grid.shape[2])) for x in (fluxes, errors)]
        with np.errstate(all="ignore"):
            p = posterior(*out, prior.to_numpy(float), zs, grid)
        best = pd.Series(zs[np.nan_to_num(p, nan=-1.0).argmax(axis=1)]).where(~np.isnan(p).any(axis=1))
        return pd.DataFrame({"z": best, "p": [*p]} if keep else {"z": best})

    flux, err = [], []
    for band in mags:
        m, e = F.col(mags[band]).cast("double"), F.col(errs[band]).cast("double")
        f = F.pow(F.lit(10.0), -0.4 * (m - 25.0))
        seen = F.abs(m) < 90
        missing = F.lit(float("nan"))
        flux.append(F.coalesce(F.when(seen, f).otherwise(F.when(m.isNotNull(), 0.0)), missing))
        err.append(F.coalesce(F.when(seen, F.greatest(f * e / 1.0857, 1e-3 * f)).otherwise(F.pow(F.lit(10.0), -0.4 * (e - 25.0))), missing))
    prior = F.col(mags[prior_band]).cast("double")
    fitted = df.withColumn("_fit", fit(F.array(*flux), F.array(*err), F.coalesce(F.when(F.abs(prior) < 90, prior), F.lit(25.0))))
    extra = [F.col("_fit.p").alias(keep), F.array(*map(F.lit, map(float, zs))).alias(f"{keep}_z")] if keep else []
    return fitted.select(*df.columns, F.col("_fit.z").alias("Z_B"), prior.alias("M_0"), *extra)


def odds(p: Column, zs: Column, z_b: Column, width: float = 0.12) -> Column:
    """Posterior share within width * (1 + Z_B) of the peak."""
    return _share(p, zs, lambda z: F.abs(z - z_b) <= width * (1 + z_b))


def q_value(p: Column, zs: Column, z_true: Column) -> Column:
    """Posterior share up to the true redshift."""
    return _share(p, zs, lambda z: z <= z_true)


def _share(p: Column, zs: Column, inside) -> Column:
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(total(F.zip_with(p, zs, lambda x, z: F.when(inside(z), x).otherwise(0.0))), total(p))


def select_by_prior_mag(df: DataFrame, limit: float = 90.0) -> DataFrame:
    """Rows with a detected prior magnitude."""
    return df.where(F.abs("M_0") < limit)
