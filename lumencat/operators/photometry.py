"""Noisy photometry: model magnitudes to observed magnitudes and errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import magnitudes as m
from ..functions.rng import normal


def noise_realisation(flux: Column, err: Column, seed: str, stream: str, row_id: Column) -> Column:
    """A draw from N(flux, err), keyed by seed, stream and row."""
    return flux + err * normal(seed, stream, row_id)


def observe(flux: Column, err: Column, limit: float, zero_point: float = 0.0, significance: float = 1.0, sn_floor: float = 0.2, sn_detect: float = 1.0) -> tuple[Column, Column]:
    """Observed magnitude and error of a noisy flux; non-detections are UNDETECTED with the limit's error."""
    sn = m.signal_to_noise(flux, err, sn_floor)
    lost = sn < sn_detect
    mag = F.when(lost, F.lit(m.UNDETECTED)).otherwise(m.mag_from_flux(flux, zero_point))
    return mag, F.when(lost, F.lit(m.non_detection_error(limit, significance))).otherwise(m.mag_error(sn))


def photometry(
    df: DataFrame,
    limits: Mapping[str, float],
    row_id: str = "unique_gal_id",
    seed: str = "sapling",
    zero_point: float = 0.0,
    significance: float = 1.0,
    sn_floor: float = 0.2,
    sn_detect: float = 1.0,
    sn_factors: Sequence[str] | None = None,
    is_flux: bool = False,
    store_flux: bool = False,
) -> DataFrame:
    """Add observed magnitudes and errors (and fluxes) of the columns named in limits, as float32.

    Row-wise: all filters are one projection. Fluxes leave the row first, so that
    their draws are not repeated wherever a flux is used.
    """
    if sn_factors is not None and len(sn_factors) != len(limits):
        raise ValueError("one S/N factor is needed for each filter")
    if sn_floor >= sn_detect:
        raise ValueError("the S/N floor must lie below the detection limit")
    fluxes, out = {}, []
    for i, (name, limit) in enumerate(limits.items()):
        err = m.flux_error(limit, zero_point, significance, F.col(sn_factors[i]) if sn_factors else None)
        flux = m.flux_from_mag(m.clean(F.col(name)), zero_point, is_flux)
        fluxes[f"_flux_{i}"] = noise_realisation(flux, err, seed, name, F.col(row_id))
        fluxes[f"_err_{i}"] = err
    noisy = df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in fluxes.items()])))) if fluxes else df
    for i, (name, limit) in enumerate(limits.items()):
        flux, err = F.col(f"_flux_{i}"), F.col(f"_err_{i}")
        mag, mag_err = observe(flux, err, limit, zero_point, significance, sn_floor, sn_detect)
        obs, obs_err = m.observed_names(name)
        out += [mag.cast("float").alias(obs, metadata={"unit": "mag", "description": "observed magnitude"})]
        out += [mag_err.cast("float").alias(obs_err, metadata={"unit": "mag", "description": "error of the observed magnitude"})]
        if store_flux:
            out += [flux.cast("float").alias(f"flux_{obs}"), err.cast("float").alias(f"fluxerr_{obs}")]
    return noisy.select(*df.columns, *out)
