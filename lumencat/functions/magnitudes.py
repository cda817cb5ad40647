"""Magnitude corrections, flux conversions, colours and band names as column expressions.

Magnitudes are hygienic on the way in: NaN counts as missing (null). The value
UNDETECTED marks a non-detection in outputs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETECTED = 99.0

#: Column stem of each band, and the detection band, by survey layout.
KIDS_LIKE = {
    "u": "sdss_u", "g": "sdss_g", "r": "sdss_r", "i": "sdss_i", "z": "sdss_z", "y": "des_asahi_full_y",
    "j": "vhs_j", "h": "vhs_h", "ks": "vhs_ks", "B": "lephare_b", "V": "lephare_v", "R": "lephare_rc", "I": "lephare_ic",
}
DES_LIKE = {
    "g": "des_asahi_full_g", "r": "des_asahi_full_r", "i": "des_asahi_full_i", "z": "des_asahi_full_z", "y": "des_asahi_full_y",
    "B": "lephare_b", "V": "lephare_v", "R": "lephare_rc", "I": "lephare_ic",
}
EUCLID_LIKE = {"g": "lsst_g", "r": "lsst_r", "i": "lsst_i", "z": "lsst_z", "B": "lsst_g", "V": "lephare_v", "R": "lsst_r", "I": "lsst_i"}
BAND_MAPS = {"kids": (KIDS_LIKE, "r"), "des": (DES_LIKE, "i"), "euclid": (EUCLID_LIKE, "i")}


def clean(mag: Column) -> Column:
    """The magnitude with NaN as null, so that comparisons behave as on missing values."""
    return F.nanvl(mag.cast("double"), F.lit(None).cast("double"))


def evolution_corrected(mag: Column, z: Column) -> Column:
    """Evolution correction, fixed coefficients."""
    return mag - 0.8 * (F.atan(1.5 * z) - 0.1489)


def evolve_magnitudes(df: DataFrame, z: str = "z_cgal") -> DataFrame:
    """Add an ``_evo`` column for every ``_true`` column; an error if there is none."""
    stems = [c[: -len("_true")] for c in df.columns if c.endswith("_true")]
    if not stems:
        raise KeyError("no column ends in '_true'")
    note = {"unit": "mag", "description": "evolution corrected model magnitude"}
    return df.select("*", *[evolution_corrected(F.col(f"{s}_true"), F.col(z)).alias(f"{s}_evo", metadata=note) for s in stems])


def magnified(mag: Column, kappa: Column) -> Column:
    """Flux magnification of a convergence; null where 1 + 2 kappa is not positive."""
    gain = 1 + 2 * kappa
    return mag - 2.5 * F.when(gain > 0, F.log10(gain))


def magnify(df: DataFrame, filters: Sequence[str], kappa: str = "kappa") -> DataFrame:
    """Add a ``_mag`` column for each named magnitude column."""
    note = {"unit": "mag", "description": "magnitude with flux magnification"}
    return df.select("*", *[magnified(F.col(f), F.col(kappa)).alias(f"{f}_mag", metadata=note) for f in filters])


def flux_from_mag(mag: Column, zero_point: float = 0.0, is_flux: bool = False) -> Column:
    return mag if is_flux else F.pow(F.lit(10.0), -0.4 * (mag - zero_point))


def flux_error(limit: float, zero_point: float = 0.0, significance: float = 1.0, sn_factor: Column | None = None) -> Column:
    """Error that a magnitude limit of given significance implies; better in a smaller aperture."""
    err = F.lit(10.0 ** (-0.4 * (limit - zero_point)) / significance)
    return err if sn_factor is None else err / sn_factor


def mag_from_flux(flux: Column, zero_point: float = 0.0) -> Column:
    """Magnitude of a flux; UNDETECTED where it is not positive (or missing)."""
    return F.when(flux > 0, -2.5 * F.log10(flux) + zero_point).otherwise(F.lit(UNDETECTED))


def signal_to_noise(flux: Column, err: Column, floor: float = 0.2) -> Column:
    """Flux over error, at least floor; floor where the ratio is undefined or infinite."""
    ratio = F.try_divide(flux, err)
    return F.when(ratio.isNull() | F.isnan(ratio) | (ratio == float("inf")), F.lit(floor)).otherwise(F.greatest(ratio, F.lit(floor)))


def mag_error(sn: Column) -> Column:
    return 2.5 / math.log(10) / sn


def non_detection_error(limit: float, significance: float) -> float:
    """Magnitude error that is written for a non-detection."""
    return limit - 2.5 * math.log10(significance)


def observed_names(column: str) -> tuple[str, str]:
    """Names of the observed magnitude and its error for a model column."""
    if column.endswith("_evo"):
        stem, tail = column[: -len("_evo")], ""
    elif column.endswith("_mag"):
        stem, tail = column[: -len("_mag")].removesuffix("_evo"), "_mag"
    else:
        stem, tail = column, ""
    return f"{stem}_obs{tail}", f"{stem}_obserr{tail}"


def resolve_mag(columns: Iterable[str], bands: Mapping[str, str], band: str, suffixes: str | Sequence[str]) -> Column:
    """The column of a band: magnified before plain, the first suffix that exists."""
    if band not in bands:
        raise KeyError(f"the survey has no band {band!r}")
    have = set(columns)
    for suffix in [suffixes] if isinstance(suffixes, str) else suffixes:
        for name in (f"{bands[band]}_{suffix}_mag", f"{bands[band]}_{suffix}"):
            if name in have:
                return clean(F.col(name))
    raise KeyError(f"no column for band {band!r} with suffix {suffixes!r}")


def deredden(df: DataFrame, extinction: Mapping[str, str]) -> DataFrame:
    """Subtract each magnitude's extinction column."""
    return df.withColumns({m: F.col(m) - F.col(e) for m, e in extinction.items()})


def not_sentinel(mag: Column, limit: float = 90.0) -> Column:
    return F.coalesce(F.abs(clean(mag)) < limit, F.lit(False))


def colours(df: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Add ``a-b`` for consecutive filters, null unless both are detected."""
    pairs = zip(filters, filters[1:], strict=False)
    return df.withColumns({f"{a}-{b}": F.when(not_sentinel(F.col(a)) & not_sentinel(F.col(b)), F.col(a) - F.col(b)) for a, b in pairs})


def colour_terms(g: Column, r: Column, i: Column) -> tuple[Column, Column, Column]:
    """The three colour combinations (along, across, upper) that red-galaxy cuts use."""
    return 0.7 * (g - r) + 1.2 * (r - i - 0.18), (r - i) - (g - r) / 4.0 - 0.18, (r - i) - (g - r) / 8.0


def redshift_error(z_phot: Column, z_true: Column) -> Column:
    return (z_phot - z_true) / (1 + z_true)
