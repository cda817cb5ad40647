"""Composite pipelines: photometric catalogues, spectroscopic samples, realisations, quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import apertures, magnitudes, sky
from ..operators import match, photometry, photoz, selections, stats
from ..sources import tables
from ..sources.storage import checkpointed


@dataclass(frozen=True)
class Preset:
    """Depth and seeing of a survey layout; limits and PSFs by column stem."""

    limits: Mapping[str, float]
    psf: Mapping[str, float]
    significance: float
    scale: float = 2.5
    share: float = 0.5


#: Magnitude limits (AB) and PSF sizes (arcsec) of the published set-ups.
KIDS_PRESET = Preset(
    limits={"sdss_u": 25.5, "sdss_g": 26.3, "sdss_r": 26.2, "sdss_i": 24.9, "sdss_z": 24.85, "des_asahi_full_y": 24.1, "vhs_j": 24.2, "vhs_h": 23.3, "vhs_ks": 23.2},
    psf={"sdss_u": 1.0, "sdss_g": 0.9, "sdss_r": 0.7, "sdss_i": 0.8, "sdss_z": 1.0, "des_asahi_full_y": 1.0, "vhs_j": 0.9, "vhs_h": 1.0, "vhs_ks": 0.9},
    significance=1.5,
)

DES_PRESET = Preset(
    limits={"des_asahi_full_g": 23.4, "des_asahi_full_r": 23.2, "des_asahi_full_i": 22.5, "des_asahi_full_z": 21.8, "des_asahi_full_y": 20.1},
    psf={"des_asahi_full_g": 1.25, "des_asahi_full_r": 1.07, "des_asahi_full_i": 0.97, "des_asahi_full_z": 0.89, "des_asahi_full_y": 1.07},
    significance=12.0,
)


@dataclass(frozen=True)
class PhotozFit:
    """The photo-z step of a chain: a model grid (template, z, band, flux), the stem of each of its bands, the prior's band."""

    model: DataFrame
    stems: Mapping[str, str]
    prior_band: str
    z_min: float = 0.01
    z_max: float = 2.0

    def fitted(self, df: DataFrame, tail: str) -> DataFrame:
        """df with Z_B and M_0 from the observed columns that end in tail."""
        mags = {b: f"{s}_obs{tail}" for b, s in self.stems.items()}
        errs = {b: f"{s}_obserr{tail}" for b, s in self.stems.items()}
        return photoz.photoz_grid_fit(df, mags, errs, self.model, self.prior_band, self.z_min, self.z_max)


def intrinsic(df: DataFrame, stems: Sequence[str], preset: Preset, box: sky.Box | None = None, lensed: bool = True, radius: bool = True) -> DataFrame:
    """What every noise realisation shares: box, evolution, magnification, sizes and apertures, as one projection over the scan."""
    out = sky.sky_box(df, box) if box else df
    out = magnitudes.evolve_magnitudes(out)
    if lensed:
        out = magnitudes.magnify(out, [f"{s}_evo" for s in stems])
    if radius:
        out = apertures.apertures(apertures.with_half_light_radius(out, share=preset.share), {s: preset.psf[s] for s in stems}, "bulge_axis_ratio", scale=preset.scale)
    return out


def observed(base: DataFrame, stems: Sequence[str], preset: Preset, lensed: bool = True, radius: bool = True, seed: str = "sapling", row_id: str = "unique_gal_id") -> DataFrame:
    """Noisy photometry of an intrinsic table."""
    limits = {f"{s}_evo_mag" if lensed else f"{s}_evo": preset.limits[s] for s in stems}
    return photometry.photometry(base, limits, row_id=row_id, seed=seed, significance=preset.significance, sn_factors=[f"sn_factor_{s}" for s in stems] if radius else None)


def photometric_catalogue(
    df: DataFrame,
    stems: Sequence[str],
    preset: Preset,
    box: sky.Box | None = None,
    lensed: bool = True,
    seed: str = "sapling",
    reference: tuple[DataFrame, Mapping] | None = None,
    rules: Sequence[tuple[str, str, object]] = (),
    columns: Sequence[str] | None = None,
    radius: bool = True,
    photo_z: PhotozFit | None = None,
) -> DataFrame:
    """Box, evolution, magnification, sizes, noise, a transferred property, photo-z, rules and columns on one lineage.

    reference: the second table and the arguments of nearest_property. All but
    that join is row-wise; the fit's posterior lives inside an Arrow batch.
    """
    out = observed(intrinsic(df, stems, preset, box, lensed, radius), stems, preset, lensed, radius, seed)
    if reference:
        out = match.nearest_property(out, reference[0], **reference[1])
    if photo_z:
        out = photo_z.fitted(out, "_mag" if lensed else "")
    if rules:
        out = selections.rule_filter(out, [*rules])
    return tables.project_columns(out, columns) if columns else out


def spectroscopic_sample(chunks: Sequence[DataFrame], survey: str, **options) -> tuple[DataFrame, DataFrame]:
    """The selection over the union of all chunks: target counts and draws are global."""
    return selections.select(survey, tables.vstack(chunks), **options)


def line_of_sight_realisations(
    df: DataFrame, survey: str, box: sky.Box, n_ra: int, n_dec: int, n: int | None = None, layout: str = "kids", seed: str = "sapling", statistics: tuple[str, str] | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """The survey's selection in every tile of a grid, and the statistics of its steps (pointing_id, step_no, step, N_tot, z_mean).

    n rows of each tile at most; further options (n_z, surface...) as of
    ``select``, and an error where the survey needs one that is missing. All
    tiles are one job. statistics: (path, mode) that the statistics go to, each
    tile an output of its own.
    """
    tiled = df.withColumn("pointing_id", sky.grid_index(F.col("ra_gal"), F.col("dec_gal"), box, n_ra, n_dec))
    drawn, stats = selections.select_by_stratum(survey, tiled, "pointing_id", layout=layout, seed=seed, n_tot=n, **options)
    if statistics:
        tables.write_statistics(stats, *statistics, survey=survey, output=f"{survey}_", by="pointing_id")
    return drawn, stats


def realised(rows: DataFrame, n: int) -> DataFrame:
    """Every row n times, told apart by ``realisation`` and by the key of its draws, ``_key``."""
    return rows.withColumn("realisation", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("_key", F.concat_ws(":", "unique_gal_id", "realisation"))


def photometry_realisations(df: DataFrame, limits: Mapping[str, float], n: int, survey: str | None = None, seed: str = "sapling", layout: str = "kids", **options) -> DataFrame:
    """n noise realisations of every row, told apart by ``realisation``; a selection's cut is applied to each.

    The realisation is part of the random key, so all are one job.
    """
    out = photometry.photometry(realised(df, n), limits, row_id="_key", seed=seed, **options).drop("_key")
    if survey is None:
        return out
    s = selections.SELECTIONS[survey]
    return out.where(s.cut(selections.magnitude_lookup(out, layout, s.suffixes)))


def deep_field_realisations(
    df: DataFrame,
    stems: Sequence[str],
    preset: Preset,
    n: int,
    survey: str,
    pointings: DataFrame | None = None,
    pointing: int = 50,
    photo_z: PhotozFit | None = None,
    lensed: bool = True,
    radius: bool = True,
    seed: str = "sapling",
    layout: str = "kids",
    statistics: tuple[str, str] | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """n realisations of one tile's photometry, each with photo-z and the survey's selection, and their step statistics.

    The tile (the nth of pointings), its evolved and magnified magnitudes and
    its apertures are computed once, as a checkpoint; only then rows are
    repeated, so scan, root search and projections do not grow with n. Noise,
    success draws and target counts are drawn in each realisation. options as
    of ``select``: n_tot rows of each realisation, n_z, surface,
    pass_survey_selection. statistics: (path, mode) that the statistics
    (realisation, step_no, step, N_tot, z_mean) go to.
    """
    base = df
    if pointings is not None:
        base = sky.assign_pointing(base, tables.pointing_nth(pointings, pointing)).drop("pointing_id")
    base = checkpointed(intrinsic(base, stems, preset, None, lensed, radius))
    out = observed(realised(base, n), stems, preset, lensed, radius, seed, "_key")
    if photo_z:
        out = photo_z.fitted(out, "_mag" if lensed else "")
    # the realised rows feed the statistics and every later draw
    drawn, stats = selections.select_by_stratum(survey, checkpointed(out), "realisation", layout=layout, seed=seed, row_id="_key", **options)
    if statistics:
        tables.write_statistics(stats, *statistics, survey=survey, output=f"{survey}_phot_", by="realisation")
    return drawn.drop("_key"), stats


def add_property(existing: DataFrame, reference: DataFrame, rules: Sequence[tuple[str, str, object]] = (), **options) -> DataFrame:
    """Another property from another reference, then the rules again."""
    return selections.rule_filter(match.nearest_property(existing, reference, **options), [*rules])


def quality_report(data: DataFrame, sim: DataFrame, columns: Sequence[str], edges: Sequence[float], low: float = 0.5, high: float = 99.5) -> tuple[DataFrame, DataFrame]:
    """Histograms by filter and sample, and the limits that both samples share."""
    both = stats.data_vs_sim(data, sim, columns)
    return stats.histogram_per_filter(both, columns, edges, sample="sample"), stats.percentile_limits(both, columns, low, high, sample="sample")
