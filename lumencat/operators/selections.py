"""Survey selection functions: predicates, samplers in order, and statistics of each step.

A step is a boolean column. Steps are AND-ed as in the surveys' definitions;
statistics of all steps come from one pass. Predicates are null-safe: a missing
magnitude never selects. As in the originals the colour masks on non-detections
are not applied; ``strict_colours`` applies them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import magnitudes as m
from . import sampling

#: Cut constants of the red-galaxy samples, tuned and as published.
BOSS_TUNED = {"low_r": 20.0, "low_offset": 13.35, "mid_i": 20.1, "mid_offset": 19.98, "mid_d": 0.7}
BOSS_PUBLISHED = {"low_r": 19.6, "low_offset": 13.5, "mid_i": 19.9, "mid_offset": 19.86, "mid_d": 0.8}
#: The deep colour cut, tuned and as published.
DEEP_TUNED = {"faint": 24.0, "slope": 2.0, "shift": 0.4, "blue": 0.2}
DEEP_PUBLISHED = {"faint": 24.1, "slope": 2.45, "shift": 0.2976, "blue": 0.5}

Magnitude = Callable[[str], Column]


def true(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def detected(mag: Column) -> Column:
    """Finite and brighter than the non-detection mark."""
    return true((m.clean(mag) < 90.0) & (mag > float("-inf")))


def rule_filter(df: DataFrame, rules: list[tuple[str, str, object]]) -> DataFrame:
    """Rows that obey every (column, op, value); ops: gg, ll, ge, le, eq, ne."""
    ops = {"gg": Column.__gt__, "ll": Column.__lt__, "ge": Column.__ge__, "le": Column.__le__, "eq": Column.__eq__, "ne": Column.__ne__}
    return df.where(reduce(and_, [ops[op](F.col(c), F.lit(v)) for c, op, v in rules], F.lit(True)))


def all_detected(*mags: Column) -> Column:
    return reduce(and_, [m.not_sentinel(x, 99.0) for x in mags])


def gama(mag: Magnitude) -> Column:
    return true(mag("r") < 19.87)


def sdss_main(mag: Magnitude) -> Column:
    return true(mag("r") < 17.7)


def idealized(mag: Magnitude) -> Column:
    return true(mag("r") < 24.0)


def sdss_qso(mag: Magnitude) -> Column:
    """Central galaxies of the most massive haloes stand in for quasars."""
    return true((F.col("flag_central") == 1) & (F.col("lmstellar") > 11.2) & (F.col("lmhalo") > 13.3))


def boss(mag: Magnitude, cuts: Mapping[str, float] = BOSS_TUNED, strict_colours: bool = False) -> Column:
    g, r, i = mag("g"), mag("r"), mag("i")
    along, across, upper = m.colour_terms(g, r, i)
    low = (r > 16.0) & (r < cuts["low_r"]) & (F.abs(across) < 0.2) & (r < cuts["low_offset"] + along / 0.3)
    mid = (i > 17.5) & (i < cuts["mid_i"]) & (upper > 0.55) & (i < cuts["mid_offset"] + 1.6 * (upper - cuts["mid_d"])) & (r - i < 2.0)
    both = true(low) | true(mid)
    return both & all_detected(g, r, i) if strict_colours else both


def boss_original(mag: Magnitude) -> Column:
    return boss(mag, BOSS_PUBLISHED)


def two_df_lens_parts(mag: Magnitude) -> dict[str, Column]:
    """The exclusive low-redshift branches, the middle and the high-redshift part."""
    g, r, i, z, k = map(mag, ("g", "r", "i", "z", "ks"))
    along, across, upper = m.colour_terms(g, r, i)
    first = true((r > 16.5) & (r < 19.2) & (r < 13.1 + along / 0.32) & (F.abs(across) < 0.2))
    second = ~first & true((r > 16.5) & (r < 19.5) & (g - r > 1.3 + 0.25 * (r - i)) & (across > 0.45 - (g - r) / 6.0))
    third = ~first & ~second & true((r > 16.5) & (r < 19.6) & (r < 13.5 + along / 0.32) & (F.abs(across) < 0.2))
    mid = true((i > 17.5) & (i < 19.9) & (r - i < 2.0) & (upper > 0.55) & (i < 19.86 + 1.6 * (upper - 0.9)))
    high = true((z < 19.9) & (i > 19.9) & (i < 21.8) & (r - k > 1.9 * (r - i)) & (r - i > 0.98) & (i - z > 0.6))
    return {"low1": first, "low2": second, "low3": third, "mid": mid, "high": high}


def two_df_lens(mag: Magnitude, strict_colours: bool = False) -> Column:
    union = reduce(or_, two_df_lens_parts(mag).values())
    return union & all_detected(*map(mag, ("g", "r", "i", "z", "ks"))) if strict_colours else union


def wigglez(mag: Magnitude, strict_colours: bool = False) -> Column:
    u, g, r, i, z = map(mag, ("u", "g", "r", "i", "z"))
    red = (g < 22.5) & (i < 21.5) & (r - i < g - r - 0.1) & (r - i < 0.4) & (g - r > 0.6) & (r - z < 0.7 * (g - r))
    kept = true((r > 20.0) & (r < 22.5)) & ~true(red)
    return kept & all_detected(u, g, r, i, z) if strict_colours else kept


def deep2(mag: Magnitude, cuts: Mapping[str, float] = DEEP_TUNED) -> Column:
    b, r, i = mag("B"), mag("R"), mag("I")
    colour = (b - r < cuts["slope"] * (r - i) - cuts["shift"]) | (r - i > 1.1) | (b - r < cuts["blue"])
    return true((r > 18.5) & (r < cuts["faint"]) & colour)


def deep2_original(mag: Magnitude) -> Column:
    return deep2(mag, DEEP_PUBLISHED)


def vvds(mag: Magnitude) -> Column:
    return true((mag("I") > 18.5) & (mag("I") < 24.0))


def zcosmos(mag: Magnitude) -> Column:
    return true((mag("I") > 15.0) & (mag("I") < 22.5))


@dataclass(frozen=True)
class Selection:
    """A survey: its cut, magnitude suffixes in order of preference, and what follows the cut.

    success: boolean column of an acceptance draw, from (magnitude lookup,
    redshift, seed, id). needs_n: a target count is drawn at the end. needs_nz:
    a target redshift sample. count_first: the target count is a share of the
    input, drawn before the detection step.
    """

    cut: Callable[[Magnitude], Column]
    suffixes: tuple[str, ...] = ("obs",)
    success: Callable[[Magnitude, Column, str, Column], Column] | None = None
    needs_n: bool = False
    needs_nz: bool = False
    share_of_input: float | None = None
    parts: dict[str, Callable[[Magnitude], Column]] = field(default_factory=dict)


DEEP = ("evo", "obs")

SELECTIONS: dict[str, Selection] = {
    "2dflens": Selection(two_df_lens),
    "gama": Selection(gama),
    "sdss_main": Selection(sdss_main),
    "boss": Selection(boss),
    "boss_original": Selection(boss_original),
    "sdss_qso": Selection(sdss_qso),
    "sdss": Selection(lambda mag: sdss_main(mag) | boss(mag) | sdss_qso(mag), parts={"sdss_main": sdss_main, "sdss_boss": boss, "sdss_qso": sdss_qso}),
    "wigglez": Selection(wigglez, needs_nz=True),
    "deep2": Selection(deep2, DEEP, sampling.deep2_success, needs_n=True),
    "deep2_original": Selection(deep2_original, DEEP, sampling.deep2_success, needs_n=True),
    "vvds": Selection(vvds, DEEP, sampling.vvds_success, needs_n=True),
    "zcosmos": Selection(zcosmos, DEEP, None, needs_n=True),
    "idealized": Selection(idealized, share_of_input=0.575 * 0.10),
}


def register_selection(name: str, selection: Selection) -> None:
    SELECTIONS[name] = selection


def magnitude_lookup(df: DataFrame, layout: str, suffixes: tuple[str, ...]) -> Magnitude:
    bands, _ = m.BAND_MAPS[layout]
    return lambda band: m.resolve_mag(df.columns, bands, band, suffixes)


def step_statistics(df: DataFrame, steps: Mapping[str, Column], z: str = "z_cgal_v", by: str | None = None) -> DataFrame:
    """(by,) step_no, step, N_tot, z_mean of each boolean column, in one pass over df."""
    cells = [c for i, s in enumerate(steps.values()) for c in (F.count_if(s).alias(f"n{i}"), F.avg(F.when(s, F.col(z))).alias(f"z{i}"))]
    rows = [F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"), F.col(f"n{i}").alias("N_tot"), F.col(f"z{i}").alias("z_mean")) for i, name in enumerate(steps)]
    keys = [by] if by else []
    return df.groupBy(*keys).agg(*cells).select(*keys, F.inline(F.array(*rows)))


@dataclass(frozen=True)
class _Plan:
    """What a selection does with a table: the table with its draws, the steps, and what is left after them."""

    survey: Selection
    work: DataFrame
    steps: dict[str, Column]
    mask: Column
    seen: Column | None


def _plan(name: str, df: DataFrame, layout: str, seed: str, row_id: str, z: str, n_tot: int | None, n_z: DataFrame | None, surface: DataFrame | None, pass_survey_selection: bool) -> _Plan:
    """Cut, success draw and detection as boolean columns; an error if the survey needs an argument that is missing."""
    s = SELECTIONS[name]
    if s.needs_n and n_tot is None:
        raise ValueError(f"{name} needs n_tot")
    if s.needs_nz and n_z is None:
        raise ValueError(f"{name} needs n_z")
    if name == "zcosmos" and surface is None:
        raise ValueError(f"{name} needs the success-rate surface (x, y, rate)")
    mag = magnitude_lookup(df, layout, s.suffixes)
    bands, detection = m.BAND_MAPS[layout]
    seen = detected(m.resolve_mag(df.columns, bands, detection, "obs")) if pass_survey_selection else None
    steps: dict[str, Column] = {"input": F.lit(True)}
    if s.parts:
        # every branch is a selection of its own with its own statistics
        for part, predicate in s.parts.items():
            steps[part] = predicate(mag) & seen if seen is not None else predicate(mag)
        mask = reduce(or_, [*steps.values()][1:])
        steps["union"] = mask
        return _Plan(s, df, steps, mask, seen)
    work, mask = df, s.cut(mag)
    steps["cut"] = mask
    if name == "zcosmos":
        work = sampling.with_surface_rate(work, F.col(z), mag("I"), surface, "_rate")
        mask = mask & true(sampling.uniform(seed, f"{name}:success", F.col(row_id)) < F.col("_rate"))
        steps["success"] = mask
    elif s.success:
        mask = mask & true(s.success(mag, F.col(z), f"{seed}:{name}", F.col(row_id)))
        steps["success"] = mask
    if seen is not None and s.share_of_input is None:
        mask = mask & seen
        steps["detection"] = mask
    return _Plan(s, work, steps, mask, seen)


def select(
    name: str,
    df: DataFrame,
    layout: str = "kids",
    seed: str = "sapling",
    row_id: str = "unique_gal_id",
    z: str = "z_cgal_v",
    n_tot: int | None = None,
    n_z: DataFrame | None = None,
    surface: DataFrame | None = None,
    pass_survey_selection: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The selected rows, and a row of statistics for each step.

    Order: cut, success draw, [survey detection], target count or redshift
    distribution; a selection by a share of its input draws before detection. A
    survey of several branches reports each branch alone, then their union.
    """
    p = _plan(name, df, layout, seed, row_id, z, n_tot, n_z, surface, pass_survey_selection)
    s, seen = p.survey, p.seen
    stats = step_statistics(p.work, p.steps, z)
    kept = p.work.where(p.mask).select(*df.columns)
    if s.parts:
        return kept, stats
    if s.share_of_input is not None:
        n_tot = int(s.share_of_input * df.count())
    if n_tot is not None:
        kept = sampling.sample_n(kept, n_tot, f"{seed}:{name}", row_id)
        stats = _with_step(stats, kept, "downsampling", z)
    if s.needs_nz:
        kept = sampling.match_distribution(kept, z, n_z, n_z.columns[0], f"{seed}:{name}", row_id)
        stats = _with_step(stats, kept, "downsampling", z)
    if seen is not None and s.share_of_input is not None:
        kept = kept.where(seen)
        stats = _with_step(stats, kept, "detection", z)
    return kept, stats


def select_by_stratum(
    name: str,
    df: DataFrame,
    stratum: str,
    layout: str = "kids",
    seed: str = "sapling",
    row_id: str = "unique_gal_id",
    z: str = "z_cgal_v",
    n_tot: int | None = None,
    n_z: DataFrame | None = None,
    surface: DataFrame | None = None,
    pass_survey_selection: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """A selection of every stratum (tile, realisation) at once: the rows, and (stratum,) statistics for each step.

    Each stratum is treated as ``select`` treats a table: n_tot rows of each,
    n(z) matched in each, a share of its own input. One job does all strata;
    rows with a null stratum belong to none.
    """
    df = df.where(F.col(stratum).isNotNull())
    p = _plan(name, df, layout, seed, row_id, z, n_tot, n_z, surface, pass_survey_selection)
    s, seen, key = p.survey, p.seen, f"{seed}:{name}"
    stats = step_statistics(p.work, p.steps, z, stratum)
    number = len(p.steps)
    kept = p.work.where(p.mask).select(*df.columns)

    def further(step: str) -> None:
        nonlocal stats, number
        # strata that lost all their rows are in the first statistics still
        last = kept.groupBy(stratum).agg(F.count("*").alias("N_tot"), F.avg(z).alias("z_mean"))
        strata = stats.where("step_no = 0").select(stratum)
        rows = strata.join(last, stratum, "left").select(stratum, F.lit(number).alias("step_no"), F.lit(step).alias("step"), F.coalesce("N_tot", F.lit(0)).alias("N_tot"), "z_mean")
        stats, number = stats.unionByName(rows), number + 1

    if s.parts:
        return kept, stats
    if s.share_of_input is not None:
        quota = df.groupBy(stratum).agg(F.floor(F.lit(s.share_of_input) * F.count("*")).alias("_quota"))
        kept = sampling.sample_n_per_stratum(kept.join(quota, stratum), F.col("_quota"), stratum, key, row_id).select(*df.columns)
        further("downsampling")
    if n_tot is not None:
        kept = sampling.sample_n_per_stratum(kept, n_tot, stratum, key, row_id)
        further("downsampling")
    if s.needs_nz:
        kept = sampling.match_distribution_by_stratum(kept, z, stratum, n_z, n_z.columns[0], key, row_id)
        further("downsampling")
    if seen is not None and s.share_of_input is not None:
        kept = kept.where(seen)
        further("detection")
    return kept, stats


def _with_step(stats: DataFrame, kept: DataFrame, name: str, z: str) -> DataFrame:
    last = step_statistics(kept, {name: F.lit(True)}, z)
    number = stats.agg((F.max("step_no") + 1).alias("step_no"))
    return stats.unionByName(last.drop("step_no").crossJoin(number).select("step_no", "step", "N_tot", "z_mean"))  # one row each
