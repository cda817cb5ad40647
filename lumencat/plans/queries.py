"""The registered queries of the catalogue operators and their SQL oracles."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import apertures, magnitudes, sky
from ..functions.rng import uniform
from ..operators import match, photometry, photoz, sampling, selections, stats
from ..sources import storage, tables
from ..streaming import catalogue_streams
from . import pipelines
from .fixtures import catalogue, catalogue_sql, normal_sql, uniform_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ID = "unique_gal_id"
BOX = sky.Box(30.0, 60.0, 0.0, 30.0)
LIMITS = {"sdss_g_evo": 26.3, "sdss_r_evo": 26.2}
Z_EDGES = [round(0.1 * i, 1) for i in range(16)]
MAG_EDGES = [16.0 + 0.5 * i for i in range(21)]
PRICE_EDGES = [5000.0 * i for i in range(21)]
MAGS = ["sdss_g_true", "sdss_r_true", "sdss_i_true", "vhs_ks_true"]


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; sql over the view cat (the catalogue) and the driver's tables."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = f"{catalogue_sql()}\n{sql}" if re.search(r"\bcat\b", sql) else sql
        return query

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All fractional columns rounded, for comparison."""
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), digits).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with its model magnitudes taken as observed."""
    cat = catalogue(spark, sf_dir)
    return cat.withColumnsRenamed({c: c.replace("_true", "_obs") for c in cat.columns if c.endswith("_true")})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.load_catalogue(spark, f"{sf_dir}/{name}.parquet")


# --- row-wise ---------------------------------------------------------------

EVO = "{m} - 0.8 * (atan(1.5 * z_cgal) - 0.1489)"


@register("evolve_magnitudes", f"SELECT {ID}, round({EVO.format(m='sdss_r_true')}, 6) AS sdss_r_evo, round({EVO.format(m='vhs_ks_true')}, 6) AS vhs_ks_evo FROM cat")
def evolve_magnitudes(spark, sf_dir):
    return rounded(magnitudes.evolve_magnitudes(catalogue(spark, sf_dir)).select(ID, "sdss_r_evo", "vhs_ks_evo"))


@register("magnify", f"SELECT {ID}, round(sdss_r_true - 2.5 * log10(1 + 2 * kappa), 6) AS sdss_r_true_mag FROM cat")
def magnify(spark, sf_dir):
    return rounded(magnitudes.magnify(catalogue(spark, sf_dir), ["sdss_r_true"]).select(ID, "sdss_r_true_mag"))


def _photometry_sql(stem: str, limit: float, seed: str = "sapling", significance: float = 1.5, key: str = ID, source: str = "cat") -> str:
    err = 10.0 ** (-0.4 * limit) / significance
    return (
        f"SELECT *, greatest(f / {err!r}::double, 0.2) AS sn FROM (SELECT *, pow(10.0::double, -0.4 * ({EVO.format(m=stem + '_true')}))"
        f" + {err!r}::double * {normal_sql(seed, stem + '_evo', key)} AS f FROM {source})"
    )


def _mag_sql(limit: float, significance: float = 1.5) -> tuple[str, str]:
    return "CASE WHEN sn < 1 THEN 99.0 WHEN f > 0 THEN -2.5 * log10(f) ELSE 99.0 END", f"CASE WHEN sn < 1 THEN {limit - 2.5 * math.log10(significance)!r} ELSE {2.5 / math.log(10)!r} / sn END"


@register("photometry", f"SELECT {ID}, round(({_mag_sql(24.2)[0]})::float::double, 3) AS sdss_r_obs, round(({_mag_sql(24.2)[1]})::float::double, 3) AS sdss_r_obserr FROM ({_photometry_sql('sdss_r', 24.2)})")
def photometry_query(spark, sf_dir):
    cat = magnitudes.evolve_magnitudes(catalogue(spark, sf_dir))
    return rounded(photometry.photometry(cat, {"sdss_r_evo": 24.2}, significance=1.5).select(ID, "sdss_r_obs", "sdss_r_obserr"), 3)


@register("non_detections", f"SELECT sn < 1 AS lost, count(*) AS n, round(avg({_mag_sql(22.0)[1]}), 4) AS mean_err FROM ({_photometry_sql('sdss_r', 22.0)}) GROUP BY 1")
def non_detections(spark, sf_dir):
    cat = magnitudes.evolve_magnitudes(catalogue(spark, sf_dir))
    seen = photometry.photometry(cat, {"sdss_r_evo": 22.0}, significance=1.5)
    return seen.groupBy((F.col("sdss_r_obs") >= 99).alias("lost")).agg(F.count("*").alias("n"), F.round(F.avg("sdss_r_obserr"), 4).alias("mean_err"))


@register("half_light_radius", f"SELECT {ID}, CAST(0.5 AS DOUBLE) AS fraction FROM cat")
def half_light_radius(spark, sf_dir):
    sizes = F.col("disk_length"), F.col("bulge_length"), F.col("bulge_fraction")
    found = apertures.with_half_light_radius(catalogue(spark, sf_dir))
    return rounded(found.select(ID, apertures.flux_fraction(F.col("R_E"), *sizes).alias("fraction")))


@register(
    "apertures",
    f"SELECT {ID}, round(a, 6) AS aper_a_intr, round(sqrt(a * a + 0.49), 6) AS aper_a_r, round(sqrt(b * b + 0.49) / sqrt(a * a + 0.49), 6) AS aper_ba_ratio_r,"
    " round(pi() * sqrt(a * a + 0.49) * sqrt(b * b + 0.49), 4) AS aper_area_r, round(sqrt(0.49 / (sqrt(a * a + 0.49) * sqrt(b * b + 0.49))), 6) AS sn_factor_r"
    " FROM (SELECT *, a * bulge_axis_ratio AS b FROM (SELECT *, 2.5 * (disk_length + bulge_length) AS a FROM cat))",
)
def apertures_query(spark, sf_dir):
    cat = catalogue(spark, sf_dir).withColumn("R_E", F.col("disk_length") + F.col("bulge_length"))
    out = apertures.apertures(cat, {"r": 0.7}, "bulge_axis_ratio").select(ID, "aper_a_intr", "aper_a_r", "aper_ba_ratio_r", F.round("aper_area_r", 4).alias("aper_area_r"), "sn_factor_r")
    return rounded(out)


@register("colours", f"SELECT {ID}, round(sdss_g_true - sdss_r_true, 6) AS \"sdss_g_true-sdss_r_true\", CASE WHEN abs(vhs_ks_true) < 90 THEN round(sdss_r_true - vhs_ks_true, 6) END AS \"sdss_r_true-vhs_ks_true\" FROM cat")
def colours(spark, sf_dir):
    out = magnitudes.colours(catalogue(spark, sf_dir), ["sdss_g_true", "sdss_r_true", "vhs_ks_true"])
    return rounded(out.select(ID, F.col("`sdss_g_true-sdss_r_true`"), F.col("`sdss_r_true-vhs_ks_true`")))


@register("deredden", f"SELECT {ID}, round(sdss_r_true - kappa, 6) AS sdss_r_true FROM cat")
def deredden(spark, sf_dir):
    return rounded(magnitudes.deredden(catalogue(spark, sf_dir), {"sdss_r_true": "kappa"}).select(ID, "sdss_r_true"))


@register("redshift_error", f"SELECT {ID}, round((z_b - z_cgal) / (1 + z_cgal), 6) AS dz FROM cat")
def redshift_error(spark, sf_dir):
    return rounded(catalogue(spark, sf_dir).select(ID, magnitudes.redshift_error(F.col("z_b"), F.col("z_cgal")).alias("dz")))


# --- sky --------------------------------------------------------------------


@register("base_query", f"SELECT {ID}, round(ra_gal, 6) AS ra_gal, round(dec_gal, 6) AS dec_gal FROM cat WHERE dec_gal <= 20 AND ra_gal BETWEEN 35 AND 55")
def base_query(spark, sf_dir):
    return rounded(tables.base_query(catalogue(spark, sf_dir), [ID, "ra_gal", "dec_gal"], sky.Box(35.0, 55.0, 0.0, 20.0)))


@register("sky_box", f"SELECT {ID} FROM cat WHERE (ra_gal >= 55 OR ra_gal <= 35) AND dec_gal BETWEEN 6 AND 24")
def sky_box(spark, sf_dir):
    return sky.sky_box(catalogue(spark, sf_dir), sky.Box(55.0, 35.0, 6.0, 24.0)).select(ID)


@register("rule_filter", f"SELECT {ID} FROM cat WHERE sdss_r_true > 20 AND kappa < 0.01 AND flag_central = 1")
def rule_filter(spark, sf_dir):
    return selections.rule_filter(catalogue(spark, sf_dir), [("sdss_r_true", "gg", 20.0), ("kappa", "ll", 0.01), ("flag_central", "eq", 1)]).select(ID)


_TILES = """tiles AS (SELECT k + 1 AS pointing_id, 30 + (k % 5) * 6.0 AS ra_min, 36 + (k % 5) * 6.0 AS ra_max,
 degrees(asin((k // 5) * 0.125)) AS dec_min, degrees(asin((k // 5 + 1) * 0.125)) AS dec_max FROM range(20) t(k))"""


@register(
    "pointing_grid",
    f", {_TILES} SELECT pointing_id, any_value('T_' || replace(printf('%.1f', (ra_min + ra_max) / 2), '.', 'p') || '_' || replace(printf('%.1f', (dec_min + dec_max) / 2), '.', 'p')) AS name,"
    f" round(any_value(dec_min), 6) AS dec_min, count({ID}) AS n FROM tiles LEFT JOIN cat ON ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max GROUP BY 1",
)
def pointing_grid(spark, sf_dir):
    grid = sky.pointing_grid(spark, BOX, 5, 4, "T")
    found = catalogue(spark, sf_dir).select(sky.grid_index(F.col("ra_gal"), F.col("dec_gal"), BOX, 5, 4).alias("pointing_id")).groupBy("pointing_id").agg(F.count("*").alias("n"))
    return rounded(grid.join(found, "pointing_id", "left").select("pointing_id", "name", "dec_min", F.coalesce("n", F.lit(0)).alias("n")))


@register("assign_pointing", f", {_TILES} SELECT {ID}, pointing_id FROM cat, tiles WHERE ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max")
def assign_pointing(spark, sf_dir):
    return sky.assign_pointing(catalogue(spark, sf_dir), sky.pointing_grid(spark, BOX, 5, 4)).select(ID, "pointing_id")


_REGISTRY = "SELECT o_orderpriority AS survey, round(min(ra_gal), 6) AS ra_min, round(max(ra_gal), 6) AS ra_max, round(min(dec_gal), 6) AS dec_min, round(max(dec_gal), 6) AS dec_max FROM cat JOIN orders ON o_orderkey = unique_gal_id"


@register(
    "footprint_upsert",
    f", old AS ({_REGISTRY} GROUP BY 1), new AS ({_REGISTRY} WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1),"
    " merged AS (SELECT * FROM old WHERE survey NOT IN (SELECT survey FROM new) UNION ALL SELECT * FROM new)"
    " SELECT *, round((ra_max - ra_min) * degrees(sin(radians(dec_max)) - sin(radians(dec_min))), 4) AS area FROM merged",
)
def footprint_upsert(spark, sf_dir):
    both = catalogue(spark, sf_dir).join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col(ID))

    def registry(df):
        cells = [F.round(f(c), 6).alias(n) for f, c, n in ((F.min, "ra_gal", "ra_min"), (F.max, "ra_gal", "ra_max"), (F.min, "dec_gal", "dec_min"), (F.max, "dec_gal", "dec_max"))]
        bounds = df.groupBy(F.col("o_orderpriority").alias("survey")).agg(*cells)
        return bounds.withColumn("area", F.round(sky.footprint_area(*map(F.col, ("ra_min", "ra_max", "dec_min", "dec_max"))), 4))

    new = registry(both.where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")))
    return tables.footprint_upsert(registry(both), new)


# --- selections -------------------------------------------------------------

_COLOURS = """o AS (SELECT *, sdss_u_true AS u, sdss_g_true AS g, sdss_r_true AS r, sdss_i_true AS i, sdss_z_true AS z, vhs_ks_true AS k, lephare_b_true AS mb, lephare_rc_true AS mr, lephare_ic_true AS mi,
 0.7 * (sdss_g_true - sdss_r_true) + 1.2 * (sdss_r_true - sdss_i_true - 0.18) AS cp, (sdss_r_true - sdss_i_true) - (sdss_g_true - sdss_r_true) / 4.0 - 0.18 AS cr,
 (sdss_r_true - sdss_i_true) - (sdss_g_true - sdss_r_true) / 8.0 AS dr FROM cat)"""
_BOSS = "((r > 16 AND r < 20 AND abs(cr) < 0.2 AND r < 13.35 + cp / 0.3) OR (i > 17.5 AND i < 20.1 AND dr > 0.55 AND i < 19.98 + 1.6 * (dr - 0.7) AND r - i < 2))"
_CUTS = {
    "gama": "r < 19.87",
    "sdss_main": "r < 17.7",
    "idealized": "r < 24",
    "sdss_qso": "flag_central = 1 AND lmstellar > 11.2 AND lmhalo > 13.3",
    "boss": _BOSS,
    "boss_original": "((r > 16 AND r < 19.6 AND abs(cr) < 0.2 AND r < 13.5 + cp / 0.3) OR (i > 17.5 AND i < 19.9 AND dr > 0.55 AND i < 19.86 + 1.6 * (dr - 0.8) AND r - i < 2))",
    "sdss": f"r < 17.7 OR {_BOSS} OR (flag_central = 1 AND lmstellar > 11.2 AND lmhalo > 13.3)",
    "2dflens": "(r > 16.5 AND r < 19.2 AND r < 13.1 + cp / 0.32 AND abs(cr) < 0.2) OR (r > 16.5 AND r < 19.5 AND g - r > 1.3 + 0.25 * (r - i) AND cr > 0.45 - (g - r) / 6)"
    " OR (r > 16.5 AND r < 19.6 AND r < 13.5 + cp / 0.32 AND abs(cr) < 0.2) OR (i > 17.5 AND i < 19.9 AND r - i < 2 AND dr > 0.55 AND i < 19.86 + 1.6 * (dr - 0.9))"
    " OR (z < 19.9 AND i > 19.9 AND i < 21.8 AND r - k > 1.9 * (r - i) AND r - i > 0.98 AND i - z > 0.6)",
    "wigglez": "r > 20 AND r < 22.5 AND NOT (g < 22.5 AND i < 21.5 AND r - i < g - r - 0.1 AND r - i < 0.4 AND g - r > 0.6 AND r - z < 0.7 * (g - r))",
    "deep2": "mr > 18.5 AND mr < 24 AND (mb - mr < 2.0 * (mr - mi) - 0.4 OR mr - mi > 1.1 OR mb - mr < 0.2)",
    "deep2_original": "mr > 18.5 AND mr < 24.1 AND (mb - mr < 2.45 * (mr - mi) - 0.2976 OR mr - mi > 1.1 OR mb - mr < 0.5)",
    "vvds": "mi > 18.5 AND mi < 24",
    "zcosmos": "mi > 15 AND mi < 22.5",
}


def _selection_query(name: str) -> Query:
    def query(spark, sf_dir):
        cat = observed(spark, sf_dir)
        s = selections.SELECTIONS[name]
        mask = s.cut(selections.magnitude_lookup(cat, "kids", s.suffixes))
        return rounded(cat.where(mask).select(ID, "z_cgal_v"))

    return query


for _name, _cut in _CUTS.items():
    register(f"sel_{_name}", f", {_COLOURS} SELECT {ID}, round(z_cgal_v, 6) AS z_cgal_v FROM o WHERE {_cut}")(_selection_query(_name))


@register(
    "selection_stats",
    f", {_COLOURS} SELECT step_no, step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM (SELECT 0 AS step_no, 'input' AS step, z_cgal_v FROM o UNION ALL SELECT 1, 'cut', z_cgal_v FROM o WHERE {_CUTS['gama']}"
    f" UNION ALL SELECT 2, 'detection', z_cgal_v FROM o WHERE {_CUTS['gama']} AND r < 90) GROUP BY 1, 2",
)
def selection_stats(spark, sf_dir):
    return rounded(selections.select("gama", observed(spark, sf_dir), pass_survey_selection=True)[1])


def _deep_sql(cut: str, draw: str, seed: str, n: int) -> str:
    return f", {_COLOURS} SELECT {ID} FROM o WHERE {cut} AND {draw} ORDER BY {uniform_sql(seed, 'sample', ID)}, {ID} LIMIT {n}"


def _deep(name: str, n: int, surface: Query | None = None) -> Query:
    def query(spark, sf_dir):
        return selections.select(name, observed(spark, sf_dir), n_tot=n, surface=surface(spark, sf_dir) if surface else None)[0].select(ID)

    return query


register("deep2_sample", _deep_sql(_CUTS["deep2"], f"{uniform_sql('sapling:deep2', 'success', ID)} < {sampling.deep2_curve().sql('mr')}", "sapling:deep2", 500))(_deep("deep2", 500))
_I, _ZB, _ZD = sampling.vvds_curves()
register(
    "vvds_sample",
    _deep_sql(
        _CUTS["vvds"],
        f"{uniform_sql('sapling:vvds', 'success_mag', ID)} < {_I.sql('mi')} AND {uniform_sql('sapling:vvds', 'success_z', ID)} < CASE WHEN mi <= 22.5 THEN {_ZB.sql('z_cgal_v')} ELSE {_ZD.sql('z_cgal_v')} END",
        "sapling:vvds",
        500,
    ),
)(_deep("vvds", 500))


def surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in success-rate surface: 15 redshifts by 16 magnitudes."""
    grid = spark.range(15 * 16).select((F.col("id") % 15).alias("i"), F.floor(F.col("id") / 15).alias("j"))
    return grid.select((F.col("i") * 0.1).alias("x"), (15 + F.col("j") * 0.5).alias("y"), (0.95 - 0.003 * F.col("i") * F.col("j")).alias("rate"))


_RATE = """((1 - fu) * ((1 - fv) * (0.95 - 0.003 * a * b) + fv * (0.95 - 0.003 * a * (b + 1))) + fu * ((1 - fv) * (0.95 - 0.003 * (a + 1) * b) + fv * (0.95 - 0.003 * (a + 1) * (b + 1))))"""
_PLACED = f"""p0 AS (SELECT *, least(greatest(z_cgal_v / 0.1, 0), 14) AS uu, least(greatest((mi - 15) / 0.5, 0), 15) AS vv FROM o),
 p1 AS (SELECT *, least(floor(uu), 13) AS a, least(floor(vv), 14) AS b FROM p0), p2 AS (SELECT *, uu - a AS fu, vv - b AS fv FROM p1), p AS (SELECT *, {_RATE} AS rate FROM p2)"""


@register("accept_rate_2d", f", {_COLOURS}, {_PLACED} SELECT {ID}, round(rate, 6) AS rate FROM p WHERE {uniform_sql('sapling:zcosmos', 'success', ID)} < rate")
def accept_rate_2d(spark, sf_dir):
    rated = sampling.with_surface_rate(catalogue(spark, sf_dir), F.col("z_cgal_v"), F.col("lephare_ic_true"), surface(spark, sf_dir), "rate")
    return rounded(rated.where(uniform("sapling:zcosmos", "success", F.col(ID)) < F.col("rate")).select(ID, "rate"))


@register("accept_rate_1d", f"SELECT {ID} FROM cat WHERE {uniform_sql('s', 'd', ID)} < {sampling.deep2_curve().sql('lephare_rc_true')}")
def accept_rate_1d(spark, sf_dir):
    return catalogue(spark, sf_dir).where(sampling.accepted(F.col("lephare_rc_true"), sampling.deep2_curve(), "s", "d", F.col(ID))).select(ID)


@register("idealized_sample", f", {_COLOURS} SELECT {ID} FROM o WHERE r < 24 ORDER BY {uniform_sql('sapling:idealized', 'sample', ID)}, {ID} LIMIT (SELECT floor({0.575 * 0.10!r}::double * count(*))::bigint FROM o)")
def idealized_sample(spark, sf_dir):
    return selections.select("idealized", observed(spark, sf_dir))[0].select(ID)


_ZCOSMOS_DRAW = f"{_CUTS['zcosmos']} AND {uniform_sql('sapling:zcosmos', 'success', ID)} < rate"


@register(
    "zcosmos_stats",
    f", {_COLOURS}, {_PLACED} SELECT step_no, step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM (SELECT 0 AS step_no, 'input' AS step, z_cgal_v FROM p UNION ALL SELECT 1, 'cut', z_cgal_v FROM p WHERE {_CUTS['zcosmos']}"
    f" UNION ALL SELECT 2, 'success', z_cgal_v FROM p WHERE {_ZCOSMOS_DRAW} UNION ALL SELECT 3, 'downsampling', z_cgal_v FROM (SELECT * FROM p WHERE {_ZCOSMOS_DRAW} ORDER BY {uniform_sql('sapling:zcosmos', 'sample', ID)}, {ID} LIMIT 400)) GROUP BY 1, 2",
)
def zcosmos_stats(spark, sf_dir):
    return rounded(selections.select("zcosmos", observed(spark, sf_dir), n_tot=400, surface=surface(spark, sf_dir))[1])


# --- sampling ---------------------------------------------------------------


@register("sample_n", f"SELECT {ID} FROM cat ORDER BY {uniform_sql('s', 'sample', ID)}, {ID} LIMIT 700")
def sample_n(spark, sf_dir):
    return sampling.sample_n(catalogue(spark, sf_dir), 700, "s").select(ID)


@register(
    "sample_n_per_tile",
    f", {_TILES} SELECT {ID}, pointing_id FROM (SELECT {ID}, pointing_id, row_number() OVER (PARTITION BY pointing_id ORDER BY {uniform_sql('s', 'stratum', ID)}, {ID}) AS no FROM cat, tiles"
    " WHERE ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max) WHERE no <= 25",
)
def sample_n_per_tile(spark, sf_dir):
    tiled = catalogue(spark, sf_dir).withColumn("pointing_id", sky.grid_index(F.col("ra_gal"), F.col("dec_gal"), BOX, 5, 4))
    return sampling.sample_n_per_stratum(tiled, 25, "pointing_id", "s").select(ID, "pointing_id")


@register(
    "sample_systematic",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, 400.0::double / count(*) OVER () AS f FROM orders) WHERE i = 0 OR floor(i * f) > floor(i * f - f)",
)
def sample_systematic(spark, sf_dir):
    return sampling.sample_systematic(table(spark, sf_dir, "orders"), 400, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@register("sparse_every", "SELECT o_orderkey, o_custkey, o_orderstatus FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) WHERE i % 256 = 0")
def sparse_every(spark, sf_dir):
    return sampling.sparse_every(table(spark, sf_dir, "orders"), 256, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


def _kde_sql(rows: str, h: str) -> str:
    """Sums of the grid's cells, then the kernel estimate at every grid point."""
    return (
        f"{rows}0 AS (SELECT greatest(0, least(floor((x - low) / step), 1999)) AS a, (x - low) / step AS place FROM {rows}, p),"
        f" {rows}1 AS (SELECT pos, sum(w) AS w FROM (SELECT a AS pos, 1 - (place - a) AS w FROM {rows}0 UNION ALL SELECT a + 1, place - a FROM {rows}0) GROUP BY 1),"
        f" {rows}2 AS (SELECT g.k, sum(w * exp(-0.5 * pow((g.k - pos) * (step / {h}), 2))) / (sum(w) * any_value({h}) * sqrt(2 * pi())) AS d FROM range(2001) g(k), {rows}1, p GROUP BY 1)"
    )


@register(
    "match_distribution",
    f", {_COLOURS}, s AS (SELECT {ID}, z_cgal_v AS x FROM o WHERE {_CUTS['wigglez']}), t AS (SELECT z_cgal_v AS x FROM o WHERE {_CUTS['sdss_main']} AND z_cgal_v < 1),"
    " p AS (SELECT least(s0, t0) AS low, (greatest(s1, t1) - least(s0, t0)) / 2000 AS step, hs, ht, ns, nt FROM (SELECT min(x) AS s0, max(x) AS s1, 0.05::double * stddev_samp(x) AS hs, count(*) AS ns FROM s),"
    f" (SELECT min(x) AS t0, max(x) AS t1, 0.05::double * stddev_samp(x) AS ht, count(*) AS nt FROM t)), {_kde_sql('s', 'hs')}, {_kde_sql('t', 'ht')},"
    " r AS (SELECT s2.k, least(CASE WHEN s2.d * ns = 0 THEN 1 ELSE t2.d * nt / (s2.d * ns) END, 1e6) AS r FROM s2 JOIN t2 USING (k), p),"
    " c AS (SELECT *, (x - low) / step AS place, least(floor((x - low) / step), 1999) AS cell FROM s, p)"
    f" SELECT {ID} FROM c JOIN r a ON a.k = cell JOIN r b ON b.k = cell + 1 WHERE 1 - least(1, a.r + (place - cell) * (b.r - a.r)) < {uniform_sql('sapling:wigglez', 'match', ID)}",
)
def match_distribution(spark, sf_dir):
    cat = observed(spark, sf_dir)
    wanted = selections.SELECTIONS["sdss_main"].cut(selections.magnitude_lookup(cat, "kids", ("obs",)))
    return selections.select("wigglez", cat, n_z=cat.where(wanted & (F.col("z_cgal_v") < 1)).select("z_cgal_v"))[0].select(ID)


# --- joins ------------------------------------------------------------------


@register("hstack", f"SELECT {ID}, round(ra_gal, 6) AS ra_gal, round(o_totalprice, 2) AS o_totalprice FROM cat JOIN orders ON o_orderkey = {ID}")
def hstack(spark, sf_dir):
    left = catalogue(spark, sf_dir).select(ID, "ra_gal")
    right = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(ID), "o_totalprice")
    return rounded(tables.hstack([left, right], ID).withColumn("o_totalprice", F.round("o_totalprice", 2)))


@register("vstack", f"SELECT {ID}, flag_central FROM cat")
def vstack(spark, sf_dir):
    chunks = tables.split_rows(catalogue(spark, sf_dir).select(ID, "flag_central"), 4, ID)
    return tables.vstack([chunks.where(F.col("chunk") == i).drop("chunk") for i in range(4)])


_NEAR = f"""s AS (SELECT * FROM cat WHERE {ID} % 10 <> 0), f AS (SELECT * FROM cat WHERE {ID} % 10 = 0),
 d AS (SELECT s.{ID} AS sid, f.{ID} AS fid, f.lmhalo AS w, pow(s.sdss_r_true - f.sdss_r_true, 2) + pow(s.sdss_g_true - f.sdss_g_true, 2) + pow(s.sdss_i_true - f.sdss_i_true, 2) AS d2 FROM s, f
 WHERE abs(s.sdss_r_true - f.sdss_r_true) < 0.3)"""


@register("nearest_property", f", {_NEAR} SELECT s.{ID}, round(coalesce(b.w, 0), 6) AS weight FROM s LEFT JOIN (SELECT sid, arg_min(w, (d2, fid)) AS w FROM d WHERE d2 < 0.09 GROUP BY 1) b ON b.sid = s.{ID}")
def nearest_property(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    attrs = ["sdss_r_true", "sdss_g_true", "sdss_i_true"]
    ref = cat.where(F.col(ID) % 10 == 0).select(F.col(ID).alias("ref_id"), *attrs, F.col("lmhalo").alias("w"))
    out = match.nearest_property(cat.where(F.col(ID) % 10 != 0).select(ID, *attrs), ref, attrs, attrs, {"w": "weight"}, "ref_id", 0.3, {"w": 0.0})
    return rounded(out.select(ID, "weight"))


@register(
    "nearest_unbounded",
    "SELECT s.vec_id, arg_min(r.label, (list_distance(s.embedding::DOUBLE[], r.embedding::DOUBLE[]), r.vec_id)) AS near_label FROM embeddings s, embeddings r WHERE s.vec_id % 10 <> 0 AND r.vec_id % 10 = 0 GROUP BY 1",
)
def nearest_unbounded(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    ref = vectors.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("ref_v"), F.col("label").alias("ref_label"))
    sim = vectors.where(F.col("vec_id") % 10 != 0).select("vec_id", "embedding")
    return match.nearest_unbounded(sim, ref, "embedding", "ref_v", {"ref_label": "near_label"}, "ref_id", "vec_id").select("vec_id", "near_label")


@register(
    "nearest_property_cells",
    f", {_NEAR.replace('s AS (SELECT * FROM cat', f's AS (SELECT *, {ID} % 50 AS repeated FROM cat')}, k AS (SELECT s.{ID} AS real, repeated, round(sdss_r_true, 6) AS r FROM s),"
    f" b AS (SELECT sid, arg_min(w, (d2, fid)) AS w FROM d WHERE d2 < 0.09 AND sid % 13 <> 0 GROUP BY 1) SELECT repeated AS {ID}, r, round(coalesce(b.w, 0), 6) AS weight FROM k LEFT JOIN b ON b.sid = k.real",
)
def nearest_property_cells(spark, sf_dir):
    """The path of a large reference, with ids that repeat and attributes that are NaN."""
    cat = catalogue(spark, sf_dir)
    attrs = ["sdss_r_true", "sdss_g_true", "sdss_i_true"]
    ref = cat.where(F.col(ID) % 10 == 0).select(F.col(ID).alias("ref_id"), *attrs, F.col("lmhalo").alias("w"))
    missing = F.when(F.col(ID) % 13 == 0, float("nan")).otherwise(F.col("sdss_g_true")).alias("sdss_g_true")
    sim = cat.where(F.col(ID) % 10 != 0).select((F.col(ID) % 50).alias(ID), F.round("sdss_r_true", 6).alias("r"), "sdss_r_true", missing, "sdss_i_true")
    out = match.nearest_property(sim, ref, attrs, attrs, {"w": "weight"}, "ref_id", 0.3, {"w": 0.0}, broadcast_values=0)
    return rounded(out.select(ID, "r", "weight"))


@register(
    "nearest_unbounded_cells",
    "SELECT s.vec_id % 7 AS vec_id, arg_min(r.label, (list_distance(s.embedding::DOUBLE[], r.embedding::DOUBLE[]), r.vec_id)) AS near_label, s.vec_id AS v FROM embeddings s, embeddings r WHERE s.vec_id % 10 <> 0 AND s.vec_id % 11 <> 0 AND r.vec_id % 10 = 0 GROUP BY s.vec_id"
    " UNION ALL SELECT vec_id % 7, NULL, vec_id FROM embeddings WHERE vec_id % 10 <> 0 AND vec_id % 11 = 0",
)
def nearest_unbounded_cells(spark, sf_dir):
    """The path of a large reference, with ids that repeat and vectors that hold NaN."""
    vectors = table(spark, sf_dir, "embeddings")
    ref = vectors.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("ref_v"), F.col("label").alias("ref_label"))
    holed = F.when(F.col("vec_id") % 11 == 0, F.transform("embedding", lambda x, i: F.when(i == 3, F.lit(float("nan")).cast("float")).otherwise(x))).otherwise(F.col("embedding"))
    sim = vectors.where(F.col("vec_id") % 10 != 0).select((F.col("vec_id") % 7).alias("vec_id"), F.col("vec_id").alias("v"), holed.alias("embedding"))
    out = match.nearest_unbounded(sim, ref, "embedding", "ref_v", {"ref_label": "near_label"}, "ref_id", broadcast_values=0)
    return out.select("vec_id", "near_label", "v")


@register("nearest_approximate")
def nearest_approximate(spark, sf_dir):
    """Hashed buckets that meet at least nine of ten true neighbours of a sample; tests measure it on all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    ref = vectors.where(F.col("vec_id") % 10 == 0).select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("ref_v"), F.col("label").alias("ref_label"))
    out = match.nearest_unbounded(vectors.where(F.col("vec_id") % 10 != 0), ref, "embedding", "ref_v", {"ref_id": "near_id", "ref_label": "near_label"}, "ref_id", recall=0.9, broadcast_values=0)
    return out.select("vec_id", "near_id", "near_label")


# --- statistics -------------------------------------------------------------

_PRICE_BIN = "least(floor(l_extendedprice / 5000), 19)::int"


def _price_sql(value: str) -> str:
    return f"SELECT t.bin::int AS bin, round(coalesce(v, 0)::double, 9) AS value FROM range(20) t(bin) LEFT JOIN (SELECT {_PRICE_BIN} AS bin, {value} AS v FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 100000 GROUP BY 1) h ON h.bin = t.bin"


@register("histogram_density", _price_sql("count(*) / 5000.0 / (SELECT count(*) FROM lineitem WHERE l_extendedprice BETWEEN 0 AND 100000)"))
def histogram_density(spark, sf_dir):
    return rounded(stats.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", PRICE_EDGES, density=True).select("bin", "value"), 9)


@register("histogram_weighted", _price_sql("sum(l_quantity)"))
def histogram_weighted(spark, sf_dir):
    return rounded(stats.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", PRICE_EDGES, weight="l_quantity").select("bin", "value"), 9)


@register(
    "histogram_per_filter",
    "SELECT filter, least(floor((x - 16) / 0.5), 19)::int AS bin, count(*)::double AS value FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS filter, {c} AS x FROM cat" for c in MAGS) + ") WHERE x BETWEEN 16 AND 26 GROUP BY 1, 2",
)
def histogram_per_filter(spark, sf_dir):
    return stats.histogram_per_filter(catalogue(spark, sf_dir), MAGS, MAG_EDGES)


@register(
    "percentile_limits",
    "SELECT filter, round(min(low), 6) AS low, round(max(high), 6) AS high FROM (SELECT filter, s, quantile_cont(x, 0.005) AS low, quantile_cont(x, 0.995) AS high FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS filter, flag_central AS s, {c} AS x FROM cat" for c in MAGS)
    + ") WHERE abs(x) < 90 GROUP BY 1, 2) GROUP BY 1",
)
def percentile_limits(spark, sf_dir):
    return rounded(stats.percentile_limits(catalogue(spark, sf_dir), MAGS, 0.5, 99.5, sample="flag_central", exact=True))


@register(
    "kde_1d",
    ", s AS (SELECT stddev_samp(z_cgal) * pow(count(*)::double, -0.2) AS h, count(*) AS n FROM cat), g AS (SELECT k * 0.006 AS z FROM range(251) t(k))"
    " SELECT round(g.z, 6) AS z, round(sum(exp(-0.5 * pow((g.z - z_cgal) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 3) AS density FROM g, cat, s GROUP BY g.z",
)
def kde_1d(spark, sf_dir):
    out = stats.kde_1d(catalogue(spark, sf_dir), "z_cgal", 0.0, 1.5)
    return out.select(F.round("z", 6).alias("z"), F.round("density", 3).alias("density"))


_DZ = "b AS (SELECT floor(z_b * 10 + 1e-9)::int AS bin, z_b, (z_b - z_cgal) / (1 + z_cgal) AS dz FROM cat WHERE z_b >= 0 AND z_b < 1.5), m AS (SELECT *, avg(dz) OVER (PARTITION BY bin) AS bias FROM b)"
_MAD = f"{_DZ}, q AS (SELECT *, 1.4826 * median(abs(dz - bias)) OVER (PARTITION BY bin) AS mad FROM m)"
_PHOTOZ = "z_b", "z_b", "z_cgal", Z_EDGES


def _photoz(*columns: str) -> Query:
    return lambda spark, sf_dir: rounded(stats.photoz_statistics(catalogue(spark, sf_dir), *_PHOTOZ, exact=True).where("n > 0").select("bin", *columns))


@register("photoz_bias", f", {_DZ} SELECT bin, round(avg(z_b), 6) AS center, round(avg(dz), 6) AS bias FROM m GROUP BY 1")
def photoz_bias(spark, sf_dir):
    return rounded(stats.photoz_bias(catalogue(spark, sf_dir), *_PHOTOZ))


register("photoz_mad", f", {_MAD} SELECT bin, round(any_value(mad), 6) AS mad FROM q GROUP BY 1")(_photoz("mad"))
register("photoz_nmad_fraction", f", {_MAD} SELECT bin, round(avg((abs(dz) > 3 * mad)::int), 6) AS nmad_fraction FROM q GROUP BY 1")(_photoz("nmad_fraction"))
register("photoz_outlier_fraction", f", {_DZ} SELECT bin, round(bin / 10.0 + 0.05, 6)::double AS middle, round(avg((abs(dz) > 0.15)::int), 6) AS outlier_fraction FROM m GROUP BY 1")(_photoz("middle", "outlier_fraction"))
register(
    "photoz_summary", f", {_MAD.replace('floor(z_b * 10 + 1e-9)::int', '0').replace('z_b >= 0 AND z_b < 1.5', 'z_b >= 0.1 AND z_b < 0.9')} SELECT bin, count(*) AS n, round(any_value(bias), 6) AS bias, round(any_value(mad), 6) AS mad FROM q GROUP BY 1"
)(lambda spark, sf_dir: rounded(stats.photoz_statistics(catalogue(spark, sf_dir), "z_b", "z_b", "z_cgal", [0.1, 0.9], exact=True).select("bin", "n", "bias", "mad")))


@register(
    "photoz_statistics",
    ", e AS (SELECT quantile_cont(sdss_r_true, [(0.5 + 4 * k) / 100 for k in range(25)]) AS e FROM cat),"
    " b AS (SELECT len(list_filter(e, lambda x: x <= sdss_r_true)) - 1 AS bin, sdss_r_true AS m, (z_b - z_cgal) / (1 + z_cgal) AS dz FROM cat, e WHERE sdss_r_true >= e[1] AND sdss_r_true < e[25])"
    " SELECT bin::int AS bin, count(*) AS n, round(avg(m), 6) AS center, round(avg(dz), 6) AS bias FROM b GROUP BY 1",
)
def photoz_statistics(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    edges = stats.percentile_edges(cat, "sdss_r_true", exact=True)
    return rounded(stats.photoz_statistics(cat, "sdss_r_true", "z_b", "z_cgal", edges).select("bin", "n", "center", "bias"))


_STEP = "u AS (SELECT DISTINCT z_b AS v FROM cat), d AS (SELECT DISTINCT v - lag(v) OVER (ORDER BY v) AS d FROM u), t AS (SELECT avg(d) / 2 AS step FROM d)"


@register("distinct_grid_spacing", f", {_STEP} SELECT round(step, 6) AS step FROM t")
def distinct_grid_spacing(spark, sf_dir):
    return rounded(stats.grid_step(catalogue(spark, sf_dir), "z_b"))


@register("jitter_discrete", f", {_STEP} SELECT {ID}, round(z_b + (2 * {uniform_sql('s', 'jitter', ID)} - 1) * step, 6) AS z_smooth FROM cat, t")
def jitter_discrete(spark, sf_dir):
    return rounded(stats.jitter_discrete(catalogue(spark, sf_dir), "z_b", "s", ID, "z_smooth").select(ID, "z_smooth"))


# --- photometric redshifts --------------------------------------------------

BANDS = {"g": ("sdss_g_true", 1), "r": ("sdss_r_true", 2), "i": ("sdss_i_true", 3), "z": ("sdss_z_true", 4)}


def model_grid(spark: SparkSession) -> DataFrame:
    """A stand-in model grid: 3 templates, 20 redshifts, 4 bands."""
    grid = spark.range(3 * 20 * 4).select((F.col("id") % 3).cast("int").alias("template"), ((F.floor(F.col("id") / 3) % 20 + 1) * 0.1).alias("z"), F.floor(F.col("id") / 60).alias("b"))
    flux = (1 + 0.3 * F.col("template") * (F.col("b") + 1)) * F.exp(0.4 * F.col("z") * (F.col("b") + 1))
    return grid.select("template", "z", F.element_at(F.array(*map(F.lit, BANDS)), (F.col("b") + 1).cast("int")).alias("band"), flux.alias("flux"))


def _fit(spark, sf_dir) -> DataFrame:
    cat = catalogue(spark, sf_dir).drop("z_b").withColumn("err", F.lit(0.1))
    return photoz.photoz_grid_fit(cat, {b: c for b, (c, _) in BANDS.items()}, {b: "err" for b in BANDS}, model_grid(spark), "i", z_max=2.05, keep="p")


_POSTERIOR = (
    ", g AS (SELECT a.k AS template, (b.k + 1) * 0.1::double AS zz FROM range(3) a(k), range(20) b(k)), "
    "f AS (SELECT *, " + ", ".join(f"pow(10.0::double, -0.4 * ({c} - 25)) AS f{n}" for c, n in BANDS.values()) + " FROM cat), "
    "t AS (SELECT *, " + ", ".join(f"(1 + 0.3 * template * {n}) * exp(0.4 * zz * {n}) AS t{n}, 1.0857 / (f{n} * 0.1::double) AS w{n}" for _, n in BANDS.values()) + " FROM f, g), "
    "x AS (SELECT *, " + ", ".join(f"{' + '.join(f'{a}{n} * {b}{n} * w{n} * w{n}' for _, n in BANDS.values())} AS {o}" for a, b, o in (("f", "f", "ff"), ("f", "t", "ft"), ("t", "t", "tt"))) + " FROM t), "
    f"y AS (SELECT {ID}, any_value(z_cgal) AS z_true, any_value(sdss_i_true) AS m0, zz, sum(exp(-0.5 * (ff - greatest(ft, 0) * greatest(ft, 0) / tt)) / sqrt(tt)) * exp(-pow(zz / greatest(0.2, 0.5 + 0.15 * (any_value(sdss_i_true) - 22)), 2)) AS p FROM x GROUP BY {ID}, zz)"
)


@register("photoz_grid_fit", f"{_POSTERIOR} SELECT {ID}, round(arg_max(zz, (p, -zz)), 6) AS Z_B, round(any_value(m0), 6) AS M_0 FROM y GROUP BY 1")
def photoz_grid_fit(spark, sf_dir):
    return rounded(_fit(spark, sf_dir).select(ID, "Z_B", "M_0"))


@register("photoz_q_value", f"{_POSTERIOR} SELECT {ID}, round(CASE WHEN sum(p) > 0 THEN sum(CASE WHEN zz <= z_true THEN p ELSE 0 END) / sum(p) END, 4) AS q FROM y GROUP BY 1")
def photoz_q_value(spark, sf_dir):
    return rounded(_fit(spark, sf_dir).select(ID, photoz.q_value(F.col("p"), F.col("p_z"), F.col("z_cgal")).alias("q")), 4)


@register(
    "photoz_odds",
    f"{_POSTERIOR}, b AS (SELECT *, arg_max(zz, (p, -zz)) OVER (PARTITION BY {ID}) AS zb FROM y) SELECT {ID}, round(CASE WHEN sum(p) > 0 THEN sum(CASE WHEN abs(zz - zb) <= 0.12::double * (1 + zb) THEN p ELSE 0 END) / sum(p) END, 4) AS odds FROM b GROUP BY 1",
)
def photoz_odds(spark, sf_dir):
    return rounded(_fit(spark, sf_dir).select(ID, photoz.odds(F.col("p"), F.col("p_z"), F.col("Z_B")).alias("odds")), 4)


# --- pipelines --------------------------------------------------------------


@register(
    "photometry_realisations",
    f", k AS (SELECT *, {ID}::varchar || ':' || n::varchar AS key FROM cat, range(3) t(n)) SELECT n::int AS realisation, count(*) AS n_detected, round(avg({_mag_sql(24.2)[0]}), 4) AS mean_mag FROM ({_photometry_sql('sdss_r', 24.2, key='key', source='k')}) WHERE sn >= 1 AND f > 0 GROUP BY 1",
)
def photometry_realisations(spark, sf_dir):
    cat = magnitudes.evolve_magnitudes(catalogue(spark, sf_dir))
    out = pipelines.photometry_realisations(cat, {"sdss_r_evo": 24.2}, 3, significance=1.5)
    return out.where("sdss_r_obs < 99").groupBy("realisation").agg(F.count("*").alias("n_detected"), F.round(F.avg("sdss_r_obs"), 4).alias("mean_mag"))


@register(
    "line_of_sight_realisations",
    f", {_TILES} SELECT pointing_id, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM (SELECT pointing_id, z_cgal_v, row_number() OVER (PARTITION BY pointing_id ORDER BY {uniform_sql('sapling:gama', 'stratum', ID)}, {ID}) AS no"
    " FROM cat, tiles WHERE sdss_r_true < 19.87 AND ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max) WHERE no <= 20 GROUP BY 1",
)
def line_of_sight_realisations(spark, sf_dir):
    drawn = pipelines.line_of_sight_realisations(observed(spark, sf_dir), "gama", BOX, 5, 4, 20)[1].where("step = 'downsampling' AND N_tot > 0")
    return rounded(drawn.select("pointing_id", "N_tot", "z_mean"))


_SIZES = {"d": "1.6721 * r / disk_length", "b": "7.6697 * pow(r / bulge_length, 0.25)"}
_INSIDE = (
    f"(CASE WHEN bulge_fraction < 1 AND disk_length > 0 THEN (1 - bulge_fraction) * (1 - exp(-{_SIZES['d']}) * (1 + {_SIZES['d']})) ELSE 0 END"
    f" + CASE WHEN bulge_fraction > 0 AND bulge_length > 0 THEN bulge_fraction * (1 - exp(-{_SIZES['b']}) * ({' + '.join(f'pow({_SIZES["b"]}, {k}) / {math.factorial(k)}' for k in range(8))})) ELSE 0 END)"
)
_R_LIMIT, _R_PSF = pipelines.KIDS_PRESET.limits["sdss_r"], pipelines.KIDS_PRESET.psf["sdss_r"]


@register(
    "photometric_catalogue",
    f", q AS (SELECT {ID}, disk_length, bulge_length, bulge_fraction, bulge_axis_ratio, {EVO.format(m='sdss_r_true')} - 2.5 * log10(1 + 2 * kappa) AS m FROM cat WHERE ra_gal BETWEEN 35 AND 55 AND dec_gal BETWEEN 6 AND 24),"
    f" h AS (SELECT {ID}, lo, hi FROM (WITH RECURSIVE h AS (SELECT *, -5.0::double AS lo, 2.0::double AS hi, 0 AS k FROM q UNION ALL SELECT {ID}, disk_length, bulge_length, bulge_fraction, bulge_axis_ratio, m,"
    f" CASE WHEN under THEN mid ELSE lo END, CASE WHEN under THEN hi ELSE mid END, k + 1 FROM (SELECT *, {_INSIDE} < 0.5 AS under FROM (SELECT *, (lo + hi) / 2 AS mid, pow(10.0::double, (lo + hi) / 2) AS r FROM h WHERE k < 50))) SELECT * FROM h WHERE k = 50)),"
    f" a AS (SELECT {ID}, m, 2.5 * pow(10.0::double, (lo + hi) / 2) AS a, 2.5 * pow(10.0::double, (lo + hi) / 2) * bulge_axis_ratio AS b FROM q JOIN h USING ({ID})),"
    f" e AS (SELECT *, sqrt({_R_PSF**2!r} / (sqrt(a * a + {_R_PSF**2!r}) * sqrt(b * b + {_R_PSF**2!r}))) AS factor FROM a),"
    f" f AS (SELECT *, {10.0 ** (-0.4 * _R_LIMIT) / 1.5!r}::double / factor AS err FROM e), g AS (SELECT *, pow(10.0::double, -0.4 * m) + err * {normal_sql('sapling', 'sdss_r_evo_mag', ID)} AS f FROM f), n AS (SELECT *, greatest(f / err, 0.2) AS sn FROM g)"
    f" SELECT {ID}, round(({_mag_sql(_R_LIMIT)[0]})::float::double, 3) AS sdss_r_obs_mag, round(({_mag_sql(_R_LIMIT)[1]})::float::double, 3) AS sdss_r_obserr_mag, round(factor, 3) AS sn_factor_sdss_r FROM n WHERE {_mag_sql(_R_LIMIT)[0]} < 99",
)
def photometric_catalogue(spark, sf_dir):
    out = pipelines.photometric_catalogue(
        catalogue(spark, sf_dir), ["sdss_g", "sdss_r"], pipelines.KIDS_PRESET, sky.Box(35.0, 55.0, 6.0, 24.0), rules=[("sdss_r_obs_mag", "ll", 99.0)], columns=[ID, "sdss_r_obs_mag", "sdss_r_obserr_mag", "sn_factor_sdss_r"]
    )
    return rounded(out, 3)


@register(
    "quality_report",
    "SELECT filter, CASE flag_central WHEN 1 THEN 'data' ELSE 'sim' END AS sample, least(floor((x - 16) / 0.5), 19)::int AS bin, count(*)::double AS value FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS filter, flag_central, {c} AS x FROM cat" for c in MAGS)
    + ") WHERE x BETWEEN 16 AND 26 GROUP BY 1, 2, 3",
)
def quality_report(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    return pipelines.quality_report(cat.where("flag_central = 1"), cat.where("flag_central = 0"), MAGS, MAG_EDGES)[0]


# --- single building blocks -------------------------------------------------

_DISK, _BULGE = "1.6721 * {r} / disk_length", "7.6697 * pow({r} / bulge_length, 0.25)"
_SERIES = " + ".join(f"pow(y, {k}) / {math.factorial(k)}" for k in range(8))


@register(
    "flux_fraction",
    f", x AS (SELECT *, {_DISK.format(r='0.8')} AS x, {_BULGE.format(r='0.8')} AS y FROM cat WHERE disk_length > 0 AND bulge_length > 0)"
    f" SELECT {ID}, round((1 - bulge_fraction) * (1 - exp(-x) * (1 + x)) + bulge_fraction * (1 - exp(-y) * ({_SERIES})), 6) AS inside,"
    " round((1 - bulge_fraction) * x * exp(-x) * 1.6721 / disk_length + bulge_fraction * pow(y, 7) * exp(-y) / 5040 * y / (4 * 0.8), 6) AS slope FROM x",
)
def flux_fraction(spark, sf_dir):
    cat = catalogue(spark, sf_dir).where("disk_length > 0 AND bulge_length > 0")
    args = F.lit(0.8), F.col("disk_length"), F.col("bulge_length"), F.col("bulge_fraction")
    return rounded(cat.select(ID, apertures.flux_fraction(*args).alias("inside"), apertures.flux_fraction_derivative(*args).alias("slope")))


@register("axis_ratio_from_area", f"SELECT {ID}, round(bulge_axis_ratio, 6) AS ratio FROM cat WHERE disk_length > 0")
def axis_ratio_from_area(spark, sf_dir):
    cat = catalogue(spark, sf_dir).where("disk_length > 0")
    area = math.pi * F.col("disk_length") * F.col("disk_length") * F.col("bulge_axis_ratio")
    return rounded(cat.select(ID, apertures.axis_ratio_from_area(area, F.col("disk_length")).alias("ratio")))


@register(
    "flux_conversions",
    f"SELECT {ID}, round(pow(10.0::double, -0.4 * (sdss_r_true - 25)), 6) AS flux, round(10.0 ** (-0.4 * (24.0 - 25)) / 1.5 / bulge_axis_ratio, 6) AS err, round(sdss_r_true, 6) AS mag FROM cat",
)
def flux_conversions(spark, sf_dir):
    flux = magnitudes.flux_from_mag(F.col("sdss_r_true"), 25.0)
    err = magnitudes.flux_error(24.0, 25.0, 1.5, F.col("bulge_axis_ratio"))
    return rounded(catalogue(spark, sf_dir).select(ID, flux.alias("flux"), err.alias("err"), magnitudes.mag_from_flux(flux, 25.0).alias("mag")))


@register(
    "noise_realisation",
    f"SELECT {ID}, round(sn, 4) AS sn, round(2.5 / ln(10) / sn, 4) AS err FROM (SELECT *, greatest(1 + 0.5 * {normal_sql('s', 'n', ID)}, 0.1) / 0.5 AS sn FROM cat)",
)
def noise_realisation(spark, sf_dir):
    draw = photometry.noise_realisation(F.lit(1.0), F.lit(0.5), "s", "n", F.col(ID))
    sn = magnitudes.signal_to_noise(draw, F.lit(0.5))
    return rounded(catalogue(spark, sf_dir).select(ID, sn.alias("sn"), magnitudes.mag_error(sn).alias("err")), 4)


@register("colour_cut_terms", f", {_COLOURS} SELECT {ID}, round(cp, 6) AS along, round(cr, 6) AS across, round(dr, 6) AS upper FROM o")
def colour_cut_terms(spark, sf_dir):
    terms = magnitudes.colour_terms(*map(F.col, MAGS[:3]))
    return rounded(catalogue(spark, sf_dir).select(ID, *[t.alias(n) for t, n in zip(terms, ("along", "across", "upper"), strict=True)]))


@register("detected", f"SELECT {ID}, vhs_ks_true < 90 AS seen, abs(vhs_ks_true) < 99 AS below_99 FROM cat")
def detected(spark, sf_dir):
    k = F.col("vhs_ks_true")
    return catalogue(spark, sf_dir).select(ID, selections.detected(k).alias("seen"), magnitudes.not_sentinel(k, 99.0).alias("below_99"))


_LOW1 = "(r > 16.5 AND r < 19.2 AND r < 13.1 + cp / 0.32 AND abs(cr) < 0.2)"
_LOW2 = "(r > 16.5 AND r < 19.5 AND g - r > 1.3 + 0.25 * (r - i) AND cr > 0.45 - (g - r) / 6)"
_PARTS = {
    "low1": _LOW1,
    "low2": f"NOT {_LOW1} AND {_LOW2}",
    "low3": f"NOT {_LOW1} AND NOT {_LOW2} AND r > 16.5 AND r < 19.6 AND r < 13.5 + cp / 0.32 AND abs(cr) < 0.2",
    "mid": "i > 17.5 AND i < 19.9 AND r - i < 2 AND dr > 0.55 AND i < 19.86 + 1.6 * (dr - 0.9)",
    "high": "z < 19.9 AND i > 19.9 AND i < 21.8 AND r - k > 1.9 * (r - i) AND r - i > 0.98 AND i - z > 0.6",
}


@register("two_df_lens_parts", f", {_COLOURS} " + " UNION ALL ".join(f"SELECT {n} AS step_no, '{name}' AS step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM o WHERE {cut}" for n, (name, cut) in enumerate(_PARTS.items())))
def two_df_lens_parts(spark, sf_dir):
    cat = observed(spark, sf_dir)
    parts = selections.two_df_lens_parts(selections.magnitude_lookup(cat, "kids", ("obs",)))
    return rounded(selections.step_statistics(cat, parts))


@register(
    "footprint_area",
    f"SELECT {ID}, round(10 * degrees(sin(radians(dec_gal + 1)) - sin(radians(dec_gal))), 6) AS area, round(degrees(asin(least(1, greatest(-1, 5 / degrees(1) / 10 + sin(radians(dec_gal)))))), 6) AS upper FROM cat",
)
def footprint_area(spark, sf_dir):
    dec = F.col("dec_gal")
    return rounded(catalogue(spark, sf_dir).select(ID, sky.footprint_area(F.lit(355.0), F.lit(5.0), dec, dec + 1).alias("area"), sky.next_dec(F.lit(5.0), F.lit(10.0), dec).alias("upper")))


@register("pointing_nth", f", {_TILES} SELECT {ID} FROM cat, tiles WHERE pointing_id = 8 AND ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max")
def pointing_nth(spark, sf_dir):
    tile = tables.pointing_nth(sky.pointing_grid(spark, BOX, 5, 4), 8)
    return sky.assign_pointing(catalogue(spark, sf_dir), tile).select(ID)


@register("accept_rate_by_class", f"SELECT {ID} FROM cat WHERE {uniform_sql('s', 'c', ID)} < CASE WHEN lephare_ic_true <= 22.5 THEN {_ZB.sql('z_cgal')} ELSE {_ZD.sql('z_cgal')} END")
def accept_rate_by_class(spark, sf_dir):
    kept = sampling.accepted_by_class(F.col("z_cgal"), F.col("lephare_ic_true") <= 22.5, _ZB, _ZD, "s", "c", F.col(ID))
    return catalogue(spark, sf_dir).where(kept).select(ID)


@register("dense_row_index", "SELECT o_orderkey, o_custkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders")
def dense_row_index(spark, sf_dir):
    found = sampling.dense_row_index(table(spark, sf_dir, "orders"), "o_orderkey")
    return found.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("row_index").cast("bigint").alias("row_index"))


@register("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@register("median_default", "SELECT filter, round(median(x), 6) AS median FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS filter, {c} AS x FROM cat" for c in MAGS) + ") WHERE abs(x) < 90 GROUP BY 1")
def median_default(spark, sf_dir):
    return rounded(stats.median_default(catalogue(spark, sf_dir), MAGS, exact=True))


@register("data_vs_sim", "SELECT CASE flag_central WHEN 1 THEN 'data' ELSE 'sim' END AS sample, count(*) AS n, round(avg(sdss_r_true), 6) AS mean_r FROM cat GROUP BY 1")
def data_vs_sim(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    both = stats.data_vs_sim(cat.where("flag_central = 1"), cat.where("flag_central = 0"), ["sdss_r_true"])
    return rounded(both.groupBy("sample").agg(F.count("*").alias("n"), F.avg("sdss_r_true").alias("mean_r")))


@register(
    "outlier_envelope",
    f", {_MAD.replace('floor(z_b * 10 + 1e-9)::int', 'CASE WHEN z_b < 0.9 THEN 0 ELSE 1 END').replace('z_b >= 0 AND z_b < 1.5', 'z_b >= 0.1 AND z_b < 1.5')}, w AS (SELECT max(mad) FILTER (WHERE bin = 0) AS a, max(mad) FILTER (WHERE bin = 1) AS b FROM q),"
    " l AS (SELECT * FROM (VALUES ('upper', 1), ('lower', -1)) l(line, s), w) SELECT line, 0.0::double AS z_true, round(-s * a, 6) AS z_phot FROM l"
    " UNION ALL SELECT line, round((0.9 + s * a) / (1 - s * a), 6), 0.9 FROM l UNION ALL SELECT line, round((0.9 + s * b) / (1 - s * b), 6), 0.9 FROM l UNION ALL SELECT line, round((1.5 + s * b) / (1 - s * b), 6), 1.5 FROM l",
)
def outlier_envelope(spark, sf_dir):
    found = stats.photoz_statistics(catalogue(spark, sf_dir), "z_b", "z_b", "z_cgal", [0.1, 0.9, 1.5], exact=True).orderBy("bin").collect()  # two rows
    return rounded(spark.createDataFrame(stats.outlier_envelope(found[0]["mad"], found[1]["mad"], 1.5), "line string, z_true double, z_phot double"))


@register("top_n_per_stratum", "SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY " + uniform_sql("s", "stratum", "event_id") + ", event_id) AS no FROM events) WHERE no <= 10")
def top_n_per_stratum(spark, sf_dir):
    return sampling.sample_n_per_stratum(table(spark, sf_dir, "events"), 10, "event_type", "s", "event_id").select("event_id", "event_type")


@register("spectroscopic_sample", f", {_COLOURS} SELECT {ID}, round(z_cgal_v, 6) AS z_cgal_v FROM o WHERE {_CUTS['gama']} AND r < 90")
def spectroscopic_sample(spark, sf_dir):
    cat = observed(spark, sf_dir)
    chunks = [cat.where(F.col(ID) % 3 == i) for i in range(3)]
    return rounded(pipelines.spectroscopic_sample(chunks, "gama", pass_survey_selection=True)[0].select(ID, "z_cgal_v"))


@register("add_property", f", {_NEAR} SELECT s.{ID} FROM s WHERE {ID} IN (SELECT sid FROM d WHERE d2 < 0.09)")
def add_property(spark, sf_dir):
    cat, attrs = catalogue(spark, sf_dir), MAGS[:3]
    ref = cat.where(F.col(ID) % 10 == 0).select(F.col(ID).alias("ref_id"), *[F.col(a).alias(f"ref_{a}") for a in attrs], F.lit(1).alias("gold"))
    sim = cat.where(F.col(ID) % 10 != 0).select(ID, *attrs)
    out = pipelines.add_property(sim, ref, [("flag_gold", "eq", 1)], sim_attrs=attrs, ref_attrs=[f"ref_{a}" for a in attrs], props={"gold": "flag_gold"}, ref_id="ref_id", r_max=0.3, fallback={"gold": 0})
    return out.select(ID)


@register("select_by_prior_mag", f"SELECT {ID}, round(sdss_i_true, 6) AS M_0 FROM cat WHERE abs(sdss_i_true) < 90")
def select_by_prior_mag(spark, sf_dir):
    return rounded(photoz.select_by_prior_mag(catalogue(spark, sf_dir).withColumn("M_0", F.col("sdss_i_true"))).select(ID, "M_0"))


# --- files, streams, other layouts -------------------------------------------


def scratch(spark: SparkSession) -> str:
    """A new folder for a query's files, in the folder that all executors share."""
    return storage.new_path(spark, "queries")


_GAMA_STEPS = f"SELECT 'gama' AS survey, 'main' AS output, 0 AS step_no, 'input' AS step, z_cgal_v FROM o UNION ALL SELECT 'gama', 'main', 1, 'cut', z_cgal_v FROM o WHERE {_CUTS['gama']}"


@register(
    "write_statistics",
    f", {_COLOURS} SELECT survey, output, step_no, step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM ({_GAMA_STEPS} UNION ALL {_GAMA_STEPS.replace('gama', 'sdss_main').replace(_CUTS['gama'], _CUTS['sdss_main'])}) GROUP BY 1, 2, 3, 4",
)
def write_statistics(spark, sf_dir):
    path = f"{scratch(spark)}/stats"
    for name, mode in (("gama", "w"), ("sdss_main", "a"), ("boss", "n")):
        tables.write_statistics(selections.select(name, observed(spark, sf_dir))[1], path, mode, name, "main")
    return rounded(tables.load_catalogue(spark, path, required=["survey", "step"]))


@register("write_catalogue", f"SELECT {ID}, sdss_r_true FROM cat WHERE flag_central = 1")
def write_catalogue(spark, sf_dir):
    path = scratch(spark)
    tables.write_catalogue(catalogue(spark, sf_dir).select(ID, "sdss_r_true", "flag_central"), path)
    return tables.load_catalogue(spark, path, required=[ID]).where("flag_central = 1").select(ID, "sdss_r_true")


@register("split_by_tile", f", {_TILES} SELECT pointing_id, count(*) AS n, round(avg(sdss_r_true), 6) AS mean_r FROM cat, tiles WHERE ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max GROUP BY 1")
def split_by_tile(spark, sf_dir):
    path = scratch(spark)
    tables.write_catalogue(sky.assign_pointing(catalogue(spark, sf_dir).select(ID, "ra_gal", "dec_gal", "sdss_r_true"), sky.pointing_grid(spark, BOX, 5, 4)), path, partition_by=["pointing_id"])
    back = tables.load_catalogue(spark, path).groupBy(F.col("pointing_id").cast("bigint").alias("pointing_id"))
    return rounded(back.agg(F.count("*").alias("n"), F.avg("sdss_r_true").alias("mean_r")))


@register("pointings_file", f", {_TILES} SELECT pointing_id, count({ID}) AS n FROM tiles LEFT JOIN cat ON ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max WHERE pointing_id > 10 GROUP BY 1")
def pointings_file(spark, sf_dir):
    path = scratch(spark)
    tables.write_pointings(sky.pointing_grid(spark, BOX, 5, 4), path, decimals=12)
    tiles = tables.read_pointings(spark, path).where("pointing_id > 10")
    found = sky.assign_pointing(catalogue(spark, sf_dir), tiles).groupBy("pointing_id").agg(F.count("*").alias("n"))
    return tiles.select("pointing_id").join(found, "pointing_id", "left").select("pointing_id", F.coalesce("n", F.lit(0)).alias("n"))


@register("footprint_lookup", f", b AS (SELECT min(ra_gal) AS a, max(ra_gal) AS b, min(dec_gal) AS c, max(dec_gal) AS d FROM cat WHERE {ID} % 1000 < 3) SELECT {ID} FROM cat, b WHERE ra_gal BETWEEN a AND b AND dec_gal BETWEEN c AND d")
def footprint_lookup(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    bounds = [f(c).alias(n) for f, c, n in ((F.min, "ra_gal", "ra_min"), (F.max, "ra_gal", "ra_max"), (F.min, "dec_gal", "dec_min"), (F.max, "dec_gal", "dec_max"))]
    registry = cat.where(F.col(ID) % 1000 < 3).groupBy(F.lit("deep").alias("survey")).agg(*bounds)
    return sky.sky_box(cat, tables.footprint_lookup(registry, "deep")).select(ID)


@register("rate_curve_file", "SELECT l_linenumber::double AS x, round(avg(l_discount)::double, 6) AS rate FROM lineitem GROUP BY 1")
def rate_curve_file(spark, sf_dir):
    path = scratch(spark)
    rates = table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(F.avg("l_discount").alias("rate"))
    lines = rates.select(F.format_string("%d \t %.12e  # bin", F.col("l_linenumber").cast("int"), F.col("rate").cast("double")).alias("value"))
    lines.unionByName(spark.range(1).select(F.lit("# x rate").alias("value"))).write.text(path)
    return rounded(tables.load_rate_curve(spark, path))


@register("column_metadata", "SELECT 'sdss_r_true' AS name, 'mag' AS unit, 'model magnitude' AS description, count(*) AS n FROM cat UNION ALL SELECT 'z_cgal', '', 'redshift', count(*) FROM cat")
def column_metadata(spark, sf_dir):
    noted = tables.with_column_metadata(catalogue(spark, sf_dir).select("sdss_r_true", "z_cgal"), {"sdss_r_true": ("mag", "model magnitude"), "z_cgal": ("", "redshift")})
    rows = [(f.name, f.metadata["unit"], f.metadata["description"]) for f in noted.schema]
    counts = noted.agg(F.count("*").alias("n"))
    return spark.createDataFrame(rows, "name string, unit string, description string").crossJoin(F.broadcast(counts))  # one row


@register("target_count", f"SELECT {ID} FROM cat ORDER BY {uniform_sql('s', 'sample', ID)}, {ID} LIMIT {sampling.target_count(8698, 0.815761, 5156.625, 256 * 512)}")
def target_count(spark, sf_dir):
    return sampling.sample_n(catalogue(spark, sf_dir), sampling.target_count(8698, 0.815761, 5156.625, 256 * 512), "s").select(ID)


_DEEP_EVO = {b: EVO.format(m=f"lephare_{c}_true") for b, c in (("mb", "b"), ("mr", "rc"), ("mi", "ic"))}


@register("sel_deep2_evolved", f", o AS (SELECT *, {', '.join(f'{e} AS {b}' for b, e in _DEEP_EVO.items())} FROM cat) SELECT {ID} FROM o WHERE {_CUTS['deep2']}")
def sel_deep2_evolved(spark, sf_dir):
    """Evolved magnitudes come before observed ones."""
    cat = magnitudes.evolve_magnitudes(catalogue(spark, sf_dir)).withColumns({f"lephare_{b}_obs": F.lit(0.0) for b in ("b", "rc", "ic")})
    s = selections.SELECTIONS["deep2"]
    return cat.where(s.cut(selections.magnitude_lookup(cat, "kids", s.suffixes))).select(ID)


@register(
    "deep2_detected_stats",
    f", {_COLOURS}, d AS (SELECT *, {_CUTS['deep2']} AS a, {uniform_sql('sapling:deep2', 'success', ID)} < {sampling.deep2_curve().sql('mr')} AS b, r < 20 AS c FROM o)"
    f" SELECT step_no, step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM (SELECT 0 AS step_no, 'input' AS step, z_cgal_v FROM d UNION ALL SELECT 1, 'cut', z_cgal_v FROM d WHERE a UNION ALL SELECT 2, 'success', z_cgal_v FROM d WHERE a AND b"
    f" UNION ALL SELECT 3, 'detection', z_cgal_v FROM d WHERE a AND b AND c UNION ALL SELECT 4, 'downsampling', z_cgal_v FROM (SELECT * FROM d WHERE a AND b AND c ORDER BY {uniform_sql('sapling:deep2', 'sample', ID)}, {ID} LIMIT 100)) GROUP BY 1, 2",
)
def deep2_detected_stats(spark, sf_dir):
    """A deep survey with the detection of the shallow one: what is fainter than 20 is lost there."""
    cat = observed(spark, sf_dir).withColumn("sdss_r_obs", F.when(F.col("sdss_r_obs") < 20, F.col("sdss_r_obs")).otherwise(99.0))
    return rounded(selections.select("deep2", cat, n_tot=100, pass_survey_selection=True)[1])


def _renamed(spark: SparkSession, sf_dir: str, stem: str) -> DataFrame:
    """The observed catalogue with another layout's column names."""
    cat = observed(spark, sf_dir)
    return cat.withColumnsRenamed({f"sdss_{b}_obs": f"{stem}_{b}_obs" for b in "griz"})


@register("sel_boss_des", f", {_COLOURS} SELECT step_no, step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM (SELECT 0 AS step_no, 'input' AS step, z_cgal_v FROM o UNION ALL SELECT 1, 'cut', z_cgal_v FROM o WHERE {_CUTS['boss']} UNION ALL SELECT 2, 'detection', z_cgal_v FROM o WHERE {_CUTS['boss']} AND i < 90) GROUP BY 1, 2")
def sel_boss_des(spark, sf_dir):
    return rounded(selections.select("boss", _renamed(spark, sf_dir, "des_asahi_full"), layout="des", pass_survey_selection=True)[1])


@register("sel_gama_euclid", f", {_COLOURS} SELECT {ID} FROM o WHERE {_CUTS['gama']}")
def sel_gama_euclid(spark, sf_dir):
    return selections.select("gama", _renamed(spark, sf_dir, "lsst"), layout="euclid")[0].select(ID)


@register("register_selection", f", {_COLOURS} SELECT {ID} FROM o WHERE r < 21 AND g - r > 1")
def register_selection(spark, sf_dir):
    selections.register_selection("red", selections.Selection(lambda mag: selections.true((mag("r") < 21.0) & (mag("g") - mag("r") > 1.0))))
    return selections.select("red", observed(spark, sf_dir))[0].select(ID)


_NINE = ["sdss_u_true", "sdss_g_true", "sdss_r_true", "sdss_i_true", "sdss_z_true", "lephare_b_true", "lephare_rc_true", "lephare_ic_true", "z_cgal"]


@register(
    "nearest_property_nine",
    f", s AS (SELECT * FROM cat WHERE {ID} % 10 <> 0), f AS (SELECT * FROM cat WHERE {ID} % 10 = 0),"
    f" d AS (SELECT s.{ID} AS sid, f.{ID} AS fid, f.lmhalo AS w, {' + '.join(f'pow(s.{c} - f.{c}, 2)' for c in _NINE)} AS d2 FROM s, f WHERE abs(s.sdss_r_true - f.sdss_r_true) < 0.6)"
    f" SELECT s.{ID}, round(coalesce(b.w, -1), 6) AS weight FROM s LEFT JOIN (SELECT sid, arg_min(w, (d2, fid)) AS w FROM d WHERE d2 < 0.36::double GROUP BY 1) b ON b.sid = s.{ID}",
)
def nearest_property_nine(spark, sf_dir):
    """All nine attributes of a photometric survey."""
    cat = catalogue(spark, sf_dir)
    ref = cat.where(F.col(ID) % 10 == 0).select(F.col(ID).alias("ref_id"), *_NINE, F.col("lmhalo").alias("w"))
    out = match.nearest_property(cat.where(F.col(ID) % 10 != 0).select(ID, *_NINE), ref, _NINE, _NINE, {"w": "weight"}, "ref_id", 0.6, {"w": -1.0})
    return rounded(out.select(ID, "weight"))


@register("stream_statistics", f", {_COLOURS} SELECT step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM (SELECT 'input' AS step, z_cgal_v FROM o UNION ALL SELECT 'cut', z_cgal_v FROM o WHERE {_CUTS['gama']}) GROUP BY 1")
def stream_statistics(spark, sf_dir):
    """Running statistics of a stream of catalogue files, after the last of them."""
    path = scratch(spark)
    rows = observed(spark, sf_dir).select(ID, "sdss_r_obs", "z_cgal_v")
    rows.repartition(6).write.parquet(f"{path}/in")
    stream = catalogue_streams.read_stream(spark, f"{path}/in", rows.schema, 2)
    steps = {"input": F.lit(True), "cut": F.col("sdss_r_obs") < 19.87}
    name = f"running_{uuid.uuid4().hex}"
    catalogue_streams.running_statistics(stream, steps).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return rounded(spark.table(name))


@register("stream_windows", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    """Hourly counts by type of a stream of events, in complete mode."""
    path = scratch(spark)
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.repartition(3).write.parquet(f"{path}/in")
    stream = catalogue_streams.read_stream(spark, f"{path}/in", events.schema, 1)
    name = f"windows_{uuid.uuid4().hex}"
    catalogue_streams.windowed_counts(stream, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n")
