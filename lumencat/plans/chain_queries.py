"""Registered queries of whole chains: catalogues with photo-z, realisations, tiles, reports; each with SQL of the whole chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import magnitudes, sky
from ..operators import report, sampling, selections
from ..sources import tables
from ..sources.storage import checkpointed
from . import pipelines, queries
from .fixtures import catalogue as derived_catalogue
from .fixtures import normal_sql, uniform_sql
from .queries import BOX, EVO, ID, model_grid, observed, register, rounded, scratch, surface

STEMS = {"g": "sdss_g", "r": "sdss_r", "i": "sdss_i", "z": "sdss_z"}
PRESET = pipelines.KIDS_PRESET
TILE = 8


#: What chains read of the catalogue: a column that is not read costs a digest for each row.
READ = [ID, "ra_gal", "dec_gal", "z_cgal", "kappa", *[f"{s}_true" for s in STEMS.values()], "disk_length", "bulge_length", "bulge_fraction", "bulge_axis_ratio"]


def stored(cat: DataFrame, *columns: str) -> DataFrame:
    """The named columns of the stand-in catalogue as a stored table, as a real one would be: chains use them many times."""
    return checkpointed(cat.select(*columns))


# --- the chain in SQL ---------------------------------------------------------


def _intrinsic_sql(where: str) -> str:
    """CTE base: the catalogue's rows with lensed magnitudes m_<band> and the intrinsic aperture a, b, by bisection."""
    mags = ", ".join(f"{EVO.format(m=s + '_true')} - 2.5 * log10(1 + 2 * kappa) AS m_{b}" for b, s in STEMS.items())
    return f""", q AS (SELECT *, {mags} FROM cat WHERE {where}),
h AS (SELECT {ID}, lo, hi FROM (WITH RECURSIVE h AS (SELECT {ID}, disk_length, bulge_length, bulge_fraction, -5.0::double AS lo, 2.0::double AS hi, 0 AS k FROM q UNION ALL SELECT {ID}, disk_length, bulge_length, bulge_fraction,
  CASE WHEN under THEN mid ELSE lo END, CASE WHEN under THEN hi ELSE mid END, k + 1 FROM (SELECT *, {queries._INSIDE} < 0.5 AS under FROM (SELECT *, (lo + hi) / 2 AS mid, pow(10.0::double, (lo + hi) / 2) AS r FROM h WHERE k < 50))) SELECT * FROM h WHERE k = 50)),
base AS (SELECT q.*, {PRESET.scale} * pow(10.0::double, (lo + hi) / 2) AS a, {PRESET.scale} * pow(10.0::double, (lo + hi) / 2) * bulge_axis_ratio AS b FROM q JOIN h USING ({ID}))"""


def _observed_sql(source: str, key: str) -> str:
    """CTE obs: source with o_<band> and e_<band>, the float32 magnitudes and errors, as doubles."""
    steps = []
    for band, stem in STEMS.items():
        psf, limit = PRESET.psf[stem] ** 2, PRESET.limits[stem]
        err = f"({10.0 ** (-0.4 * limit) / PRESET.significance!r}::double / sqrt({psf!r} / (sqrt(a * a + {psf!r}) * sqrt(b * b + {psf!r}))))"
        steps.append(f"{err} AS er_{band}, pow(10.0::double, -0.4 * m_{band}) + {err} * {normal_sql('sapling', stem + '_evo_mag', key)} AS f_{band}")
    sn = ", ".join(f"greatest(f_{b} / er_{b}, 0.2) AS sn_{b}" for b in STEMS)
    out = []
    for band, stem in STEMS.items():
        mag, err = (x.replace("sn", f"sn_{band}").replace("f >", f"f_{band} >").replace("log10(f)", f"log10(f_{band})") for x in queries._mag_sql(PRESET.limits[stem], PRESET.significance))
        out.append(f"({mag})::float::double AS o_{band}, ({err})::float::double AS e_{band}")
    return f"obs AS (SELECT *, {', '.join(out)} FROM (SELECT *, {sn} FROM (SELECT *, {', '.join(steps)} FROM {source})))"


def _fit_sql(source: str, keys: str) -> str:
    """CTE fit: keys, Z_B and M_0 of the rows of source, from its o_<band> and e_<band>."""
    flux = ", ".join(f"CASE WHEN abs(o_{b}) < 90 THEN pow(10.0::double, -0.4 * (o_{b} - 25)) ELSE 0 END AS f{n}" for n, b in enumerate(STEMS, 1))
    weight = ", ".join(
        f"1 / CASE WHEN abs(o_{b}) < 90 THEN greatest(f{n} * e_{b} / 1.0857::double, 1e-3 * f{n}) ELSE pow(10.0::double, -0.4 * (e_{b} - 25)) END AS w{n}, (1 + 0.3::double * template * {n}) * exp(0.4::double * zz * {n}) AS t{n}"
        for n, b in enumerate(STEMS, 1)
    )
    sums = ", ".join(f"{' + '.join(f'{a}{n} * {b}{n} * w{n} * w{n}' for n in range(1, 5))} AS {o}" for a, b, o in (("f", "f", "ff"), ("f", "t", "ft"), ("t", "t", "tt")))
    return f"""g AS (SELECT a.k AS template, (b.k + 1) * 0.1::double AS zz FROM range(3) a(k), range(20) b(k)),
fl AS (SELECT {keys}, o_i, {', '.join(f'e_{b}, o_{b} AS oo_{b}' for b in STEMS)}, {flux} FROM {source}),
fx AS (SELECT {keys}, o_i, zz, template, {sums} FROM (SELECT *, {weight.replace('abs(o_', 'abs(oo_')} FROM fl, g)),
fy AS (SELECT {keys}, any_value(o_i) AS m0, zz, sum(exp(-0.5 * (ff - greatest(ft, 0) * greatest(ft, 0) / tt)) / sqrt(tt))
  * exp(-pow(zz / greatest(0.2, 0.5 + 0.15 * (CASE WHEN abs(any_value(o_i)) < 90 THEN any_value(o_i) ELSE 25 END - 22)), 2)) AS p FROM fx GROUP BY {keys}, zz),
fit AS (SELECT {keys}, arg_max(zz, (p, -zz)) AS Z_B, any_value(m0) AS M_0 FROM fy GROUP BY {keys})"""


def photo_z(spark: SparkSession) -> pipelines.PhotozFit:
    return pipelines.PhotozFit(model_grid(spark), STEMS, "i", z_max=2.05)


# --- catalogue with property and photo-z --------------------------------------

_ATTRS = ("g", "r", "i")


@register(
    "photometric_catalogue_photoz",
    f"{_intrinsic_sql('ra_gal BETWEEN 35 AND 55 AND dec_gal BETWEEN 6 AND 24')}, {_observed_sql('base', ID)}, {_fit_sql('obs', ID)},"
    f" ref AS (SELECT {ID} AS rid, lmhalo AS w, {', '.join(f'sdss_{b}_true - 0.2::double AS r_{b}' for b in _ATTRS)} FROM cat WHERE {ID} % 10 = 0),"
    f" near AS (SELECT o.{ID}, arg_min(w, (d2, rid)) AS w FROM (SELECT o.{ID}, rid, w, {' + '.join(f'pow(o_{b} - r_{b}, 2)' for b in _ATTRS)} AS d2 FROM obs o, ref WHERE abs(o_r - r_r) < 0.5) o WHERE d2 < 0.25 GROUP BY 1)"
    f" SELECT o.{ID}, round(o_r, 3) AS sdss_r_obs_mag, round(near.w, 6) AS recal_weight, round(fit.Z_B, 6) AS Z_B, round(fit.M_0, 3) AS M_0 FROM obs o JOIN near USING ({ID}) JOIN fit USING ({ID}) WHERE fit.M_0 < 90",
)
def photometric_catalogue_photoz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: sizes, noise, a property of real data, photo-z, then the rules on property and prior magnitude."""
    cat, box = derived_catalogue(spark, sf_dir, held=True), sky.Box(35.0, 55.0, 6.0, 24.0)
    real = stored(cat.where(F.col(ID) % 10 == 0), ID, "lmhalo", *[f"sdss_{b}_true" for b in _ATTRS])
    ref = real.select(F.col(ID).alias("ref_id"), F.col("lmhalo").alias("w"), *[(F.col(f"sdss_{b}_true") - 0.2).alias(f"ref_{b}") for b in _ATTRS])
    drawn = {"sim_attrs": [f"sdss_{b}_obs_mag" for b in _ATTRS], "ref_attrs": [f"ref_{b}" for b in _ATTRS], "props": {"w": "recal_weight"}, "ref_id": "ref_id", "r_max": 0.5, "fallback": {"w": 0.0}}
    rules = [("recal_weight", "gg", 0.0), ("M_0", "ll", 90.0)]
    out = pipelines.photometric_catalogue(stored(sky.sky_box(cat, box), *READ), [*STEMS.values()], PRESET, box, reference=(ref, drawn), rules=rules, photo_z=photo_z(spark))
    number = lambda c, digits: F.round(F.col(c).cast("double"), digits).alias(c)
    return out.select(ID, number("sdss_r_obs_mag", 3), number("recal_weight", 6), number("Z_B", 6), number("M_0", 3))


# --- realisations of one tile --------------------------------------------------

_DEEP = {b: EVO.format(m=f"lephare_{c}_true") for b, c in (("mb", "b"), ("mr", "rc"), ("mi", "ic"))}
_DEEP_READ = [f"lephare_{c}_true" for c in ("b", "rc", "ic")]
_KEY = f"({ID}::varchar || ':' || realisation::varchar)"
_REALISED = (
    f", {queries._TILES}{_intrinsic_sql('EXISTS (SELECT 1 FROM tiles WHERE pointing_id = ' + str(TILE) + ' AND ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max)')},"
    f" k AS (SELECT *, {', '.join(f'{e} AS {b}' for b, e in _DEEP.items())}, {_KEY} AS key FROM base, range(3) t(realisation)), {_observed_sql('k', 'key')},"
    f" d AS (SELECT *, {queries._CUTS['deep2']} AS c1, {uniform_sql('sapling:deep2', 'success', 'key')} < {sampling.deep2_curve().sql('mr')} AS c2, o_r < 90 AS c3 FROM obs),"
    f" s AS (SELECT *, row_number() OVER (PARTITION BY realisation ORDER BY {uniform_sql('sapling:deep2', 'stratum', 'key')}, key) AS no FROM d WHERE c1 AND c2 AND c3)"
)
_STEPS = ("input", "true", "d"), ("cut", "c1", "d"), ("success", "c1 AND c2", "d"), ("detection", "c1 AND c2 AND c3", "d"), ("downsampling", "no <= 40", "s")


def _deep_field(spark: SparkSession, sf_dir: str, statistics: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    tiles = sky.pointing_grid(spark, BOX, 5, 4)
    return pipelines.deep_field_realisations(
        stored(derived_catalogue(spark, sf_dir), *READ, "z_cgal_v", *_DEEP_READ), [*STEMS.values()], PRESET, 3, "deep2", tiles, TILE, photo_z(spark), statistics=statistics, n_tot=40, pass_survey_selection=True
    )


@register(
    "deep_field_statistics",
    f"{_REALISED} SELECT 'deep2' AS survey, 'deep2_phot_' || realisation AS output, step_no, step, N_tot, z_mean FROM ("
    + " UNION ALL ".join(f"SELECT realisation, {n} AS step_no, '{step}' AS step, count_if({cut})::bigint AS N_tot, round(avg(z_cgal_v) FILTER (WHERE {cut}), 6) AS z_mean FROM {source} GROUP BY 1" for n, (step, cut, source) in enumerate(_STEPS))
    + ")",
)
def deep_field_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics file that the realisations of one tile leave behind."""
    path = f"{scratch(spark)}/stats"
    _deep_field(spark, sf_dir, (path, "a"))
    return rounded(tables.load_catalogue(spark, path))


@register(
    "deep_field_realisations",
    f"{_REALISED}, p AS (SELECT * FROM s WHERE no <= 40), {_fit_sql('p', f'{ID}, realisation')} SELECT {ID}, realisation::int AS realisation, round(o_r, 3) AS sdss_r_obs_mag, round(fit.Z_B, 6) AS Z_B FROM p JOIN fit USING ({ID}, realisation)",
)
def deep_field_realisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = _deep_field(spark, sf_dir)[0]
    return drawn.select(ID, "realisation", F.round(F.col("sdss_r_obs_mag").cast("double"), 3).alias("sdss_r_obs_mag"), F.round("Z_B", 6).alias("Z_B"))


# --- selections of every tile ---------------------------------------------------

_IN_TILES = "ra_gal >= ra_min AND ra_gal < ra_max AND dec_gal >= dec_min AND dec_gal < dec_max"


def _tile_steps(steps: list[tuple[str, str, str]], survey: str) -> str:
    """Statistics of every tile that holds rows of d: (step, condition, source)."""
    parts = [f"SELECT pointing_id, {n} AS step_no, '{step}' AS step, count_if({cut})::bigint AS N_tot, round(avg(z_cgal_v) FILTER (WHERE {cut}), 6) AS z_mean FROM {source} GROUP BY 1" for n, (step, cut, source) in enumerate(steps)]
    return f" SELECT '{survey}' AS survey, '{survey}_' || pointing_id AS output, step_no, step, N_tot, z_mean FROM ({' UNION ALL '.join(parts)})"


def _tiles_query(survey: str, n: int | None, **needs) -> queries.Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{scratch(spark)}/stats"
        # what selections read, stored: their cuts name a magnitude many times
        cat = observed(spark, sf_dir)
        cat = checkpointed(cat.select(ID, "ra_gal", "dec_gal", "z_cgal_v", *[c for c in cat.columns if c.endswith("_obs")]))
        options = {name: made(spark, sf_dir) for name, made in needs.items()}
        pipelines.line_of_sight_realisations(cat, survey, BOX, 5, 4, n, statistics=(path, "a"), **options)
        return rounded(tables.load_catalogue(spark, path))

    return query


register(
    "line_of_sight_zcosmos",
    f", {queries._COLOURS}, {queries._PLACED}, {queries._TILES}, d AS (SELECT p.*, pointing_id, {queries._CUTS['zcosmos']} AS c1, {uniform_sql('sapling:zcosmos', 'success', ID)} < rate AS c2 FROM p, tiles WHERE {_IN_TILES}),"
    f" s AS (SELECT *, c1 AND c2 AND row_number() OVER (PARTITION BY pointing_id, c1 AND c2 ORDER BY {uniform_sql('sapling:zcosmos', 'stratum', ID)}, {ID}) <= 12 AS kept FROM d)"
    + _tile_steps([("input", "true", "d"), ("cut", "c1", "d"), ("success", "c1 AND c2", "d"), ("downsampling", "kept", "s")], "zcosmos"),
)(_tiles_query("zcosmos", 12, surface=surface))


def wanted_redshifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in n(z): that of the bright sample below redshift 1."""
    cat = observed(spark, sf_dir)
    bright = selections.SELECTIONS["sdss_main"].cut(selections.magnitude_lookup(cat, "kids", ("obs",)))
    return cat.where(bright & (F.col("z_cgal_v") < 1)).select("z_cgal_v")


register(
    "line_of_sight_wigglez",
    f", {queries._COLOURS}, {queries._TILES}, d AS (SELECT o.*, z_cgal_v AS x, pointing_id, {queries._CUTS['wigglez']} AS c1 FROM o, tiles WHERE {_IN_TILES}), s AS (SELECT * FROM d WHERE c1),"
    f" t AS (SELECT z_cgal_v AS x FROM o WHERE {queries._CUTS['sdss_main']} AND z_cgal_v < 1),"
    " p AS (SELECT least(s0, t0) AS low, (greatest(s1, t1) - least(s0, t0)) / 2000 AS step, ht, nt FROM (SELECT min(x) AS s0, max(x) AS s1 FROM s), (SELECT min(x) AS t0, max(x) AS t1, 0.05::double * stddev_samp(x) AS ht, count(*) AS nt FROM t)),"
    f" {queries._kde_sql('t', 'ht')},"
    " sp AS (SELECT pointing_id, 0.05::double * stddev_samp(x) AS hs, count(*) AS ns FROM s GROUP BY 1),"
    " s0 AS (SELECT *, (x - low) / step AS place, least(floor((x - low) / step), 1999) AS cell FROM s, p),"
    " s1 AS (SELECT pointing_id, pos, sum(w) AS w FROM (SELECT pointing_id, cell AS pos, 1 - (place - cell) AS w FROM s0 UNION ALL SELECT pointing_id, cell + 1, place - cell FROM s0) GROUP BY 1, 2),"
    " s2 AS (SELECT pointing_id, g.k, sum(w * exp(-0.5 * pow((g.k - pos) * (step / hs), 2))) / (sum(w) * any_value(hs) * sqrt(2 * pi())) AS d FROM range(2001) g(k), s1 JOIN sp USING (pointing_id), p GROUP BY 1, 2),"
    " r AS (SELECT s2.pointing_id, s2.k, least(CASE WHEN s2.d > 0 THEN t2.d * nt / (s2.d * ns) ELSE 1 END, 1e6) AS r FROM s2 JOIN t2 ON t2.k = s2.k JOIN sp ON sp.pointing_id = s2.pointing_id, p),"
    f" m AS (SELECT s0.*, 1 - least(1, a.r + (place - cell) * (b.r - a.r)) < {uniform_sql('sapling:wigglez', 'match', ID)} AS kept FROM s0 JOIN r a ON a.k = cell AND a.pointing_id = s0.pointing_id JOIN r b ON b.k = cell + 1 AND b.pointing_id = s0.pointing_id),"
    f" e AS (SELECT d.pointing_id, d.z_cgal_v, coalesce(m.kept, false) AS kept FROM d LEFT JOIN m ON m.{ID} = d.{ID})"
    + _tile_steps([("input", "true", "d"), ("cut", "c1", "d"), ("downsampling", "kept", "e")], "wigglez"),
)(_tiles_query("wigglez", None, n_z=wanted_redshifts))


@register(
    "sdss_statistics",
    f", {queries._COLOURS} "
    + " UNION ALL ".join(
        f"SELECT {n} AS step_no, '{step}' AS step, count(*) AS N_tot, round(avg(z_cgal_v), 6) AS z_mean FROM o WHERE ({cut}) AND (r < 19 OR {n} = 0)"
        for n, (step, cut) in enumerate([("input", "true"), ("sdss_main", queries._CUTS["sdss_main"]), ("sdss_boss", queries._CUTS["boss"]), ("sdss_qso", queries._CUTS["sdss_qso"]), ("union", queries._CUTS["sdss"])])
    ),
)
def sdss_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each branch's own count and mean redshift, then the union's, of what a shallow survey detects.

    Cuts are made on magnitudes of the model, the detection on a column of its own.
    """
    cat = observed(spark, sf_dir)
    shallow = cat.withColumns({"sdss_r_obs_mag": F.col("sdss_r_obs")}).withColumn("shallow", F.col("sdss_r_obs") < 19)
    mag = selections.magnitude_lookup(cat, "kids", ("obs",))
    parts = selections.SELECTIONS["sdss"].parts
    selections.register_selection("sdss_shallow", selections.Selection(selections.SELECTIONS["sdss"].cut, parts={n: (lambda _, p=p: p(mag) & selections.true(F.col("shallow"))) for n, p in parts.items()}))
    return rounded(selections.select("sdss_shallow", shallow)[1])


# --- reports ---------------------------------------------------------------------

_M = ["sdss_g_true", "sdss_r_true", "vhs_ks_true"]
_EDGES = {"magnitude": [16.0 + 0.5 * i for i in range(21)], "colour": [-2.0 + 0.25 * i for i in range(29)], "aperture": [0.25 * i for i in range(13)], "photo_z": [round(0.1 * i, 1) for i in range(16)]}


def _families() -> list[report.Family]:
    return [
        report.magnitudes(_M, _EDGES["magnitude"]),
        report.colours(_M, _EDGES["colour"]),
        report.errors({"sdss_r_true": "kappa", "vhs_ks_true": "kappa"}, _EDGES["magnitude"]),
        report.apertures(["disk_length", "bulge_length"], _EDGES["aperture"]),
        report.properties("lmhalo", ["sdss_r_true"], _EDGES["magnitude"]),
        report.photo_z("z_b", "z_cgal", _EDGES["photo_z"]),
    ]


_DZ = "(z_b - z_cgal) / (1 + z_cgal)"
_CELLS = [
    *[("magnitude", c, f"CASE WHEN abs({c}) < 90 THEN {c} END", "NULL") for c in _M],
    *[("colour", f"{a}-{b}", f"CASE WHEN abs({a}) < 90 AND abs({b}) < 90 THEN {a} - {b} END", "NULL") for a, b in zip(_M, _M[1:], strict=False)],
    *[("error", c, f"CASE WHEN abs({c}) < 90 THEN {c} END", f"CASE WHEN abs({c}) < 90 THEN kappa END") for c in ("sdss_r_true", "vhs_ks_true")],
    *[("aperture", c, c, "NULL") for c in ("disk_length", "bulge_length")],
    ("property", "sdss_r_true", "CASE WHEN abs(sdss_r_true) < 99 THEN sdss_r_true END", "lmhalo"),
    *[("photo_z", n, x, y) for n, x, y in (("estimate", "z_b", _DZ), ("truth", "z_cgal", _DZ), ("estimate_outliers", "z_b", f"(abs({_DZ}) > 0.15)::int"), ("truth_outliers", "z_cgal", f"(abs({_DZ}) > 0.15)::int"))],
]


def _bins_sql(family: str, x: str) -> str:
    edges = _EDGES[{"error": "magnitude", "property": "magnitude"}.get(family, family)]
    listed = "[" + ", ".join(f"{e!r}::double" for e in edges) + "]"
    return f"CASE WHEN {x} BETWEEN {edges[0]!r} AND {edges[-1]!r} THEN least(len(list_filter({listed}, lambda e: e <= {x})) - 1, {len(edges) - 2}) END"


_REPORT = ", cells AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS family, '{n}' AS label, CASE flag_central WHEN 1 THEN 'data' ELSE 'sim' END AS sample, {_bins_sql(f, '(' + x + ')')} AS bin, {x} AS x, ({y})::double AS y FROM cat" for f, n, x, y in _CELLS
) + ")"


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = [ID, "flag_central", *_M, "kappa", "disk_length", "bulge_length", "lmhalo", "z_b", "z_cgal"]
    return checkpointed(derived_catalogue(spark, sf_dir).select(*read)).withColumn("sample", F.when(F.col("flag_central") == 1, "data").otherwise("sim"))


@register("quality_report_families", f"{_REPORT} SELECT family, label, sample, bin::int AS bin, count(*) AS n, round(avg(y), 6) AS mean FROM cells WHERE bin IS NOT NULL GROUP BY GROUPING SETS ((family, label, sample, bin), (family, label, sample))")
def quality_report_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six families of statistics of two samples, bins and totals, in one aggregate."""
    return rounded(report.report(_both(spark, sf_dir), _families()))


_LOW_HIGH = {f: report.LIMITS[f] for f in report.LIMITS}


@register(
    "quality_report_limits",
    f"{_REPORT}, e AS (SELECT family, label, sample, CASE WHEN family IN ('error', 'property') THEN y ELSE x END AS v FROM cells WHERE family <> 'aperture')"
    " SELECT family, label, round(min(low), 6) AS low, round(max(high), 6) AS high FROM ("
    + " UNION ALL ".join(f"SELECT family, label, sample, quantile_cont(v, {a / 100!r}) AS low, quantile_cont(v, {b / 100!r}) AS high FROM e WHERE family = '{f}' AND v IS NOT NULL GROUP BY 1, 2, 3" for f, (a, b) in _LOW_HIGH.items())
    + ") GROUP BY 1, 2",
)
def quality_report_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report.limits(_both(spark, sf_dir), _families(), exact=True))
