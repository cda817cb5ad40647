"""Formulas on hand-computed rows, properties, metamorphic checks and edge rows of the catalogue operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumencat.functions import apertures, magnitudes, sky
from lumencat.functions.lookup import among
from lumencat.functions.rng import normal, uniform
from lumencat.functions.spline import quadratic
from lumencat.operators import match, photometry, sampling, selections, stats
from lumencat.plans import pipelines
from lumencat.plans.fixtures import catalogue
from lumencat.sources import tables
from lumencat.streaming import catalogue_streams

NAN, INF = float("nan"), float("inf")


def values(df, column):
    return [r[column] for r in df.select(column).collect()]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.fixture(scope="module")
def cat(spark, sf_dir):
    return catalogue(spark, sf_dir)


def test_magnitude_formulas(spark):
    assert one(spark, magnitudes.evolution_corrected(F.lit(20.0), F.lit(1.0))) == pytest.approx(20 - 0.8 * (math.atan(1.5) - 0.1489))
    assert one(spark, magnitudes.magnified(F.lit(20.0), F.lit(0.05))) == pytest.approx(20 - 2.5 * math.log10(1.1))
    assert one(spark, magnitudes.magnified(F.lit(20.0), F.lit(0.0))) == 20
    assert one(spark, magnitudes.magnified(F.lit(20.0), F.lit(-0.5))) is None
    assert [one(spark, magnitudes.mag_from_flux(F.lit(x))) for x in (1.0, 0.0, -1.0)] == [0, 99, 99]
    assert [one(spark, magnitudes.signal_to_noise(F.lit(x), F.lit(y))) for x, y in ((4.0, 2.0), (-4.0, 2.0), (1.0, 0.0), (NAN, 1.0))] == [2, 0.2, 0.2, 0.2]


def test_names():
    assert magnitudes.observed_names("a_evo") == ("a_obs", "a_obserr")
    assert magnitudes.observed_names("a_evo_mag") == ("a_obs_mag", "a_obserr_mag")
    assert magnitudes.observed_names("a_true_mag") == ("a_true_obs_mag", "a_true_obserr_mag")
    assert magnitudes.observed_names("a") == ("a_obs", "a_obserr")
    with pytest.raises(KeyError):
        magnitudes.resolve_mag(["sdss_r_obs"], magnitudes.DES_LIKE, "ks", "obs")
    with pytest.raises(KeyError):
        magnitudes.resolve_mag(["sdss_r_evo"], magnitudes.KIDS_LIKE, "r", "obs")


def test_magnified_column_wins(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "sdss_r_obs double, sdss_r_obs_mag double")
    assert df.select(magnitudes.resolve_mag(df.columns, magnitudes.KIDS_LIKE, "r", ("evo", "obs"))).first()[0] == 2


def test_photometry_edges(spark):
    df = spark.createDataFrame([(1, 20.0), (2, 99.0), (3, NAN), (4, None), (5, 40.0), (6, INF)], "unique_gal_id bigint, m_evo double")
    rows = {r["unique_gal_id"]: r for r in photometry.photometry(df, {"m_evo": 24.0}, significance=1.5, store_flux=True).collect()}
    lost = magnitudes.non_detection_error(24.0, 1.5)
    assert abs(rows[1]["m_obs"] - 20) < 0.2 and rows[1]["fluxerr_m_obs"] > 0
    for i in (3, 4):
        assert rows[i]["m_obs"] == 99 and rows[i]["m_obserr"] == pytest.approx(lost)
    assert all(r["m_obs"] < 99 or r["m_obserr"] == pytest.approx(lost) for r in rows.values())
    with pytest.raises(ValueError):
        photometry.photometry(df, {"m_evo": 24.0}, sn_factors=["a", "b"])


def test_normal_deviates(spark):
    x = np.array(values(spark.range(20000).select(normal("s", "t", F.col("id")).alias("x")), "x"))
    assert abs(x.mean()) < 0.03 and abs(x.std() - 1) < 0.03 and abs((x**4).mean() - 3) < 0.3


def test_seed_changes_draws_only(cat):
    cols = ["unique_gal_id", "sdss_r_true"]
    a, b = (photometry.photometry(cat.select(*cols), {"sdss_r_true": 24.0}, seed=s).orderBy("unique_gal_id").collect() for s in ("a", "b"))
    assert [r[:2] for r in a] == [r[:2] for r in b] and [r[2] for r in a] != [r[2] for r in b]


def test_half_light_radius(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0), (0.0, 1.0, 1.0), (2.0, 0.5, 0.3), (0.0, 0.0, 0.5), (0.0, 0.8, 0.4)], "disk_length double, bulge_length double, bulge_fraction double")
    out = apertures.with_half_light_radius(df).withColumn("f", apertures.flux_fraction(F.col("R_E"), F.col("disk_length"), F.col("bulge_length"), F.col("bulge_fraction")))
    r, f = values(out, "R_E"), values(out, "f")
    # an exponential disk holds half its light inside 1.6783 / 1.6721 scale lengths
    assert r[0] == pytest.approx(1.67835 / 1.6721, rel=1e-4) and r[1] == pytest.approx(1.0, rel=1e-3) and r[3] is None and r[4] is None
    assert f[:3] == pytest.approx([0.5] * 3, abs=1e-10)


def test_flux_fraction_derivative(spark):
    args = F.lit(1.5), F.lit(0.7), F.lit(0.4)
    up, down, slope = (one(spark, x) for x in (apertures.flux_fraction(F.lit(1.001), *args), apertures.flux_fraction(F.lit(0.999), *args), apertures.flux_fraction_derivative(F.lit(1.0), *args)))
    assert slope == pytest.approx((up - down) / 0.002, rel=1e-5)


def test_aperture_needs_positive_psf(cat):
    with pytest.raises(ValueError):
        apertures.apertures(cat, {"r": 0.0}, "bulge_axis_ratio", "disk_length")


def test_axis_ratio_from_area(spark):
    assert one(spark, apertures.axis_ratio_from_area(F.lit(math.pi * 6), F.lit(3.0))) == pytest.approx(2 / 3)


def test_tiles_have_equal_area_and_cover(spark, cat):
    for box in (sky.Box(30, 60, 0, 30), sky.Box(350, 20, -30, 10)):
        rows = sky.pointing_grid(spark, box, 6, 5).collect()
        areas = [sky.Box(r["ra_min"], r["ra_max"], r["dec_min"], r["dec_max"]).area for r in rows]
        assert len(rows) == 30 and areas == pytest.approx([box.area / 30] * 30) and len({r["name"] for r in rows}) == 30
    box = sky.Box(30, 60, 0, 30)
    grid = cat.select("unique_gal_id", sky.grid_index(F.col("ra_gal"), F.col("dec_gal"), box, 6, 5).alias("p"))
    generic = sky.assign_pointing(cat.select("unique_gal_id", "ra_gal", "dec_gal"), sky.pointing_grid(spark, box, 6, 5))
    assert {*map(tuple, grid.collect())} == {(r["unique_gal_id"], r["pointing_id"]) for r in generic.collect()}


def test_wrapped_boxes(spark):
    assert sky.Box(350, 10, 0, 10).width == 20
    df = spark.createDataFrame([(355.0, 5.0), (5.0, 5.0), (180.0, 5.0)], "ra double, dec double")
    assert values(sky.sky_box(df, sky.Box(350, 10, 0, 10), "ra", "dec"), "ra") == [355, 5]
    name = one(spark, sky.pointing_name("p", F.lit(350.0), F.lit(20.0), F.lit(-10.0), F.lit(0.0)))
    assert name == "p_5p0_m5p0"
    for bad in ((0, 10, 5, 5), (0, 0, 0, 10), (0, 400, 0, 10), (0, 10, -91, 0)):
        with pytest.raises(ValueError):
            sky.Box(*bad)


def test_next_dec(spark):
    box = sky.Box(10, 30, 0, 20)
    assert one(spark, sky.next_dec(F.lit(box.area), F.lit(20.0), F.lit(0.0))) == pytest.approx(20)
    assert one(spark, sky.next_dec(F.lit(1e6), F.lit(20.0), F.lit(0.0))) == 90


def test_missing_magnitudes_never_select(spark):
    bands = [f"{s}_obs" for s in magnitudes.KIDS_LIKE.values()]
    schema = "unique_gal_id bigint, z_cgal_v double, flag_central int, lmhalo double, lmstellar double, " + ", ".join(f"{b} double" for b in bands)
    df = spark.createDataFrame([(i, 0.5, 0, 12.0, 9.0, *[x] * len(bands)) for i, x in enumerate((None, NAN, INF))], schema)
    for name, s in selections.SELECTIONS.items():
        assert df.where(s.cut(selections.magnitude_lookup(df, "kids", s.suffixes))).count() == 0, name


def test_strict_colours_drop_non_detections(spark):
    df = spark.createDataFrame([(20.0, 99.0)], "r double, g double")
    mag = {"g": F.col("g"), "r": F.col("r"), "i": F.col("r") - 0.8, "u": F.col("r"), "z": F.col("r")}.__getitem__
    assert df.where(selections.wigglez(mag, strict_colours=True)).count() == 0


def test_selection_requirements(cat):
    with pytest.raises(ValueError):
        selections.select("deep2", cat)
    with pytest.raises(ValueError):
        selections.select("wigglez", cat)


def test_register_selection(cat):
    selections.register_selection("bright", selections.Selection(lambda mag: selections.true(mag("r") < 18), ("true",)))
    kept, steps = selections.select("bright", cat)
    assert kept.count() == cat.where("sdss_r_true < 18").count() == steps.where("step = 'cut'").first()["N_tot"]
    del selections.SELECTIONS["bright"]


def test_spline_passes_its_nodes(spark):
    rng = np.random.default_rng(0)
    x, y = np.cumsum(rng.random(12) + 0.1), rng.random(12)
    curve = quadratic(x, y, above=0.25)
    df = spark.createDataFrame([(float(v),) for v in (*x, x[0] - 1, x[-1] + 1)], "x double").select(curve.column(F.col("x")).alias("y"))
    assert values(df, "y") == pytest.approx([*y, y[0], 0.25], abs=1e-7)
    line = quadratic([0, 1, 2, 3, 4], [0, 1, 4, 9, 16])
    assert one(spark, line.column(F.lit(2.7))) == pytest.approx(7.29)


def test_among(spark):
    assert [one(spark, among(F.lit(x), [0, 1, 2, 3, 4], F.lit)) for x in (-1.0, 0.0, 0.5, 3.0, 9.0)] == [0, 0, 0, 3, 4]


def test_acceptance_follows_the_curve(spark):
    df = spark.range(40000).select(F.col("id"), F.lit(23.5).alias("x"))
    share = df.where(sampling.accepted(F.col("x"), sampling.deep2_curve(), "s", "d", F.col("id"))).count() / 40000
    assert abs(share - one(spark, sampling.deep2_curve().column(F.lit(23.5)))) < 0.01


@pytest.mark.parametrize("few", [0, 10_000])
def test_sample_n_is_exact_and_stable(spark, monkeypatch, few):
    monkeypatch.setattr(sampling, "FEW", few)
    df = spark.range(3000).withColumnRenamed("id", "unique_gal_id")
    a, b = ({*values(sampling.sample_n(d, 500, "s"), "unique_gal_id")} for d in (df.repartition(1), df.repartition(13)))
    assert a == b and len(a) == 500
    assert sampling.sample_n(df, 5000, "s").count() == 3000 and sampling.sample_n(df, 0, "s").count() == 0
    repeated = spark.range(3000).select(F.lit(1).alias("unique_gal_id"))
    assert sampling.sample_n(repeated, 500, "s").count() == 500


def test_systematic_sample_and_stride(spark):
    df = spark.range(1000)
    kept = sorted(values(sampling.sample_systematic(df, 100, "id"), "id"))
    assert kept[0] == 0 and len(kept) == 100 and {*np.diff(kept)} == {10}
    assert sorted(values(sampling.sparse_every(df, 300, "id"), "id")) == [0, 300, 600, 900]
    assert sampling.target_count(8698, 0.815761, 5156.625, 256) == int(8698 / 0.815761 * 5156.625 / 256)


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_row_index_of_wide_tables(spark, sf_dir, parts):
    """Every number once, in order, whatever else the table holds; keys that tie, nulls, strings."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    wide = lines.withColumn("half", F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")))
    for order in ("l_orderkey", "half", "l_shipdate", "l_returnflag"):
        rows = sampling.dense_row_index(wide, order, partitions=parts).orderBy("row_index").select("row_index", order).collect()
        assert [r[0] for r in rows] == list(range(lines.count()))
        keys = [r[1] for r in rows]
        assert keys == sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))
    assert sampling.sparse_every(wide, 10, "l_orderkey").count() == -(-lines.count() // 10)
    assert sampling.dense_row_index(wide.limit(0), "half").count() == 0


def test_match_distribution_beyond_the_source(spark):
    df = spark.range(500).select(F.col("id").alias("unique_gal_id"), (0.4 + 0.2 * uniform("s", "x", F.col("id"))).alias("x"))
    target = spark.range(4000).select((20 * uniform("s", "t", F.col("id"))).alias("x"))
    assert 0 < sampling.match_distribution(df, "x", target, "x", "s").count() <= 500
    assert sampling.match_distribution(df, "x", target.limit(0), "x", "s").count() == 0


def test_exact_quantiles_equal_numpy(spark, monkeypatch):
    """Ties, null keys, groups of one value; brackets that hold part of the values only."""
    rng = np.random.default_rng(11)
    groups = {"a": rng.normal(size=4000).round(2), "b": np.repeat(5.0, 50), None: rng.random(7), "c": np.concatenate([np.zeros(3000), rng.random(1000)])}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("a", None)], "k string, x double").repartition(5)
    shares = [0.0, 0.005, 0.25, 0.5, 0.995, 1.0]
    for accuracy in (100, 200_000):
        monkeypatch.setattr(stats, "SKETCH", accuracy)
        found = {r["k"]: r["values"] for r in stats.exact_quantiles(df, ["k"], "x", shares).collect()}
        assert found == {k: pytest.approx(np.quantile(x, shares).tolist()) for k, x in groups.items()}


def test_statistics_without_spread(spark):
    none, same = spark.createDataFrame([], "x double, z double"), spark.createDataFrame([(1.0, 1.0)] * 5, "x double, z double")
    for df in (none, same):
        assert values(stats.kde_1d(df, "x", 0, 1, points=5), "density") == [None] * 5
        assert stats.grid_step(df, "x").first()["step"] is None
    assert stats.percentile_edges(none, "x") == [] and stats.photoz_statistics(none, "x", "x", "z", []).count() == 0
    assert stats.percentile_limits(none, ["x"], 1, 99).count() == 0 and stats.median_default(none, ["x"]).count() == 0


def test_hstack_pairs_one_to_one(spark):
    a, b = spark.range(5).withColumn("p", F.lit(1)), spark.range(5).withColumn("q", F.lit(2))
    assert sorted(map(tuple, tables.hstack([a, b, b.withColumnRenamed("q", "r")], "id").collect())) == [(i, 1, 2, 2) for i in range(5)]
    for other in (b.limit(4), b.unionByName(b), b.where("id < 4").unionByName(b.where("id = 3")), b.withColumn("id", F.col("id") + 1)):
        with pytest.raises(ValueError):
            tables.hstack([a, other], "id")


def test_tiles_across_zero(spark):
    df = spark.createDataFrame([(i, ra) for i, ra in enumerate([359.5, 0.0, 0.4, 10.0, 350.0, 360.0])], "unique_gal_id bigint, ra_gal double").withColumn("dec_gal", F.lit(1.0))
    tiles = spark.createDataFrame([(1, 350.0, 10.0, 0.0, 2.0), (2, 0.0, 0.5, 0.0, 2.0)], "pointing_id bigint, ra_min double, ra_max double, dec_min double, dec_max double")
    assert sorted(map(tuple, sky.assign_pointing(df, tiles).select("pointing_id", "unique_gal_id").collect())) == [(1, 0), (1, 1), (1, 2), (1, 4), (1, 5), (2, 1), (2, 2)]


def test_match_distribution_shape(spark):
    df = spark.range(20000).select(F.col("id").alias("unique_gal_id"), uniform("s", "x", F.col("id")).alias("x"))
    target = spark.range(1500).select((0.5 + 0.1 * normal("s", "t", F.col("id"))).alias("x"))
    kept = np.array(values(sampling.match_distribution(df, "x", target, "x", "s"), "x"))
    assert abs(kept.mean() - 0.5) < 0.02 and abs(kept.std() - 0.1) < 0.02 and abs(len(kept) - 1500) < 200


@pytest.mark.parametrize("values_", [10, 8_000_000])
def test_nearest_property_equals_brute_force(spark, monkeypatch, values_):
    """By cells with hot ones split, and by broadcast in small blocks of pairs."""
    monkeypatch.setattr(match, "BROADCAST_VALUES", values_)
    monkeypatch.setattr(match.neighbours, "BLOCK_ROWS", 20)
    monkeypatch.setattr(match, "PAIRS", 30)
    rng = np.random.default_rng(5)
    sim = [(i, *map(float, x)) for i, x in enumerate([*rng.random((200, 2)), *[[99.0, 99.0]] * 30])]
    ref = [(i, *map(float, x), f"p{i}") for i, x in enumerate([*rng.random((60, 2)), [99.0, 99.0], [99.0, 99.0]])]
    s = spark.createDataFrame(sim, "unique_gal_id bigint, a double, b double")
    r = spark.createDataFrame(ref, "rid bigint, c double, d double, p string")
    found = {x["unique_gal_id"]: x["q"] for x in match.nearest_property(s, r, ["a", "b"], ["c", "d"], {"p": "q"}, "rid", 0.1, {"p": "none"}).collect()}
    for i, a, b in sim:
        d, _, p = min(((a - c) ** 2 + (b - e) ** 2, k, p) for k, c, e, p in ref)
        assert found[i] == (p if d < 0.1 * 0.1 else "none")
    with pytest.raises(KeyError):
        match.nearest_property(s, r, ["a"], ["c"], {"p": "q"}, "rid", 0.1, {"x": 1})


def test_neighbour_at_exactly_r_max_is_out(spark):
    s = spark.createDataFrame([(1, 0.0)], "unique_gal_id bigint, a double")
    r = spark.createDataFrame([(1, 0.5, 7), (2, -0.5, 8)], "rid bigint, c double, p int")
    assert match.nearest_property(s, r, ["a"], ["c"], {"p": "q"}, "rid", 0.5).first()["q"] is None
    assert match.nearest_property(s, r, ["a"], ["c"], {"p": "q"}, "rid", 0.6).first()["q"] == 7


def test_nearest_unbounded_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(match, "BROADCAST_VALUES", 21)
    monkeypatch.setattr(match, "PAIRS", 50)
    rng = np.random.default_rng(6)
    s = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.random((40, 3)))], "i bigint, v array<double>")
    r = spark.createDataFrame([(i, v.tolist(), i * 2) for i, v in enumerate(rng.random((30, 3)))], "j bigint, w array<double>, p int")
    sim, ref = s.collect(), r.collect()
    found = {x["i"]: x["p"] for x in match.nearest_unbounded(s, r, "v", "w", {"p": "p"}, "j", "i").collect()}
    assert found == {x["i"]: min(ref, key=lambda y: sum((a - b) ** 2 for a, b in zip(x["v"], y["w"], strict=True)))["p"] for x in sim}


def test_histograms(spark):
    x = [0.0, 0.5, 1.0, 2.0, 3.0, 3.0, 3.1, -1.0, NAN, None]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    clean = [v for v in x if v is not None and not math.isnan(v)]
    assert values(stats.histogram(df, "x", [0, 1, 2, 3]).orderBy("bin"), "value") == np.histogram(clean, [0, 1, 2, 3])[0].tolist()
    dens = stats.histogram(df, "x", [0, 1, 3], density=True).orderBy("bin").collect()
    assert sum(r["value"] * (r["high"] - r["low"]) for r in dens) == pytest.approx(1)
    assert values(stats.histogram(df.limit(0), "x", [0, 1]), "value") == [0]


def test_kde_equals_pairwise(spark):
    x = np.random.default_rng(7).normal(0, 1, 300)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    rows = stats.kde_1d(df, "x", -2, 2, points=41).orderBy("z").collect()
    h = x.std(ddof=1) * 300 ** (-0.2)
    want = [np.exp(-0.5 * ((r["z"] - x) / h) ** 2).sum() / 300 / h / math.sqrt(2 * math.pi) for r in rows]
    assert [r["density"] for r in rows] == pytest.approx(want, rel=1e-3)


def test_photoz_statistics_with_an_empty_bin(spark):
    rng = np.random.default_rng(8)
    z = rng.uniform(0, 1, 400)
    zp = z + rng.normal(0, 0.1, 400) * (1 + z)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(z, zp, strict=True)], "z double, zp double")
    rows = stats.photoz_statistics(df, "z", "zp", "z", [0, 0.5, 1, 2], exact=True).orderBy("bin").collect()
    for r, (lo, hi) in zip(rows, ((0, 0.5), (0.5, 1)), strict=False):
        dz = ((zp - z) / (1 + z))[(z >= lo) & (z < hi)]
        mad = 1.4826 * np.median(np.abs(dz - dz.mean()))
        assert (r["n"], r["bias"], r["mad"], r["nmad_fraction"], r["outlier_fraction"]) == pytest.approx((len(dz), dz.mean(), mad, (abs(dz) > 3 * mad).mean(), (abs(dz) > 0.15).mean()))
    assert rows[2]["n"] == 0 and rows[2]["mad"] is None and rows[2]["middle"] == 1.5


def test_outlier_envelope():
    points = stats.outlier_envelope(0.05, 0.1, 1.5)
    assert points[0] == ("upper", 0.0, -0.05) and points[1] == ("upper", pytest.approx(0.95 / 0.95), 0.9) and len(points) == 8


def test_registry_and_pointings(spark, tmp_path):
    reg = tables.footprint_row(spark, "a", sky.Box(0.0, 10.0, 0.0, 10.0)).unionByName(tables.footprint_row(spark, "b", sky.Box(0.0, 20.0, 0.0, 10.0)))
    new = tables.footprint_upsert(reg, tables.footprint_row(spark, "a", sky.Box(5.0, 10.0, 0.0, 10.0)))
    assert new.count() == 2 and tables.footprint_lookup(new, "a").ra_min == 5
    with pytest.raises(KeyError):
        tables.footprint_lookup(new, "c")
    grid = sky.pointing_grid(spark, sky.Box(0, 10, 0, 10), 2, 2)
    tables.write_pointings(grid, str(tmp_path / "p"))
    back = tables.read_pointings(spark, str(tmp_path / "p"))
    assert back.count() == 4 and tables.pointing_nth(back, 3).first()["ra_min"] == 0
    with pytest.raises(IndexError):
        tables.pointing_nth(back, 5)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_catalogue_files(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5)], "id bigint, x double")
    path = str(tmp_path / fmt)
    options = {"header": True} if fmt == "csv" else {}
    df.write.options(**options).format(fmt).save(path) if fmt == "csv" else tables.write_catalogue(df, path, fmt)
    assert tables.load_catalogue(spark, path, fmt, ["id"], **options).count() == 2
    with pytest.raises(KeyError):
        tables.load_catalogue(spark, path, fmt, ["nope"], **options)


def test_rate_curve_and_statistics_files(spark, tmp_path, cat):
    (tmp_path / "curve.txt").write_text("# comment\n# x  rate\n1.0e+00   9.0e-01\n2.0 0.5\n\n")
    assert [tuple(r) for r in tables.load_rate_curve(spark, str(tmp_path / "curve.txt")).collect()] == [(1, 0.9), (2, 0.5)]
    steps = selections.step_statistics(cat, {"input": F.lit(True)})
    for mode in "naawaa":
        tables.write_statistics(steps, str(tmp_path / "s"), mode, "x", "y")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3


def test_metadata_stack_and_split(spark):
    df = tables.with_column_metadata(spark.range(10), {"id": ("1", "number")})
    assert df.schema["id"].metadata == {"unit": "1", "description": "number"}
    with pytest.raises(ValueError):
        tables.hstack([df, spark.range(9)], "id")
    assert tables.split_rows(df, 3, "id").select("chunk").distinct().count() <= 3


def test_report_and_property_pipelines(cat):
    hist, limits = pipelines.quality_report(cat.where("flag_central = 1"), cat.where("flag_central = 0"), ["sdss_r_true"], [16, 20, 26])
    assert hist.count() == 4 and limits.count() == 1
    ref = cat.where("unique_gal_id % 3 = 0").select(F.col("unique_gal_id").alias("rid"), F.col("sdss_r_true").alias("m"), F.lit(1).alias("gold"))
    out = pipelines.add_property(cat, ref, [("flag_gold", "eq", 1)], sim_attrs=["sdss_r_true"], ref_attrs=["m"], props={"gold": "flag_gold"}, ref_id="rid", r_max=0.001, fallback={"gold": 0})
    assert 0 < out.count() < cat.count() or out.count() == cat.count()


def test_row_wise_operators_push_filters_and_prune_columns(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_totalprice").alias("ra_gal"), F.col("o_custkey").cast("double").alias("dec_gal"))
    plan = sky.sky_box(df, sky.Box(30, 60, 0, 30)).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice)" in plan and "o_orderdate" not in plan


def test_stream_equals_batch(spark, cat, tmp_path):
    source = str(tmp_path / "in")
    cat.repartition(3).write.parquet(source)
    stream = catalogue_streams.read_stream(spark, source, cat.schema, 1)
    evolved = magnitudes.evolve_magnitudes(stream)
    q = catalogue_streams.write_stream(evolved.select("unique_gal_id", "sdss_r_evo"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    want = {tuple(r) for r in magnitudes.evolve_magnitudes(cat).select("unique_gal_id", "sdss_r_evo").collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want
    steps = {"input": F.lit(True), "cut": F.col("sdss_r_true") < 19.87}
    q = catalogue_streams.running_statistics(stream, steps).writeStream.outputMode("complete").format("memory").queryName("running").start()
    q.processAllAvailable()
    q.stop()
    found = {r["step"]: (r["N_tot"], pytest.approx(r["z_mean"])) for r in spark.table("running").collect()}
    assert found == {r["step"]: (r["N_tot"], r["z_mean"]) for r in selections.step_statistics(cat, steps).collect()}
