"""Selections by stratum, realisations, reports, branches' statistics, missing values, row numbering."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumencat.functions import sky
from lumencat.functions.rng import uniform
from lumencat.operators import photometry, photoz, report, sampling, selections, stats
from lumencat.plans import fixtures, pipelines
from lumencat.plans.chain_queries import STEMS, photo_z
from lumencat.plans.fixtures import catalogue
from lumencat.sources import tables

PRESET = pipelines.KIDS_PRESET
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def cat(spark, sf_dir):
    found = catalogue(spark, sf_dir)
    found = found.withColumnsRenamed({c: c.replace("_true", "_obs") for c in found.columns if c.endswith("_true")})
    found = found.withColumn("tile", (F.col("unique_gal_id") % 4).cast("int"))
    return found.cache()


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*columns).collect()], key=str)


@pytest.mark.parametrize("name", ["gama", "deep2", "vvds", "zcosmos", "idealized", "wigglez", "sdss"])
def test_strata_are_treated_as_tables(spark, cat, name):
    """A selection of all strata at once gives what one selection of each gives."""
    options = {}
    if selections.SELECTIONS[name].needs_n:
        options["n_tot"] = 9
    if name == "zcosmos":
        options["surface"] = spark.createDataFrame([(x, y, 0.5 + 0.1 * x) for x in (0.0, 1.0, 2.0) for y in (15.0, 23.0)], "x double, y double, rate double")
    if name == "wigglez":
        options["n_z"] = cat.where("sdss_r_obs < 20").select("z_cgal_v")
    drawn, steps = selections.select_by_stratum(name, cat, "tile", pass_survey_selection=True, **options)
    total = [(r["tile"], r["step_no"], r["step"], r["N_tot"]) for r in steps.collect()]
    assert len({t[:2] for t in total}) == len(total)
    for tile in range(4):
        own = cat.where(F.col("tile") == tile)
        kept, single = selections.select(name, own, pass_survey_selection=True, **options)
        mine = sorted(t[1:] for t in total if t[0] == tile)
        theirs = sorted((r["step_no"], r["step"], r["N_tot"]) for r in single.collect())
        if name == "wigglez":  # grids differ: one spans all strata, the other this one
            assert mine[:-1] == theirs[:-1] and abs(mine[-1][2] - theirs[-1][2]) <= 0.1 * theirs[1][2] + 3
        else:
            assert mine == theirs
        ids = {r[0] for r in drawn.where(F.col("tile") == tile).select("unique_gal_id").collect()}
        assert len(ids) == mine[-1][2]
        if "n_tot" not in options and name not in ("idealized", "wigglez"):
            assert ids == {r[0] for r in kept.select("unique_gal_id").collect()}
    with pytest.raises(ValueError):
        selections.select_by_stratum("zcosmos", cat, "tile")


def test_strata_without_rows_are_reported(cat):
    none = cat.withColumn("sdss_r_obs", F.when(F.col("tile") == 1, 99.0).otherwise(F.col("sdss_r_obs")))
    kept, steps = selections.select_by_stratum("gama", none, "tile", n_tot=5)
    assert {(r["step"], r["N_tot"]) for r in steps.where("tile = 1 AND step_no > 0").collect()} == {("cut", 0), ("downsampling", 0)}
    assert kept.where("tile = 1").count() == 0 and kept.groupBy("tile").count().where("count > 5").count() == 0


def test_branches_report_their_own_statistics(cat):
    kept, steps = selections.select("sdss", cat)
    found = {r["step"]: (r["N_tot"], r["z_mean"]) for r in steps.collect()}
    mag = selections.magnitude_lookup(cat, "kids", ("obs",))
    for name, predicate in selections.SELECTIONS["sdss"].parts.items():
        n, z = cat.where(predicate(mag)).agg(F.count("*"), F.avg("z_cgal_v")).first()
        assert found[name] == (n, pytest.approx(z))
    assert found["union"][0] == kept.count() <= sum(found[n][0] for n in selections.SELECTIONS["sdss"].parts)


def test_realisations_share_the_tile_and_differ_in_noise(spark, sf_dir, tmp_path):
    tiles = sky.pointing_grid(spark, sky.Box(30.0, 60.0, 0.0, 30.0), 2, 2)
    path = str(tmp_path / "stats")
    drawn, steps = pipelines.deep_field_realisations(
        catalogue(spark, sf_dir).drop("z_b"), [*STEMS.values()], PRESET, 4, "gama", tiles, 3, photo_z(spark), statistics=(path, "a"), pass_survey_selection=True
    )
    n = {r["realisation"]: r["N_tot"] for r in steps.where("step = 'input'").collect()}
    assert {*n} == {0, 1, 2, 3} and len({*n.values()}) == 1
    once = drawn.groupBy("unique_gal_id").agg(F.countDistinct("aper_a_intr").alias("a"), F.countDistinct("sdss_r_obs_mag").alias("m"), F.count("*").alias("n")).where("n > 1")
    assert once.where("a != 1 OR m = 1").count() == 0 and once.count() > 0
    assert drawn.where("Z_B IS NULL OR M_0 IS NULL").count() == 0 and "_key" not in drawn.columns
    filed = tables.load_catalogue(spark, path, required=["survey", "output"])
    assert filed.count() == steps.count() and {r[0] for r in filed.select("output").distinct().collect()} == {f"gama_phot_{i}" for i in range(4)}
    again = pipelines.deep_field_realisations(catalogue(spark, sf_dir).drop("z_b"), [*STEMS.values()], PRESET, 4, "gama", tiles, 3, photo_z(spark), pass_survey_selection=True)[0]
    assert rows(again, "unique_gal_id", "realisation", "sdss_r_obs_mag") == rows(drawn, "unique_gal_id", "realisation", "sdss_r_obs_mag")


def test_catalogue_with_photoz_equals_its_steps(spark, sf_dir):
    df = catalogue(spark, sf_dir).drop("z_b").where("unique_gal_id % 7 = 0")
    whole = pipelines.photometric_catalogue(df, [*STEMS.values()], PRESET, photo_z=photo_z(spark), rules=[("M_0", "ll", 90.0)], radius=False)
    steps = pipelines.observed(pipelines.intrinsic(df, [*STEMS.values()], PRESET, radius=False), [*STEMS.values()], PRESET, radius=False)
    steps = photoz.select_by_prior_mag(photo_z(spark).fitted(steps, "_mag"))
    assert rows(whole, "unique_gal_id", "Z_B", "M_0") == rows(steps, "unique_gal_id", "Z_B", "M_0") != []


def test_report_cells_and_totals(spark):
    data = [("sim", 1.5, 0.1, 0.5, 0.5), ("sim", 1.6, 0.3, 0.4, 0.9), ("sim", 99.0, 9.0, 0.1, 0.1), ("sim", NAN, 1.0, None, 0.1), ("data", 2.0, None, 2.0, 2.0), ("data", None, 0.2, 0.5, NAN)]
    df = spark.createDataFrame(data, "sample string, m double, e double, zp double, zt double")
    families = [report.magnitudes(["m"], [1.0, 2.0, 3.0]), report.errors({"m": "e"}, [1.0, 2.0, 3.0]), report.photo_z("zp", "zt", [0.0, 1.0, 2.0])]
    found = {tuple(r)[:4]: tuple(r)[4:] for r in report.report(df, families).select("family", "label", "sample", "bin", "n", "mean").collect()}
    assert found["magnitude", "m", "sim", 0] == (2, None) and found["magnitude", "m", "sim", None] == (2, None)
    assert found["error", "m", "sim", 0] == (2, pytest.approx(0.2)) and found["error", "m", "data", 1] == (1, None)
    assert found["photo_z", "estimate", "sim", 0] == (3, pytest.approx((0 - 0.5 / 1.9 + 0) / 3)) and found["photo_z", "truth_outliers", "sim", 0][1] == pytest.approx(1 / 3)
    assert found["photo_z", "estimate", "data", 1][0] == 1  # the last bin holds its upper edge
    low = {(r["family"], r["label"]): (r["low"], r["high"]) for r in report.limits(df, families, exact=True).collect()}
    assert low["magnitude", "m"] == (pytest.approx(np.percentile([1.5, 1.6], 0.5)), 2.0)
    assert low["error", "m"] == (pytest.approx(0.1), pytest.approx(np.percentile([0.1, 0.3], 95)))
    assert report.report(df.limit(0), families).count() == 0


def test_distributions_with_missing_values(spark):
    df = spark.range(2000).select(F.col("id").alias("unique_gal_id"), (0.2 + 0.6 * uniform("s", "x", F.col("id"))).alias("x"))
    target = spark.range(1500).select((0.5 + 0.05 * uniform("s", "t", F.col("id"))).alias("x"))
    holes = spark.createDataFrame([(9000 + i, x) for i, x in enumerate((NAN, INF, -INF, None))], "unique_gal_id bigint, x double")
    plain = rows(sampling.match_distribution(df, "x", target, "x", "s"), "unique_gal_id")
    assert 0 < len(plain) < 1500
    holed = target.unionByName(holes.select("x"))
    assert rows(sampling.match_distribution(df.unionByName(holes), "x", holed, "x", "s"), "unique_gal_id") == plain
    by = df.unionByName(holes).withColumn("part", (F.col("unique_gal_id") % 2).cast("string"))
    kept = sampling.match_distribution_by_stratum(by, "x", "part", holed, "x", "s")
    counts = {r["part"]: r["count"] for r in kept.groupBy("part").count().collect()}
    assert {*counts} == {"0", "1"} and kept.where("unique_gal_id >= 9000").count() == 0
    for part, n in counts.items():  # a half-sized source needs a higher share
        assert abs(n - sampling.match_distribution(by.where(F.col("part") == part), "x", target, "x", "s").count()) < 25
    grid = stats.kde_1d(df, "x", 0.0, 1.0, 21)
    assert rows(stats.kde_1d(df.unionByName(holes), "x", 0.0, 1.0, 21), F.round("z", 9), F.round("density", 9)) == rows(grid, F.round("z", 9), F.round("density", 9))
    assert stats.kde_1d(holes, "x", 0.0, 1.0, 5).where("density IS NOT NULL").count() == 0


def test_row_index_of_many_parts_is_quick(spark):
    """The time does not follow the number of parts; what a value shared by most rows costs is split."""
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    began = time.perf_counter()
    found = sampling.dense_row_index(df, "k", partitions=200)
    n, low, high, distinct = found.agg(F.count("*"), F.min("row_index"), F.max("row_index"), F.countDistinct("row_index")).first()
    assert (n, low, high, distinct) == (300_000, 0, 299_999, 300_000)
    assert time.perf_counter() - began < 60
    assert found.where("k >= 0").select((F.col("row_index") - F.col("id") / 3 - 200_000).alias("d")).agg(F.min("d"), F.max("d")).first() == (0.0, 0.0)


def test_catalogue_is_dealt_by_rows(spark, monkeypatch):
    """One small file of many compressed ids is not left to a task for each core."""
    monkeypatch.setattr(fixtures, "TASK_ROWS", 100)
    made = fixtures.catalogue(spark, "/root/testdata/sf0.001")
    assert made.rdd.getNumPartitions() >= made.count() / 100 > spark.sparkContext.defaultParallelism


def test_draws_are_not_repeated(spark):
    """Cuts on a noisy magnitude use its flux; the plan draws it once (two uniforms a band)."""
    df = spark.range(5).select(F.col("id").alias("unique_gal_id"), (20 + F.col("id")).cast("double").alias("sdss_r_evo"))
    out = photometry.photometry(df, {"sdss_r_evo": 24.2}).where("sdss_r_obs < 99 AND sdss_r_obserr < 1").groupBy().avg("sdss_r_obs")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 2


def test_stratified_match_reads_its_input_twice(spark):
    """Once for bounds, sums and spreads (two columns), once for the rows that are kept; the target once."""
    reads = {"source": spark.sparkContext.accumulator(0), "target": spark.sparkContext.accumulator(0)}

    def counted(name):
        def add(x):
            reads[name].add(1)
            return x

        return F.udf(add, "double").asNondeterministic()

    df = spark.range(300).select(F.col("id").alias("unique_gal_id"), (F.col("id") % 2).alias("tile"), (F.col("id") / 300).alias("z"))
    target = df.select((F.col("z") / 2).alias("z"))
    kept = sampling.match_distribution_by_stratum(df.withColumn("z", counted("source")("z")), "z", "tile", target.withColumn("z", counted("target")("z")), "z", "s")
    assert 0 < kept.count() < 300
    assert reads["source"].value <= 600 and reads["target"].value <= 300


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    """A sketch that is off by more than its error must not move an exact quantile."""
    sketch, calls = F.percentile_approx, []

    def off(x, shares, accuracy):
        calls.append(1)
        return sketch(F.col(x) + (0.2 if len(calls) <= 2 else 0.0), shares, accuracy)

    monkeypatch.setattr(stats.F, "percentile_approx", off)
    df = spark.range(1001).select((F.col("id") % 2).alias("k"), (F.col("id") / 1000).alias("x"))
    found = {r["k"]: r["values"] for r in stats.exact_quantiles(df, ["k"], "x", [0.1, 0.5]).collect()}
    even, odd = [i / 1000 for i in range(0, 1001, 2)], [i / 1000 for i in range(1, 1001, 2)]
    assert np.allclose(found[0], np.quantile(even, [0.1, 0.5]), atol=1e-12) and np.allclose(found[1], np.quantile(odd, [0.1, 0.5]), atol=1e-12)
    picked = F.when(F.col("k") == 0, F.array(F.lit(2), F.lit(0))).otherwise(F.array(F.lit(1), F.lit(2)))
    own = {r["k"]: r["values"] for r in stats.exact_quantiles(df, ["k"], "x", [0.1, 0.5, 0.9], picked).collect()}
    assert np.allclose(own[0], np.quantile(even, [0.9, 0.1]), atol=1e-12) and np.allclose(own[1], np.quantile(odd, [0.5, 0.9]), atol=1e-12)
