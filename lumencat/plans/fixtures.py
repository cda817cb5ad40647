"""A deterministic catalogue over the orders table: stand-in input for the registered queries.

The formulas are SQL that Spark and DuckDB read alike; uniforms are md5-keyed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rng import uniform
from ..sources.storage import checkpointed

#: Rows of a task: a compressed split of ids would hold millions.
TASK_ROWS = 250_000

STREAMS = "ra dec z zv kap r gr ug ri iz rk br rcic cen lmh lms fb bl dl ba zp".split()

#: Column: formula over earlier columns and u_<stream>.
FORMULAS = {
    "ra_gal": "30 + 30 * u_ra",
    "dec_gal": "30 * u_dec",
    "z_cgal": "0.05 + 1.35 * u_z",
    "z_cgal_v": "z_cgal + 0.002 * (u_zv - 0.5)",
    "kappa": "0.1 * (u_kap - 0.5)",
    "sdss_r_true": "16.5 + 8.5 * sqrt(u_r)",
    "sdss_g_true": "sdss_r_true + 0.2 + 1.4 * u_gr",
    "sdss_u_true": "sdss_g_true + 0.5 + 1.5 * u_ug",
    "sdss_i_true": "sdss_r_true - (0.1 + 1.3 * u_ri)",
    "sdss_z_true": "sdss_i_true - (0.1 + 0.8 * u_iz)",
    "vhs_ks_true": "CASE WHEN unique_gal_id % 101 = 0 THEN CAST(99.0 AS DOUBLE) ELSE sdss_r_true - (0.5 + 3 * u_rk) END",
    "lephare_rc_true": "sdss_r_true - 0.2",
    "lephare_b_true": "lephare_rc_true + 0.1 + 1.9 * u_br",
    "lephare_ic_true": "lephare_rc_true - (0.1 + 1.2 * u_rcic)",
    "flag_central": "CASE WHEN u_cen < 0.6 THEN 1 ELSE 0 END",
    "lmhalo": "11 + 3.5 * u_lmh",
    "lmstellar": "8.5 + 3.2 * u_lms",
    "bulge_fraction": "CASE WHEN u_fb < 0.15 THEN CAST(0 AS DOUBLE) WHEN u_fb > 0.95 THEN CAST(1 AS DOUBLE) ELSE u_fb END",
    "bulge_length": "CASE WHEN bulge_fraction = 0 THEN CAST(0 AS DOUBLE) ELSE 0.05 + 1.2 * u_bl END",
    "disk_length": "CASE WHEN bulge_fraction = 1 THEN CAST(0 AS DOUBLE) ELSE 0.1 + 2 * u_dl END",
    "bulge_axis_ratio": "0.2 + 0.8 * u_ba",
    "z_b": "floor((z_cgal + 0.1 * (u_zp - 0.5) * (1 + z_cgal)) * 100) / 100",
}


def decimals_as_doubles(formula: str) -> str:
    """Spark reads 0.5 as a decimal; both engines shall compute in doubles."""
    import re

    return re.sub(r"(?<![\w.])(\d+\.\d+)(?![\w.])", r"CAST(\1 AS DOUBLE)", formula)


def catalogue(spark: SparkSession, sf_dir: str, held: bool = False) -> DataFrame:
    """One galaxy per order; formulas are nested once per level, not materialised.

    A row costs some twenty digests, so an input of fewer splits than cores (one
    small file), or of splits of more than TASK_ROWS, is dealt to more: its ids
    alone are shuffled. held: they are checkpointed, so that filters on derived
    columns stay above them; below, they would run in the input's splits.
    """
    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("unique_gal_id"))
    parts = max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    if df.rdd.getNumPartitions() < parts:
        df = checkpointed(df.repartition(parts)) if held else df.repartition(parts)
    df = df.select("*", *[uniform("fx", s, F.col("unique_gal_id")).alias(f"u_{s}") for s in STREAMS])
    for name, formula in FORMULAS.items():
        df = df.withColumn(name, F.expr(decimals_as_doubles(formula)))
    return df.drop(*[f"u_{s}" for s in STREAMS])


def uniform_sql(seed: str, stream: str, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:{stream}:' || ({key})::varchar), 1, 13))::ubigint / 4503599627370496.0::double)"


def normal_sql(seed: str, stream: str, key: str) -> str:
    a, b = uniform_sql(seed, stream + "a", key), uniform_sql(seed, stream + "b", key)
    return f"(sqrt(-2 * ln({a} + 1e-16)) * cos(2 * pi() * {b}))"


def catalogue_sql() -> str:
    """WITH clauses that end in the view cat, for DuckDB."""
    keyed = ", ".join(f"{uniform_sql('fx', s, 'o_orderkey')} AS u_{s}" for s in STREAMS)
    steps = [f"c0 AS (SELECT o_orderkey AS unique_gal_id, {keyed} FROM orders)"]
    for i, (name, formula) in enumerate(FORMULAS.items(), 1):
        steps.append(f"c{i} AS (SELECT *, {decimals_as_doubles(formula)} AS {name} FROM c{i - 1})")
    steps.append(f"cat AS (SELECT * EXCLUDE ({', '.join(f'u_{s}' for s in STREAMS)}) FROM c{len(FORMULAS)})")
    return "WITH " + ",\n".join(steps)
