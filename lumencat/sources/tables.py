"""Catalogue files, column metadata, rate curves, footprints, pointings and statistics tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sky import Box


def load_catalogue(spark: SparkSession, path: str | Sequence[str], format: str = "parquet", required: Sequence[str] = (), **options) -> DataFrame:
    """Read a table; an error if a required column is missing. All columns stay."""
    df = spark.read.format(format).options(**options).load(path)
    if missing := sorted({*required} - {*df.columns}):
        raise KeyError(f"missing columns in {path}: {', '.join(missing)}")
    return df


def write_catalogue(df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a table; partition_by makes one folder for each tile, survey..."""
    df.write.mode("overwrite").format(format).partitionBy(*partition_by).save(path)


def with_column_metadata(df: DataFrame, notes: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach (unit, description) to columns."""
    return reduce(lambda d, x: d.withMetadata(x[0], {"unit": x[1][0], "description": x[1][1]}), notes.items(), df)


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def base_query(df: DataFrame, columns: Sequence[str], box: Box = Box(30.0, 60.0, 0.0, 30.0)) -> DataFrame:
    """The usual download: some columns, one box; both reach the scan."""
    near = F.col("dec_gal") <= box.dec_max
    return df.where(near & F.col("ra_gal").between(box.ra_min, box.ra_max)).select(*columns)


def load_rate_curve(spark: SparkSession, path: str, columns: Sequence[str] = ("x", "rate")) -> DataFrame:
    """A white-space separated table of numbers with # comments."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"#.*", "")).alias("line")).where("line != ''")
    parts = F.split("line", r"\s+")
    return lines.select(*[F.get(parts, F.lit(i)).cast("double").alias(c) for i, c in enumerate(columns)])


def write_statistics(stats: DataFrame, path: str, mode: str = "w", survey: str = "", output: str = "", by: str | None = None) -> None:
    """Write (w) or append (a) step statistics, or nothing (n).

    by names the column of a stratum (tile, realisation): its values, after
    ``output``, tell the outputs apart, and all are one append.
    """
    if mode not in ("n", "w", "a"):
        raise ValueError("mode must be n, w or a")
    if mode != "n":
        label = F.concat(F.lit(output), F.col(by).cast("string")) if by else F.lit(output)
        labelled = stats.select(F.lit(survey).alias("survey"), label.alias("output"), "step_no", "step", "N_tot", "z_mean")
        labelled.write.mode("overwrite" if mode == "w" else "append").parquet(path)


def footprint_row(spark: SparkSession, survey: str, box: Box) -> DataFrame:
    row = [(survey, box.ra_min, box.ra_max, box.dec_min, box.dec_max, box.area)]
    return spark.createDataFrame(row, "survey string, ra_min double, ra_max double, dec_min double, dec_max double, area double")


def footprint_upsert(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Replace or add surveys by name."""
    return registry.join(new.select("survey"), "survey", "left_anti").unionByName(new)


def footprint_lookup(registry: DataFrame, survey: str) -> Box:
    """Bounds of one survey; an error if it is not registered."""
    found = registry.where(F.col("survey") == survey).limit(1).collect()
    if not found:
        raise KeyError(f"no footprint for survey {survey!r}")
    r = found[0]
    return Box(r["ra_min"], r["ra_max"], r["dec_min"], r["dec_max"])


def write_pointings(pointings: DataFrame, path: str, decimals: int = 6) -> None:
    bounds = [F.format_string(f"%.{decimals}f", c).alias(c) for c in ("ra_min", "ra_max", "dec_min", "dec_max")]
    pointings.select("pointing_id", "name", *bounds).write.mode("overwrite").csv(path, header=True)


def read_pointings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="pointing_id bigint, name string, ra_min double, ra_max double, dec_min double, dec_max double")


def pointing_nth(pointings: DataFrame, n: int) -> DataFrame:
    """The n-th tile, from 1; an error outside the grid."""
    found = pointings.where(F.col("pointing_id") == n)
    if found.isEmpty():
        raise IndexError(f"no pointing {n}")
    return found


def vstack(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def hstack(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Column concatenation on a unique key; an error if the tables do not pair one to one."""
    marked = [t.withColumn(f"_has{i}", F.lit(1)) for i, t in enumerate(tables)]
    out = reduce(lambda a, b: a.join(b, key, "full"), marked)
    marks = [f"_has{i}" for i in range(len(tables))]
    # one pass over one join: a row that lacks a mark has no partner, a key of two rows is not unique
    n, keys, *paired = out.agg(F.count("*"), F.count_distinct(key), *[F.count(m) for m in marks]).first()
    if {n} != {keys, *paired}:
        raise ValueError("tables do not pair one to one")
    return out.drop(*marks)


def split_rows(df: DataFrame, n: int, key: str, name: str = "chunk") -> DataFrame:
    """Add a chunk number by a hash of the key: no shuffle, and stable when rows are added."""
    return df.withColumn(name, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
