"""Sky boxes, equal-area tilings and the assignment of rows to tiles."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """Bounds in degrees; ra_min > ra_max crosses RA 0."""

    ra_min: float
    ra_max: float
    dec_min: float
    dec_max: float

    def __post_init__(self):
        if not (-90 <= self.dec_min < self.dec_max <= 90):
            raise ValueError("declination bounds must rise within [-90, 90]")
        if not (0 <= self.ra_min <= 360 and 0 <= self.ra_max <= 360) or self.ra_min == self.ra_max:
            raise ValueError("right ascension bounds must differ and lie in [0, 360]")

    @property
    def width(self) -> float:
        return self.ra_max - self.ra_min + 360.0 * (self.ra_max < self.ra_min)

    @property
    def area(self) -> float:
        """Square degrees."""
        return self.width * math.degrees(math.sin(math.radians(self.dec_max)) - math.sin(math.radians(self.dec_min)))


def footprint_area(ra_min: Column, ra_max: Column, dec_min: Column, dec_max: Column) -> Column:
    width = ra_max - ra_min + F.when(ra_max < ra_min, 360.0).otherwise(0.0)
    return width * F.degrees(F.sin(F.radians(dec_max)) - F.sin(F.radians(dec_min)))


def next_dec(area: Column, width: Column, dec: Column) -> Column:
    """Upper edge of a tile of given area and RA width that starts at dec, clamped to the poles."""
    edge = area / F.degrees(F.lit(1.0)) / width + F.sin(F.radians(dec))
    return F.degrees(F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), edge))))


def in_box(ra: Column, dec: Column, box: Box) -> Column:
    """Inside the box, bounds included; plain comparisons, so they reach the scan."""
    inside = ra.between(box.ra_min, box.ra_max) if box.ra_min < box.ra_max else (ra >= box.ra_min) | (ra <= box.ra_max)
    return inside & dec.between(box.dec_min, box.dec_max)


def sky_box(df: DataFrame, box: Box, ra: str = "ra_gal", dec: str = "dec_gal") -> DataFrame:
    return df.where(in_box(F.col(ra), F.col(dec), box))


def pointing_name(prefix: str, ra_min: Column, ra_max: Column, dec_min: Column, dec_max: Column) -> Column:
    """prefix_RA_DEC of the centre, one decimal, with p for the point and m for the minus sign."""
    centre = F.pmod((ra_min + ra_max + F.when(ra_max < ra_min, 360.0).otherwise(0.0)) / 2, F.lit(360.0))

    def coded(x: Column) -> Column:
        return F.replace(F.replace(F.format_string("%.1f", x), F.lit("."), F.lit("p")), F.lit("-"), F.lit("m"))

    return F.concat_ws("_", F.lit(prefix), coded(centre), coded((dec_min + dec_max) / 2))


def pointing_grid(spark: SparkSession, box: Box, n_ra: int, n_dec: int, prefix: str = "tile") -> DataFrame:
    """n_ra * n_dec equal-area tiles, numbered from 1, the right ascension running fastest."""
    if n_ra < 1 or n_dec < 1:
        raise ValueError("the grid needs at least one tile each way")
    step, low = box.width / n_ra, math.sin(math.radians(box.dec_min))
    rise = (math.sin(math.radians(box.dec_max)) - low) / n_dec
    i, j = F.col("id") % n_ra, F.floor(F.col("id") / n_ra)

    def ra(k: Column) -> Column:
        raw = box.ra_min + k * step
        return F.when(raw > 360.0, raw - 360.0).otherwise(raw)

    def dec(k: Column) -> Column:
        return F.degrees(F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), low + k * rise))))

    grid = spark.range(n_ra * n_dec).select((F.col("id") + 1).alias("pointing_id"), ra(i).alias("ra_min"), ra(i + 1).alias("ra_max"), dec(j).alias("dec_min"), dec(j + 1).alias("dec_max"))
    bounds = [F.col(c) for c in ("ra_min", "ra_max", "dec_min", "dec_max")]
    return grid.select("pointing_id", pointing_name(prefix, *bounds).alias("name"), *bounds)


def grid_index(ra: Column, dec: Column, box: Box, n_ra: int, n_dec: int) -> Column:
    """pointing_id of a position on the grid by arithmetic, no join; null outside. Upper box edges belong to the last tile."""
    low = math.sin(math.radians(box.dec_min))
    rise = (math.sin(math.radians(box.dec_max)) - low) / n_dec
    i = F.least(F.floor(F.pmod(ra - box.ra_min, F.lit(360.0)) / (box.width / n_ra)), F.lit(n_ra - 1))
    j = F.least(F.floor((F.sin(F.radians(dec)) - low) / rise), F.lit(n_dec - 1))
    return F.when(in_box(ra, dec, box), (j * n_ra + i + 1).cast("bigint"))


def assign_pointing(df: DataFrame, pointings: DataFrame, ra: str = "ra_gal", dec: str = "dec_gal", cell: float = 1.0) -> DataFrame:
    """Rows with the pointing_id of every tile of arbitrary bounds that holds them (lower edges in, upper out).

    A range join as an equi-join: tiles are spread over the cells of one degree
    each way that they touch, so a row meets only tiles of its own cell.
    """
    around = math.ceil(360 / cell)
    place = lambda x: F.pmod(F.floor(x / cell), F.lit(around))
    wraps = F.col("ra_min") > F.col("ra_max")
    last = F.col("ra_max") + F.when(wraps, 360.0).otherwise(0.0)
    tiles = pointings.select("pointing_id", "ra_min", "ra_max", "dec_min", "dec_max")
    tiles = tiles.withColumn("strip", F.explode(F.sequence(F.floor(F.col("dec_min") / cell), F.floor(F.col("dec_max") / cell))))
    tiles = tiles.withColumn("column", F.explode(F.array_distinct(F.transform(F.sequence(F.floor(F.col("ra_min") / cell), F.floor(last / cell)), lambda k: F.pmod(k, F.lit(around))))))
    rows = df.withColumns({"strip": F.floor(F.col(dec) / cell), "column": place(F.col(ra))})
    inside = F.when(wraps, (F.col(ra) >= F.col("ra_min")) | (F.col(ra) < F.col("ra_max"))).otherwise((F.col(ra) >= F.col("ra_min")) & (F.col(ra) < F.col("ra_max")))
    joined = rows.join(tiles, ["strip", "column"]).where(inside & (F.col(dec) >= F.col("dec_min")) & (F.col(dec) < F.col("dec_max")))
    return joined.select(*df.columns, "pointing_id")
