"""Tables in ranges of a column: one range exchange, kept as a checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import checkpointed

#: Bits of a row's number inside its partition in monotonically_increasing_id.
ROW_BITS = 33


def tie_breaker(df: DataFrame) -> Column:
    """A hash of the whole row (maps, which have none, left out)."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def ranged(df: DataFrame, order: str, parts: int | None = None) -> DataFrame:
    """df with _part and _local: parts rise with order (nulls first, then a hash of the row), rows are numbered from 0 inside them.

    Spark's range partitioner cuts the parts, so a value that many rows share
    is split by the hash. The numbers are those of one evaluation: it is
    checkpointed, and what is derived from it agrees.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first, tie = F.asc_nulls_first(f"`{order}`"), F.asc("_tie")
    keyed = df.withColumn("_tie", tie_breaker(df)).repartitionByRange(n, first, tie).sortWithinPartitions(first, tie)
    at = F.col("_at")
    return checkpointed(keyed.withColumn("_at", F.monotonically_increasing_id()).select(*[F.col(f"`{c}`") for c in df.columns], F.shiftright(at, ROW_BITS).cast("int").alias("_part"), at.bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_local")))
