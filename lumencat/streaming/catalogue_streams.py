"""Streams: the row-wise operators are stateless and apply as they are; step statistics are kept as running sums."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def read_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def running_statistics(stream: DataFrame, steps: Mapping[str, Column], z: str = "z_cgal_v") -> DataFrame:
    """step, N_tot, z_mean over all rows so far (complete or update mode); state is one row for each step."""
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("step"), s.alias("kept")) for name, s in steps.items()])).alias("cell")
    rows = stream.select(F.col(z).alias("z"), cells).select("z", "cell.*").where("kept")
    return rows.groupBy("step").agg(F.count("*").alias("N_tot"), F.avg("z").alias("z_mean"))


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by time window and key with a watermark for late rows."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"))


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows to files, exactly once for each checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
