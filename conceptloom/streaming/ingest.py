"""Streams of arriving units and relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, folder: str, like: DataFrame, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files that appear in a folder, with the schema of a table already there."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_arrivals(stream: DataFrame, key: str, at: str, late: str = "30 days") -> DataFrame:
    """Each key once, however often its row is delivered within the allowed lateness."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def arrivals_by_window(stream: DataFrame, at: str, window: str, *keys: str, late: str = "30 days") -> DataFrame:
    """Rows per window of time and key; a window is final once the watermark has passed it."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("since"), F.col("window.end").alias("until"), *keys, "n")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a table, exactly once, and end when all that is there is read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
