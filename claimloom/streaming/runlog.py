"""The run log as a stream. An addition: the batch engine works without it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "log_date string, timestamp_utc string, event string, run_id string, status string, mode string, profile string"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """The ends of runs."""
    return spark.readStream.schema(EVENT).json(path).where("event <> 'run_started'").withColumn("at", F.try_to_timestamp("timestamp_utc"))


def status_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Runs by day and status; a day is closed when the watermark has passed it."""
    return events.withWatermark("at", late).groupBy(F.window("at", "1 day").alias("day"), "status").agg(F.count(F.lit(1)).alias("n"))


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Closed days, appended as they close, each written once."""
    flat = counts.select(F.col("day.start").cast("date").alias("day"), "status", "n")
    return flat.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
