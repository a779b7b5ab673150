"""Structured Streaming forms of two batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.sources.store import scratch


def streaming_demand(events: DataFrame, at: str = "started_at", delay: str = "2 hours") -> DataFrame:
    """Pickups by station and hour; an event later than the watermark is dropped."""
    own = events.withColumn("_at", F.col(at).cast("timestamp"))
    counted = own.withWatermark("_at", delay).groupBy(F.window("_at", "1 hour"), "start_station_id").agg(F.count("*").alias("demand_count"))
    return counted.select("start_station_id", F.col("window.start").cast("timestamp_ntz").alias("hour"), "demand_count")


def streaming_performance(log: DataFrame, at: str = "forecast_hour", delay: str = "1 day") -> DataFrame:
    """Errors over seven days, each day anew."""
    off = F.col("predicted_demand") - F.col("actual_demand")
    own = log.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
    rolled = own.groupBy(F.window("_at", "7 days", "1 day")).agg(F.count("*").alias("n"), F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"))
    return rolled.select(F.col("window.start").cast("timestamp_ntz").alias("first_day"), "n", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


def with_actuals(predictions: DataFrame, actuals: DataFrame, delay: str = "1 day") -> DataFrame:
    """J13 of two streams: predictions (station_id, forecast_hour, predicted_demand) meet actuals (station_id, hour, actual_demand) of their
    hour, whichever comes first. A row waits in state until the watermarks of both have passed its hour, no longer."""
    p = predictions.select("station_id", F.col("forecast_hour").cast("timestamp").alias("_at"), "predicted_demand").withWatermark("_at", delay)
    a = actuals.select(F.col("station_id").alias("_station"), F.col("hour").cast("timestamp").alias("_hour"), "actual_demand").withWatermark("_hour", delay)
    return p.join(a, (F.col("station_id") == F.col("_station")) & (F.col("_at") == F.col("_hour"))).select("station_id", "_at", "predicted_demand", "actual_demand")


def streaming_errors(predictions: DataFrame, actuals: DataFrame, delay: str = "1 day") -> DataFrame:
    """X02 from two streams: errors over seven days, each day anew, of the predictions whose actual has come."""
    off = F.col("predicted_demand") - F.col("actual_demand")
    rolled = with_actuals(predictions, actuals, delay).groupBy(F.window("_at", "7 days", "1 day")).agg(F.count(off).alias("n"), F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"))
    return rolled.select(F.col("window.start").cast("timestamp_ntz").alias("first_day"), "n", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


def drained(stream: DataFrame, what: str) -> DataFrame:
    """What a stream appends until its source has no more: written, with its checkpoint, to the shared folder."""
    root = scratch(stream.sparkSession, what)
    run = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")
