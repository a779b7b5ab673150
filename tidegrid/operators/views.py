"""Serving views that follow new forecasts: partial aggregates by station and hour of day, merged into every view.

The store holds predictions and partials in folders by bucket of station. New forecasts change the buckets of their stations alone:
those are read, the new hours take the place of old ones, the stations' partials are made again, and the buckets written anew. A run that
broke off is repeated with the same forecasts. Views are sums over partials, never over predictions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions import labels
from tidegrid.operators.serving import HIGH_DEMAND
from tidegrid.sources.scratch import discard, exists, saved

#: Folders that stations are dealt to.
BUCKETS = 64
KEY = ("station_id", "forecast_hour")


def bucket_of(station: str = "station_id") -> Column:
    return F.pmod(F.xxhash64(station), F.lit(BUCKETS)).cast("int")


def partials(predictions: DataFrame) -> DataFrame:
    """A row a station and hour of day, from which all of A26 to A29 can be merged."""
    p = F.col("predicted_demand")
    first = F.max_by("forecast_hour", F.struct(p, -F.unix_seconds(F.col("forecast_hour").cast("timestamp"))))
    return predictions.groupBy("station_id", F.hour("forecast_hour").alias("hour_of_day")).agg(
        F.count(p).alias("n"), F.sum(p).alias("total"), F.max(p).alias("most"), first.alias("most_at"), F.min("forecast_hour").alias("first_hour"), F.min_by("model_version", "forecast_hour").alias("model_version")
    )


def _rewrite(rows: DataFrame, path: str, what: str) -> None:
    """Stored aside first: rows come from the folders that they replace."""
    aside = saved(rows, what)
    aside.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    discard(aside)


def update(spark: SparkSession, root: str, new: DataFrame) -> list[int]:
    """Takes new forecasts (station_id, forecast_hour, predicted_demand, model_version) into the store; returns the buckets that changed."""
    columns = [*KEY, "predicted_demand", "model_version"]
    new = saved(new.select(*columns, bucket_of().alias("bucket")), "new-forecasts")
    changed = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # BUCKETS at the most
    stored, kept = f"{root}/predictions", f"{root}/partials"
    rows = new.select(*columns, "bucket")
    if exists(spark, stored):
        old = spark.read.parquet(stored).where(F.col("bucket").isin(changed)).select(*columns, "bucket")
        rows = rows.unionByName(old.join(new.select(*KEY), list(KEY), "left_anti"))
    _rewrite(rows, stored, "forecasts")
    own = changed_partials(spark, root, new, changed)
    if exists(spark, kept):
        old = spark.read.parquet(kept).where(F.col("bucket").isin(changed))
        own = own.unionByName(old.join(new.select("station_id").distinct(), "station_id", "left_anti"))
    _rewrite(own, kept, "partials")
    discard(new)
    return changed


def changed_partials(spark: SparkSession, root: str, new: DataFrame, changed: list[int]) -> DataFrame:
    """The partials of the stations of new forecasts, from their buckets of the store."""
    rows = spark.read.parquet(f"{root}/predictions").where(F.col("bucket").isin(changed)).join(new.select("station_id").distinct(), "station_id", "left_semi")
    return partials(rows).withColumn("bucket", bucket_of())


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/partials").drop("bucket")


def prediction_summary(parts: DataFrame) -> DataFrame:
    """A26."""
    return parts.groupBy("station_id").agg(F.round(F.sum("total") / F.sum("n"), 4).alias("mean_demand"), F.max("most").alias("max_demand"), F.round(F.sum("total"), 4).alias("total_demand"), F.min("first_hour").alias("first_hour"), F.min_by("model_version", "first_hour").alias("model_version"))


def network_demand(parts: DataFrame) -> DataFrame:
    """A27."""
    return parts.groupBy("hour_of_day").agg(F.round(F.sum("total"), 4).alias("total_demand"), F.min("first_hour").alias("first_hour"))


def station_peaks(parts: DataFrame, high: float = HIGH_DEMAND) -> DataFrame:
    """A28."""
    p = F.col("peak_demand")
    return parts.groupBy("station_id").agg(F.max("most").alias("peak_demand")).withColumns({"tier": labels.demand_tier(p), "action": labels.demand_action(p), "recommended_stock": labels.recommended_stock(p), "high_demand": p >= high})


def forecast_summary(parts: DataFrame) -> DataFrame:
    """A29."""
    first = F.max_by("most_at", F.struct("most", -F.unix_seconds(F.col("most_at").cast("timestamp"))))
    return parts.groupBy("station_id").agg(F.max("most").alias("peak"), F.round(F.sum("total") / F.sum("n"), 6).alias("average"), first.alias("peak_hour"))
