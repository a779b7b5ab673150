"""The domain's tables, read from the tables at hand: events are trips, customers are stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.times import floor_hour, local_time
from tidegrid.operators import features, panel


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def trips(spark: SparkSession, d: str, repeats: bool = False) -> DataFrame:
    """Events as trips; with repeats, purchases come a second time, a second later."""
    e = table(spark, d, "events")
    if repeats:
        again = e.where("event_type = 'purchase'").withColumn("ts", F.col("ts") + F.expr("interval 1 second"))
        e = e.unionByName(again)
    seconds = F.floor(F.col("value") * 60).cast("int")
    return e.select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("rideable_type"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("ended_at"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("start_station_name"),
        F.col("user_id").cast("string").alias("start_station_id"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("end_station_id"),
        (F.col("value") / 1000 + 42).alias("start_lat"),
        (F.col("value") / -1000 - 71).alias("start_lng"),
        F.when(F.col("user_id") % 2 == 0, "Member ").otherwise("casual").alias("member_casual"),
    )


def demand_panel(spark: SparkSession, d: str) -> DataFrame:
    return panel.hourly_demand(trips(spark, d))


def weather(spark: SparkSession, d: str) -> DataFrame:
    """Hours with errors have weather; the others are gaps."""
    e = table(spark, d, "events").where("event_type = 'error'").groupBy(floor_hour(local_time("ts")).alias("hour"))
    v, n = F.col("value"), F.count("*")
    return e.agg(
        F.round(F.avg(v) / 7 - 5, 4).alias("temperature_c"),
        F.round(F.greatest(F.lit(0.0), F.max(v) / 70 - 1), 4).alias("precipitation_mm"),
        F.round(F.min(v) / 10, 4).alias("wind_speed_kmh"),
        (40 + n).cast("double").alias("humidity_pct"),
        (n % 3).cast("int").alias("weather_code"),
    )


def stations(spark: SparkSession, d: str) -> DataFrame:
    """Customers; every tenth is missing from the feed."""
    c = table(spark, d, "customer").where("c_custkey % 10 != 7")
    return c.select(F.col("c_custkey").cast("string").alias("station_id"), F.col("c_name").alias("station_name"), (F.col("c_nationkey") + 5).cast("int").alias("capacity"), F.col("c_mktsegment").alias("station_type"), F.when(F.col("c_nationkey") > 2, F.col("c_nationkey").cast("string")).alias("region_id"))


def places(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Vectors as places: even ones stand for trip stations, odd ones for the feed."""
    e = table(spark, d, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("lat"), F.get("embedding", F.lit(1)).cast("double").alias("lon"))
    return e.where("vec_id % 2 = 0").select(F.col("vec_id").cast("string").alias("start_station_id"), "lat", "lon"), e.where("vec_id % 2 = 1").select(F.col("vec_id").cast("string").alias("station_id"), "lat", "lon", F.lit(10).alias("capacity"))


def matrix(spark: SparkSession, d: str) -> DataFrame:
    feed = stations(spark, d).select(F.col("station_id").alias("start_station_id"), "capacity")
    return features.demand_matrix(panel.station_hours(trips(spark, d)), weather(spark, d), feed, features.holiday_calendar(spark))


def naive_scores(spark: SparkSession, d: str) -> DataFrame:
    """The matrix with y and p of the naive forecaster."""
    return matrix(spark, d).withColumns({"y": F.col("demand_count").cast("double"), "p": F.col("demand_lag_24h")})


def history_scores(spark: SparkSession, d: str) -> DataFrame:
    """The same from the panel alone, for queries without weather and stations."""
    points = panel.filled(panel.station_series(panel.station_hours(trips(spark, d))))
    return panel.with_time_features(features.with_series_history(points)).withColumns({"y": F.col("demand_count").cast("double"), "p": F.col("demand_lag_24h")})


def predictions(spark: SparkSession, d: str) -> DataFrame:
    h = history_scores(spark, d)
    return h.select(F.col("start_station_id").alias("station_id"), F.col("hour").alias("forecast_hour"), F.col("rolling_avg_24h").alias("raw"), F.round("rolling_avg_24h", 4).alias("predicted_demand"), F.lit("naive-1").alias("model_version"), F.col("y").alias("actual_demand"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").cast("long").alias("run_id"), (F.abs("s_acctbal") / 1000).alias("val_rmse"), F.when(F.col("s_nationkey") % 2 == 0, "approved").otherwise("rejected").alias("status"), F.col("s_suppkey").alias("started_at"), F.when(F.col("s_suppkey") == 3, "champion").alias("alias"))


def halves(df: DataFrame, at: str, bound: str) -> tuple[DataFrame, DataFrame]:
    mark = F.lit(bound).cast("timestamp_ntz")
    return df.where(F.col(at) < mark), df.where(F.col(at) >= mark)
