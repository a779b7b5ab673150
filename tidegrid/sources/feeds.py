"""Landed JSON feeds of stations and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATIONS = "data struct<stations: array<struct<station_id: string, name: string, short_name: string, lat: double, lon: double, capacity: int, region_id: string, rental_methods: array<string>>>>"
WEATHER = "hourly struct<time: array<string>, temperature_2m: array<double>, precipitation: array<double>, windspeed_10m: array<double>, relativehumidity_2m: array<double>, weathercode: array<int>>"


def read_stations(spark: SparkSession, path: str, fetched_at: str | None = None) -> DataFrame:
    """Eight fields a station, its rental methods joined by commas."""
    rows = spark.read.schema(STATIONS).option("multiLine", True).json(path).select(F.explode("data.stations").alias("s"))
    at = F.lit(fetched_at).cast("timestamp") if fetched_at else F.current_timestamp()
    return rows.select("s.station_id", F.col("s.name").alias("station_name"), "s.short_name", "s.lat", "s.lon", "s.capacity", "s.region_id", F.concat_ws(",", "s.rental_methods").alias("rental_methods"), at.alias("fetched_at"))


def read_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parallel arrays, of any number of batches, as one row an hour."""
    h = spark.read.schema(WEATHER).option("multiLine", True).json(path).select("hourly.*")
    rows = h.select(F.explode(F.arrays_zip("time", "temperature_2m", "precipitation", "windspeed_10m", "relativehumidity_2m", "weathercode")).alias("r"))
    named = {"temperature_2m": "temperature_c", "precipitation": "precipitation_mm", "windspeed_10m": "wind_speed_kmh", "relativehumidity_2m": "humidity_pct", "weathercode": "weather_code"}
    return rows.select(F.col("r.time").cast("timestamp_ntz").alias("hour"), *(F.col(f"r.{k}").alias(v) for k, v in named.items())).dropDuplicates(["hour"])
