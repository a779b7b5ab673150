"""Features of the panel: history, cycles, weather, capacity, holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.labels import holiday_type
from tidegrid.functions.times import cyclical
from tidegrid.operators import panel as panels

LAGS = {"demand_lag_1h": 1, "demand_lag_24h": 24, "demand_lag_168h": 168}
ROLLING = {"rolling_avg_3h": 3, "rolling_avg_6h": 6, "rolling_avg_24h": 24}
WEATHER = ("temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "weather_code")
CAPACITY_DEFAULT = 17

# Fixed values: (date, name) of the holidays of two years.
HOLIDAYS = [
    ("2023-01-01", "New Year's Day"), ("2023-01-16", "Martin Luther King Jr. Day"), ("2023-02-20", "Presidents Day"), ("2023-04-17", "Patriots Day (MA)"),
    ("2023-05-29", "Memorial Day"), ("2023-06-19", "Juneteenth"), ("2023-07-04", "Independence Day"), ("2023-09-04", "Labor Day"),
    ("2023-10-09", "Columbus Day"), ("2023-11-10", "Veterans Day"), ("2023-11-23", "Thanksgiving"), ("2023-12-25", "Christmas"),
    ("2024-01-01", "New Year's Day"), ("2024-01-15", "Martin Luther King Jr. Day"), ("2024-02-19", "Presidents Day"), ("2024-04-15", "Patriots Day (MA)"),
    ("2024-05-27", "Memorial Day"), ("2024-06-19", "Juneteenth"), ("2024-07-04", "Independence Day"), ("2024-09-02", "Labor Day"),
    ("2024-10-14", "Columbus Day"), ("2024-11-11", "Veterans Day"), ("2024-11-28", "Thanksgiving"), ("2024-12-25", "Christmas"),
]


def history() -> Window:
    return Window.partitionBy("start_station_id").orderBy("hour")


def with_history(panel: DataFrame) -> DataFrame:
    """All six share one sort by station and hour. What is missing is 0."""
    w = history()
    lags = {name: F.coalesce(F.lag("demand_count", n).over(w).cast("double"), F.lit(0.0)) for name, n in LAGS.items()}
    means = {name: F.coalesce(F.avg("demand_count").over(w.rowsBetween(-n, -1)), F.lit(0.0)) for name, n in ROLLING.items()}
    return panel.withColumns(lags | means)


def with_series_history(filled: DataFrame) -> DataFrame:
    """W01 and W02 of panel.filled: differences of the station's own running sums, so no window sorts the rows."""
    before = panels.trips_before
    lags = {name: (before(n) - before(n + 1)).cast("double") for name, n in LAGS.items()}
    means = {name: F.when(F.col("_i") == 0, F.lit(0.0)).otherwise((before(1) - before(n + 1)).cast("double") / F.least(F.col("_i"), F.lit(n))) for name, n in ROLLING.items()}
    return filled.withColumns(lags | means).drop("_upto", "_i")


def with_cycles(panel: DataFrame) -> DataFrame:
    """P08."""
    c = F.col
    return panel.withColumns(cyclical("hour", c("hour_of_day"), 24) | cyclical("dow", c("day_of_week"), 7) | cyclical("month", c("month"), 12))


def with_weather_flags(weather: DataFrame) -> DataFrame:
    """P09."""
    t = F.col("temperature_c")
    return weather.withColumns({"is_precipitation": (F.col("precipitation_mm") > 0).cast("int"), "is_cold": (t < 10).cast("int"), "is_hot": (t > 25).cast("int"), "feels_like_c": t - 0.2 * F.col("wind_speed_kmh")})


def filled_weather(weather: DataFrame, demand: DataFrame, columns: tuple[str, ...] = WEATHER) -> DataFrame:
    """The weather of every hour between demand's first and last (the panel, or the counts that it is made of), gaps filled forward, then backward. The timeline is one city's hours (8,766 a
    year, whatever the number of trips), so one ordered window over it is bounded; it is filled before the join, where a fill would
    run from one station's last hour into the next station's first."""
    bounds = demand.agg(F.min("hour").alias("_a"), F.max("hour").alias("_b"))
    hours = bounds.select(F.explode(F.expr("sequence(_a, _b, interval 1 hour)")).alias("weather_hour"))
    order = Window.orderBy("weather_hour")
    known, ahead = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    joined = hours.join(weather.withColumnRenamed("hour", "weather_hour"), "weather_hour", "left")
    return joined.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(known), F.first(c, ignorenulls=True).over(ahead)) for c in columns})


def join_weather(panel: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather (weather_hour, ...) is hours of one city (8,766 a year, whatever the number of trips), so it is broadcast and the
    panel stays where it is."""
    return panel.join(F.broadcast(weather), panel["hour"] == weather["weather_hour"], "left").drop("weather_hour")


def join_capacity(panel: DataFrame, stations: DataFrame, default: int = CAPACITY_DEFAULT) -> DataFrame:
    """Stations (start_station_id, capacity); a station without one has the exact median, cut to an integer."""
    median = stations.agg(F.coalesce(F.floor(F.median("capacity")), F.lit(default)).cast("int").alias("_median"))
    joined = panel.join(stations.select("start_station_id", "capacity"), "start_station_id", "left").crossJoin(F.broadcast(median))
    return joined.withColumn("capacity", F.coalesce("capacity", "_median").cast("int")).drop("_median")


def holiday_calendar(spark, rows: list[tuple[str, str]] = HOLIDAYS) -> DataFrame:
    """Date, holiday, year, holiday_type, is_holiday."""
    cells = F.array(*(F.struct(F.lit(day).alias("day"), F.lit(name).alias("holiday")) for day, name in rows))
    days = spark.range(1).select(F.inline(cells)).select(F.to_date("day").alias("date"), "holiday")
    return days.withColumns({"year": F.year("date"), "holiday_type": holiday_type(F.col("holiday")), "is_holiday": F.lit(1)})


def join_holidays(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """J03, P12."""
    days = calendar.select("date", "is_holiday").dropDuplicates(["date"])
    return panel.join(F.broadcast(days), "date", "left").withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))


def feature_matrix(panel: DataFrame, weather: DataFrame, stations: DataFrame, calendar: DataFrame, demand: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """The panel with every feature of the contract. demand: a smaller table with the panel's first and last hour, such as
    panel.station_hours; a panel that is not stored would be computed twice without it. ordered: by station and hour, in ranges of stations that
    the panel is dealt to while it is narrow."""
    filled = with_weather_flags(filled_weather(weather, panel if demand is None else demand))
    narrow = join_capacity(panel, stations)  # by station, as history is
    if ordered:
        tasks = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        narrow = narrow.repartitionByRange(tasks, "start_station_id").sortWithinPartitions("start_station_id", "hour")
    return with_cycles(join_holidays(join_weather(with_history(narrow), filled), calendar))


def demand_matrix(demand: DataFrame, weather: DataFrame, stations: DataFrame, calendar: DataFrame) -> DataFrame:
    """C02 and C04 from panel.station_hours: what belongs to a station is joined to its series; what belongs to an hour is made once an hour and
    broadcast. The rows of the panel, once made, are shuffled and sorted no more."""
    hours = with_weather_flags(filled_weather(weather, demand)).withColumnRenamed("weather_hour", "hour")
    hours = with_cycles(join_holidays(panels.with_time_features(hours), calendar))
    rows = with_series_history(panels.filled(join_capacity(panels.station_series(demand), stations)))
    return rows.join(F.broadcast(hours), "hour")
