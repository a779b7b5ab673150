"""The registered queries: each applies an operator to whole tables. SQL gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import streaming
from tidegrid.functions import labels
from tidegrid.operators import clean, drift, features, gates, metrics, ml, panel, quality, serving, slices, stations
from tidegrid.plans import domain
from tidegrid.plans.oracle import sql
from tidegrid.sources import store
from tidegrid.sources.scratch import saved

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
SPLIT = "2024-01-16"  # the events cover one month
BOUNDS = ("2024-01-11", "2024-01-21")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


def dated(df: DataFrame) -> DataFrame:
    """Dates as text, which every reader of a result shows alike."""
    return df.select(*(F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes))


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes))


# Cleaning


@query(sql("""SELECT ride_id, lower(trim(rideable_type)) AS rideable_type, started_at, secs AS trip_duration_seconds, round(secs / 60, 6) AS trip_duration_minutes, lower(trim(member_casual)) AS member_casual,
  CAST(hour(started_at) AS INTEGER) AS hour, CAST(isodow(started_at) AS INTEGER) AS day_of_week, CAST(month(started_at) AS INTEGER) AS month, CAST(year(started_at) AS INTEGER) AS year, CAST(CAST(started_at AS DATE) AS VARCHAR) AS date
  FROM flagged WHERE n = 1 AND NOT missing AND secs BETWEEN 60 AND 86400""", "flagged"))
def clean_trips(spark: SparkSession, d: str) -> DataFrame:
    out = clean.clean_trips(domain.trips(spark, d, repeats=True))
    return rounded(out.select("ride_id", "rideable_type", "started_at", "trip_duration_seconds", "trip_duration_minutes", "member_casual", "hour", "day_of_week", "month", "year", "date"))


@query(sql("""SELECT count(*) AS n_raw, count(*) FILTER (n > 1) AS n_duplicate, count(*) FILTER (n = 1 AND missing) AS n_missing, count(*) FILTER (n = 1 AND NOT missing AND NOT secs BETWEEN 60 AND 86400) AS n_duration,
  count(*) FILTER (n = 1 AND NOT missing AND secs BETWEEN 60 AND 86400) AS n_kept, round(100.0::DOUBLE * count(*) FILTER (n = 1 AND NOT missing AND secs BETWEEN 60 AND 86400) / count(*), 4) AS retention_pct FROM flagged""", "flagged"))
def cleaning_waterfall(spark: SparkSession, d: str) -> DataFrame:
    return clean.cleaning_waterfall(domain.trips(spark, d, repeats=True))


@query(sql("""SELECT column_name, null_count, round(100.0::DOUBLE * null_count / n, 4) AS null_pct FROM (
  SELECT count(*) AS n, count(*) FILTER (ride_id IS NULL) AS ride_id, count(*) FILTER (rideable_type IS NULL) AS rideable_type, count(*) FILTER (started_at IS NULL) AS started_at, count(*) FILTER (ended_at IS NULL) AS ended_at,
  count(*) FILTER (start_station_name IS NULL) AS start_station_name, count(*) FILTER (start_station_id IS NULL) AS start_station_id, count(*) FILTER (end_station_id IS NULL) AS end_station_id, count(*) FILTER (start_lat IS NULL) AS start_lat,
  count(*) FILTER (start_lng IS NULL) AS start_lng, count(*) FILTER (member_casual IS NULL) AS member_casual FROM trips)
  UNPIVOT (null_count FOR column_name IN (ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id, end_station_id, start_lat, start_lng, member_casual))""", "trips"))
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return clean.null_profile(domain.trips(spark, d))


@query(sql("SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) FILTER (n > 1) AS keys_with_duplicates FROM (SELECT ride_id, count(*) AS n FROM trips2 GROUP BY 1)", "trips2"))
def duplicate_profile(spark: SparkSession, d: str) -> DataFrame:
    return clean.duplicate_profile(domain.trips(spark, d, repeats=True))


@query(sql("SELECT ride_id, count(*) AS n FROM trips2 GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, ride_id LIMIT 5", "trips2"))
def duplicate_worst_keys(spark: SparkSession, d: str) -> DataFrame:
    return clean.worst_keys(domain.trips(spark, d, repeats=True))


@query(sql("SELECT CASE WHEN secs < 0 THEN 'negative' WHEN secs < 60 THEN 'under_1_min' WHEN secs > 86400 THEN 'over_24_h' ELSE 'normal' END AS category, count(*) AS n, round(avg(secs), 4) AS mean_seconds FROM trips GROUP BY 1", "trips"))
def duration_categories(spark: SparkSession, d: str) -> DataFrame:
    return clean.duration_categories(domain.trips(spark, d))


@query(sql("SELECT ride_id, CAST(hour(started_at) AS INTEGER) AS hour, CAST(isodow(started_at) AS INTEGER) AS day_of_week, CAST(month(started_at) AS INTEGER) AS month, CAST(year(started_at) AS INTEGER) AS year, CAST(CAST(started_at AS DATE) AS VARCHAR) AS date FROM trips", "trips"))
def trip_time_parts(spark: SparkSession, d: str) -> DataFrame:
    return dated(clean.with_time_parts(domain.trips(spark, d)).select("ride_id", "hour", "day_of_week", "month", "year", "date"))


@query(sql("SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev(value), 6) AS stddev, min(value) AS least, round(quantile_cont(value, 0.25), 6) AS q1, round(median(value), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS greatest FROM events"))
def describe_value(spark: SparkSession, d: str) -> DataFrame:
    return rounded(clean.describe(domain.table(spark, d, "events"), "value"))


@query("""SELECT 'c_custkey' AS column_name, 'left_only' AS side, false AS same_type, count(*) FILTER (c_custkey IS NULL) AS left_nulls, NULL::BIGINT AS right_nulls FROM customer
UNION ALL SELECT 'nationkey', 'common', true, count(*) FILTER (c_nationkey IS NULL), (SELECT count(*) FILTER (s_nationkey IS NULL) FROM supplier) FROM customer
UNION ALL SELECT 'name', 'common', true, count(*) FILTER (c_name IS NULL), (SELECT count(*) FILTER (s_name IS NULL) FROM supplier) FROM customer
UNION ALL SELECT 's_suppkey', 'right_only', false, NULL, count(*) FILTER (s_suppkey IS NULL) FROM supplier""")
def schema_comparison(spark: SparkSession, d: str) -> DataFrame:
    left = domain.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"))
    right = domain.table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"))
    return clean.schema_comparison(left, right)


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM (SELECT o_orderpriority FROM orders WHERE year(o_orderdate) = 1995 UNION ALL SELECT o_orderpriority FROM orders WHERE year(o_orderdate) > 1995) GROUP BY 1")
def union_years(spark: SparkSession, d: str) -> DataFrame:
    o = domain.table(spark, d, "orders")
    first, rest = o.where(F.year("o_orderdate") == 1995).drop("o_custkey"), o.where(F.year("o_orderdate") > 1995)
    return store.union_all([first, rest]).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


# Panel


@query(sql("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM panel", "panel"))
def hourly_demand(spark: SparkSession, d: str) -> DataFrame:
    return dated(domain.demand_panel(spark, d))


@query(sql("SELECT start_station_id, hour, demand_count FROM d", "d"))
def station_hours(spark: SparkSession, d: str) -> DataFrame:
    return panel.station_hours(domain.trips(spark, d))


@query(sql("SELECT min(hour) AS first_hour, max(hour) AS last_hour, count(DISTINCT start_station_id) AS stations, count(*) AS n_rows FROM d", "d"))
def demand_bounds(spark: SparkSession, d: str) -> DataFrame:
    return panel.hour_range(panel.station_hours(domain.trips(spark, d)))


@query(sql("SELECT DISTINCT start_station_id FROM d", "d"))
def distinct_stations(spark: SparkSession, d: str) -> DataFrame:
    return domain.trips(spark, d).select("start_station_id").distinct()


@query(sql("""SELECT check_name, observed, expected, observed = expected AS passed FROM (
  SELECT unnest([{'c': 'duplicates', 'o': count(*) - count(DISTINCT (start_station_id, hour)), 'e': 0}, {'c': 'nulls', 'o': count(*) FILTER (demand_count IS NULL), 'e': 0}, {'c': 'negatives', 'o': count(*) FILTER (demand_count < 0), 'e': 0},
    {'c': 'total_demand', 'o': CAST(sum(demand_count) AS BIGINT), 'e': (SELECT count(*) FROM events)}, {'c': 'grid_rows', 'o': count(*), 'e': count(DISTINCT start_station_id) * count(DISTINCT hour)}]) AS x FROM panel) t,
  LATERAL (SELECT x.c AS check_name, x.o AS observed, x.e AS expected)""", "panel"))
def panel_validation(spark: SparkSession, d: str) -> DataFrame:
    return panel.panel_checks(domain.demand_panel(spark, d), domain.trips(spark, d))


@query(sql("SELECT count(*) AS n_rows, count(*) FILTER (demand_count = 0) AS zero_rows, count(*) FILTER (demand_count <> 0) AS nonzero_rows, round(100.0::DOUBLE * count(*) FILTER (demand_count = 0) / count(*), 4) AS zero_pct FROM panel", "panel"))
def panel_sparsity(spark: SparkSession, d: str) -> DataFrame:
    return panel.sparsity(domain.demand_panel(spark, d))


# Features

CYCLES = ", ".join(f"round({f}(2 * pi() * {c} / {p}), 6) + 0 AS {n}_{f}" for n, c, p in (("hour", "hour_of_day", 24), ("dow", "day_of_week", 7), ("month", "month", 12)) for f in ("sin", "cos"))


@query(sql(f"SELECT start_station_id, hour, {CYCLES} FROM panel", "panel"))
def cyclical_encoding(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.with_cycles(domain.demand_panel(spark, d)).select("start_station_id", "hour", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"))


@query(sql("SELECT start_station_id, hour, demand_lag_1h, demand_lag_24h, demand_lag_168h FROM hist", "hist"))
def lag_features(spark: SparkSession, d: str) -> DataFrame:
    return features.with_history(domain.demand_panel(spark, d)).select("start_station_id", "hour", *features.LAGS)


@query(sql("SELECT start_station_id, hour, round(rolling_avg_3h, 6) AS rolling_avg_3h, round(rolling_avg_6h, 6) AS rolling_avg_6h, round(rolling_avg_24h, 6) AS rolling_avg_24h FROM hist", "hist"))
def rolling_averages(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.with_history(domain.demand_panel(spark, d)).select("start_station_id", "hour", *features.ROLLING))


@query(sql("SELECT hour AS weather_hour, temperature_c, precipitation_mm, wind_speed_kmh, humidity_pct, weather_code, is_precipitation, is_cold, is_hot, round(feels_like_c, 6) AS feels_like_c FROM wflags", "wflags"))
def weather_fill(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.with_weather_flags(features.filled_weather(domain.weather(spark, d), panel.station_hours(domain.trips(spark, d)))))


@query(sql("SELECT start_station_id, hour, demand_count, temperature_c, precipitation_mm, is_cold FROM panel LEFT JOIN wflags USING (hour)", "panel", "wflags"))
def enrich_weather(spark: SparkSession, d: str) -> DataFrame:
    p = domain.demand_panel(spark, d)
    w = features.with_weather_flags(features.filled_weather(domain.weather(spark, d), p))
    return features.join_weather(p, w).select("start_station_id", "hour", "demand_count", "temperature_c", "precipitation_mm", "is_cold")


@query(sql("SELECT start_station_id, hour, coalesce(s.capacity, CAST(floor(m.median) AS INTEGER)) AS capacity FROM panel LEFT JOIN stations s ON s.station_id = start_station_id CROSS JOIN (SELECT median(capacity) AS median FROM stations) m", "panel", "stations"))
def enrich_capacity(spark: SparkSession, d: str) -> DataFrame:
    feed = domain.stations(spark, d).select(F.col("station_id").alias("start_station_id"), "capacity")
    return features.join_capacity(domain.demand_panel(spark, d), feed).select("start_station_id", "hour", "capacity")


@query(sql("SELECT start_station_id, hour, CAST(holidays.date IS NOT NULL AS INTEGER) AS is_holiday FROM panel LEFT JOIN holidays ON holidays.date = panel.date", "panel", "holidays"))
def enrich_holidays(spark: SparkSession, d: str) -> DataFrame:
    return features.join_holidays(domain.demand_panel(spark, d), features.holiday_calendar(spark)).select("start_station_id", "hour", "is_holiday")


@query(sql("""SELECT CASE WHEN contains(holiday, 'Day') AND NOT contains(holiday, 'Independence') THEN 'federal_observance' WHEN holiday IN ('Thanksgiving', 'Christmas') THEN 'major_holiday' WHEN holiday = 'Independence Day' THEN 'summer_holiday' ELSE 'federal_holiday' END AS holiday_type,
  count(DISTINCT panel.date) AS holidays, count(*) AS panel_rows, CAST(sum(demand_count) AS BIGINT) AS demand FROM panel JOIN holidays ON holidays.date = panel.date GROUP BY 1""", "panel", "holidays"))
def holiday_demand(spark: SparkSession, d: str) -> DataFrame:
    """Holiday types with the panel's rows on them."""
    joined = domain.demand_panel(spark, d).join(features.holiday_calendar(spark).select("date", "holiday_type"), "date")
    return joined.groupBy("holiday_type").agg(F.countDistinct("date").alias("holidays"), F.count("*").alias("panel_rows"), F.sum("demand_count").alias("demand"))


MATRIX = ["start_station_id", "hour", "demand_count", "date", "capacity", "is_holiday", "is_weekend", "demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h", "temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "weather_code", "is_precipitation", "is_cold", "is_hot", "feels_like_c", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
DOUBLES = {"demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h", "temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "feels_like_c", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"}


@query(sql("SELECT " + ", ".join(f"round({c}, 6) + 0 AS {c}" if c in DOUBLES else f"CAST({c} AS VARCHAR) AS {c}" if c == "date" else c for c in MATRIX) + " FROM matrix", "matrix"))
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(domain.matrix(spark, d).select(*MATRIX))


CONTRACT_SQL = ", ".join(f"round({c}, 6) + 0 AS {c}" if c in DOUBLES else c for c in [*quality.FEATURES, quality.TARGET, quality.SPLIT_KEY])


@query(sql(f"SELECT {CONTRACT_SQL} FROM matrix", "matrix"))
def feature_contract(spark: SparkSession, d: str) -> DataFrame:
    return rounded(quality.contract_projection(domain.matrix(spark, d)))


@query(sql("SELECT start_station_id, hour, CAST(dense_rank() OVER (ORDER BY start_station_id) - 1 AS INTEGER) AS station_code FROM panel", "panel"))
def encode_station(spark: SparkSession, d: str) -> DataFrame:
    return ml.encode_station(domain.demand_panel(spark, d)).select("start_station_id", "hour", "station_code")


# Quality


def _range_sql() -> str:
    rows = []
    for c, (low, high) in quality.RANGES.items():
        below = f"count(*) FILTER ({c} < {low})" if low is not None else "0"
        above = f"count(*) FILTER ({c} > {high})" if high is not None else "0"
        rows.append(f"SELECT '{c}' AS column_name, CAST({below} AS BIGINT) AS below, CAST({above} AS BIGINT) AS above, round(CAST(min({c}) AS DOUBLE), 6) + 0 AS seen_min, round(CAST(max({c}) AS DOUBLE), 6) + 0 AS seen_max FROM matrix")
    return "SELECT *, below = 0 AND above = 0 AS passed FROM (" + "\nUNION ALL ".join(rows) + ")"


@query(sql(_range_sql(), "matrix"))
def range_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.range_checks(domain.matrix(spark, d))


@query(sql("SELECT column_name, status, unreadable FROM (SELECT unnest([" + ", ".join(f"{{'column_name': '{c}', 'status': 'ok', 'unreadable': count({c}) - count(TRY_CAST(CAST({c} AS VARCHAR) AS {({'int': 'BIGINT', 'float': 'DOUBLE', 'numeric': 'DOUBLE', 'string': 'VARCHAR', 'timestamp': 'TIMESTAMP'})[f]}))}}" for c, f in quality.CONTRACT.items()) + "], recursive := true) FROM matrix)", "matrix"))
def schema_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.schema_checks(domain.matrix(spark, d))


@query(sql("SELECT column_name, nulls, nulls = 0 AS passed FROM (SELECT " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in quality.CONTRACT) + " FROM matrix) UNPIVOT (nulls FOR column_name IN (" + ", ".join(quality.CONTRACT) + "))", "matrix"))
def null_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_checks(domain.matrix(spark, d), list(quality.CONTRACT))


@query(sql("SELECT CAST(count(*) - count(DISTINCT (start_station_id, hour)) AS BIGINT) AS duplicates, count(*) = count(DISTINCT (start_station_id, hour)) AS passed FROM panel", "panel"))
def duplicate_checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_check(domain.demand_panel(spark, d))


@query(sql("SELECT count(*) AS n_rows, CAST(1000000 AS BIGINT) AS least, count(*) >= 1000000 AS passed FROM panel", "panel"))
def row_count_check(spark: SparkSession, d: str) -> DataFrame:
    return quality.row_count_check(domain.demand_panel(spark, d))


@query(sql("SELECT count(*) AS n_rows, CAST(0 AS INTEGER) AS nulls, count(DISTINCT start_station_id) AS stations, min(hour) AS first_hour, max(hour) AS last_hour, round(avg(demand_count), 6) AS mean_demand, median(demand_count) AS median_demand, max(demand_count) AS max_demand, round(avg(CAST(demand_count = 0 AS INTEGER)) * 100, 4) AS zero_pct, CAST(8 + 1 - 0 AS INTEGER) AS n_columns FROM panel", "panel"))
def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.summary_stats(domain.demand_panel(spark, d))


@query(sql("""SELECT check_name, observed, expected, observed = expected AS passed FROM (SELECT unnest([{'c': 'rows', 'o': count(*), 'e': (SELECT count(*) FROM panel)}, {'c': 'demand', 'o': CAST(sum(demand_count) AS BIGINT), 'e': (SELECT CAST(sum(demand_count) AS BIGINT) FROM panel)},
  {'c': 'null_target', 'o': count(*) FILTER (demand_count IS NULL), 'e': 0}, {'c': 'null_keys', 'o': count(*) FILTER (start_station_id IS NULL OR hour IS NULL), 'e': 0}]) AS x FROM matrix) t, LATERAL (SELECT x.c AS check_name, x.o AS observed, x.e AS expected)""", "matrix"))
def matrix_validation(spark: SparkSession, d: str) -> DataFrame:
    return quality.matrix_checks(domain.matrix(spark, d), domain.demand_panel(spark, d))


_ROW_HASH = "CAST('0x' || substr(md5(concat_ws('|', {cells})), 1, 15) AS BIGINT)"
LINEITEM = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


@query("SELECT count(*) AS n_rows, bit_xor(h) AS hash_xor, CAST(sum(h) AS VARCHAR) AS hash_sum FROM (SELECT " + _ROW_HASH.format(cells=", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '-')" for c in LINEITEM)) + " AS h FROM lineitem)")
def dataset_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return store.fingerprint(domain.table(spark, d, "lineitem").select(*LINEITEM))


# Stations


@query(sql("SELECT start_station_id, arg_min(start_station_name, (started_at, ride_id)) AS station_name, round(median(start_lat), 6) AS lat, round(median(start_lng), 6) AS lon FROM trips GROUP BY 1", "trips"))
def station_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stations.station_profile(domain.trips(spark, d)))


NAMED = "SELECT p.start_station_id, p.station_name, s.station_id AS feed_station_id, s.capacity FROM (SELECT start_station_id, min(start_station_name) AS station_name FROM trips GROUP BY 1) p LEFT JOIN stations s USING (station_name)"


@query(sql(NAMED, "trips", "stations"))
def station_name_match(spark: SparkSession, d: str) -> DataFrame:
    return stations.match_by_name(stations.station_profile(domain.trips(spark, d)), domain.stations(spark, d)).select("start_station_id", "station_name", "feed_station_id", "capacity")


@query(sql(f"SELECT start_station_id, station_name FROM ({NAMED}) WHERE capacity IS NULL", "trips", "stations"))
def station_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return stations.unmatched(stations.match_by_name(stations.station_profile(domain.trips(spark, d)), domain.stations(spark, d))).select("start_station_id", "station_name")


PLACES = "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lon FROM embeddings"
NEAREST = """SELECT start_station_id, arg_min(feed, (m, feed)) AS feed_station_id, 10 AS capacity, round(min(m), 4) AS distance_m FROM (
  SELECT CAST(a.vec_id AS VARCHAR) AS start_station_id, CAST(b.vec_id AS VARCHAR) AS feed, sqrt(pow(a.lat - b.lat, 2) + pow(a.lon - b.lon, 2)) * 111000.0::DOUBLE AS m
  FROM places a JOIN places b ON a.vec_id % 2 = 0 AND b.vec_id % 2 = 1) WHERE m <= 500 GROUP BY 1"""


@query(sql(NEAREST, "places", places=PLACES))
def station_nearest_match(spark: SparkSession, d: str) -> DataFrame:
    trip_side, feed = domain.places(spark, d)
    return rounded(stations.nearest(trip_side, feed), 4)


@query(sql(f"""SELECT start_station_id, feed_station_id, capacity, 'name' AS matched_by FROM ({NAMED}) WHERE capacity IS NOT NULL
UNION ALL SELECT start_station_id, b.station_id, b.capacity, 'place' FROM (
  SELECT u.start_station_id, arg_min({{'station_id': s.station_id, 'capacity': s.capacity}}, (sqrt(pow(p.lat - s.lat, 2) + pow(p.lon - s.lon, 2)) * 111000.0::DOUBLE, s.station_id)) AS b
  FROM ({NAMED}) u JOIN (SELECT start_station_id, median(start_lat) AS lat, median(start_lng) AS lon FROM trips GROUP BY 1) p USING (start_station_id)
  JOIN (SELECT *, 42 + CAST(station_id AS BIGINT) % 64 * 0.004::DOUBLE AS lat, -71 - CAST(station_id AS BIGINT) % 64 * 0.004::DOUBLE AS lon FROM stations) s ON sqrt(pow(p.lat - s.lat, 2) + pow(p.lon - s.lon, 2)) * 111000.0::DOUBLE <= 500
  WHERE u.capacity IS NULL GROUP BY 1)""", "trips", "stations"))
def station_lookup(spark: SparkSession, d: str) -> DataFrame:
    """C03. The feed's stations stand along the line on which the trips' stations lie, so stations without a name match have neighbours."""
    k = F.col("station_id").cast("long") % 64 * F.lit(0.004)
    feed = domain.stations(spark, d).withColumns({"lat": 42 + k, "lon": -71 - k})
    return stations.station_lookup(domain.trips(spark, d), feed)


@query("SELECT count(*) FILTER (l AND r) AS both, count(*) FILTER (l AND NOT r) AS left_only, count(*) FILTER (r AND NOT l) AS right_only FROM (SELECT n, bool_or(l) AS l, bool_or(NOT l) AS r FROM (SELECT DISTINCT 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS n, true AS l FROM events UNION ALL SELECT c_name, false FROM customer WHERE c_custkey % 10 <> 7) GROUP BY n)")
def station_name_overlap(spark: SparkSession, d: str) -> DataFrame:
    return stations.name_overlap(domain.trips(spark, d).select(F.col("start_station_name").alias("station_name")), domain.stations(spark, d))


@query(sql("SELECT count(*) AS trips, count(*) FILTER (station_id IS NULL) AS unmatched_trips, count(DISTINCT start_station_id) AS stations, count(DISTINCT CASE WHEN station_id IS NULL THEN start_station_id END) AS unmatched_stations FROM trips LEFT JOIN stations ON station_id = start_station_id", "trips", "stations"))
def station_direct_join(spark: SparkSession, d: str) -> DataFrame:
    return stations.direct_join(domain.trips(spark, d), domain.stations(spark, d))


# Slices


@query(sql("SELECT * FROM stats", "stats"))
def slice_stats(spark: SparkSession, d: str) -> DataFrame:
    return slices.slice_stats(domain.matrix(spark, d), labels.data_slices())


DISPARITY = "SELECT slice_name, CASE WHEN count(*) FILTER (mean_demand > 0) >= 2 THEN round(max(mean_demand) FILTER (mean_demand > 0) / min(mean_demand) FILTER (mean_demand > 0), 2) ELSE 1.0 END AS disparity_ratio, count(*) AS n_groups FROM stats GROUP BY 1"


@query(sql(DISPARITY, "stats"))
def slice_disparity(spark: SparkSession, d: str) -> DataFrame:
    return slices.slice_disparity(slices.slice_stats(domain.matrix(spark, d), labels.data_slices()))


@query(sql(f"SELECT slice_name, 'disparity' AS flag, NULL::VARCHAR AS group_name, disparity_ratio AS value FROM ({DISPARITY}) WHERE disparity_ratio > 1.2 UNION ALL SELECT slice_name, 'representation', group_name, representation_pct FROM stats WHERE representation_pct < 30", "stats"))
def slice_flags(spark: SparkSession, d: str) -> DataFrame:
    """With bounds that one even month of events meets; the defaults are 5.0 and 2.0."""
    return slices.slice_flags(slices.slice_stats(domain.matrix(spark, d), labels.data_slices()), 1.2, 30.0)


@query(sql("SELECT slice_name, arg_max(group_name, (mean_demand, group_name)) AS most, arg_min(group_name, (mean_demand, group_name)) AS least, max(s) AS largest_share_pct, min(s) AS smallest_share_pct FROM (SELECT *, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY slice_name), 2) AS s FROM stats) GROUP BY 1", "stats"))
def bias_display(spark: SparkSession, d: str) -> DataFrame:
    return slices.bias_display(slices.slice_stats(domain.matrix(spark, d), labels.data_slices()))


@query(sql("SELECT * FROM errors", "errors"))
def slice_errors(spark: SparkSession, d: str) -> DataFrame:
    return slices.slice_errors(domain.naive_scores(spark, d), labels.model_slices())


ERROR_REPORT = "SELECT slice_name, disparity_ratio, eligible_groups, CASE WHEN disparity_ratio IS NULL THEN 'SKIPPED' WHEN disparity_ratio > 1.05 THEN 'FAILED' ELSE 'PASSED' END AS status, NULL::VARCHAR AS override_reason FROM (SELECT slice_name, CASE WHEN count(*) FILTER (n >= 1000 AND rmse > 0) >= 2 THEN round(max(rmse) FILTER (n >= 1000) / min(rmse) FILTER (n >= 1000 AND rmse > 0), 4) END AS disparity_ratio, count(*) FILTER (n >= 1000 AND rmse > 0) AS eligible_groups FROM errors GROUP BY 1)"


@query(sql(ERROR_REPORT, "errors"))
def error_disparity(spark: SparkSession, d: str) -> DataFrame:
    return slices.error_disparity(slices.slice_errors(domain.naive_scores(spark, d), labels.model_slices()), max_ratio=1.05)


_W = "coalesce((SELECT least(3.0, greatest(1.0, e.rmse / (SELECT rmse FROM alle))) FROM errors e JOIN rep USING (slice_name) WHERE status = 'FAILED' AND slice_name = '{}' AND group_name = ns.{}), 1.0)"
_L = {
    "time_of_day": "CASE WHEN hour_of_day IN (7, 8, 9, 17, 18, 19) THEN 'peak' WHEN hour_of_day >= 21 OR hour_of_day <= 6 THEN 'night' ELSE 'off_peak' END",
    "day_type": "CASE WHEN is_holiday = 1 THEN 'holiday' WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END",
    "station_capacity": "CASE WHEN capacity <= 10 THEN 'low' WHEN capacity <= 20 THEN 'mid' ELSE 'high' END",
    "precipitation": "CASE WHEN precipitation_mm > 0 THEN 'rainy' ELSE 'dry' END",
    "temperature": "CASE WHEN temperature_c < 10 THEN 'cold' WHEN temperature_c > 25 THEN 'hot' ELSE 'mild' END",
    "season": "CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month <= 5 THEN 'spring' WHEN month <= 8 THEN 'summer' ELSE 'fall' END",
}


@query(sql(
    "SELECT start_station_id, hour, round(" + " * ".join(f"coalesce(f_{k}.w, 1.0::DOUBLE)" for k in _L) + ", 6) AS weight FROM lab " + " ".join(f"LEFT JOIN fac f_{k} ON f_{k}.slice_name = '{k}' AND f_{k}.group_name = lab.{k}" for k in _L),
    "errors", "rep", "alle", "fac", "lab",
    rep=ERROR_REPORT,
    alle="SELECT round(sqrt(avg((p - y) * (p - y))), 6) AS rmse FROM ns",
    fac="SELECT slice_name, group_name, least(3.0, greatest(1.0, e.rmse / alle.rmse)) AS w FROM errors e JOIN rep USING (slice_name) CROSS JOIN alle WHERE status = 'FAILED'",
    lab="SELECT start_station_id, hour, " + ", ".join(f"{v} AS {k}" for k, v in _L.items()) + " FROM ns",
))
def mitigation_weights(spark: SparkSession, d: str) -> DataFrame:
    scored = domain.naive_scores(spark, d)
    errors = slices.slice_errors(scored, labels.model_slices())
    report = slices.error_disparity(errors, max_ratio=1.05)
    return slices.mitigation_weights(scored, labels.model_slices(), errors, report, metrics.regression_metrics(scored), ["start_station_id", "hour"])


# Metrics, splits, monitoring


@query(sql("SELECT * FROM metrics", "metrics"))
def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.regression_metrics(domain.history_scores(spark, d))


_SPLIT_SQL = f"CASE WHEN hour < TIMESTAMP '{BOUNDS[0]}' THEN 'train' WHEN hour < TIMESTAMP '{BOUNDS[1]}' THEN 'validation' ELSE 'test' END"


@query(sql("SELECT split, count(*) AS n, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae, round(avg(CASE WHEN y > 0 THEN abs(p - y) / y END) * 100, 6) AS mape, round(1 - sum((p - y) * (p - y)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2 FROM (SELECT *, " + _SPLIT_SQL + " AS split FROM hs) GROUP BY 1", "hs"))
def metrics_by_split(spark: SparkSession, d: str) -> DataFrame:
    return metrics.regression_metrics(metrics.temporal_split(domain.history_scores(spark, d), "hour", *BOUNDS), ["split"])


@query(sql("""SELECT *, bool_and(passed) OVER () AS all_passed FROM (SELECT 'rmse' AS metric, rmse AS value, 'max' AS kind, 2.5::DOUBLE AS threshold, rmse <= 2.5 AS passed FROM metrics
  UNION ALL SELECT 'r2', r2, 'min', 0.5, r2 >= 0.5 FROM metrics UNION ALL SELECT 'mae', mae, 'max', 1.5, mae <= 1.5 FROM metrics)""", "metrics"))
def validation_gate(spark: SparkSession, d: str) -> DataFrame:
    return metrics.validation_gate(metrics.regression_metrics(domain.history_scores(spark, d)))


@query(sql(f"SELECT split, count(*) AS n, min(hour) AS first_at, max(hour) AS last_at, true AS intact FROM (SELECT hour, {_SPLIT_SQL} AS split FROM panel) GROUP BY 1", "panel"))
def temporal_split(spark: SparkSession, d: str) -> DataFrame:
    return metrics.split_summary(metrics.temporal_split(domain.demand_panel(spark, d), "hour", *BOUNDS))


_OSPLIT = "SELECT CASE WHEN o_orderdate < TIMESTAMP '1995-03-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'validation' ELSE 'test' END AS split, o_custkey FROM orders"


@query(f"WITH s AS (SELECT DISTINCT * FROM ({_OSPLIT})) SELECT split, o_custkey FROM s WHERE split <> 'train' AND o_custkey NOT IN (SELECT o_custkey FROM s WHERE split = 'train')")
def unseen_stations(spark: SparkSession, d: str) -> DataFrame:
    o = metrics.temporal_split(domain.table(spark, d, "orders"), "o_orderdate", "1995-03-01", "1998-01-01")
    return metrics.unseen_stations(o, "o_custkey")


@query(f"SELECT count(*) FILTER (n > 1) AS shared_keys, count(*) FILTER (n > 1) = 0 AS disjoint FROM (SELECT o_custkey, count(DISTINCT split) AS n FROM ({_OSPLIT}) GROUP BY 1)")
def split_overlap(spark: SparkSession, d: str) -> DataFrame:
    o = metrics.temporal_split(domain.table(spark, d, "orders"), "o_orderdate", "1995-03-01", "1998-01-01")
    return metrics.split_overlap(o, ["o_custkey"])


@query(sql("SELECT start_station_id, hour, demand_count FROM panel WHERE " + _ROW_HASH.format(cells="start_station_id, CAST(hour AS VARCHAR)") + " % 100 < 20", "panel"))
def sample_split(spark: SparkSession, d: str) -> DataFrame:
    """20 percent of the panel, the same rows every time; sampling is the operator."""
    return metrics.hashed_sample(domain.demand_panel(spark, d), ["start_station_id", "hour"], 20).select("start_station_id", "hour", "demand_count")


@query(sql("SELECT count(*) AS n, round(avg(y - p), 6) AS mean, round(stddev_pop(y - p), 6) AS stddev, round(median(y - p), 6) AS median FROM hs", "hs"))
def residual_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.residual_stats(domain.history_scores(spark, d))


@query(sql("SELECT CAST(CASE WHEN hi > lo THEN least(floor((r - lo) / ((hi - lo) / 100)), 99) ELSE 0 END AS BIGINT) AS bin, count(*) AS n FROM (SELECT y - p AS r FROM hs) CROSS JOIN (SELECT min(y - p) AS lo, max(y - p) AS hi FROM hs) GROUP BY 1", "hs"))
def residual_histogram(spark: SparkSession, d: str) -> DataFrame:
    return metrics.residual_histogram(domain.history_scores(spark, d))


@query(sql("SELECT station_id, forecast_hour, predicted_demand, CAST(d.demand_count AS DOUBLE) AS actual_demand FROM pred JOIN d ON d.start_station_id = station_id AND d.hour = forecast_hour", "pred", "d"))
def predictions_with_actuals(spark: SparkSession, d: str) -> DataFrame:
    actuals = panel.station_hours(domain.trips(spark, d)).select(F.col("start_station_id").alias("station_id"), "hour", F.col("demand_count").cast("double").alias("actual_demand"))
    return metrics.with_actuals(domain.predictions(spark, d).select("station_id", "forecast_hour", "predicted_demand"), actuals)


@query(sql("SELECT station_id, forecast_hour, predicted_demand FROM pred WHERE forecast_hour >= TIMESTAMP '2024-01-30' - INTERVAL 7 DAY", "pred"))
def recent_predictions(spark: SparkSession, d: str) -> DataFrame:
    return metrics.recent(domain.predictions(spark, d), "2024-01-30").select("station_id", "forecast_hour", "predicted_demand")


@query(sql("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM perf", "perf"))
def rolling_performance(spark: SparkSession, d: str) -> DataFrame:
    return dated(metrics.rolling_performance(domain.predictions(spark, d)))


@query(sql("SELECT n, rmse, mae, round(rmse / 0.2::DOUBLE, 6) AS rmse_ratio, rmse > 1.5 * 0.2 OR mae > 4 AS degraded FROM perf WHERE status IS NOT NULL", "perf"))
def degradation_check(spark: SparkSession, d: str) -> DataFrame:
    return metrics.degradation_check(metrics.rolling_performance(domain.predictions(spark, d)), 0.2)


@query(sql("SELECT count(*) AS n, round(max(abs(rolling_avg_24h - rolling_avg_6h)), 6) AS max_abs, round(avg(abs(rolling_avg_24h - rolling_avg_6h)), 6) AS mean_abs, CASE WHEN max(abs(rolling_avg_24h - rolling_avg_6h)) <= 0.01 THEN 'PASSED' ELSE 'FAILED' END AS status FROM hist", "hist"))
def scorer_parity(spark: SparkSession, d: str) -> DataFrame:
    h = features.with_history(domain.demand_panel(spark, d))
    key = ["start_station_id", "hour"]
    return metrics.scorer_parity(h.select(*key, F.col("rolling_avg_24h").alias("p")), h.select(*key, F.col("rolling_avg_6h").alias("p")), key)


# Drift


def _bins(feature: str, source: str, value: str, at: str, bins: int) -> str:
    return f"""SELECT '{feature}' AS feature, lo, hi, {bins} AS bins, b.bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) CROSS JOIN (SELECT unnest(range(0, {bins})) AS bin) b
  LEFT JOIN (SELECT least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins} - 1) AS bin, count(*) FILTER ({at} < TIMESTAMP '{SPLIT}') AS r, count(*) FILTER ({at} >= TIMESTAMP '{SPLIT}') AS c FROM {source} CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) GROUP BY 1) USING (bin)"""


EVENTS_KL = _bins("value", "events", "value", "ts", 20) + " UNION ALL " + _bins("user_id", "(SELECT ts, CAST(user_id AS DOUBLE) AS user_id FROM events)", "user_id", "ts", 20)


def _event_halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return domain.halves(domain.table(spark, d, "events"), "ts", SPLIT)


@query(sql("SELECT feature, round(kl, 6) AS kl, kl > 0.1 AS drifted FROM kl20", "kl20", kbins=EVENTS_KL))
def kl_feature_drift(spark: SparkSession, d: str) -> DataFrame:
    return drift.feature_drift(*_event_halves(spark, d), ["value", "user_id", "missing"])


@query(sql("SELECT round(kl, 6) AS kl, kl > 0.15 AS drifted, a.m AS reference_mean, a.s AS reference_std, b.m AS current_mean, b.s AS current_std FROM kl20, (SELECT round(avg(value), 6) AS m, round(stddev_pop(value), 6) AS s FROM events WHERE ts < TIMESTAMP '" + SPLIT + "') a, (SELECT round(avg(value), 6) AS m, round(stddev_pop(value), 6) AS s FROM events WHERE ts >= TIMESTAMP '" + SPLIT + "') b", "kl20", kbins=_bins("value", "events", "value", "ts", 30)))
def target_drift(spark: SparkSession, d: str) -> DataFrame:
    return drift.target_drift(*_event_halves(spark, d), "value")


MAES = f"SELECT avg(abs(p - y)) FILTER (hour < TIMESTAMP '{SPLIT}') AS a, avg(abs(p - y)) FILTER (hour >= TIMESTAMP '{SPLIT}') AS b FROM hs"


@query(sql("SELECT round(a, 6) AS baseline_mae, round(b, 6) AS current_mae, round(coalesce((b - a) / nullif(a, 0) * 100, 0), 6) AS increase_pct, coalesce((b - a) / nullif(a, 0) * 100, 0) > 20 AS drifted FROM maes", "hs", "maes", maes=MAES))
def performance_drift(spark: SparkSession, d: str) -> DataFrame:
    scored = domain.history_scores(spark, d).withColumn("e", F.col("p") - F.col("y"))
    return drift.performance_drift(*domain.halves(scored, "hour", SPLIT), "e")


KS = f"SELECT 'value' AS feature, value AS x, ts < TIMESTAMP '{SPLIT}' AS ref FROM events UNION ALL SELECT 'user_id', user_id, ts < TIMESTAMP '{SPLIT}' FROM events"


@query(sql("""SELECT feature, round(max(abs(r - c)), 6) AS ks FROM (
  SELECT feature, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS r, sum(c) OVER w / sum(c) OVER (PARTITION BY feature) AS c
  FROM (SELECT feature, x, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c FROM ks GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY 1""", "ks", ks=KS))
def ks_drift(spark: SparkSession, d: str) -> DataFrame:
    return drift.ks_statistic(*_event_halves(spark, d), ["value", "user_id"])


@query(sql("SELECT feature, kl, CASE WHEN kl >= 0.01 THEN 'DRIFTED' WHEN kl >= 0.7 * 0.01 THEN 'WARNING' ELSE 'OK' END AS severity FROM (SELECT feature, round(kl, 6) AS kl FROM kl20)", "kl20", kbins=EVENTS_KL))
def drift_severity(spark: SparkSession, d: str) -> DataFrame:
    found = drift.feature_drift(*_event_halves(spark, d), ["value", "user_id"])
    return found.select("feature", "kl", labels.drift_severity(F.col("kl"), 0.01).alias("severity"))


@query(sql("SELECT feature, kl, drifted, CAST(row_number() OVER (PARTITION BY drifted ORDER BY CASE WHEN drifted THEN -kl ELSE kl END, feature) AS INTEGER) AS rank FROM (SELECT feature, round(kl, 6) AS kl, kl > 0.1 AS drifted FROM kl20)", "kl20", kbins=EVENTS_KL))
def drift_top(spark: SparkSession, d: str) -> DataFrame:
    return drift.top_drifted(drift.feature_drift(*_event_halves(spark, d), ["value", "user_id"]))


def _report(spark: SparkSession, d: str) -> DataFrame:
    halves = _event_halves(spark, d)
    return drift.drift_report(drift.feature_drift(*halves, ["value", "user_id"]), drift.target_drift(*halves, "value"), performance_drift(spark, d))


_REPORT_SQL = "SELECT f.feature_drift, max_kl, drifted_features, false AS target_drift, m.drifted AS performance_drift, f.feature_drift OR m.drifted AS overall_drift, CASE WHEN f.feature_drift OR m.drifted THEN 'retrain' ELSE 'monitor' END AS recommendation FROM (SELECT count(*) FILTER (kl > 0.1) > 0 AS feature_drift, round(max(kl), 6) AS max_kl, coalesce(string_agg(CASE WHEN kl > 0.1 THEN feature END, ',' ORDER BY feature), '') AS drifted_features FROM kl20) f CROSS JOIN (SELECT coalesce((b - a) / nullif(a, 0) * 100, 0) > 20 AS drifted FROM maes) m"


@query(sql(_REPORT_SQL, "kl20", "hs", "maes", kbins=EVENTS_KL, maes=MAES))
def drift_report(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d)


# Gates

_CANDIDATE = "(SELECT run_id, val_rmse FROM runs WHERE run_id = (SELECT max(run_id) FROM runs))"


def _candidate_of(runs: DataFrame) -> DataFrame:
    """The best run, as a candidate that the gate accepts."""
    return gates.best_run(runs).select("run_id", "val_rmse")


def _candidate(spark: SparkSession, d: str) -> DataFrame:
    return domain.runs(spark, d).orderBy(F.desc("run_id")).limit(1).select("run_id", "val_rmse")


@query(sql(f"SELECT run_id, val_rmse, best AS best_val_rmse, CASE WHEN best IS NULL OR val_rmse < best THEN 'approved' ELSE 'rejected' END AS decision FROM {_CANDIDATE} CROSS JOIN (SELECT min(val_rmse) AS best FROM runs WHERE status = 'approved')", "runs"))
def champion_selection(spark: SparkSession, d: str) -> DataFrame:
    return gates.champion_selection(domain.runs(spark, d), _candidate(spark, d))


@query(sql(f"SELECT run_id, val_rmse, champion AS champion_val_rmse, CASE WHEN champion IS NOT NULL AND val_rmse > champion * 1.1::DOUBLE THEN 'rejected' ELSE 'accepted' END AS decision FROM {_CANDIDATE} CROSS JOIN (SELECT min(val_rmse) AS champion FROM runs WHERE alias = 'champion')", "runs"))
def rollback_gate(spark: SparkSession, d: str) -> DataFrame:
    return gates.rollback_gate(domain.runs(spark, d).where("alias = 'champion'"), _candidate(spark, d))


@query(sql("SELECT run_id, val_rmse, status FROM runs WHERE status = 'approved' ORDER BY val_rmse, run_id LIMIT 1", "runs"))
def best_run(spark: SparkSession, d: str) -> DataFrame:
    return gates.best_run(domain.runs(spark, d)).select("run_id", "val_rmse", "status")


@query(sql("SELECT run_id, val_rmse FROM runs WHERE status = 'approved' ORDER BY started_at DESC, run_id DESC LIMIT 10", "runs"))
def last_runs(spark: SparkSession, d: str) -> DataFrame:
    return gates.last_runs(domain.runs(spark, d)).select("run_id", "val_rmse")


@query(sql("SELECT run_id, val_rmse, round(val_rmse - lag(val_rmse) OVER (ORDER BY started_at, run_id), 6) AS rmse_delta FROM runs", "runs"))
def run_delta(spark: SparkSession, d: str) -> DataFrame:
    return gates.run_delta(domain.runs(spark, d)).select("run_id", "val_rmse", "rmse_delta")


@query("SELECT o_custkey AS run_id, CASE WHEN bool_or(o_orderstatus = 'F') THEN 'failed' WHEN bool_and(o_orderstatus = 'O') THEN 'success' ELSE 'running' END AS status FROM orders GROUP BY 1")
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Orders as tasks of their customer's run."""
    o = domain.table(spark, d, "orders")
    return gates.status_rollup(o.select(F.col("o_custkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "success").otherwise("running").alias("status")))


@query(sql(f"""SELECT overall_drift, degraded, degradation_ratio, round((old - val_rmse) / old * 100, 6) AS improvement_pct, overall_drift OR degraded AS retrain FROM ({_REPORT_SQL}) r
  CROSS JOIN (SELECT rmse > 1.5 * 0.2 OR mae > 4 AS degraded, round(rmse / 0.2::DOUBLE, 6) AS degradation_ratio FROM perf WHERE status IS NOT NULL) p
  CROSS JOIN (SELECT val_rmse, lead(val_rmse) OVER (ORDER BY started_at DESC, run_id DESC) AS old FROM runs QUALIFY row_number() OVER (ORDER BY started_at DESC, run_id DESC) = 1) l""", "kl20", "hs", "maes", "perf", "runs", kbins=EVENTS_KL, maes=MAES))
def retrain_decision(spark: SparkSession, d: str) -> DataFrame:
    return gates.retrain_decision(_report(spark, d), degradation_check(spark, d), domain.runs(spark, d))


@query(sql("SELECT run_id, ps_partkey, ps_quantity FROM (SELECT l_suppkey AS run_id, l_partkey AS ps_partkey, sum(l_quantity) AS ps_quantity FROM lineitem GROUP BY 1, 2) JOIN runs USING (run_id) WHERE alias = 'champion'", "runs"))
def champion_report(spark: SparkSession, d: str) -> DataFrame:
    """Quantities by supplier and part as reports of the supplier's run."""
    reports = domain.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").cast("long").alias("run_id"), F.col("l_partkey").alias("ps_partkey")).agg(F.sum("l_quantity").alias("ps_quantity"))
    return gates.champion_report(domain.runs(spark, d), reports)


# Serving


@query(sql("SELECT station_id, round(avg(predicted_demand), 4) AS mean_demand, max(predicted_demand) AS max_demand, round(sum(predicted_demand), 4) AS total_demand, min(forecast_hour) AS first_hour, arg_min(model_version, forecast_hour) AS model_version FROM pred GROUP BY 1", "pred"))
def prediction_summary(spark: SparkSession, d: str) -> DataFrame:
    return serving.prediction_summary(domain.predictions(spark, d))


@query(sql("SELECT CAST(hour(forecast_hour) AS INTEGER) AS hour_of_day, round(sum(predicted_demand), 4) AS total_demand, min(forecast_hour) AS first_hour FROM pred GROUP BY 1", "pred"))
def network_demand(spark: SparkSession, d: str) -> DataFrame:
    return serving.network_demand(domain.predictions(spark, d))


@query(sql("""SELECT station_id, peak_demand, CASE WHEN peak_demand >= 5 THEN 'Very high' WHEN peak_demand >= 3 THEN 'High' WHEN peak_demand >= 1.5 THEN 'Moderate' WHEN peak_demand >= 0.5 THEN 'Low' ELSE 'Very low' END AS tier,
  CASE WHEN peak_demand >= 5 THEN 'Stock up now' WHEN peak_demand >= 2 THEN 'Monitor' ELSE '-' END AS action, CAST(ceil(peak_demand * 1.5) AS BIGINT) AS recommended_stock, peak_demand >= 3 AS high_demand FROM (SELECT station_id, max(actual_demand) AS peak_demand FROM pred GROUP BY 1)""", "pred"))
def station_peaks(spark: SparkSession, d: str) -> DataFrame:
    return serving.station_peaks(domain.predictions(spark, d).withColumn("predicted_demand", F.col("actual_demand")))


@query(sql("SELECT station_id, max(predicted_demand) AS peak, round(avg(predicted_demand), 6) AS average, arg_max(forecast_hour, (predicted_demand, -epoch(forecast_hour))) AS peak_hour FROM pred GROUP BY 1", "pred"))
def forecast_summary(spark: SparkSession, d: str) -> DataFrame:
    return serving.forecast_summary(domain.predictions(spark, d))


@query(sql("SELECT day_of_week, " + ", ".join(f"round(avg(demand_count) FILTER (hour_of_day = {h}), 6) AS h{h:02d}" for h in range(24)) + " FROM panel GROUP BY 1", "panel"))
def demand_heatmap(spark: SparkSession, d: str) -> DataFrame:
    return serving.demand_heatmap(domain.demand_panel(spark, d))


@query(sql("SELECT hour_of_day, round(avg(demand_count), 6) AS mean_demand, CAST(sum(demand_count) AS BIGINT) AS total_demand FROM panel GROUP BY 1", "panel"))
def hourly_profile(spark: SparkSession, d: str) -> DataFrame:
    return serving.hourly_profile(domain.demand_panel(spark, d))


@query(sql("SELECT hour_of_day, round(avg(demand_count), 6) AS mean_demand, CAST(sum(demand_count) AS BIGINT) AS total_demand FROM panel GROUP BY 1 ORDER BY mean_demand DESC, hour_of_day LIMIT 10", "panel"))
def busiest_hours(spark: SparkSession, d: str) -> DataFrame:
    return serving.hourly_profile(domain.demand_panel(spark, d), top=10)


@query(sql("SELECT station_id, capacity, fill_pct, current_bikes, round(mean, 4) AS mean_demand, risk_level, net_flow_1h FROM status", "status"))
def station_risk(spark: SparkSession, d: str) -> DataFrame:
    return serving.station_risk(domain.predictions(spark, d), domain.stations(spark, d))


def _fills(spark: SparkSession, d: str) -> DataFrame:
    """Every customer as a station, with a fill level that its key gives."""
    c = domain.table(spark, d, "customer")
    return serving.fill_table(c.select(F.col("c_custkey").cast("string").alias("station_id"), (F.col("c_custkey") * 7 % 101).cast("int").alias("fill_pct")))


@query(sql("SELECT * FROM fills", "fills"))
def fill_urgency(spark: SparkSession, d: str) -> DataFrame:
    return _fills(spark, d)


@query(sql("SELECT u.urgency, count(fills.urgency) AS n FROM (SELECT unnest(['Critical', 'Warning', 'OK']) AS urgency) u LEFT JOIN fills USING (urgency) GROUP BY 1", "fills"))
def alert_counts(spark: SparkSession, d: str) -> DataFrame:
    return serving.alert_counts(_fills(spark, d))


@query(sql("SELECT round(100.0::DOUBLE * count(*) FILTER (risk = 'moderate') / count(*), 4) AS healthy_pct, round(avg(fill_pct), 4) AS average_fill, count(*) FILTER (fill_pct <= 10) AS need_bikes, count(*) FILTER (fill_pct >= 90) AS overflow, " + ", ".join(f"count(*) FILTER (risk = '{r}') AS n_{r}" for r in ("critical", "low", "surplus", "moderate")) + " FROM fills", "fills"))
def network_kpis(spark: SparkSession, d: str) -> DataFrame:
    return serving.network_kpis(_fills(spark, d))


@query(sql("SELECT station_id, urgency, round(mean, 6) AS mean_demand FROM fills JOIN means USING (station_id) WHERE urgency IN ('Critical', 'Warning') ORDER BY urgency, round(mean, 6) DESC, station_id LIMIT 20", "fills", "means"))
def top_alerts(spark: SparkSession, d: str) -> DataFrame:
    demand = domain.predictions(spark, d).groupBy("station_id").agg(F.round(F.avg("predicted_demand"), 6).alias("mean_demand"))
    return serving.top_alerts(_fills(spark, d), demand)


@query(sql("SELECT station_id, urgency FROM fills JOIN stations USING (station_id) WHERE urgency IN ('Critical', 'Warning') AND station_type IN ('BUILDING', 'MACHINERY')", "fills", "stations"))
def alert_filter(spark: SparkSession, d: str) -> DataFrame:
    fills = _fills(spark, d).join(domain.stations(spark, d).select("station_id", F.col("station_type").alias("district")), "station_id")
    return serving.alert_filter(fills, ("Critical", "Warning"), ("BUILDING", "MACHINERY")).select("station_id", "urgency")


@query(sql("SELECT station_id, risk, fill_pct, CASE risk WHEN 'critical' THEN 0 WHEN 'surplus' THEN 1 WHEN 'low' THEN 2 ELSE 3 END AS risk_rank FROM fills ORDER BY risk_rank, fill_pct, station_id LIMIT 14", "fills"))
def priority_list(spark: SparkSession, d: str) -> DataFrame:
    return serving.priority_list(_fills(spark, d))


_IMPORTANCE = "SELECT p_name AS feature, round(sum(p_retailprice), 4) AS importance, sum(p_size) AS gain, count(*) AS shap FROM part GROUP BY 1"


def _importance(spark: SparkSession, d: str) -> DataFrame:
    """Part names as features, prices as importance."""
    return domain.table(spark, d, "part").groupBy(F.col("p_name").alias("feature")).agg(F.round(F.sum("p_retailprice"), 4).alias("importance"), F.sum("p_size").alias("gain"), F.count("*").alias("shap"))


@query(f"SELECT feature, importance FROM ({_IMPORTANCE}) ORDER BY importance DESC, feature LIMIT 15")
def top_features(spark: SparkSession, d: str) -> DataFrame:
    return serving.top_features(_importance(spark, d).select("feature", "importance"))


@query(f"""WITH f AS ({_IMPORTANCE}), r AS (SELECT feature, row_number() OVER (ORDER BY gain DESC, feature) AS g, row_number() OVER (ORDER BY shap DESC, feature) AS s FROM f)
SELECT a.l AS top_gain, b.l AS top_shap, a.l = b.l AS agree FROM (SELECT string_agg(feature, ',' ORDER BY feature) AS l FROM r WHERE g <= 3) a, (SELECT string_agg(feature, ',' ORDER BY feature) AS l FROM r WHERE s <= 3) b""")
def score_agreement(spark: SparkSession, d: str) -> DataFrame:
    return serving.score_agreement(_importance(spark, d))


@query(f"WITH f AS ({_IMPORTANCE}) SELECT split_part(feature, ' ', 2) AS category, round(sum(importance), 6) AS importance, round(100.0::DOUBLE * sum(importance) / (SELECT sum(importance) FROM f), 4) AS share_pct FROM f GROUP BY 1")
def category_share(spark: SparkSession, d: str) -> DataFrame:
    own = _importance(spark, d)
    return serving.category_share(own.select("feature", "importance"), own.select("feature", F.split_part("feature", F.lit(" "), F.lit(2)).alias("category")))


@query(sql("SELECT station_id, capacity FROM stations ORDER BY capacity DESC, station_id LIMIT 10", "stations"))
def top_stations(spark: SparkSession, d: str) -> DataFrame:
    return serving.top_stations(domain.stations(spark, d).select("station_id", "capacity"))


@query(sql("SELECT station_id, CASE WHEN station_id IN ('5', '42', '99') THEN 0 ELSE 1 END AS pinned FROM stations", "stations"))
def focus_stations(spark: SparkSession, d: str) -> DataFrame:
    return serving.pinned_first(domain.stations(spark, d), ("5", "42", "99")).select("station_id", "pinned")


@query(sql("SELECT station_id, station_name FROM stations WHERE (contains(lower(station_name), '00001') OR contains(lower(station_id), '00001')) AND station_type = 'BUILDING'", "stations"))
def station_search(spark: SparkSession, d: str) -> DataFrame:
    return serving.station_search(domain.stations(spark, d), "00001", "BUILDING").select("station_id", "station_name")


def _bridge(spark: SparkSession, d: str) -> DataFrame:
    """Customer names as feed ids; every fifth has none."""
    c = domain.table(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("station_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).otherwise("").alias("gbfs_id"))


@query(sql("SELECT station_id, forecast_hour, predicted_demand FROM pred WHERE station_id = '12'", "pred"))
def station_by_id(spark: SparkSession, d: str) -> DataFrame:
    return serving.by_station(domain.predictions(spark, d), "Customer#000000012", _bridge(spark, d)).select("station_id", "forecast_hour", "predicted_demand")


@query(sql("SELECT CASE WHEN CAST(station_id AS INTEGER) % 5 <> 0 THEN 'Customer#' || lpad(station_id, 9, '0') ELSE station_id END AS station_id, count(*) AS n, round(sum(predicted_demand), 4) AS total FROM pred GROUP BY 1", "pred"))
def id_translation(spark: SparkSession, d: str) -> DataFrame:
    out = serving.translated(domain.predictions(spark, d), _bridge(spark, d))
    return out.groupBy("station_id").agg(F.count("*").alias("n"), F.round(F.sum("predicted_demand"), 4).alias("total"))


@query(sql("SELECT station_id, arg_max(forecast_hour, (predicted_demand, -epoch(forecast_hour))) AS forecast_hour, max(predicted_demand) AS predicted_demand, 'naive-1' AS model_version FROM pred WHERE station_id IN (SELECT station_id FROM stations WHERE capacity > 10) GROUP BY 1", "pred", "stations"))
def best_prediction_rows(spark: SparkSession, d: str) -> DataFrame:
    return serving.best_rows(domain.predictions(spark, d), domain.stations(spark, d).where("capacity > 10"))


@query(sql("""SELECT route_id, count(f.station_id) AS urgent_stops FROM (SELECT DISTINCT o_custkey % 7 AS route_id, CAST(o_custkey AS VARCHAR) AS station_id FROM orders WHERE o_custkey % 7 <> 3) r
  LEFT JOIN (SELECT station_id FROM fills WHERE risk = 'critical' AND fill_pct <= 10) f USING (station_id) GROUP BY 1 ORDER BY urgent_stops DESC, route_id LIMIT 1""", "fills"))
def priority_route(spark: SparkSession, d: str) -> DataFrame:
    """Customers with orders as stops, their key modulo 7 as the route; one route is not active."""
    stops = domain.table(spark, d, "orders").select("o_custkey").distinct().select((F.col("o_custkey") % 7).alias("route_id"), F.struct(F.col("o_custkey").cast("string").alias("station_id")).alias("stop"))
    routes = stops.groupBy("route_id").agg(F.collect_list("stop").alias("stops")).withColumn("status", F.when(F.col("route_id") == 3, "idle").otherwise("active"))
    return serving.priority_route(routes, _fills(spark, d))


@query("SELECT event_id, CASE WHEN value > 1e9 THEN NULL ELSE round(value / 7, 6) END AS value, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_safe(spark: SparkSession, d: str) -> DataFrame:
    e = domain.table(spark, d, "events").select("event_id", (F.col("value") / 7).alias("value"), "ts", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return serving.json_safe(e)


@query(sql("SELECT station_id, forecast_hour, round(greatest(raw - 0.1::DOUBLE, 0), 4) AS predicted_demand FROM pred", "pred"))
def clip_predictions(spark: SparkSession, d: str) -> DataFrame:
    p = domain.predictions(spark, d)
    return p.select("station_id", "forecast_hour", serving.clipped(F.col("raw") - 0.1).alias("predicted_demand"))


@query(sql("SELECT start_station_id, hour, round(CASE WHEN hour_of_day % 2 = 0 THEN 0.5 ELSE sin(2 * pi() * hour_of_day / 24) END, 6) + 0 AS hour_sin, round(cos(2 * pi() * hour_of_day / 24), 6) + 0 AS hour_cos FROM panel", "panel"))
def scoring_request(spark: SparkSession, d: str) -> DataFrame:
    requests = domain.demand_panel(spark, d).withColumn("hour_sin", F.when(F.col("hour_of_day") % 2 == 0, F.lit(0.5)))
    return rounded(serving.completed_requests(requests).select("start_station_id", "hour", "hour_sin", "hour_cos"))


@query(sql("SELECT min(temperature_c) AS min_temperature, max(temperature_c) AS max_temperature, round(avg(temperature_c), 6) AS mean_temperature, round(100.0::DOUBLE * avg(CAST(precipitation_mm > 0 AS INTEGER)), 4) AS rainy_pct, round(sum(precipitation_mm), 4) AS total_precipitation, (SELECT string_agg(CAST(weather_code AS VARCHAR), ',' ORDER BY n DESC, weather_code) FROM (SELECT weather_code, count(*) AS n FROM weather GROUP BY 1 ORDER BY n DESC, weather_code LIMIT 3)) AS common_codes FROM weather", "weather"))
def weather_profile(spark: SparkSession, d: str) -> DataFrame:
    return serving.weather_profile(domain.weather(spark, d))


@query(sql("SELECT count(*) AS stations, CAST(sum(capacity) AS BIGINT) AS total_capacity, round(avg(capacity), 4) AS mean_capacity, count(*) FILTER (region_id IS NULL) AS without_region FROM stations", "stations"))
def station_feed_profile(spark: SparkSession, d: str) -> DataFrame:
    return serving.station_feed_profile(domain.stations(spark, d))


@query(sql("SELECT start_station_id, array_to_string(list(CAST(demand_count AS VARCHAR) ORDER BY hour), ',') AS history, arg_max(capacity, hour) AS capacity, max(hour) AS last_hour FROM (SELECT *, row_number() OVER (PARTITION BY start_station_id ORDER BY hour DESC) AS n FROM matrix) WHERE n <= 200 GROUP BY 1", "matrix"))
def station_history(spark: SparkSession, d: str) -> DataFrame:
    out = serving.station_history(domain.matrix(spark, d))
    return out.withColumn("history", F.array_join(F.transform("history", lambda x: x.cast("long").cast("string")), ","))


@query(sql("SELECT arg_max(temperature_c, hour) AS temperature_c, arg_max(precipitation_mm, hour) AS precipitation_mm, arg_max(wind_speed_kmh, hour) AS wind_speed_kmh FROM matrix", "matrix"))
def last_known(spark: SparkSession, d: str) -> DataFrame:
    return serving.last_known(domain.matrix(spark, d), ["temperature_c", "precipitation_mm", "wind_speed_kmh"])


# Streams


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The table's path as a pattern: a stream's plain path has to be a folder, and the table may be one file."""
    return spark.readStream.schema(domain.table(spark, d, "events").schema).parquet(f"{d}/[e]vents.parquet")


@query("SELECT CAST(user_id AS VARCHAR) AS start_station_id, date_trunc('hour', ts) AS hour, count(*) AS demand_count FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events) GROUP BY 1, 2")
def streaming_demand(spark: SparkSession, d: str) -> DataFrame:
    """The hours that the watermark has closed."""
    trips = _event_stream(spark, d).select(F.col("user_id").cast("string").alias("start_station_id"), F.col("ts").alias("started_at"))
    return streaming.drained(streaming.streaming_demand(trips), "streaming-demand")


@query("""SELECT first_day, count(*) AS n, round(sqrt(avg((value - user_id) * (value - user_id))), 6) AS rmse, round(avg(abs(value - user_id)), 6) AS mae FROM (SELECT *, unnest([date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) FOR k IN range(0, 7)]) AS first_day FROM events)
WHERE first_day + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1""")
def streaming_performance(spark: SparkSession, d: str) -> DataFrame:
    """X02, with an event's value as the prediction and its user as the truth."""
    log = _event_stream(spark, d).select(F.col("ts").alias("forecast_hour"), F.col("value").alias("predicted_demand"), F.col("user_id").cast("double").alias("actual_demand"))
    return streaming.drained(streaming.streaming_performance(log), "streaming-performance")


@query("""WITH p AS (SELECT user_id, ts, value FROM events WHERE event_type <> 'error'), a AS (SELECT user_id, ts, CAST(user_id AS DOUBLE) AS actual FROM events WHERE event_type <> 'view'),
j AS (SELECT ts, value - actual AS off FROM p JOIN a USING (user_id, ts)), w AS (SELECT *, unnest([date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) FOR k IN range(0, 7)]) AS first_day FROM j)
SELECT first_day, count(*) AS n, round(sqrt(avg(off * off)), 6) AS rmse, round(avg(abs(off)), 6) AS mae FROM w
WHERE first_day + INTERVAL 7 DAY <= (SELECT least((SELECT max(ts) FROM p), (SELECT max(ts) FROM a)) - INTERVAL 1 DAY) GROUP BY 1""")
def streaming_errors(spark: SparkSession, d: str) -> DataFrame:
    """X02 with J13: one stream of events' values as predictions, another of their users as the truth; each lacks some of the other's."""
    e = lambda: _event_stream(spark, d)
    predictions = e().where("event_type <> 'error'").select(F.col("user_id").alias("station_id"), F.col("ts").alias("forecast_hour"), F.col("value").alias("predicted_demand"))
    actuals = e().where("event_type <> 'view'").select(F.col("user_id").alias("station_id"), F.col("ts").alias("hour"), F.col("user_id").cast("double").alias("actual_demand"))
    return streaming.drained(streaming.streaming_errors(predictions, actuals), "streaming-errors")


# Models (rows only, but for the forecast without a model)


def _split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The matrix's two halves, stored: training reads it many times."""
    return domain.halves(saved(domain.matrix(spark, d), "matrix"), "hour", SPLIT)


@query()
def gbt_train_score(spark: SparkSession, d: str) -> DataFrame:
    train, rest = _split(spark, d)
    return ml.Boosted().train(train, rest).predict(rest).select("start_station_id", "hour", F.col("demand_count").cast("double").alias("y"), "p")


@query()
def gain_importance(spark: SparkSession, d: str) -> DataFrame:
    return ml.Boosted().train(*_split(spark, d)).importances(spark)


@query()
def permutation_importance(spark: SparkSession, d: str) -> DataFrame:
    train, rest = _split(spark, d)
    return ml.permutation_importance(ml.Boosted().train(train, rest).model, rest, ["start_station_id", "hour"])


@query()
def parameter_sweep(spark: SparkSession, d: str) -> DataFrame:
    return ml.sweep(*_split(spark, d))


@query()
def random_search(spark: SparkSession, d: str) -> DataFrame:
    """M22 over the wider space."""
    return ml.random_search(*_split(spark, d), ml.WIDE)


@query()
def joint_search(spark: SparkSession, d: str) -> DataFrame:
    """M22 over five dimensions."""
    return ml.random_search(*_split(spark, d), ml.JOINT)


MADE_AT = "2024-01-31T00:00:00+00:00"


def _forecast(spark: SparkSession, m: DataFrame, model=None, version: int = 0) -> DataFrame:
    weather = serving.last_known(m, list(features.WEATHER) + ["is_precipitation", "is_cold", "is_hot", "feels_like_c"])
    return ml.recursive_forecast(serving.station_history(m), weather, features.holiday_calendar(spark), model=model, model_version=version, generated_at=MADE_AT)


@query(sql(f"SELECT start_station_id AS station_id, hour + INTERVAL 24 HOUR AS forecast_hour, round(CAST(demand_count AS DOUBLE), 4) AS predicted_demand, CAST(0 AS INTEGER) AS model_version, '{MADE_AT}' AS generated_at FROM panel WHERE hour > (SELECT max(hour) FROM panel) - INTERVAL 24 HOUR", "panel"))
def recursive_forecast(spark: SparkSession, d: str) -> DataFrame:
    """M19 without a model: the last day's demand comes again."""
    return _forecast(spark, domain.matrix(spark, d))


@query(sql("""SELECT station_id, count(*) AS hours, min(forecast_hour) AS first_hour, max(forecast_hour) AS last_hour, CAST(0 AS BIGINT) AS negative, CAST(1 AS INTEGER) AS model_version
FROM (SELECT start_station_id AS station_id, hour + INTERVAL 24 HOUR AS forecast_hour FROM panel WHERE hour > (SELECT max(hour) FROM panel) - INTERVAL 24 HOUR) GROUP BY 1""", "panel"))
def model_forecast(spark: SparkSession, d: str) -> DataFrame:
    """M19 with boosted trees, as far as SQL can tell: the hours of every station and that no demand is negative."""
    train, rest = _split(spark, d)
    out = _forecast(spark, train.unionByName(rest), ml.Boosted().train(train, rest).model, 1)
    return out.groupBy("station_id").agg(F.count("*").alias("hours"), F.min("forecast_hour").alias("first_hour"), F.max("forecast_hour").alias("last_hour"), F.count_if(F.col("predicted_demand") < 0).alias("negative"), F.max("model_version").alias("model_version"))


from tidegrid.plans import file_queries  # noqa: E402, F401  registers the queries of files and pipelines
