"""Named parts of SQL that the queries' oracles share; ``sql`` puts those that a query needs before it."""

from __future__ import annotations

#: Parts that others name more than once and that are dear to compute.
REPEATED = {"hist", "matrix", "ns", "errors", "alle", "rep", "fac", "lab"}

PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), "SELECT * FROM events"),
    "ev2": ((), "SELECT * FROM events UNION ALL SELECT * REPLACE (ts + INTERVAL 1 SECOND AS ts) FROM events WHERE event_type = 'purchase'"),
    **{
        name: ((source,), f"""SELECT CAST(event_id AS VARCHAR) AS ride_id, ' ' || upper(event_type) AS rideable_type, ts AS started_at,
  ts + to_seconds(CAST(floor(value * 60) AS INTEGER)) AS ended_at, 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS start_station_name,
  CAST(user_id AS VARCHAR) AS start_station_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS end_station_id,
  value / 1000 + 42 AS start_lat, value / -1000 - 71 AS start_lng, CASE WHEN user_id % 2 = 0 THEN 'Member ' ELSE 'casual' END AS member_casual,
  CAST(floor(value * 60) AS BIGINT) AS secs FROM {source}""")
        for name, source in (("trips", "ev"), ("trips2", "ev2"))
    },
    "flagged": (("trips2",), """SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY started_at) AS n,
  end_station_id IS NULL OR start_station_id IS NULL AS missing FROM trips2"""),
    "d": ((), """SELECT CAST(user_id AS VARCHAR) AS start_station_id, date_trunc('hour', timezone('America/New_York', timezone('UTC', ts))) AS hour, count(*) AS demand_count
  FROM events GROUP BY 1, 2"""),
    "grid": (("d",), "SELECT s.start_station_id, h.hour FROM (SELECT DISTINCT start_station_id FROM d) s CROSS JOIN (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM d) h"),
    "panel": (("grid",), """SELECT start_station_id, hour, CAST(coalesce(demand_count, 0) AS BIGINT) AS demand_count, CAST(hour AS DATE) AS date, CAST(year(hour) AS INTEGER) AS year, CAST(month(hour) AS INTEGER) AS month,
  CAST(isodow(hour) - 1 AS INTEGER) AS day_of_week, CAST(hour(hour) AS INTEGER) AS hour_of_day, CAST(isodow(hour) >= 6 AS INTEGER) AS is_weekend
  FROM grid LEFT JOIN d USING (start_station_id, hour)"""),
    "hist": (("panel",), """SELECT *, CAST(coalesce(lag(demand_count, 1) OVER w, 0) AS DOUBLE) AS demand_lag_1h, CAST(coalesce(lag(demand_count, 24) OVER w, 0) AS DOUBLE) AS demand_lag_24h,
  CAST(coalesce(lag(demand_count, 168) OVER w, 0) AS DOUBLE) AS demand_lag_168h,
  coalesce(avg(demand_count) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS rolling_avg_3h, coalesce(avg(demand_count) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 0) AS rolling_avg_6h,
  coalesce(avg(demand_count) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS rolling_avg_24h
  FROM panel WINDOW w AS (PARTITION BY start_station_id ORDER BY hour)"""),
    "hs": (("hist",), "SELECT *, CAST(demand_count AS DOUBLE) AS y, demand_lag_24h AS p FROM hist"),
    "weather": ((), """SELECT date_trunc('hour', timezone('America/New_York', timezone('UTC', ts))) AS hour, round(avg(value) / 7 - 5, 4) AS temperature_c, round(greatest(0, max(value) / 70 - 1), 4) AS precipitation_mm,
  round(min(value) / 10, 4) AS wind_speed_kmh, CAST(40 + count(*) AS DOUBLE) AS humidity_pct, CAST(count(*) % 3 AS INTEGER) AS weather_code
  FROM events WHERE event_type = 'error' GROUP BY 1"""),
    "filled": (("weather", "d"), "SELECT hour, " + ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (ORDER BY hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}" for c in ("temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "weather_code")) + """
  FROM (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM d) LEFT JOIN weather USING (hour)"""),
    "wflags": (("filled",), "SELECT *, CAST(precipitation_mm > 0 AS INTEGER) AS is_precipitation, CAST(temperature_c < 10 AS INTEGER) AS is_cold, CAST(temperature_c > 25 AS INTEGER) AS is_hot, temperature_c - 0.2::DOUBLE * wind_speed_kmh AS feels_like_c FROM filled"),
    "stations": ((), "SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS station_name, CAST(c_nationkey + 5 AS INTEGER) AS capacity, c_mktsegment AS station_type, CASE WHEN c_nationkey > 2 THEN CAST(c_nationkey AS VARCHAR) END AS region_id FROM customer WHERE c_custkey % 10 <> 7"),
    "holidays": ((), "SELECT CAST(x[1] AS DATE) AS date, x[2] AS holiday FROM (SELECT unnest({HOLIDAYS}) AS x)"),
    "matrix": (("hist", "wflags", "stations", "holidays"), """SELECT hist.*, wflags.* EXCLUDE (hour), coalesce(s.capacity, CAST(floor(m.median) AS INTEGER)) AS capacity, CAST(holidays.date IS NOT NULL AS INTEGER) AS is_holiday,
  sin(2 * pi() * hour_of_day / 24) AS hour_sin, cos(2 * pi() * hour_of_day / 24) AS hour_cos, sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
  sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos
  FROM hist LEFT JOIN wflags USING (hour) LEFT JOIN stations s ON s.station_id = hist.start_station_id CROSS JOIN (SELECT median(capacity) AS median FROM stations) m LEFT JOIN holidays ON holidays.date = hist.date"""),
    "ns": (("matrix",), "SELECT *, CAST(demand_count AS DOUBLE) AS y, demand_lag_24h AS p FROM matrix"),
    "pred": (("hs",), "SELECT start_station_id AS station_id, hour AS forecast_hour, rolling_avg_24h AS raw, round(rolling_avg_24h, 4) AS predicted_demand, 'naive-1' AS model_version, y AS actual_demand FROM hs"),
    "runs": ((), "SELECT s_suppkey AS run_id, abs(s_acctbal) / 1000 AS val_rmse, CASE WHEN s_nationkey % 2 = 0 THEN 'approved' ELSE 'rejected' END AS status, s_suppkey AS started_at, CASE WHEN s_suppkey = 3 THEN 'champion' END AS alias FROM supplier"),
    "dslices": (("matrix",), """SELECT demand_count, unnest([
  {'s': 'time_of_day', 'g': CASE WHEN hour_of_day IN (7, 8, 9, 16, 17, 18, 19) THEN 'peak' WHEN hour_of_day >= 22 OR hour_of_day <= 6 THEN 'night' ELSE 'off_peak' END},
  {'s': 'day_type', 'g': CASE WHEN is_holiday = 1 THEN 'holiday' WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END},
  {'s': 'season', 'g': CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month <= 5 THEN 'spring' WHEN month <= 8 THEN 'summer' ELSE 'fall' END},
  {'s': 'station_capacity', 'g': CASE WHEN capacity <= 10 THEN 'low_cap' WHEN capacity <= 20 THEN 'mid_cap' ELSE 'high_cap' END},
  {'s': 'precipitation', 'g': CASE WHEN is_precipitation = 1 THEN 'rainy' ELSE 'dry' END},
  {'s': 'temperature', 'g': CASE WHEN is_cold = 1 THEN 'cold' WHEN is_hot = 1 THEN 'hot' ELSE 'mild' END}]) AS x FROM matrix"""),
    "stats": (("dslices",), """SELECT x.s AS slice_name, x.g AS group_name, count(*) AS n, round(avg(demand_count), 3) AS mean_demand, round(median(demand_count), 1) AS median_demand,
  round(avg(CAST(demand_count = 0 AS INTEGER)) * 100, 1) AS zero_demand_pct, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM matrix), 2) AS representation_pct FROM dslices GROUP BY 1, 2"""),
    "mslices": (("ns",), """SELECT y, p, unnest([
  {'s': 'time_of_day', 'g': CASE WHEN hour_of_day IN (7, 8, 9, 17, 18, 19) THEN 'peak' WHEN hour_of_day >= 21 OR hour_of_day <= 6 THEN 'night' ELSE 'off_peak' END},
  {'s': 'day_type', 'g': CASE WHEN is_holiday = 1 THEN 'holiday' WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END},
  {'s': 'season', 'g': CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month <= 5 THEN 'spring' WHEN month <= 8 THEN 'summer' ELSE 'fall' END},
  {'s': 'station_capacity', 'g': CASE WHEN capacity <= 10 THEN 'low' WHEN capacity <= 20 THEN 'mid' ELSE 'high' END},
  {'s': 'precipitation', 'g': CASE WHEN precipitation_mm > 0 THEN 'rainy' ELSE 'dry' END},
  {'s': 'temperature', 'g': CASE WHEN temperature_c < 10 THEN 'cold' WHEN temperature_c > 25 THEN 'hot' ELSE 'mild' END}]) AS x FROM ns"""),
    "errors": (("mslices",), "SELECT x.s AS slice_name, x.g AS group_name, count(*) AS n, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae FROM mslices GROUP BY 1, 2"),
    "metrics": (("hs",), """SELECT count(*) AS n, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae, round(avg(CASE WHEN y > 0 THEN abs(p - y) / y END) * 100, 6) AS mape,
  round(1 - sum((p - y) * (p - y)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2 FROM hs"""),
    "perf": (("pred",), """SELECT CAST(forecast_hour AS DATE) AS date, count(*) AS n, round(sqrt(avg((predicted_demand - actual_demand) * (predicted_demand - actual_demand))), 8) AS rmse,
  round(avg(abs(predicted_demand - actual_demand)), 8) AS mae, CASE WHEN grouping(CAST(forecast_hour AS DATE)) = 1 THEN CASE WHEN count(*) = 0 THEN 'no_data' WHEN count(*) < 50 THEN 'insufficient_data' ELSE 'ok' END END AS status
  FROM pred GROUP BY ROLLUP (CAST(forecast_hour AS DATE)) HAVING grouping(CAST(forecast_hour AS DATE)) = 1 OR count(*) >= 10"""),
    "means": (("pred",), "SELECT station_id, avg(predicted_demand) AS mean, sum(predicted_demand) AS s, count(*) AS c FROM pred GROUP BY 1"),
    "marks": (("means",), """SELECT max(CASE WHEN i = CAST(floor(n * 0.85::DOUBLE) AS BIGINT) THEN mean END) AS p85, max(CASE WHEN i = CAST(floor(n * 0.65::DOUBLE) AS BIGINT) THEN mean END) AS p65, max(CASE WHEN i = CAST(floor(n * 0.15::DOUBLE) AS BIGINT) THEN mean END) AS p15,
  sum(s) / sum(c) AS network FROM (SELECT *, row_number() OVER (ORDER BY mean, station_id) - 1 AS i, count(*) OVER () AS n FROM means)"""),
    "status": (("means", "marks", "stations"), """SELECT *, CAST(floor(fill_pct * capacity / 100.0::DOUBLE + 0.5) AS INTEGER) AS current_bikes,
  CAST(CASE WHEN risk_level = 'critical' THEN -ceil(mean) WHEN risk_level = 'surplus' THEN ceil(mean * 0.5) ELSE 0 END AS INTEGER) AS net_flow_1h FROM (
  SELECT means.station_id, mean, coalesce(capacity, 20) AS capacity, CAST(least(95, greatest(5, floor(80 - mean / CASE WHEN network <> 0 THEN network ELSE 1 END * 35 + 0.5))) AS INTEGER) AS fill_pct,
  CASE WHEN mean >= p85 THEN 'critical' WHEN mean >= p65 THEN 'low' WHEN mean <= p15 THEN 'surplus' ELSE 'moderate' END AS risk_level
  FROM means LEFT JOIN stations USING (station_id) CROSS JOIN marks)"""),
    "fills": (("stations",), """SELECT station_id, fill_pct,
  CASE WHEN fill_pct / 100.0::DOUBLE < 0.1 OR fill_pct / 100.0::DOUBLE > 0.9 THEN 'Critical' WHEN fill_pct / 100.0::DOUBLE < 0.2 OR fill_pct / 100.0::DOUBLE > 0.8 THEN 'Warning' ELSE 'OK' END AS urgency,
  CASE WHEN fill_pct / 100.0::DOUBLE < 0.15 THEN 'add' WHEN fill_pct / 100.0::DOUBLE > 0.85 THEN 'remove' ELSE 'balanced' END AS action,
  CASE WHEN fill_pct <= 10 OR fill_pct >= 92 THEN 'critical' WHEN fill_pct <= 25 THEN 'low' WHEN fill_pct >= 75 THEN 'surplus' ELSE 'moderate' END AS risk,
  CASE WHEN fill_pct <= 10 OR fill_pct >= 92 THEN 'red' WHEN fill_pct <= 25 OR fill_pct >= 80 THEN 'amber' ELSE 'green' END AS bar_severity,
  CASE WHEN fill_pct < 15 OR fill_pct > 90 THEN 'red' WHEN fill_pct < 30 OR fill_pct > 80 THEN 'amber' ELSE 'green' END AS map_severity
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS station_id, CAST(c_custkey * 7 % 101 AS INTEGER) AS fill_pct FROM customer)"""),
    "kl20": (("kbins",), """SELECT feature, sum(p * ln(p / q)) AS kl FROM (
  SELECT feature, dc / sum(dc) OVER (PARTITION BY feature) AS p, dr / sum(dr) OVER (PARTITION BY feature) AS q FROM (
    SELECT feature, r / (sum(r) OVER (PARTITION BY feature) * (hi - lo) / bins) + 1e-10::DOUBLE AS dr, c / (sum(c) OVER (PARTITION BY feature) * (hi - lo) / bins) + 1e-10::DOUBLE AS dc FROM kbins)) GROUP BY 1"""),
}


def sql(body: str, *names: str, **own: str) -> str:
    """body after a WITH of the named parts and all that they need; own gives further parts by name."""
    from tidegrid.operators.features import HOLIDAYS

    listed = "[" + ", ".join("['{}', '{}']".format(a, b.replace("'", "''")) for a, b in HOLIDAYS) + "]"
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        if name in own:
            order.append(name)
            return
        for other in PARTS[name][0]:
            need(other)
        order.append(name)

    for name in names:
        need(name)
    if not order:
        return body
    once = lambda n: "MATERIALIZED " if n in REPEATED else ""
    return "WITH " + ",\n".join(f"{n} AS {once(n)}({(own[n] if n in own else PARTS[n][1]).replace('{HOLIDAYS}', listed)})" for n in order) + "\n" + body
