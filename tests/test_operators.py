"""Values that the operators must give on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import labels
from tidegrid.operators import clean, drift, features, gates, metrics, panel, quality, serving, slices, stations

DAY = dt.datetime(2024, 6, 15, 8)


def trips(spark, rows):
    """rows: (ride_id, seconds, start, end)."""
    data = [(r, " Classic ", DAY, DAY + dt.timedelta(seconds=s), a, b, "Member ") for r, s, a, b in rows]
    return spark.createDataFrame(data, "ride_id string, rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string, member_casual string")


def test_cleaning(spark):
    raw = trips(spark, [("a", 900, "x", "y"), ("a", 900, "x", "y"), ("b", 900, None, "y"), ("c", 30, "x", "y"), ("d", 90_000, "x", "y"), ("e", 60, "x", "y"), ("f", 86_400, "x", "y")])
    out = {r["ride_id"]: r for r in clean.clean_trips(raw).collect()}
    assert set(out) == {"a", "e", "f"}
    assert out["a"]["rideable_type"] == "classic" and out["a"]["member_casual"] == "member"
    assert out["a"]["trip_duration_minutes"] == 15 and out["a"]["day_of_week"] == 6
    w = clean.cleaning_waterfall(raw).first()
    assert (w["n_raw"], w["n_duplicate"], w["n_missing"], w["n_duration"], w["n_kept"]) == (7, 1, 1, 2, 3)


def test_cleaning_of_nothing(spark):
    empty = trips(spark, [])
    assert clean.clean_trips(empty).count() == 0
    assert clean.cleaning_waterfall(empty).first()["retention_pct"] is None


def test_panel_is_dense(spark):
    rows = [("2024-06-15 12:10:00", "a"), ("2024-06-15 12:50:00", "a"), ("2024-06-15 14:10:00", "b")]
    t = spark.createDataFrame(rows, "s string, start_station_id string").select(F.col("s").cast("timestamp_ntz").alias("started_at"), "start_station_id")
    out = panel.hourly_demand(t)
    assert out.count() == 6
    assert out.agg(F.sum("demand_count")).first()[0] == 3
    first = out.orderBy("start_station_id", "hour").first()
    assert first["hour"] == dt.datetime(2024, 6, 15, 8) and first["demand_count"] == 2 and first["is_weekend"] == 1
    assert all(r["passed"] for r in panel.panel_checks(out, t).collect())


def test_filled_series_equal_a_grid_and_windows(spark):
    """Gaps at both ends, a station of one hour, a null id, a null hour: as a grid joined to its counts, with windows over it."""
    at = lambda h: DAY + dt.timedelta(hours=h)
    rows = [("a", at(3), 2), ("a", at(4), 1), ("a", at(200), 5), ("b", at(0), 7), ("c", at(230), 1), (None, at(9), 4), ("d", None, 3)]
    d = spark.createDataFrame(rows, "start_station_id string, hour timestamp_ntz, demand_count long")
    hours = d.agg(F.expr("explode(sequence(min(hour), max(hour), interval 1 hour))").alias("hour"))
    want = d.select("start_station_id").distinct().crossJoin(hours).join(d, ["start_station_id", "hour"], "left").withColumn("demand_count", F.coalesce("demand_count", F.lit(0)))
    names = ["start_station_id", "hour", "demand_count", *features.LAGS, *features.ROLLING]
    for ordered in (False, True):
        got = features.with_series_history(panel.filled(panel.station_series(d, ordered)))
        assert got.count() == want.count() == 5 * 231
        assert got.select(names).exceptAll(features.with_history(want).select(names)).count() == 0
    parts = panel.hourly_demand(spark.createDataFrame([(s, DAY + dt.timedelta(hours=h)) for s in "cab" for h in (0, 5)], "start_station_id string, started_at timestamp_ntz"), ordered=True)
    keys = [(r["start_station_id"], r["hour"]) for r in parts.collect()]
    assert keys == sorted(keys) and len(keys) == 18
    assert panel.zero_filled(d.limit(0)).count() == 0


def test_hours_merge_when_clocks_go_back(spark):
    rows = [("2024-11-03 05:30:00", "a"), ("2024-11-03 06:30:00", "a")]
    t = spark.createDataFrame(rows, "s string, start_station_id string").select(F.col("s").cast("timestamp_ntz").alias("started_at"), "start_station_id")
    assert [(r["hour"], r["demand_count"]) for r in panel.station_hours(t).collect()] == [(dt.datetime(2024, 11, 3, 1), 2)]


def demand(spark, by_station):
    rows = [(s, DAY + dt.timedelta(hours=i), d) for s, values in by_station.items() for i, d in enumerate(values)]
    return spark.createDataFrame(rows, "start_station_id string, hour timestamp_ntz, demand_count long")


def test_history(spark):
    out = features.with_history(demand(spark, {"a": [0, 10, 20, 30, 40, 50], "b": [7, 8]})).orderBy("start_station_id", "hour").collect()
    assert out[4]["rolling_avg_3h"] == 20
    assert out[0]["demand_lag_1h"] == 0 and out[1]["rolling_avg_24h"] == 0 and out[2]["rolling_avg_24h"] == 5
    assert out[6]["demand_lag_1h"] == 0 and out[7]["demand_lag_1h"] == 7


def test_history_takes_one_exchange(spark):
    plan = features.with_history(demand(spark, {"a": [1, 2]}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_cycles(spark):
    row = features.with_cycles(spark.createDataFrame([(6, 0, 12)], "hour_of_day int, day_of_week int, month int")).first()
    assert row["hour_sin"] == pytest.approx(1) and row["dow_cos"] == pytest.approx(1) and row["month_sin"] == pytest.approx(0, abs=1e-9)


def test_holidays(spark):
    by = {r["holiday_type"]: r["n"] for r in features.holiday_calendar(spark).groupBy("holiday_type").agg(F.count("*").alias("n")).collect()}
    assert by == {"federal_observance": 16, "major_holiday": 4, "summer_holiday": 2, "federal_holiday": 2}


def test_capacity_median_and_default(spark):
    p = demand(spark, {"a": [1], "b": [1]})
    feed = spark.createDataFrame([("a", 10), ("c", 15)], "start_station_id string, capacity int")
    assert {r["start_station_id"]: r["capacity"] for r in features.join_capacity(p, feed).collect()} == {"a": 10, "b": 12}
    assert {r["capacity"] for r in features.join_capacity(p, feed.where("false")).collect()} == {17}


def test_weather_gaps(spark):
    p = demand(spark, {"a": [1, 1, 1, 1]})
    weather = spark.createDataFrame([(DAY + dt.timedelta(hours=1), 5.0, 1.0, 0.0, 1.0, 1), (DAY + dt.timedelta(hours=3), 30.0, 0.0, 0.0, 1.0, 1)], "hour timestamp_ntz, temperature_c double, precipitation_mm double, wind_speed_kmh double, humidity_pct double, weather_code int")
    out = features.with_weather_flags(features.filled_weather(weather, p)).orderBy("weather_hour").collect()
    assert [r["temperature_c"] for r in out] == [5, 5, 5, 30]
    assert [r["is_cold"] for r in out] == [1, 1, 1, 0] and out[3]["is_hot"] == 1


def test_range_and_null_checks(spark):
    df = spark.createDataFrame([(-1, 25, None), (2, 3, 4.0)], "demand_count long, hour_of_day int, temperature_c double")
    bad = {r["column_name"]: r for r in quality.range_checks(df).where("NOT passed").collect()}
    assert set(bad) == {"demand_count", "hour_of_day"} and bad["hour_of_day"]["above"] == 1
    assert {r["column_name"]: r["nulls"] for r in quality.null_checks(df).collect()}["temperature_c"] == 1
    status = {r["column_name"]: r["status"] for r in quality.schema_checks(df).collect()}
    assert status["capacity"] == "missing" and status["demand_count"] == "ok"
    with pytest.raises(quality.ContractError):
        quality.validate_features(df)


def test_disparity(spark):
    stats = spark.createDataFrame([("s", "a", 10.0, 50.0), ("s", "b", 1.0, 50.0), ("t", "a", 3.0, 1.0)], "slice_name string, group_name string, mean_demand double, representation_pct double")
    assert {r["slice_name"]: r["disparity_ratio"] for r in slices.slice_disparity(stats).collect()} == {"s": 10.0, "t": 1.0}
    assert {(r["slice_name"], r["flag"]) for r in slices.slice_flags(stats).collect()} == {("s", "disparity"), ("t", "representation")}


def test_error_disparity(spark):
    rows = [("s", "a", 2000, 1.0), ("s", "b", 2000, 2.0), ("s", "c", 2000, 3.0), ("t", "a", 2000, 1.0), ("t", "b", 10, 9.0)]
    out = {r["slice_name"]: r for r in slices.error_disparity(spark.createDataFrame(rows, "slice_name string, group_name string, n long, rmse double")).collect()}
    assert out["s"]["disparity_ratio"] == 3.0 and out["s"]["status"] == "PASSED"
    assert out["t"]["disparity_ratio"] is None and out["t"]["status"] == "SKIPPED"


def test_hour_labels(spark):
    hours = spark.createDataFrame([(7,), (13,), (22,), (16,)], "h int")
    own = [tuple(r) for r in hours.select("h", labels.hour_label(F.col("h"), labels.MODEL_PEAK, labels.MODEL_NIGHT), labels.hour_label(F.col("h"), labels.DATA_PEAK, labels.DATA_NIGHT)).collect()]
    assert own == [(7, "peak", "peak"), (13, "off_peak", "off_peak"), (22, "night", "night"), (16, "off_peak", "peak")]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 1.0), (4.0, 5.0)], "y double, p double")
    m = metrics.regression_metrics(df).first()
    assert m["mape"] == 25 and m["rmse"] == 1 and m["mae"] == 1
    gate = {r["metric"]: r["passed"] for r in metrics.validation_gate(metrics.regression_metrics(df)).collect()}
    assert gate == {"rmse": True, "r2": True, "mae": True}


def test_metrics_of_constant_truth(spark):
    assert metrics.regression_metrics(spark.createDataFrame([(2.0, 1.0)], "y double, p double")).first()["r2"] is None


def test_split(spark):
    hours = spark.sql("SELECT explode(sequence(timestamp_ntz'2024-06-30 22:00:00', timestamp_ntz'2024-10-01 01:00:00', interval 1 hour)) AS hour")
    out = {r["split"]: r["n"] for r in metrics.split_summary(metrics.temporal_split(hours)).collect()}
    assert out["train"] == 2 and out["test"] == 2 and sum(out.values()) == hours.count()


def runs(spark):
    return spark.createDataFrame([(1, 1.6, "approved", 1), (2, 1.9, "rejected", 2)], "run_id long, val_rmse double, status string, started_at long")


@pytest.mark.parametrize(("rmse", "decision"), [(2.0, "rejected"), (1.5, "accepted"), (1.7, "accepted")])
def test_rollback(spark, rmse, decision):
    candidate = spark.createDataFrame([(3, rmse)], "run_id long, val_rmse double")
    assert gates.rollback_gate(gates.best_run(runs(spark)), candidate).first()["decision"] == decision
    assert gates.rollback_gate(runs(spark).where("false"), candidate).first()["decision"] == "accepted"
    assert gates.rollback_gate(gates.best_run(runs(spark)), candidate, force=True).first()["decision"] == "accepted"


def test_drift(spark):
    ref = spark.range(5000).select(F.randn(1).alias("t"), F.lit(3.0).alias("same"))
    assert drift.feature_drift(ref, ref, ["t", "same"]).where("drifted").count() == 0
    moved = ref.select((F.col("t") + 3).alias("t"), "same")
    kl = {r["feature"]: r["kl"] for r in drift.feature_drift(ref, moved, ["t", "same", "absent"]).collect()}
    assert kl["t"] > 0.1 and kl["same"] < 0.01 and set(kl) == {"t", "same"}
    assert drift.ks_statistic(ref, moved, ["t"]).first()["ks"] > 0.5


@pytest.mark.parametrize(("after", "drifted"), [(1.08, True), (0.567, False)])
def test_performance_drift(spark, after, drifted):
    frame = lambda e: spark.createDataFrame([(e,)] * 5, "e double")
    assert drift.performance_drift(frame(0.54), frame(after), "e").first()["drifted"] is drifted
    assert drift.performance_drift(frame(0.0), frame(1.0), "e").first()["increase_pct"] == 0


def test_nearest_equals_all_pairs(spark):
    import random

    draw = random.Random(5)
    a = [(f"a{i}", 42 + draw.random() / 50, -71 + draw.random() / 50) for i in range(60)]
    b = [(f"b{i}", 10, 42 + draw.random() / 50, -71 + draw.random() / 50) for i in range(60)]
    got = {r["start_station_id"]: r["feed_station_id"] for r in stations.nearest(spark.createDataFrame(a, "start_station_id string, lat double, lon double"), spark.createDataFrame(b, "station_id string, capacity int, lat double, lon double")).collect()}
    want = {}
    for i, x, y in a:
        best = min((((x - u) ** 2 + (y - v) ** 2) ** 0.5 * 111_000, j) for j, _, u, v in b)
        if best[0] <= 500:
            want[i] = best[1]
    assert got == want and want


def test_a_place_of_many_feed_stations_is_met_once(spark):
    feed = spark.range(2000).select(F.col("id").cast("string").alias("station_id"), F.lit(42.0).alias("lat"), F.lit(-71.0).alias("lon"), F.col("id").cast("int").alias("capacity"))
    feed = feed.where("station_id <> '0'").unionByName(spark.createDataFrame([("0", 42.002, -71.0, 7)], "station_id string, lat double, lon double, capacity int"))
    own = spark.range(500).select(F.concat(F.lit("s"), "id").alias("start_station_id"), F.lit(42.0).alias("lat"), F.lit(-71.0).alias("lon"))
    out = stations.nearest(own, feed)
    assert out.groupBy("feed_station_id", "capacity").count().collect() == [("1", 1, 500)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [lat") == 1  # before the join


def test_duplicates_are_counted_by_dealt_keys(spark):
    d = demand(spark, {"a": [1, 2, 3], "b": [4]})
    again = d.unionByName(d.where("start_station_id = 'a'")).unionByName(d.limit(1))
    assert quality.duplicate_check(again).collect() == [(4, False)] and quality.duplicate_check(d).collect() == [(0, True)]
    plan = quality.duplicate_check(panel.filled(panel.station_series(d)))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning(start_station_id#") >= 2


def test_station_risk_picks_elements(spark):
    rows = [(f"s{i:02d}", DAY, float(i)) for i in range(20)]
    p = spark.createDataFrame(rows, "station_id string, forecast_hour timestamp_ntz, predicted_demand double")
    out = {r["station_id"]: r for r in serving.station_risk(p, spark.createDataFrame([("s00", 40)], "station_id string, capacity int")).collect()}
    assert [i for i in range(20) if out[f"s{i:02d}"]["risk_level"] == "critical"] == [17, 18, 19]
    assert out["s13"]["risk_level"] == "low" and out["s03"]["risk_level"] == "surplus" and out["s05"]["risk_level"] == "moderate"
    assert out["s00"]["capacity"] == 40 and out["s01"]["capacity"] == 20


def test_json_safe(spark):
    row = serving.json_safe(spark.createDataFrame([(float("nan"), float("inf"), 1 / 3, DAY)], "a double, b double, c double, d timestamp_ntz")).first()
    assert tuple(row) == (None, None, 0.333333, "2024-06-15T08:00:00")


def test_severity_is_inclusive(spark):
    assert spark.range(1).select(labels.drift_severity(F.lit(0.1), 0.1), labels.drift_severity(F.lit(0.07), 0.1), labels.drift_severity(F.lit(0.01), 0.1)).first()[:] == ("DRIFTED", "WARNING", "OK")


def test_rows_without_an_actual_are_not_counted(spark):
    """Sixty rows, five of them with an actual, are five."""
    rows = [("2024-01-01 00:00:00", 2.0, 1.0 if i < 5 else None) for i in range(60)] + [("2024-01-02 00:00:00", None, 1.0)]
    log = spark.createDataFrame(rows, "forecast_hour string, predicted_demand double, actual_demand double")
    out = metrics.rolling_performance(log).collect()
    assert [(r["date"], r["n"], r["rmse"], r["status"]) for r in out] == [(None, 5, 1.0, "insufficient_data")]
    assert [(r["n"], r["status"]) for r in metrics.rolling_performance(log.where("false")).collect()] == [(0, "no_data")]
    assert metrics.degradation_check(metrics.rolling_performance(log), 0.5).first()["n"] == 5


def test_every_capacity_is_in_a_slice_of_the_model_report(spark):
    df = spark.createDataFrame([(None,), (0,), (-3,), (10,), (11,), (20,), (21,), (1000,)], "capacity int")
    slices_of = lambda f: [r[0] for r in df.select(f()["station_capacity"].alias("g")).collect()]
    assert slices_of(labels.model_slices) == ["high", "low", "low", "low", "mid", "mid", "high", "high"]
    assert slices_of(labels.data_slices) == [None, None, None, "low_cap", "mid_cap", "mid_cap", "high_cap", None]
    rows = spark.createDataFrame([(c, 12, 0, 0, 6, 0.0, 15.0, 1.0, 2.0) for c in (None, 0, 1000)], "capacity int, hour_of_day int, is_weekend int, is_holiday int, month int, precipitation_mm double, temperature_c double, y double, p double")
    found = {r["group_name"]: r["n"] for r in slices.slice_errors(rows, labels.model_slices()).where("slice_name = 'station_capacity'").collect()}
    assert found == {"low": 1, "high": 2}


def test_medians_and_shares_are_rounded_to_one_place(spark):
    rows = spark.createDataFrame([(d,) for d in (0, 0, 1, 1, 2, 3, 7)], "demand_count long")
    got = slices.slice_stats(rows, {"all": F.lit("all")}).first()
    assert (got["median_demand"], got["zero_demand_pct"], got["mean_demand"]) == (1.0, 28.6, 2.0)
