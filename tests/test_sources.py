"""Files in, files out, streams."""

import datetime as dt
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tidegrid import streaming
from tidegrid.operators import features, ml, serving, views
from tidegrid.plans import pipelines
from tidegrid.sources import feeds, store, trips

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n"
ROW = "r{0},classic,2024-06-15 08:00:00,2024-06-15 08:15:00,A,x,B,y,42.1,-71.1,42.2,-71.2,member\n"


def test_trip_files(spark, tmp_path):
    (tmp_path / "new.csv").write_text(HEADER + ROW.format(1) + ROW.format(2))
    (tmp_path / "old.csv").write_text("tripduration,starttime\n5,2015-01-01\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bare.csv").write_text(HEADER.strip())
    (tmp_path / "notes.txt").write_text(HEADER + ROW.format(9))
    for name, row in (("a", 3), ("new", 4), ("none", None)):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("readme.txt", "x")
            if row:
                z.writestr("trips.csv", HEADER + ROW.format(row))
                z.writestr("z.csv", HEADER + ROW.format(99))
    read = trips.read_trips(spark, str(tmp_path))
    assert {r["ride_id"]: r["started_at"] for r in read.collect()} == dict.fromkeys(("r1", "r2", "r3"), dt.datetime(2024, 6, 15, 8))
    assert trips.read_trips(spark, [str(tmp_path / "*.zip")]).count() == 2
    assert trips.read_trips(spark, str(tmp_path / "nothing*")).count() == 0


def test_large_files_are_read_in_ranges(spark, tmp_path):
    rows = [ROW.format(i) for i in range(300)]
    (tmp_path / "a.csv").write_bytes((HEADER.replace("\n", "\r\n") + "".join(rows)).rstrip("\n").encode())
    size = (tmp_path / "a.csv").stat().st_size
    for width in (1, 97, 1000, len(HEADER) + 1, size - 1, size, size + 9):
        pieces = trips.parts([(str(tmp_path / "a.csv"), size)], width)
        found = [r for p in pieces for one in p.ranges for batch in trips.read_range(*one) for r in batch.column("ride_id").to_pylist()]
        assert found == [f"r{i}" for i in range(300)], width
    assert len(trips.parts([("x.zip", 10**9), ("y.csv", 5), ("z.csv", 7)], 100)) == 2  # archives are whole, small files go together


def test_any_number_of_files_is_one_scan_and_one_job(spark, tmp_path):
    for i in range(10_000):
        (tmp_path / f"{i}.csv").write_text(HEADER + ROW.format(i))
    sc = spark.sparkContext
    sc.setJobGroup("many files", "")
    read = trips.read_trips(spark, f"{tmp_path}/*.csv")
    assert len(sc.statusTracker().getJobIdsForGroup("many files")) == 0  # nothing is read to plan
    assert len(read.select("ride_id").toArrow().column(0).unique()) == 10_000
    assert len(sc.statusTracker().getJobIdsForGroup("many files")) == 1
    sc._jsc.clearJobGroup()
    assert read._jdf.queryExecution().executedPlan().toString().count("BatchScan") == 1


def test_archives_reach_cleaned_partitions(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "202406.zip", "w") as z:
        z.writestr("trips.csv", HEADER + ROW.format(1) + ROW.format(1) + ROW.format(2))
    pipelines.clean_year(spark, str(tmp_path / "*"), str(tmp_path / "out"))
    assert store.read_years(spark, str(tmp_path / "out"), 2024).count() == 2


def test_feeds(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"data": {"stations": [{"station_id": "a", "name": "A", "short_name": "A1", "lat": 1.0, "lon": 2.0, "capacity": 9, "rental_methods": ["KEY", "CARD"]}]}}))
    row = feeds.read_stations(spark, str(tmp_path / "s.json"), "2024-01-01 00:00:00").first()
    assert row["rental_methods"] == "KEY,CARD" and row["region_id"] is None
    for k in range(2):
        hourly = {"time": [f"2024-01-0{k + 1}T00:00", f"2024-01-0{k + 1}T01:00"], "temperature_2m": [1.0, 2.0], "precipitation": [0.0, 0.0], "windspeed_10m": [1.0, 1.0], "relativehumidity_2m": [50.0, 51.0], "weathercode": [1, 2]}
        (tmp_path / f"w{k}.json").write_text(json.dumps({"hourly": hourly}))
    assert feeds.read_weather(spark, str(tmp_path / "w*.json")).count() == 4


def test_partitions_are_overwritten_alone(spark, tmp_path):
    path = str(tmp_path / "p")
    frame = lambda rows: spark.createDataFrame(rows, "year int, month int, v int")
    store.write_partitioned(frame([(2023, 1, 1), (2024, 1, 2)]), path)
    store.write_partitioned(frame([(2024, 1, 3)]), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert store.read_years(spark, path, 2024).count() == 1


def test_sorted_sink_and_fingerprint(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("start_station_id"), F.col("id").alias("hour"))
    store.write_sorted(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert store.fingerprint(back).first() == store.fingerprint(df).first()
    assert store.fingerprint(df.where("hour < 999")).first() != store.fingerprint(df).first()


def test_report_and_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "slice_name string, group_name string, n int")
    store.write_report(df, str(tmp_path / "r"), by="slice_name")
    assert len(spark.read.json(str(tmp_path / "r")).first()["rows"]) == 2
    store.write_formats(df, str(tmp_path / "f"))
    assert spark.read.option("header", True).csv(str(tmp_path / "f/csv")).count() == 2


def test_forecast(spark, tmp_path):
    hours = [dt.datetime(2024, 6, 1) + dt.timedelta(hours=i) for i in range(200)]
    rows = [(s, h, i % 24, 10, 20.0, 0.0, 5.0, 50.0, 1, 0, 0, 0, 19.0) for s in "ab" for i, h in enumerate(hours)]
    m = spark.createDataFrame(rows, "start_station_id string, hour timestamp_ntz, demand_count long, capacity int, temperature_c double, precipitation_mm double, wind_speed_kmh double, humidity_pct double, weather_code int, is_precipitation int, is_cold int, is_hot int, feels_like_c double")
    weather = serving.last_known(m, ["temperature_c", "precipitation_mm"])
    out = ml.recursive_forecast(serving.station_history(m), weather, features.holiday_calendar(spark))
    got = [(r["forecast_hour"], r["predicted_demand"]) for r in out.where("station_id = 'a'").orderBy("forecast_hour").collect()]
    assert len(got) == 24 and got[0][0] == hours[-1] + dt.timedelta(hours=1)
    assert [p for _, p in got] == [float((200 + i) % 24) for i in range(24)]
    store.write_predictions(out, str(tmp_path / "p"))
    assert store.read_predictions(spark, str(tmp_path / "p"), "2024-06-09").count() == 48


def test_readers_never_see_a_forecast_half_written(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/p"
    rows = lambda v: spark.createDataFrame([("a", dt.datetime(2024, 6, 1), v, 1, "x")], store.PREDICTIONS)
    seen = lambda day=None: [r["predicted_demand"] for r in store.read_predictions(spark, root, day).collect()]
    assert seen() == seen("2024-06-01") == []
    store.write_predictions(rows(1.0), root)
    real = store.point
    monkeypatch.setattr(store, "point", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))  # the writer is killed between the two steps
    with pytest.raises(KeyboardInterrupt):
        store.write_predictions(rows(2.0), root)
    assert seen() == seen("2024-06-01") == [1.0]
    monkeypatch.setattr(store, "point", real)
    reading = store.read_predictions(spark, root)
    store.write_predictions(rows(3.0), root)
    assert seen() == seen("2024-06-01") == [3.0] and [r["predicted_demand"] for r in reading.collect()] == [1.0]  # who has begun, ends
    assert store.drop_unnamed(spark, root) == 2 and seen() == [3.0]
    assert sorted(p.name for p in (tmp_path / "p").iterdir() if not p.name.startswith(".")) == ["data", "day-2024-06-01", "latest"]


def test_a_forecast_that_is_the_latest_moves_no_rows(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    rows = lambda day, k: spark.range(4).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("station_id"), F.expr(f"timestamp_ntz'2024-06-0{day} 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("forecast_hour"), (F.col("id") + k).cast("double").alias("predicted_demand"))
    seen = lambda df: sorted((r["station_id"], r["predicted_demand"], r["latest"]) for r in df.collect())
    store.write_predictions(rows(1, 0), root)
    alone = store.with_latest(spark, root, "2024-06-01")
    assert seen(alone) == [(f"S{k}", k, k) for k in range(4)]
    assert not re.search("Exchange|Join", alone._jdf.queryExecution().executedPlan().toString())
    # the latest forecast shares one hour with the first, whose day is pointed back to it
    store.write_predictions(rows(2, 10).unionByName(rows(1, 20).where("station_id = 'S3'")), root)
    store.point(spark, f"{root}/day-2024-06-01", [f for f in (f"{root}/data/{p.name}" for p in (tmp_path / "p" / "data").iterdir()) if spark.read.parquet(f).count() == 4][0])
    assert seen(store.with_latest(spark, root, "2024-06-01")) == [("S3", 3, 23)]


def test_views_follow_changes(spark, tmp_path):
    root = str(tmp_path / "views")
    hours = [dt.datetime(2024, 6, 1) + dt.timedelta(hours=i) for i in range(48)]
    rows = [(f"s{s}", h, float((s * 7 + i * 3) % 11), i % 3) for s in range(40) for i, h in enumerate(hours)]
    frame = lambda own: spark.createDataFrame(own, "station_id string, forecast_hour timestamp_ntz, predicted_demand double, model_version int")
    views.update(spark, root, frame(rows[: 40 * 48 - 24]))
    new = [("s3", h, 50.0, 9) for h in hours[10:20]] + [("new", hours[0], 1.0, 9)] + rows[40 * 48 - 24 :]
    changed = views.update(spark, root, frame(new))
    assert len(changed) <= 3
    now = {(r[0], r[1]): r for r in rows} | {(r[0], r[1]): r for r in new}
    whole = frame(list(now.values()))
    parts = views.read_partials(spark, root)
    for name in ("prediction_summary", "network_demand", "station_peaks", "forecast_summary"):
        got, want = getattr(views, name)(parts), getattr(serving, name)(whole)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    again = views.update(spark, root, frame(new))  # a run that is repeated changes nothing
    assert again == changed and views.read_partials(spark, root).exceptAll(views.partials(whole)).count() == 0
    plan = views.changed_partials(spark, root, frame(new), changed)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in plan.inputFiles()} >= set(changed)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "bucket" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_two_streams_meet(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("a", base + dt.timedelta(hours=12 * i), float(i)) for i in range(60)], "station_id string, forecast_hour timestamp_ntz, predicted_demand double").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([("a", base + dt.timedelta(hours=12 * i), 0.0) for i in range(60) if i % 3] + [("b", base, 1.0)], "station_id string, hour timestamp_ntz, actual_demand double").write.parquet(str(tmp_path / "a"))
    p = spark.readStream.schema("station_id string, forecast_hour timestamp_ntz, predicted_demand double").parquet(str(tmp_path / "p"))
    a = spark.readStream.schema("station_id string, hour timestamp_ntz, actual_demand double").parquet(str(tmp_path / "a"))
    out = {r["first_day"]: r for r in streaming.drained(streaming.streaming_errors(p, a), "errors").collect()}
    week = [i for i in range(14) if i % 3]
    assert out[base]["n"] == len(week) and abs(out[base]["mae"] - sum(week) / len(week)) < 1e-6
    assert max(out) + dt.timedelta(days=7) <= base + dt.timedelta(hours=12 * 59) - dt.timedelta(days=1)


def test_streams(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [("a", base + dt.timedelta(minutes=30 * i)) for i in range(20)]
    spark.createDataFrame(rows, "start_station_id string, started_at timestamp_ntz").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("start_station_id string, started_at timestamp_ntz").parquet(str(tmp_path / "in"))
    q = streaming.streaming_demand(source).writeStream.format("memory").queryName("demand").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    out = spark.table("demand").orderBy("hour").collect()
    assert [r["demand_count"] for r in out] == [2] * 7  # hours that end by the watermark, 9:30 - 2 h
    log = [(base + dt.timedelta(days=i), 1.0, 2.0) for i in range(20)]
    spark.createDataFrame(log, "forecast_hour timestamp_ntz, predicted_demand double, actual_demand double").write.parquet(str(tmp_path / "log"))
    source = spark.readStream.schema("forecast_hour timestamp_ntz, predicted_demand double, actual_demand double").parquet(str(tmp_path / "log"))
    q = streaming.streaming_performance(source).writeStream.format("memory").queryName("performance").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("performance").agg(F.max("n")).first()[0] == 7
