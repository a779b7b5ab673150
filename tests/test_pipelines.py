"""Composed pipelines and models on small tables: what SQL cannot give, by its properties."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tidegrid.operators import boosting, features, ml, quality, serving
from tidegrid.plans import domain, pipelines
from tidegrid.plans.queries import QUERIES, SPLIT
from tidegrid.sources import scratch, store, trips

DATA = "/root/testdata/sf0.001"
FEW = {"maxIter": 8, "maxDepth": 4, "stepSize": 0.3, "featureSubsetStrategy": "all"}
KEY = ["start_station_id", "hour"]


@pytest.fixture(scope="module")
def matrix(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("matrix") / "m")
    domain.matrix(spark, DATA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def halves(matrix):
    return domain.halves(matrix, "hour", SPLIT)


def test_contract_is_validated(matrix):
    pipelines.validate(matrix, least=1000)
    with pytest.raises(quality.ContractError, match="rows, 1000000 wanted"):
        pipelines.validate(matrix)
    bad = matrix.withColumn("humidity_pct", F.lit(120.0)).unionByName(matrix.limit(1).withColumn("humidity_pct", F.lit(50.0)))
    with pytest.raises(quality.ContractError, match=r"humidity_pct: 0 below.*1 duplicates"):
        pipelines.validate(bad, least=1000)
    with pytest.raises(quality.ContractError, match="capacity: missing"):
        pipelines.validate(matrix.drop("capacity"), least=1000)


def test_training_is_evaluated_and_gated(matrix):
    model, by_split, gate = pipelines.train_evaluate(matrix, FEW, None, "2024-01-16", "2024-01-24")
    found = {r["split"]: r for r in by_split.collect()}
    assert set(found) == {"validation", "test"} and 0 <= model.best_iteration < FEW["maxIter"]
    rows = {r["metric"]: r for r in gate.collect()}
    assert set(rows) == {"rmse", "r2", "mae"}
    assert rows["rmse"]["value"] == found["test"]["rmse"] and rows["rmse"]["passed"] == (found["test"]["rmse"] <= 2.5)
    assert all(r["all_passed"] == all(x["passed"] for x in rows.values()) for r in rows.values())


@pytest.mark.parametrize("forecaster", [ml.Naive(), ml.Boosted(FEW)])
def test_forecasters_have_one_interface(spark, halves, forecaster):
    train, rest = halves
    own = forecaster.train(train, rest)
    scored = own.predict(rest)
    assert scored.count() == rest.count() and scored.where("p IS NULL OR p < 0").count() == 0
    assert own.kind in ("naive", "boosted_trees") and own.best_iteration >= 0
    shares = [r["importance"] for r in own.importances(spark).collect()]
    assert sum(shares) == pytest.approx(1.0) and min(shares) >= 0
    again = type(forecaster)(*([FEW] if own.kind != "naive" else [])).train(train, rest).predict(rest)
    assert scored.select(*KEY, "p").exceptAll(again.select(*KEY, "p")).count() == 0  # equal reruns


def test_what_a_model_leans_on_is_important(halves):
    train, rest = (h.withColumn("demand_count", (F.col("hour_of_day") * 2).cast("long")) for h in halves)
    model = ml.Boosted(FEW).train(train).model
    found = {r["feature"]: r["importance"] for r in ml.permutation_importance(model, rest, KEY).collect()}
    assert set(found) == set(quality.FEATURES) and len(found) == 29
    assert found["hour_of_day"] > 1 and found["capacity"] == found["start_station_id"] == 0


def rows_of(spark, n, stations, target):
    """Prepared rows: the station's code and an hour as the inputs."""
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(n).withColumns({"a": (F.col("id") % stations).cast("double"), "b": (F.col("id") % 24).cast("double")})
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).select("features", target.cast("double").alias("demand_count"))


def test_patience_ends_at_the_best_round():
    falling = [5.0, 4.0, 3.0, 3.5, *[3.2] * 30]
    assert ml.patient(falling, 20) == (2, True) and ml.patient(falling[:15], 20) == (2, False)
    assert ml.patient([3.0, *[3.1] * 19, 2.9], 20) == (20, False) and ml.patient([3.0, *[3.1] * 20, 2.9], 20) == (0, True)


def test_trees_stop_where_validation_rises_and_the_prefix_is_the_model(spark):
    ready = rows_of(spark, 2400, 10, F.col("id") % 24 + (F.col("id") % 10) * 0.15)
    checked = rows_of(spark, 1200, 10, F.col("id") % 24 + 0.675)  # what the trees learn last doesn't hold here
    params = {"maxIter": 60, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    whole = ml.fit_trees(ready, None, params)
    errors = whole.evaluateEachIteration(checked, "squared")
    k = min(range(60), key=lambda i: errors[i])
    assert 0 < k < 30 and errors[k + 1] > errors[k]
    cut = ml.fit_trees(ready, checked, params, patience=10)
    assert cut.getNumTrees == k + 1 and cut.evaluateEachIteration(checked, "squared") == pytest.approx(errors[: k + 1])
    assert sum(cut.featureImportances.toArray()) == pytest.approx(1)


def three_inputs(spark, n=60_000):
    from pyspark.ml.feature import VectorAssembler

    rows = spark.range(n).withColumns({"a": (F.col("id") % 97).cast("double"), "b": (F.col("id") % 24).cast("double"), "c": ((F.col("id") * 7919) % 1009).cast("double")})
    rows = rows.withColumns({"demand_count": (F.col("a") * F.col("b") % 31 + F.sqrt("c")).cast("double"), "w": F.col("id") % 3 + 0.5})
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).select("features", "demand_count", "w")


@pytest.mark.parametrize("weights", [None, "w"])
def test_trees_that_draw_nothing_are_those_of_sparks_own_trainer(spark, weights):
    """In several tasks; with more values than bins in one input."""
    ready = three_inputs(spark)
    params = {"maxIter": 4, "maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 5}
    own = ml.fit_trees(ready, None, params, weights)
    theirs = GBTRegressor(featuresCol="features", labelCol="demand_count", maxBins=ml.BINS, seed=42, **params)
    theirs = (theirs.setWeightCol(weights) if weights else theirs).fit(ready)
    assert own.evaluateEachIteration(ready, "squared") == pytest.approx(theirs.evaluateEachIteration(ready, "squared"), rel=1e-6)
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), rel=1e-4)
    assert [t.numNodes for t in own.trees] == [t.numNodes for t in theirs.trees]


def test_all_trees_grow_in_one_job_and_are_the_same_in_any_number_of_tasks(spark):
    """Draws are a block's, and sums are whole numbers."""
    ready = three_inputs(spark).repartition(6)
    params = {"maxIter": 15, "maxDepth": 5, "stepSize": 0.3, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
    with scratch.run(spark):
        rows = boosting.binned(ready, ready, "demand_count", None, ml.BINS)
        assert rows.count == 60_000 and [len(c) + 1 for c in rows.cuts] == [97, 24, 256]
        spark.sparkContext.setJobGroup("trees", "trees")
        try:
            grown = [boosting.grow(rows, params, 20, 42, tasks) for tasks in (1, 4)]
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("trees")) <= 4  # two trainings, and the shuffles before them
        assert len(grown[0].trees) == 15 and grown[0].trees == grown[1].trees and grown[0].errors == pytest.approx(grown[1].errors)
        model = ml.fit_trees(rows, None, params)
        assert grown[0].errors == pytest.approx(model.evaluateEachIteration(ready, "squared"), rel=1e-6)


def test_rows_beyond_memory_are_in_a_file_and_messages_in_pieces(spark, monkeypatch):
    rows = boosting.binned(three_inputs(spark, 5000), three_inputs(spark, 1000), "demand_count", "w", ml.BINS)
    batches = rows.table.toArrow().to_batches()
    own = boosting.settled({"maxIter": 3, "maxDepth": 6, "minInstancesPerNode": 3})
    whole = boosting._Task(iter(batches), rows.cuts, True, lambda m: [m]).grown(own, 20, 1)
    for name, value in {"HELD_ROWS": 100, "PASS_ROWS": 300, "MESSAGE": 1000, "TOGETHER": 50}.items():
        monkeypatch.setattr(boosting, name, value)
    pieces = boosting._Task(iter(batches), rows.cuts, True, None).grown(own, 20, 1)
    assert pieces.trees == whole.trees and pieces.errors == pytest.approx(whole.errors)
    none = boosting._Task(iter(()), rows.cuts, True, None)  # a task without rows tells as many sums
    assert none.part.sums(np.zeros(1, np.int64), 1, 1.0, 1.0, none.starts).tolist() == np.zeros((3, 1, none.starts[-1] + 1)).tolist()


def test_an_input_without_a_value_is_an_error(halves):
    with pytest.raises(Exception, match="no value"):
        ml.train(halves[0].withColumn("temperature_c", F.when(F.col("hour_of_day") != 3, F.col("temperature_c"))), {"maxIter": 1})


def test_no_more_trees_are_grown_than_patience_needs(spark, monkeypatch):
    ready = rows_of(spark, 2400, 10, F.col("id") % 24)
    checked = rows_of(spark, 1200, 10, 24 - F.col("id") % 24)  # what the trees learn is wrong here from the first on
    real, grown = ml._booster, []
    monkeypatch.setattr(ml, "_booster", lambda params, *a: grown.append(params["maxIter"]) or real(params, *a))
    params = {"maxIter": 60, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    assert ml.fit_trees(ready, checked, params, patience=5).getNumTrees == 1 and grown == [6]


def test_training_has_no_more_tasks_than_cores_while_their_rows_are_few(spark, monkeypatch):
    assert [ml.tasks_for(n, 12) for n in (0, 1, 50_001, 540_000, 3_240_000, 12_000_000, 12_000_001, 32_400_000)] == [1, 1, 2, 11, 12, 12, 24, 36]
    monkeypatch.setattr(ml, "TASK_ROWS", 100)
    ready = rows_of(spark, 10_000, 10, F.col("id") % 24)
    with scratch.run(spark):
        stored = ml._stored(ready)
        assert stored.rdd.getNumPartitions() == min(100, spark.sparkContext.defaultParallelism) and stored.count() == 10_000


def test_more_stations_than_bins(spark, halves):
    """5,000 stations, in training and, some of them unseen, in scoring."""
    days = F.explode(F.sequence(F.lit(0), F.lit(3)))
    many = spark.range(5000).select(F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("start_station_id"), days.alias("day"))
    one = halves[0].limit(1).drop("start_station_id", "demand_count")
    rows = many.crossJoin(F.broadcast(one)).withColumn("demand_count", F.when(F.col("start_station_id") < "S02500", 1).otherwise(9).cast("long"))
    own = ml.Boosted({"maxIter": 3, "maxDepth": 3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}).train(rows.where("day < 3"))
    scored = own.predict(rows.where("day = 3").unionByName(rows.limit(1).withColumn("start_station_id", F.lit("unseen"))))
    assert scored.count() == 5001 and scored.where("p < 0 OR p IS NULL").count() == 0
    by = {r["demand_count"]: r["p"] for r in scored.where("start_station_id <> 'unseen'").groupBy("demand_count").agg(F.avg("p").alias("p")).collect()}
    assert by[1] < 3 < 7 < by[9]
    assert {r["feature"]: r["importance"] for r in own.importances(spark).collect()}["station_code"] == pytest.approx(1)


def test_all_inputs_are_dealt_in_one_shuffle_and_scored_once(spark, halves):
    model = ml.Boosted(FEW).train(halves[0]).model
    plan = ml.permutation_importance(model, halves[1], KEY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(features") == 1  # one call of the trees
    assert plan.count("Join") == 0 and plan.count("collect_list") == 1


def test_inputs_that_no_tree_reads_are_not_scored_again(spark, halves, monkeypatch):
    train, rest = (h.withColumn("demand_count", (F.col("hour_of_day") * 2).cast("long")) for h in halves)
    model = ml.Boosted({"maxIter": 2, "maxDepth": 2, "featureSubsetStrategy": "all"}).train(train).model
    read = len(model.stages[-1].featureImportances.indices)
    real, scored = type(model.stages[-1]).transform, []
    monkeypatch.setattr(type(model.stages[-1]), "transform", lambda self, df: scored.append(df.count()) or real(self, df))
    found = {r["feature"]: r["importance"] for r in ml.permutation_importance(model, rest, KEY).collect()}
    assert set(found) == set(quality.FEATURES) and sum(v != 0 for v in found.values()) <= read < 29
    assert scored == [(1 + read) * rest.count()]


def test_trials_are_kept_in_a_journal(spark, halves, tmp_path, monkeypatch):
    trials = [{"maxIter": 2, "maxDepth": d} for d in (1, 2, 3)]
    journal = f"file://{tmp_path}/journal"
    found = ml.run_trials(*halves, trials, journal, at_once=3)
    assert spark.read.json(f"{journal}/*").count() == 3
    real, trained = ml.fit_trees, []
    monkeypatch.setattr(ml, "fit_trees", lambda *a, **k: trained.append(a[2]) or real(*a, **k))
    assert ml.run_trials(*halves, trials, journal) == found and trained == []
    assert ml.run_trials(*halves, [*trials[:2], {"maxIter": 3, "maxDepth": 1}], journal)[:2] == found[:2] and trained == [{"maxIter": 3, "maxDepth": 1}]


def test_a_failed_trial_is_an_error(halves):
    with pytest.raises(Exception, match="maxDepth"):
        ml.run_trials(*halves, [{"maxIter": 2}, {"maxIter": 2, "maxDepth": -1}])


def test_sweep_and_search(halves):
    swept = ml.sweep(*halves, {"maxDepth": [1, 3], "stepSize": [0.1, 0.3]}, {"maxIter": 3}, percent=50).collect()
    assert [(r["parameter"], r["value"]) for r in swept] == [("maxDepth", 1.0), ("maxDepth", 3.0), ("stepSize", 0.1), ("stepSize", 0.3)]
    for r in swept:
        assert r["delta"] == pytest.approx(r["rmse"] - r["base_rmse"], abs=1e-5)
        assert r["sensitive"] == any(abs(x["delta"]) > 0.05 for x in swept if x["parameter"] == r["parameter"])
    small = {"maxIter": ("int", 2, 4, 1), "maxDepth": ("int", 1, 3, 1), "reg_alpha": ("log", 0.001, 10.0, 0)}
    found = ml.random_search(*halves, small, trials=3, top=2).collect()
    assert len(found) == 2 and found[0]["rmse"] <= found[1]["rmse"]
    assert all(r["improvement"] == pytest.approx(r["base_rmse"] - r["rmse"], abs=1e-5) for r in found)


def test_sweeps_and_searches_train_on_all_rows(halves, monkeypatch):
    trained = []
    monkeypatch.setattr(ml, "run_trials", lambda train, rest, trials, *a: trained.append((train.count(), rest.count())) or [(1.0, 1.0, 1)] * len(trials))
    ml.sweep(*halves)
    ml.random_search(*halves, ml.WIDE)
    ml.random_search(*halves, ml.JOINT)
    assert trained == [tuple(h.count() for h in halves)] * 3


@pytest.mark.parametrize("space", [ml.JOINT, ml.WIDE])
def test_draws_stay_within_their_ranges(space):
    drawn = ml.draw_parameters(space, 300)
    assert drawn == ml.draw_parameters(space, 300) != ml.draw_parameters(space, 300, seed=1)
    for params in drawn:
        assert list(params) == list(space)
        for name, (kind, low, high, step) in space.items():
            assert low <= params[name] <= high
            assert kind != "int" or (params[name] - low) % step == 0
            assert kind != "real" or not step or round((params[name] - low) / step, 6) % 1 == 0
    spread = sorted(p["stepSize"] for p in drawn)
    assert spread[150] == pytest.approx(0.045, abs=0.015)  # the middle of the logarithms, not of the values


def test_promotion_writes_a_forecast_or_nothing(spark, matrix, halves, tmp_path):
    runs = spark.createDataFrame([(1, 1.0, "approved"), (2, 0.5, "rejected")], "run_id long, val_rmse double, status string")
    candidate = lambda e: spark.createDataFrame([(3, e)], "run_id long, val_rmse double")
    weather = serving.last_known(matrix, [*features.WEATHER, "is_precipitation", "is_cold", "is_hot", "feels_like_c"])
    rest = (serving.station_history(matrix), weather, features.holiday_calendar(spark))
    assert pipelines.promote_and_forecast(runs, candidate(1.2), *rest, str(tmp_path / "a")) is None
    model = ml.Boosted(FEW).train(halves[0]).model
    path = pipelines.promote_and_forecast(runs, candidate(1.05), *rest, str(tmp_path / "b"), model=model)
    out = spark.read.parquet(path)
    stations = matrix.select("start_station_id").distinct().count()
    assert out.count() == 24 * stations and out.groupBy("station_id").count().where("count <> 24").count() == 0
    assert out.where("predicted_demand < 0 OR predicted_demand IS NULL").count() == 0
    assert store.read_predictions(spark, str(tmp_path / "b")).count() == out.count()
    assert {"station_id", "forecast_hour", "predicted_demand", "model_version", "generated_at"} == set(out.columns)


def test_the_first_forecast_hour_is_no_window_over_all_stations(spark, matrix):
    weather = serving.last_known(matrix, [*features.WEATHER, "is_precipitation", "is_cold", "is_hot", "feels_like_c"])
    out = ml.recursive_forecast(serving.station_history(matrix), weather, features.holiday_calendar(spark), steps=1, model_version=4, generated_at="now")
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["model_version"], r["generated_at"]) for r in out.collect()} == {(4, "now")}
    assert out.select("forecast_hour").distinct().count() == 1


def test_headers_name_the_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ride_id,started_at,start_lat,member_casual\nr1,2024-06-15 08:00:00,42.5,member\n")
    (tmp_path / "b.csv").write_text('member_casual,"ride_id",start_lat,started_at\ncasual,r2,41.5,2024-06-15 09:00:00\n')
    (tmp_path / "c.csv").write_text("tripduration,starttime\n5,2015-01-01\n")
    (tmp_path / "d.csv").write_text("")
    out = {r["ride_id"]: r for r in trips.read_trips(spark, str(tmp_path / "*.csv")).collect()}
    assert set(out) == {"r1", "r2"}
    assert (out["r2"]["member_casual"], out["r2"]["start_lat"], out["r2"]["started_at"].hour, out["r2"]["end_lat"]) == ("casual", 41.5, 9, None)
    assert trips.read_trips(spark, str(tmp_path / "c.csv")).count() == 0


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_plans_read_no_table_more_often_than_they_need(spark):
    """The trips for the grid's bounds and stations, the counts, the weather's hours and the weather; the stations twice, for the median."""
    matrix = scans(QUERIES["feature_matrix"](spark, DATA))
    assert matrix <= 8
    assert scans(QUERIES["slice_stats"](spark, DATA)) == matrix


def test_the_panel_is_not_shuffled_once_it_is_filled(spark):
    """Neither a small nor a large table of stations moves or sorts filled rows."""
    for threshold in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = domain.matrix(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        above = plan[: plan.index("Generate posexplode")]
        assert not any(x in above for x in ("Exchange hash", "Exchange range", "Sort ", "Window", "SortMergeJoin"))


def test_validation_names_planted_humidity_alone_where_errors_are_many(spark, tmp_path):
    """Ninety errors in an hour, of those that come twice, make a humidity of 130, which is not what the query plants."""
    for name in ("customer", "events"):
        df = spark.read.parquet(f"{DATA}/{name}.parquet")
        if name == "events":
            first = df.where("event_type = 'error'").orderBy("event_id").limit(1)
            df = df.unionByName(first.withColumns({"ts": F.lit("2024-01-10 09:30:00").cast("timestamp_ntz"), "event_id": F.explode(F.sequence(F.lit(10**9), F.lit(10**9 + 89)))}).select(df.columns))
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    m = domain.matrix(spark, str(tmp_path))
    assert m.where("humidity_pct > 100 AND hour_of_day <> 3").count() > 0
    issues = [r["issue"] for r in QUERIES["feature_validation"](spark, str(tmp_path)).collect()]
    assert issues[0] == f"humidity_pct: 0 below, {m.where('hour_of_day = 3').count()} above" and len(issues) == 3


def test_stored_matrix_is_in_order_and_only_the_narrow_panel_was_dealt(spark, matrix, tmp_path):
    panel_rows = domain.demand_panel(spark, DATA)
    feed = domain.stations(spark, DATA).select(F.col("station_id").alias("start_station_id"), "capacity")
    plan = features.feature_matrix(panel_rows, domain.weather(spark, DATA), feed, features.holiday_calendar(spark), ordered=True)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Window")]
    assert not any(x in above for x in ("Exchange hash", "Exchange range", "Sort "))
    pipelines.feature_matrix(panel_rows, domain.weather(spark, DATA), feed, features.holiday_calendar(spark), str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    assert stored.select(sorted(matrix.columns)).exceptAll(matrix.select(sorted(matrix.columns))).count() == 0 and stored.count() == matrix.count()
    parts = [[(r["start_station_id"], r["hour"]) for r in spark.read.parquet(f"file://{p}").select(*KEY).collect()] for p in sorted((tmp_path / "m").glob("part-*.parquet"))]
    keys = [k for part in parts for k in part]
    assert keys == sorted(keys)
