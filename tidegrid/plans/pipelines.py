"""What a user calls: operators chained, lazily, with actions only at gates and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions import labels
from tidegrid.operators import clean, drift, features, gates, metrics, ml, panel, quality, serving, slices, stations
from tidegrid.sources import store, trips


def clean_year(spark: SparkSession, raw: str, out: str, month: int | None = None) -> None:
    """Trip files, CSV or else archives, to cleaned Parquet by year and month, or those of one month again."""
    frame = trips.read_trips(spark, raw)
    store.write_partitioned(clean.clean_trips(frame if month is None else frame.where(F.month("started_at") == month)), out)


def hourly_demand(spark: SparkSession, cleaned: str, out: str) -> None:
    """Cleaned trips to the dense panel, which is filled in its order."""
    panel.hourly_demand(store.read_trip_columns(spark, cleaned), ordered=True).write.mode("overwrite").parquet(out)


def station_lookup(frame: DataFrame, feed: DataFrame, out: str) -> None:
    """C03, S16."""
    stations.station_lookup(frame, feed).write.mode("overwrite").parquet(out)


def feature_matrix(demand: DataFrame, weather: DataFrame, feed: DataFrame, calendar: DataFrame, out: str) -> None:
    """In the order of station and hour."""
    features.feature_matrix(demand, weather, feed, calendar, ordered=True).write.mode("overwrite").parquet(out)


def validate(matrix: DataFrame, least: int = quality.MIN_ROWS) -> None:
    """C05."""
    quality.validate_features(matrix, least)


def data_bias_report(matrix: DataFrame, out: str) -> None:
    """One nested object a slice."""
    store.write_report(slices.slice_stats(matrix, labels.data_slices()), out, by="slice_name")


def train_evaluate(matrix: DataFrame, params: dict | None = None, gate: dict | None = None, train_end: str = metrics.TRAIN_END, validation_end: str = metrics.VALIDATION_END) -> tuple[ml.Boosted, DataFrame, DataFrame]:
    """The model, metrics by split and the gate's rows for the test split. Training stops when the validation split gains no more."""
    split = metrics.temporal_split(matrix, "hour", train_end, validation_end)
    model = ml.Boosted(params).train(split.where("split = 'train'"), split.where("split = 'validation'"))
    by_split = metrics.regression_metrics(model.predict(split.where("split != 'train'")), ["split"], quality.TARGET, "p")
    return model, by_split, metrics.validation_gate(by_split.where("split = 'test'"), gate)


def bias_and_drift(scored: DataFrame, reference: DataFrame, current: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """C08, over one scored table."""
    errors = slices.slice_errors(scored, labels.model_slices())
    f, t = drift.feature_drift(reference, current, columns), drift.target_drift(reference, current, quality.TARGET)
    p = drift.performance_drift(reference.withColumn("e", F.col("p") - F.col("y")), current.withColumn("e", F.col("p") - F.col("y")), "e")
    return {"errors": errors, "disparity": slices.error_disparity(errors), "features": f, "report": drift.drift_report(f, t, p), "residuals": metrics.residual_histogram(scored)}


def promote_and_forecast(runs: DataFrame, candidate: DataFrame, history: DataFrame, weather: DataFrame, calendar: DataFrame, root: str, model=None, model_version: int = 0, generated_at: str | None = None) -> str | None:
    """Writes a forecast if the gate accepts the candidate; the gate is one row."""
    champion = gates.best_run(runs)
    if gates.rollback_gate(champion, candidate).first()["decision"] != "accepted":
        return None
    return store.write_predictions(ml.recursive_forecast(history, weather, calendar, model=model, model_version=model_version, generated_at=generated_at), root)


def serving_views(predictions: DataFrame, feed: DataFrame, root: str) -> None:
    """One Parquet table a view."""
    status = serving.station_risk(predictions, feed)
    fills = serving.fill_table(status)
    for name, view in {"summary": serving.prediction_summary(predictions), "network": serving.network_demand(predictions), "peaks": serving.station_peaks(predictions), "status": status, "fills": fills, "kpis": serving.network_kpis(fills), "alerts": serving.alert_counts(fills), "priority": serving.priority_list(fills)}.items():
        view.write.mode("overwrite").parquet(f"{root}/{name}")


def monitor(log: DataFrame, runs: DataFrame, report: DataFrame, now: str, baseline_rmse: float) -> DataFrame:
    """C11."""
    performance = metrics.rolling_performance(metrics.recent(log, now))
    return gates.retrain_decision(report, metrics.degradation_check(performance, baseline_rmse), runs)
