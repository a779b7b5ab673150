"""Errors of forecasts, overall, by split and over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.ranking import selected, share, value_ranges

# What a model must reach.
GATES = {"rmse": ("max", 2.5), "r2": ("min", 0.50), "mae": ("max", 1.5)}
TRAIN_END, VALIDATION_END = "2024-07-01", "2024-10-01"


def error_columns(y: str = "y", p: str = "p") -> list[Column]:
    """A22; MAPE over positive y only. R2 from sums, so that one pass does."""
    a, b = F.col(y).cast("double"), F.col(p).cast("double")
    off, n = b - a, F.count(F.col(y))
    spread = F.sum(a * a) - F.sum(a) * F.sum(a) / n
    return [
        n.alias("n"),
        F.round(F.sqrt(F.avg(off * off)), 6).alias("rmse"),
        F.round(F.avg(F.abs(off)), 6).alias("mae"),
        F.round(F.avg(F.when(a > 0, F.abs(off) / a)) * 100, 6).alias("mape"),
        F.round(1 - F.try_divide(F.sum(off * off), spread), 6).alias("r2"),
    ]


def regression_metrics(scored: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """A22; with by=["split"], M04."""
    return scored.groupBy(*(by or [])).agg(*error_columns(y, p))


def validation_gate(metrics: DataFrame, gates: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """One row a gate, and whether all pass."""
    rules = GATES if gates is None else gates
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(kind).alias("kind"), F.lit(float(t)).alias("threshold")) for m, (kind, t) in rules.items()]
    ok = F.when(F.col("kind") == "max", F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold"))
    out = metrics.select(F.inline(F.array(*cells))).withColumn("passed", ok)
    return out.withColumn("all_passed", F.every("passed").over(Window.partitionBy(F.lit(1))))  # as many rows as gates


def split_label(at: Column, train_end: str = TRAIN_END, validation_end: str = VALIDATION_END) -> Column:
    """P26."""
    return F.when(at < F.lit(train_end).cast("timestamp_ntz"), "train").when(at < F.lit(validation_end).cast("timestamp_ntz"), "validation").otherwise("test")


def temporal_split(df: DataFrame, at: str = "hour", train_end: str = TRAIN_END, validation_end: str = VALIDATION_END) -> DataFrame:
    return df.withColumn("split", split_label(F.col(at), train_end, validation_end))


def split_summary(split: DataFrame, at: str = "hour") -> DataFrame:
    """Rows and range of each split; ``intact`` says that no row is lost."""
    out = split.groupBy("split").agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    total = split.agg(F.count("*").alias("_all"))
    return out.crossJoin(F.broadcast(total)).withColumn("intact", F.sum("n").over(Window.partitionBy(F.lit(1))) == F.col("_all")).drop("_all")


def unseen_stations(split: DataFrame, station: str = "start_station_id") -> DataFrame:
    """Stations of the later splits that training lacks."""
    own = split.select("split", station).distinct()
    return own.where("split != 'train'").join(own.where("split = 'train'").select(station), station, "left_anti").select("split", station)


def split_overlap(split: DataFrame, key: list[str]) -> DataFrame:
    """Keys that stand in more than one split."""
    both = split.groupBy(*key).agg(F.countDistinct("split").alias("_n"))
    return both.agg(F.count_if(F.col("_n") > 1).alias("shared_keys")).withColumn("disjoint", F.col("shared_keys") == 0)


def hashed_sample(df: DataFrame, key: list[str], percent: int) -> DataFrame:
    """The same rows in every run."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key)))
    return df.where(F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(100)) < percent)


def residual_stats(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """A35's figures; the median is selected from ranges of residuals."""
    r = F.col(y) - F.col(p)
    figures = scored.agg(F.count("*").alias("n"), F.round(F.avg(r), 6).alias("mean"), F.round(F.stddev_pop(r), 6).alias("stddev"))
    median = selected(value_ranges(scored, r), {"median": share(0.5)})
    return figures.crossJoin(F.broadcast(median)).select("n", "mean", "stddev", F.round("median", 6).alias("median"))


def residual_histogram(scored: DataFrame, bins: int = 100, y: str = "y", p: str = "p") -> DataFrame:
    """Equal bins from the least to the greatest residual; the last is closed."""
    r = scored.select((F.col(y) - F.col(p)).cast("double").alias("r"))
    bounds = r.agg(F.min("r").alias("lo"), F.max("r").alias("hi"))
    place = F.least(F.floor((F.col("r") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1))
    return r.crossJoin(F.broadcast(bounds)).groupBy(F.when(F.col("hi") > F.col("lo"), place).otherwise(F.lit(0)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def with_actuals(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Predictions (station_id, forecast_hour, predicted_demand) that have an actual (station_id, hour, actual_demand)."""
    return predictions.join(actuals.withColumnRenamed("hour", "forecast_hour"), ["station_id", "forecast_hour"])


def recent(predictions: DataFrame, now: str, days: int = 7, at: str = "forecast_hour") -> DataFrame:
    """``now`` is an argument, so that a rerun sees the same rows; the filter reaches the scan."""
    return predictions.where(F.col(at) >= F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {int(days)} days"))


def rolling_performance(log: DataFrame, least: int = 50, least_a_day: int = 10) -> DataFrame:
    """All days together (date null) with a status, and the days that have enough rows; both levels in one rollup. Rows without an
    actual or a prediction count nowhere; an empty log has the row of all days too."""
    off = F.col("predicted_demand") - F.col("actual_demand")
    nothing = log.sparkSession.range(1).select(F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("off"))
    own = log.select(F.to_date("forecast_hour").alias("date"), off.cast("double").alias("off")).unionByName(nothing)
    rolled = own.rollup("date").agg(F.grouping("date").alias("_all"), F.count("off").alias("n"), F.round(F.sqrt(F.avg(F.col("off") * F.col("off"))), 8).alias("rmse"), F.round(F.avg(F.abs("off")), 8).alias("mae"))
    status = F.when(F.col("n") == 0, "no_data").when(F.col("n") < least, "insufficient_data").otherwise("ok")
    return rolled.where((F.col("_all") == 1) | (F.col("n") >= least_a_day)).select("date", "n", "rmse", "mae", F.when(F.col("_all") == 1, status).alias("status"))


def degradation_check(performance: DataFrame, baseline_rmse: float, max_ratio: float = 1.5, max_mae: float = 4.0) -> DataFrame:
    """M18."""
    total = performance.where("status IS NOT NULL")
    ratio = F.round(F.col("rmse") / F.lit(float(baseline_rmse)), 6)
    return total.select("n", "rmse", "mae", ratio.alias("rmse_ratio"), ((F.col("rmse") > max_ratio * baseline_rmse) | (F.col("mae") > max_mae)).alias("degraded"))


def scorer_parity(a: DataFrame, b: DataFrame, key: list[str], tolerance: float = 0.01) -> DataFrame:
    """Frames with a column p each."""
    off = F.abs(F.col("p") - F.col("q"))
    out = a.join(b.withColumnRenamed("p", "q"), key).agg(F.count("*").alias("n"), F.round(F.max(off), 6).alias("max_abs"), F.round(F.avg(off), 6).alias("mean_abs"))
    return out.withColumn("status", F.when(F.col("max_abs") <= tolerance, "PASSED").otherwise("FAILED"))
