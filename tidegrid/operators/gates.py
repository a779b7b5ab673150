"""Decisions over the table of model runs (run_id, val_rmse, test_rmse, status, started_at)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CEILING = 1.10


def champion_selection(runs: DataFrame, candidate: DataFrame) -> DataFrame:
    """Approved if there is no approved run, or if the candidate (run_id, val_rmse) is better than the best."""
    best = runs.where("status = 'approved'").agg(F.min("val_rmse").alias("best_val_rmse"))
    return candidate.crossJoin(best).select("run_id", "val_rmse", "best_val_rmse", F.when(F.col("best_val_rmse").isNull() | (F.col("val_rmse") < F.col("best_val_rmse")), "approved").otherwise("rejected").alias("decision"))


def rollback_gate(champion: DataFrame, candidate: DataFrame, ceiling: float = CEILING, force: bool = False) -> DataFrame:
    """Rejected if worse than the champion's error times the ceiling; without a champion accepted."""
    best = champion.agg(F.min("val_rmse").alias("champion_val_rmse"))
    bad = F.col("champion_val_rmse").isNotNull() & (F.col("val_rmse") > F.col("champion_val_rmse") * ceiling)
    return candidate.crossJoin(best).select("run_id", "val_rmse", "champion_val_rmse", F.when(bad & F.lit(not force), "rejected").otherwise("accepted").alias("decision"))


def best_run(runs: DataFrame) -> DataFrame:
    """T07."""
    return runs.where("status = 'approved'").orderBy("val_rmse", "run_id").limit(1)


def last_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.where("status = 'approved'").orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def run_delta(runs: DataFrame) -> DataFrame:
    """A run's error less that of the run before. The table has one row a training run."""
    return runs.withColumn("rmse_delta", F.round(F.col("val_rmse") - F.lag("val_rmse").over(Window.orderBy("started_at", "run_id")), 6))


def status_rollup(tasks: DataFrame) -> DataFrame:
    """Tasks (run_id, status)."""
    s = F.col("status")
    out = F.when(F.bool_or(s == "failed"), "failed").when(F.bool_and(s == "success"), "success").otherwise("running")
    return tasks.groupBy("run_id").agg(out.alias("status"))


def retrain_decision(drift: DataFrame, degradation: DataFrame, runs: DataFrame, forced: bool = False) -> DataFrame:
    """With the newest run's improvement over the one before, and the live error over the champion's."""
    order = Window.orderBy(F.desc("started_at"), F.desc("run_id"))
    last = runs.withColumns({"_n": F.row_number().over(order), "_old": F.lead("val_rmse").over(order)}).where("_n = 1").select(F.col("val_rmse").alias("new_rmse"), F.col("_old").alias("old_rmse"))
    one = drift.select("overall_drift").crossJoin(degradation.select("degraded", F.col("rmse_ratio").alias("degradation_ratio"))).crossJoin(last)
    up = F.round(F.try_divide(F.col("old_rmse") - F.col("new_rmse"), F.col("old_rmse")) * 100, 6)
    return one.select("overall_drift", "degraded", "degradation_ratio", up.alias("improvement_pct"), (F.lit(forced) | F.col("overall_drift") | F.col("degraded")).alias("retrain"))


def champion_report(runs: DataFrame, reports: DataFrame) -> DataFrame:
    """The reports of the run that carries the alias; none without such a run."""
    return reports.join(runs.where("alias = 'champion'").select("run_id"), "run_id")
