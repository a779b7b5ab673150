"""Drift between a reference and a current sample, over all of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.sources.scratch import saved

EPS = 1e-10
FEATURE_KL, TARGET_KL, MAE_INCREASE = 0.1, 0.15, 20.0
FEATURE_BINS, TARGET_BINS = 20, 30
# The policy's thresholds.
POLICY = {"drift_share": 0.25, "drifted_features": 3, "ks_p_value": 0.05, "rmse_increase_pct": 30.0, "least_rows": 100, "cooldown_days": 3, "promotion_margin_pct": 2.0}


def long_form(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, side, x) for the features that both have."""
    own = [f for f in features if f in reference.columns and f in current.columns]
    sides = (df.select(F.lit(side).alias("side"), *(F.col(f).cast("double").alias(f) for f in own)).unpivot("side", own, "feature", "x") for side, df in (("ref", reference), ("cur", current)))
    a, b = sides
    return a.unionByName(b).where("x IS NOT NULL")


def kl_divergence(long: DataFrame, bins: int = FEATURE_BINS) -> DataFrame:
    """M13, for every feature at once: bins over both sides' range, densities plus EPS made to sum to 1, current against
    reference. The bounds are a row a feature, so they are broadcast. A range without width is widened by a half on either side; the last bin is closed. Rows are counted by (feature,
    bin, side), so nothing but counts is shuffled."""
    wide = long.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    wide = wide.select("feature", F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"), F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))
    counts = long.join(F.broadcast(wide), "feature").groupBy("feature", "lo", "hi", place.alias("bin")).agg(F.count_if(F.col("side") == "ref").alias("r"), F.count_if(F.col("side") == "cur").alias("c"))
    grid = wide.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts.drop("lo", "hi"), ["feature", "bin"], "left").na.fill(0, ["r", "c"])
    own = Window.partitionBy("feature")
    density = lambda c: F.coalesce(F.try_divide(F.col(c), F.sum(c).over(own) * width), F.lit(0.0)) + EPS
    dense = full.withColumns({"dr": density("r"), "dc": density("c")})
    p, q = F.col("dc") / F.sum("dc").over(own), F.col("dr") / F.sum("dr").over(own)
    shares = dense.select("feature", p.alias("p"), q.alias("q"))
    return shares.groupBy("feature").agg(F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("kl"))


def feature_drift(reference: DataFrame, current: DataFrame, features: list[str], threshold: float = FEATURE_KL) -> DataFrame:
    """Drifted above the threshold."""
    kl = kl_divergence(long_form(reference, current, features))
    return kl.select("feature", F.round("kl", 6).alias("kl"), (F.col("kl") > threshold).alias("drifted"))


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(F.count("*").alias("features"), F.count_if("drifted").alias("drifted"), F.max("kl").alias("max_kl"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))), ",").alias("drifted_features"))


def target_drift(reference: DataFrame, current: DataFrame, target: str, threshold: float = TARGET_KL) -> DataFrame:
    """M16."""
    kl = kl_divergence(long_form(reference, current, [target]), TARGET_BINS).select("kl")
    figures = [df.agg(F.round(F.avg(target), 6).alias(f"{side}_mean"), F.round(F.stddev_pop(target), 6).alias(f"{side}_std")) for side, df in (("reference", reference), ("current", current))]
    both = kl.crossJoin(figures[0]).crossJoin(figures[1])
    return both.select(F.round("kl", 6).alias("kl"), (F.col("kl") > threshold).alias("drifted"), "reference_mean", "reference_std", "current_mean", "current_std")


def performance_drift(baseline: DataFrame, current: DataFrame, error: str, threshold: float = MAE_INCREASE) -> DataFrame:
    """The increase of the mean absolute error in percent; 0 from a baseline of 0."""
    a, b = baseline.agg(F.avg(F.abs(error)).alias("a")), current.agg(F.avg(F.abs(error)).alias("b"))
    up = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.col("a")) * 100, F.lit(0.0))
    return a.crossJoin(b).select(F.round("a", 6).alias("baseline_mae"), F.round("b", 6).alias("current_mae"), F.round(up, 6).alias("increase_pct"), (up > threshold).alias("drifted"))


def ks_gaps(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """(feature, ks, n_reference, n_current): the greatest gap between two empirical distributions. Equal values are counted
    first, and the counts stored once in ranges of values. Running sums are taken over ranges and within a range, so that no
    task holds all values of a feature; where the ranges' edges lie changes no result."""
    counts = long_form(reference, current, features).groupBy("feature", "x").agg(F.count_if(F.col("side") == "ref").alias("r"), F.count_if(F.col("side") == "cur").alias("c"))
    placed = saved(counts.repartitionByRange("feature", "x").withColumn("range", F.spark_partition_id()), "drift-counts")
    # a row a range
    sums = placed.groupBy("feature", "range").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    own, before = Window.partitionBy("feature"), Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("feature", "range", *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_before") for k in "rc"), *(F.sum(k).over(own).alias(f"{k}_all") for k in "rc"))
    run = Window.partitionBy("feature", "range").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    share = lambda k: F.try_divide(F.col(f"{k}_before") + F.sum(k).over(run), F.col(f"{k}_all"))
    gaps = placed.join(offsets, ["feature", "range"]).select("feature", F.abs(share("r") - share("c")).alias("gap"), "r_all", "c_all")
    return gaps.groupBy("feature").agg(F.max("gap").alias("ks"), F.max("r_all").alias("n_reference"), F.max("c_all").alias("n_current"))


def ks_statistic(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """M23's statistic."""
    return ks_gaps(reference, current, features).select("feature", F.round("ks", 6).alias("ks"))


def ks_test(reference: DataFrame, current: DataFrame, features: list[str], alpha: float = POLICY["ks_p_value"]) -> DataFrame:
    """With the p-value of the limiting distribution, 2 sum (-1)^(j-1) exp(-2 j^2 z^2) for z = ks sqrt(n m / (n + m)), and whether it is
    below alpha. The series is near 1 for small z, where it converges slowly, so 1 is taken there."""
    n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    z = F.sqrt(n * m / (n + m)) * F.col("ks")
    series = sum((F.lit(2.0 * (-1) ** (j - 1)) * F.exp(F.lit(-2.0 * j * j) * z * z) for j in range(1, 21)), F.lit(0.0))
    p = F.when(z < 0.3, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))
    return ks_gaps(reference, current, features).select("feature", F.round("ks", 6).alias("ks"), F.round(p, 6).alias("p_value"), (p < alpha).alias("drifted"))


def policy_decision(tests: DataFrame, performance: DataFrame, baseline_rmse: float, last_retrain: str | None, now: str, policy: dict[str, float] = POLICY) -> DataFrame:
    """M23, one row: data drift (enough features, or a great enough share of them, are drifted), concept drift (the error has grown
    enough, over enough rows), whether the cooldown since the last training is over, and so whether to retrain. tests: of ks_test;
    performance: of metrics.rolling_performance."""
    share = F.count_if("drifted") / F.count("*")
    data = tests.agg(F.count_if("drifted").alias("drifted_features"), F.round(share, 6).alias("drift_share"), ((share >= policy["drift_share"]) & (F.count_if("drifted") >= policy["drifted_features"])).alias("data_drift"))
    up = (F.col("rmse") / F.lit(float(baseline_rmse)) - 1) * 100
    concept = performance.where("status IS NOT NULL").select(F.round(up, 6).alias("rmse_increase_pct"), F.coalesce((F.col("n") >= policy["least_rows"]) & (up > policy["rmse_increase_pct"]), F.lit(False)).alias("concept_drift"))
    days = F.lit(None).cast("int") if last_retrain is None else F.date_diff(F.lit(now).cast("date"), F.lit(last_retrain).cast("date"))
    both = data.crossJoin(concept).withColumn("cooled_down", F.coalesce(days >= policy["cooldown_days"], F.lit(True)))
    return both.withColumn("retrain", (F.col("data_drift") | F.col("concept_drift")) & F.col("cooled_down"))


def promotion(champion_rmse: DataFrame, candidate: DataFrame, margin_pct: float = POLICY["promotion_margin_pct"]) -> DataFrame:
    """M23's promotion: the candidate (run_id, val_rmse) has to better the champion's val_rmse by the margin; without a champion it is promoted."""
    best = champion_rmse.agg(F.min("val_rmse").alias("champion_val_rmse"))
    gain = F.round((F.col("champion_val_rmse") - F.col("val_rmse")) / F.col("champion_val_rmse") * 100, 6)
    return candidate.select("run_id", "val_rmse").crossJoin(best).withColumn("gain_pct", gain).withColumn("promoted", F.coalesce(F.col("gain_pct") >= margin_pct, F.lit(True)))


def drift_report(features: DataFrame, target: DataFrame, performance: DataFrame) -> DataFrame:
    """One row; drift of any kind recommends retraining."""
    f = drift_summary(features).select((F.col("drifted") > 0).alias("feature_drift"), "max_kl", "drifted_features")
    both = f.crossJoin(target.select(F.col("drifted").alias("target_drift"))).crossJoin(performance.select(F.col("drifted").alias("performance_drift")))
    any_drift = F.col("feature_drift") | F.col("target_drift") | F.col("performance_drift")
    return both.withColumns({"overall_drift": any_drift, "recommendation": F.when(any_drift, "retrain").otherwise("monitor")})


def top_drifted(drift: DataFrame, drifted: int = 6, stable: int = 8) -> DataFrame:
    """The most drifted features, and the most stable ones."""
    order = Window.partitionBy("drifted").orderBy(F.when(F.col("drifted"), -F.col("kl")).otherwise(F.col("kl")), "feature")
    ranked = drift.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= F.when(F.col("drifted"), drifted).otherwise(stable))
