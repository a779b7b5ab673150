"""Disparities across slices of the data, and of a model's errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_DATA_RATIO, MIN_SHARE_PCT = 5.0, 2.0
MAX_ERROR_RATIO, MIN_GROUP = 3.0, 1000
WEIGHT_RANGE = (1.0, 3.0)


def by_slice(df: DataFrame, slices: dict[str, Column], keep: list[str]) -> DataFrame:
    """One row for each row and slice, so that one shuffle counts every slice. A row outside a slice's groups has none there."""
    pairs = F.array(*(F.struct(F.lit(n).alias("slice_name"), c.alias("group_name")) for n, c in slices.items()))
    return df.select(*keep, F.inline(pairs))


def slice_stats(df: DataFrame, slices: dict[str, Column]) -> DataFrame:
    """A19. A slice's groups, null among them, hold all rows, so the total needs no pass of its own."""
    d = F.col("demand_count")
    counted = by_slice(df, slices, ["demand_count"]).groupBy("slice_name", "group_name").agg(F.count("*").alias("n"), F.round(F.avg(d), 3).alias("mean_demand"), F.round(F.median(d), 1).alias("median_demand"), F.round(F.avg((d == 0).cast("int")) * 100, 1).alias("zero_demand_pct"))
    total = F.sum("n").over(Window.partitionBy("slice_name"))  # a row a group
    return counted.withColumn("representation_pct", F.round(100.0 * F.col("n") / total, 2)).where("group_name IS NOT NULL")


def slice_disparity(stats: DataFrame) -> DataFrame:
    """Greatest over least of the positive means; 1 with fewer than two groups."""
    mean = F.when(F.col("mean_demand") > 0, F.col("mean_demand"))
    ratio = F.when(F.count(mean) >= 2, F.round(F.max(mean) / F.min(mean), 2)).otherwise(F.lit(1.0))
    return stats.groupBy("slice_name").agg(ratio.alias("disparity_ratio"), F.count("*").alias("n_groups"))


def slice_flags(stats: DataFrame, max_ratio: float = MAX_DATA_RATIO, min_share: float = MIN_SHARE_PCT) -> DataFrame:
    """One row a flag."""
    wide = slice_disparity(stats).where(F.col("disparity_ratio") > max_ratio).select("slice_name", F.lit("disparity").alias("flag"), F.lit(None).cast("string").alias("group_name"), F.col("disparity_ratio").alias("value"))
    rare = stats.where(F.col("representation_pct") < min_share).select("slice_name", F.lit("representation").alias("flag"), "group_name", F.col("representation_pct").alias("value"))
    return wide.unionByName(rare)


def bias_display(stats: DataFrame) -> DataFrame:
    """Shares recomputed within a slice, and the groups with the most and the least demand."""
    own = Window.partitionBy("slice_name")
    share = stats.withColumn("share_pct", F.round(100.0 * F.col("n") / F.sum("n").over(own), 2))
    order = F.struct("mean_demand", "group_name")
    return share.groupBy("slice_name").agg(F.max_by("group_name", order).alias("most"), F.min_by("group_name", order).alias("least"), F.max("share_pct").alias("largest_share_pct"), F.min("share_pct").alias("smallest_share_pct"))


def slice_errors(scored: DataFrame, slices: dict[str, Column], y: str = "y", p: str = "p") -> DataFrame:
    """A23."""
    off = F.col(p) - F.col(y)
    return by_slice(scored, slices, [y, p]).where("group_name IS NOT NULL").groupBy("slice_name", "group_name").agg(F.count("*").alias("n"), F.round(F.sqrt(F.avg(off * off)), 6).alias("rmse"), F.round(F.avg(F.abs(off)), 6).alias("mae"))


def error_disparity(errors: DataFrame, least: int = MIN_GROUP, max_ratio: float = MAX_ERROR_RATIO, override: str | None = None) -> DataFrame:
    """Over groups with ``least`` rows; SKIPPED with fewer than two such. An override's reason lets a failure pass."""
    fit = F.when((F.col("n") >= least) & (F.col("rmse") > 0), F.col("rmse"))
    ratio = F.when(F.count(fit) >= 2, F.round(F.max(fit) / F.min(fit), 4))
    out = errors.groupBy("slice_name").agg(ratio.alias("disparity_ratio"), F.count(fit).alias("eligible_groups"))
    status = F.when(F.col("disparity_ratio").isNull(), "SKIPPED").when(F.col("disparity_ratio") > max_ratio, F.lit("FAILED" if override is None else "OVERRIDDEN")).otherwise("PASSED")
    return out.withColumns({"status": status, "override_reason": F.lit(override).cast("string")})


def mitigation_weights(rows: DataFrame, slices: dict[str, Column], errors: DataFrame, report: DataFrame, overall: DataFrame, key: list[str]) -> DataFrame:
    """For each row the product, over failed slices, of its group's error over all rows' error, held to WEIGHT_RANGE.
    errors has a few rows a slice; each slice is one join on its label, small enough to be broadcast by its own size."""
    low, high = WEIGHT_RANGE
    factor = F.least(F.lit(high), F.greatest(F.lit(low), F.col("rmse") / F.col("all_rmse")))
    table = errors.join(report.where("status = 'FAILED'").select("slice_name"), "slice_name").crossJoin(F.broadcast(overall.select(F.col("rmse").alias("all_rmse")))).select("slice_name", "group_name", factor.alias("_factor"))
    lookup = table.agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "slice_name", "group_name"), "_factor"))).alias("_factors"))  # one row, six slices
    weight = F.lit(1.0)
    for name, label in slices.items():
        weight = weight * F.coalesce(F.try_element_at("_factors", F.concat(F.lit(f"{name}:"), label)), F.lit(1.0))
    return rows.crossJoin(F.broadcast(lookup)).select(*key, F.round(weight, 6).alias("weight"))
