"""The data contract as data, and checks that compile it into one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract's columns with their type families.
CONTRACT = {
    "start_station_id": "string", "hour": "timestamp", "demand_count": "int", "date": "timestamp", "year": "int", "month": "int", "day_of_week": "int", "hour_of_day": "int", "is_weekend": "int",
    "temperature_c": "float", "precipitation_mm": "float", "wind_speed_kmh": "float", "humidity_pct": "numeric", "weather_code": "numeric", "is_precipitation": "numeric", "is_cold": "numeric", "is_hot": "numeric", "feels_like_c": "float",
    "capacity": "int", "is_holiday": "int", "demand_lag_1h": "float", "demand_lag_24h": "float", "demand_lag_168h": "float", "rolling_avg_3h": "float", "rolling_avg_6h": "float", "rolling_avg_24h": "float",
    "hour_sin": "float", "hour_cos": "float", "dow_sin": "float", "dow_cos": "float", "month_sin": "float", "month_cos": "float",
}
# Lowest and highest value of a column; None: no bound.
RANGES: dict[str, tuple[float | None, float | None]] = {
    "demand_count": (0, None), "temperature_c": (-40, 50), "precipitation_mm": (0, None), "wind_speed_kmh": (0, 200), "humidity_pct": (0, 100), "capacity": (1, None),
    "hour_of_day": (0, 23), "day_of_week": (0, 6), "month": (1, 12), "year": (2023, 2030),
    "is_weekend": (0, 1), "is_holiday": (0, 1), "is_precipitation": (0, 1), "is_cold": (0, 1), "is_hot": (0, 1),
    "hour_sin": (-1, 1), "hour_cos": (-1, 1), "dow_sin": (-1, 1), "dow_cos": (-1, 1), "month_sin": (-1, 1), "month_cos": (-1, 1),
}
MIN_ROWS = 1_000_000
# The model's inputs, in order; the target; the split key.
FEATURES = [
    "start_station_id", "capacity", "hour_of_day", "day_of_week", "month", "year", "is_weekend", "is_holiday", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "rolling_avg_3h", "rolling_avg_6h", "rolling_avg_24h", "temperature_c", "precipitation_mm", "wind_speed_kmh", "humidity_pct", "feels_like_c", "is_cold", "is_hot", "is_precipitation", "weather_code",
]
TARGET, SPLIT_KEY = "demand_count", "hour"

FAMILIES = {
    "int": {"tinyint", "smallint", "int", "bigint"},
    "float": {"float", "double"},
    "numeric": {"tinyint", "smallint", "int", "bigint", "float", "double"},
    "string": {"string"},
    "timestamp": {"timestamp", "timestamp_ntz", "date"},
}


def _rows(counted: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    return counted.select(F.inline(F.array(*(F.struct(*(v.alias(k) for k, v in r.items())) for r in rows))))


def range_checks(df: DataFrame, ranges: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """A10: one row a rule: values below and above, and the extremes seen. All rules are counted in one pass."""
    own = {c: b for c, b in (RANGES if ranges is None else ranges).items() if c in df.columns}
    aggs, rows = [], []
    for c, (low, high) in own.items():
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
        aggs += [(F.lit(0) if low is None else F.count_if(v < low)).cast("long").alias(f"{c}_low"), (F.lit(0) if high is None else F.count_if(v > high)).cast("long").alias(f"{c}_high")]
        rows.append({"column_name": F.lit(c), "below": F.col(f"{c}_low"), "above": F.col(f"{c}_high"), "seen_min": F.round(f"{c}_min", 6), "seen_max": F.round(f"{c}_max", 6)})
    aggs = [a for a in aggs if a is not None]
    return _rows(df.agg(*aggs), rows).withColumn("passed", (F.col("below") == 0) & (F.col("above") == 0))


def schema_checks(df: DataFrame, contract: dict[str, str] | None = None) -> DataFrame:
    """One row a column of the contract or the frame: missing, extra, wrong type family or ok; and how many values
    of it do not read as that family. Extra columns are a warning."""
    wanted = CONTRACT if contract is None else contract
    types = dict(df.dtypes)
    cast = {"int": "bigint", "float": "double", "numeric": "double", "string": "string", "timestamp": "timestamp"}
    bad = {c: F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(cast(`{c}` as string) as {cast[f]})").isNull()).alias(c) for c, f in wanted.items() if c in types}
    counted = df.agg(F.count("*").alias("_rows"), *bad.values())
    rows = []
    for c in [*wanted, *(x for x in types if x not in wanted)]:
        state = "missing" if c not in types else "extra" if c not in wanted else "ok" if types[c] in FAMILIES[wanted[c]] else "wrong_type"
        rows.append({"column_name": F.lit(c), "status": F.lit(state), "unreadable": (F.col(c) if c in bad else F.lit(0)).cast("long")})
    return _rows(counted, rows)


def null_checks(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A12."""
    own = columns or df.columns
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in own)).unpivot([], own, "column_name", "nulls").withColumn("passed", F.col("nulls") == 0)


def duplicate_check(df: DataFrame, key: tuple[str, ...] = ("start_station_id", "hour")) -> DataFrame:
    """A13. Keys are dealt to four times as many tasks as the session's shuffle partitions before they are counted: nearly all are distinct, so
    partial counts would only hold every key of a task a second time."""
    tasks = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_key = df.select(*key).repartition(tasks, *key).groupBy(*key).agg(F.count("*").alias("n"))
    return by_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")).withColumn("passed", F.col("duplicates") == 0)


def row_count_check(df: DataFrame, least: int = MIN_ROWS) -> DataFrame:
    """A14."""
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(least).cast("long").alias("least"), (F.col("n_rows") >= least).alias("passed"))


def summary_stats(df: DataFrame) -> DataFrame:
    """A15."""
    d = F.col("demand_count")
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(
        F.count("*").alias("n_rows"), nulls.alias("nulls"), F.countDistinct("start_station_id").alias("stations"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"),
        F.round(F.avg(d), 6).alias("mean_demand"), F.median(d).alias("median_demand"), F.max(d).cast("long").alias("max_demand"), F.round(F.avg((d == 0).cast("int")) * 100, 4).alias("zero_pct"),
    ).withColumn("n_columns", F.lit(len(df.columns)))


def matrix_checks(matrix: DataFrame, panel: DataFrame) -> DataFrame:
    """Rows and demand are preserved, keys and target are never null."""
    seen = matrix.agg(F.count("*").alias("n"), F.sum("demand_count").alias("demand"), F.count_if(F.col("demand_count").isNull()).alias("null_target"), F.count_if(F.col("start_station_id").isNull() | F.col("hour").isNull()).alias("null_keys"))
    both = seen.crossJoin(panel.agg(F.count("*").alias("n0"), F.sum("demand_count").alias("demand0")))
    rows = [("rows", "n", F.col("n0")), ("demand", "demand", F.col("demand0")), ("null_target", "null_target", F.lit(0)), ("null_keys", "null_keys", F.lit(0))]
    return _rows(both, [{"check_name": F.lit(k), "observed": F.col(c).cast("long"), "expected": e.cast("long")} for k, c, e in rows]).withColumn("passed", F.col("observed") == F.col("expected"))


def contract_projection(matrix: DataFrame) -> DataFrame:
    """P13."""
    return matrix.select(*FEATURES, TARGET, SPLIT_KEY)


class ContractError(ValueError):
    """The data breaks its contract."""


def validate_features(df: DataFrame, least: int = MIN_ROWS) -> None:
    """Raises ContractError naming every issue. The reports are small: rows a rule, not rows of data."""
    issues = [f"{r['column_name']}: {r['status']}" for r in schema_checks(df).where("status IN ('missing', 'wrong_type')").collect()]
    if not issues:
        issues += [f"{r['column_name']}: {r['below']} below, {r['above']} above" for r in range_checks(df).where("NOT passed").collect()]
        issues += [f"{r['column_name']}: {r['nulls']} nulls" for r in null_checks(df, list(CONTRACT)).where("NOT passed").collect()]
        issues += [f"{r['duplicates']} duplicates" for r in duplicate_check(df).where("NOT passed").collect()]
        issues += [f"{r['n_rows']} rows, {r['least']} wanted" for r in row_count_check(df, least).where("NOT passed").collect()]
    if issues:
        raise ContractError("; ".join(issues))
