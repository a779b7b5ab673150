"""Trip cleaning: deduplication, filters, derived columns, and reports on what goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.times import day_of_week
from tidegrid.operators.ranking import selected, share, value_ranges

CRITICAL = ("ride_id", "started_at", "ended_at", "start_station_id", "end_station_id")
SHORTEST, LONGEST = 60, 86_400


def first_of_each(trips: DataFrame, key: str = "ride_id", order: tuple[str, ...] = ("started_at",)) -> DataFrame:
    """One row for each key, the first by ``order``; dropDuplicates would keep any."""
    ranked = trips.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_n = 1").drop("_n")


def duration_seconds() -> Column:
    return F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))


def with_duration(trips: DataFrame) -> DataFrame:
    """P02."""
    return trips.withColumn("trip_duration_seconds", duration_seconds()).withColumn("trip_duration_minutes", F.col("trip_duration_seconds") / 60)


def with_time_parts(trips: DataFrame) -> DataFrame:
    """P05; Monday is 1 here, as in the cleaned trips, and 0 in the panel."""
    at = F.col("started_at")
    return trips.withColumns({"hour": F.hour(at), "day_of_week": day_of_week(at) + 1, "month": F.month(at), "year": F.year(at), "date": F.to_date(at)})


def standardised(trips: DataFrame, columns: tuple[str, ...] = ("rideable_type", "member_casual")) -> DataFrame:
    """P04."""
    return trips.withColumns({c: F.lower(F.trim(c)) for c in columns if c in trips.columns})


def clean_trips(trips: DataFrame, order: tuple[str, ...] = ("started_at",)) -> DataFrame:
    """Duplicates, nulls in critical fields and implausible durations go; the rest is standardised."""
    kept = first_of_each(trips, order=order).na.drop(subset=[c for c in CRITICAL if c in trips.columns])
    kept = with_duration(kept).where(F.col("trip_duration_seconds").between(SHORTEST, LONGEST))
    return with_time_parts(standardised(kept))


def cleaning_waterfall(trips: DataFrame, order: tuple[str, ...] = ("started_at",)) -> DataFrame:
    """Rows that each step removes, in one aggregate over flagged rows."""
    n = F.row_number().over(Window.partitionBy("ride_id").orderBy(*order))
    missing = F.lit(False)
    for c in CRITICAL:
        if c in trips.columns:
            missing = missing | F.col(c).isNull()
    step = F.when(F.col("_n") > 1, "duplicate").when(missing, "missing").when(~duration_seconds().between(SHORTEST, LONGEST), "duration")
    flagged = trips.withColumn("_n", n).select(F.coalesce(step, F.lit("kept")).alias("step"))
    counts = [F.count_if(F.col("step") == s).alias(f"n_{s}") for s in ("duplicate", "missing", "duration", "kept")]
    total = flagged.agg(F.count("*").alias("n_raw"), *counts)
    return total.withColumn("retention_pct", F.round(F.try_divide(100.0 * F.col("n_kept"), F.col("n_raw")), 4))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls of each column, counted in one pass, one row a column."""
    counted = df.agg(F.count("*").alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    long = counted.unpivot("_rows", df.columns, "column_name", "null_count")
    return long.select("column_name", "null_count", F.round(F.try_divide(100.0 * F.col("null_count"), F.col("_rows")), 4).alias("null_pct"))


def duplicate_profile(df: DataFrame, key: str = "ride_id") -> DataFrame:
    """Totals; the worst keys are ``worst_keys``."""
    by_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("unique_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"), F.count_if(F.col("n") > 1).alias("keys_with_duplicates"))


def worst_keys(df: DataFrame, key: str = "ride_id", top: int = 5) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), key).limit(top)


def duration_categories(trips: DataFrame) -> DataFrame:
    """A08."""
    s = duration_seconds()
    label = F.when(s < 0, "negative").when(s < SHORTEST, "under_1_min").when(s > LONGEST, "over_24_h").otherwise("normal")
    return trips.groupBy(label.alias("category")).agg(F.count("*").alias("n"), F.round(F.avg(s), 4).alias("mean_seconds"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """A04. Quartiles are selected from ranges of values, so no buffer holds them all; the other figures come from the same counts."""
    ranges = value_ranges(df, F.col(column))
    v, n = F.col("_v").cast("double"), F.col("_n")
    rows, total = F.sum("_n"), F.sum(v * n)
    spread = F.greatest(F.lit(0.0), F.sum(v * v * n) - total * total / rows)
    figures = ranges.agg(F.coalesce(rows, F.lit(0)).alias("n"), F.round(total / rows, 6).alias("mean"), F.round(F.sqrt(F.try_divide(spread, rows - 1)), 6).alias("stddev"), F.min("_v").alias("least"), F.max("_v").alias("greatest"))
    quartiles = selected(ranges, {"q1": share(0.25), "median": share(0.5), "q3": share(0.75)})
    return figures.crossJoin(F.broadcast(quartiles)).select("n", "mean", "stddev", "least", "q1", "median", "q3", "greatest")


def schema_comparison(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two sources, where each stands, its type and nulls on either side."""
    def profile(df: DataFrame, side: str) -> DataFrame:
        types = F.create_map(*(F.lit(x) for c, t in df.dtypes for x in (c, t)))
        nulls = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns)).unpivot([], df.columns, "column_name", f"{side}_nulls")
        return nulls.withColumn(f"{side}_type", types[F.col("column_name")])

    both = profile(left, "left").join(profile(right, "right"), "column_name", "full")
    where = F.when(F.col("right_type").isNull(), "left_only").when(F.col("left_type").isNull(), "right_only").otherwise("common")
    return both.select("column_name", where.alias("side"), F.coalesce(F.col("left_type") == F.col("right_type"), F.lit(False)).alias("same_type"), "left_nulls", "right_nulls")
