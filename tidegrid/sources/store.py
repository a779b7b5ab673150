"""Parquet, JSON and CSV sinks, and fingerprints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.sources.scratch import exists, folder

PREDICTIONS = "station_id string, forecast_hour timestamp_ntz, predicted_demand double, model_version int, generated_at string"


def scratch(spark: SparkSession, what: str) -> str:
    """A folder that nobody else uses, below the shared one; it is deleted when the run ends."""
    return folder(spark, what)


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month")) -> None:
    """Only the partitions that df has are overwritten."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_years(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """A year's filter prunes folders."""
    df = spark.read.parquet(path)
    return df if year is None else df.where(F.col("year") == year)


def read_trip_columns(spark: SparkSession, path: str) -> DataFrame:
    """S04."""
    return spark.read.parquet(path).select("started_at", "start_station_id")


def write_sorted(df: DataFrame, path: str, keys: tuple[str, ...] = ("start_station_id", "hour")) -> None:
    """Ranges of keys, each sorted: a total order without one task that sorts all."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def point(spark: SparkSession, pointer: str, target: str) -> None:
    """Makes a pointer file name a folder, in one step: a reader sees the old name or the new one, never a part of one."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    place, aside = hadoop.fs.Path(pointer), hadoop.fs.Path(f"{pointer}-{uuid.uuid4().hex}")
    system = place.getFileSystem(conf)
    out = system.create(aside, True)
    out.write(target.encode())
    out.close()
    over = spark.sparkContext._gateway.new_array(hadoop.fs.Options.Rename, 1)
    over[0] = hadoop.fs.Options.Rename.OVERWRITE
    hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(system.makeQualified(aside), system.makeQualified(place), over)


def pointed(spark: SparkSession, pointer: str) -> str | None:
    """The folder that a pointer file names; none where it is missing."""
    if not exists(spark, pointer):
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(pointer)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_predictions(df: DataFrame, root: str) -> str:
    """A folder that is written once and never over another, then the pointers of its first forecast day and of the latest forecast.
    A writer that fails before a pointer leaves what it named. Returns the folder."""
    spark, folder = df.sparkSession, f"{root}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    day = spark.read.parquet(folder).agg(F.date_format(F.min("forecast_hour"), "yyyy-MM-dd").alias("d")).first()["d"]
    point(spark, f"{root}/day-{day}", folder)
    point(spark, f"{root}/latest", folder)
    return folder


def read_predictions(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """The latest forecast, or the one whose first day is ``day``; no rows where there is none."""
    folder = pointed(spark, f"{root}/latest" if day is None else f"{root}/day-{day}")
    return spark.read.parquet(folder) if folder else spark.createDataFrame([], PREDICTIONS)


def with_latest(spark: SparkSession, root: str, day: str) -> DataFrame:
    """The forecast whose first day is ``day``, and beside it what the latest forecast says of the same station and hour (latest). A forecast has a
    row a station and hour, so where both pointers name one folder its rows are their own latest, and nothing is shuffled to find that out."""
    own = read_predictions(spark, root, day)
    if pointed(spark, f"{root}/day-{day}") == pointed(spark, f"{root}/latest"):
        return own.withColumn("latest", F.col("predicted_demand"))
    latest = read_predictions(spark, root).select("station_id", "forecast_hour", F.col("predicted_demand").alias("latest"))
    return own.join(latest, ["station_id", "forecast_hour"])


def drop_unnamed(spark: SparkSession, root: str) -> int:
    """Deletes the folders that no pointer names, and says how many; for a time when nobody writes or reads an older forecast."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = {pointed(spark, s.getPath().toString()) for s in system.listStatus(place) if s.isFile()}
    gone = [s.getPath() for s in system.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")) if f"{root}/data/{s.getPath().getName()}" not in named]
    for folder in gone:
        system.delete(folder, True)
    return len(gone)


def write_formats(df: DataFrame, root: str) -> None:
    """S11, for small tables."""
    df.write.mode("overwrite").option("header", True).csv(f"{root}/csv")
    df.write.mode("overwrite").json(f"{root}/json")
    df.write.mode("overwrite").parquet(f"{root}/parquet")


def write_report(report: DataFrame, path: str, by: str | None = None) -> None:
    """Long rows, or one nested object a group."""
    if by:
        rest = [c for c in report.columns if c != by]
        report = report.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("rows"))
    report.write.mode("overwrite").json(path)


def fingerprint(df: DataFrame) -> DataFrame:
    """A content hash that no order or file layout changes: of the MD5 of each row, its cells as text between bars, the exclusive
    or and the sum of the first 60 bits. A null is told from an empty text."""
    cells = F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in df.columns))
    h = F.conv(F.substring(F.md5(cells), 1, 15), 16, 10).cast("long")
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("hash_xor"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("hash_sum"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """U01."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
