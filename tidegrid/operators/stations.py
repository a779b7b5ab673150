"""Matching trip stations to the station feed, by name and then by place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.ranking import selected, share, value_ranges

METRES_PER_DEGREE, REACH = 111_000.0, 500.0


def station_profile(trips: DataFrame) -> DataFrame:
    """The name of the first trip, and median coordinates, of each station. A station's places are spread over ranges of values, so
    one with a great share of all trips is no task's alone."""
    station = ["start_station_id"]
    names = trips.groupBy(*station).agg(F.min_by("start_station_name", F.struct("started_at", "ride_id")).alias("station_name"))
    both = names.withColumnRenamed("start_station_id", "_station")
    for column, name in (("start_lat", "lat"), ("start_lng", "lon")):
        median = selected(value_ranges(trips, F.col(column).cast("double"), station), {name: share(0.5)}, station)
        both = both.join(median, F.col("_station").eqNullSafe(F.col("start_station_id")), "left").drop("start_station_id")
    return both.withColumnRenamed("_station", "start_station_id")


def match_by_name(profile: DataFrame, feed: DataFrame) -> DataFrame:
    """Feed (station_id, station_name, capacity, lat, lon). A name that the feed repeats counts once, the least id's, so no row fans out."""
    first = Window.partitionBy("station_name").orderBy("station_id")
    unique = feed.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(F.col("station_name").alias("_name"), F.col("station_id").alias("feed_station_id"), "capacity")
    return profile.join(unique, profile["station_name"] == unique["_name"], "left").drop("_name")


def unmatched(matched: DataFrame) -> DataFrame:
    """J08."""
    return matched.where(F.col("capacity").isNull()).drop("feed_station_id", "capacity")


def nearest(stations: DataFrame, feed: DataFrame, reach: float = REACH) -> DataFrame:
    """The nearest feed station within ``reach`` metres. Both sides are dealt to cells as wide as the reach; a station meets
    its own cell and the eight around it in an equi-join, so no side is broadcast and no pair out of reach is made. Of feed stations at the same
    place only the least id can be the nearest, so a place stands once in its cell, however many stations the feed has there."""
    width = reach / METRES_PER_DEGREE
    cell = lambda c: F.floor(F.col(c) / width)
    around = F.array(*(F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    left = stations.withColumn("_a", F.explode(around)).withColumns({"_x": cell("lat") + F.col("_a.dx"), "_y": cell("lon") + F.col("_a.dy")}).drop("_a")
    places = feed.groupBy("lat", "lon").agg(F.min_by(F.struct("station_id", "capacity"), "station_id").alias("f")).select("lat", "lon", "f.*")
    right = places.select(F.col("station_id").alias("feed_station_id"), "capacity", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), cell("lat").alias("_x"), cell("lon").alias("_y"))
    far = F.sqrt(F.pow(F.col("lat") - F.col("_lat"), 2) + F.pow(F.col("lon") - F.col("_lon"), 2)) * METRES_PER_DEGREE
    near = left.join(right, ["_x", "_y"]).withColumn("distance_m", far).where(F.col("distance_m") <= reach)
    best = F.min_by(F.struct("feed_station_id", "capacity", "distance_m"), F.struct("distance_m", "feed_station_id"))
    return near.groupBy("start_station_id").agg(best.alias("b")).select("start_station_id", "b.*")


def station_lookup(trips: DataFrame, feed: DataFrame, reach: float = REACH) -> DataFrame:
    """(start_station_id, feed_station_id, capacity, matched_by)."""
    named = match_by_name(station_profile(trips), feed)
    by_name = named.where(F.col("capacity").isNotNull()).select("start_station_id", "feed_station_id", "capacity", F.lit("name").alias("matched_by"))
    by_place = nearest(unmatched(named), feed, reach).select("start_station_id", "feed_station_id", "capacity", F.lit("place").alias("matched_by"))
    return by_name.unionByName(by_place)


def name_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names in both, in the left only, in the right only, for frames with one column station_name."""
    a, b = (x.select("station_name").where("station_name IS NOT NULL").distinct().withColumn(side, F.lit(1)) for x, side in ((left, "_l"), (right, "_r")))
    both = a.join(b, "station_name", "full")
    return both.agg(F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("both"), F.count_if(F.col("_r").isNull()).alias("left_only"), F.count_if(F.col("_l").isNull()).alias("right_only"))


def direct_join(trips: DataFrame, feed: DataFrame) -> DataFrame:
    """How many trips and stations the feed's ids miss."""
    ids = feed.select(F.col("station_id").alias("_id")).distinct()
    joined = trips.join(ids, trips["start_station_id"] == ids["_id"], "left")
    missed = F.col("_id").isNull()
    return joined.agg(F.count("*").alias("trips"), F.count_if(missed).alias("unmatched_trips"), F.countDistinct("start_station_id").alias("stations"), F.countDistinct(F.when(missed, F.col("start_station_id"))).alias("unmatched_stations"))
