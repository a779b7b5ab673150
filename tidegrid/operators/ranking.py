"""Places in a global or a group's order, and exact quantiles, without one task that sorts it all.

Rows are dealt to ranges of (group, order), sorted within a range and numbered there as they stream by; what lies before a range is a
sum over counts of ranges. A group as large as the table is spread over as many ranges as it takes. Rows that are equal in group and
order may take their places in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.sources.scratch import saved

#: monotonically_increasing_id() is the partition's number in the upper bits and the row's place in it in the lower 33.
_PLACES = 33


def numbered(df: DataFrame, order: list[Column | str], name: str, group: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """df with ``name``, a long from 1 in the given order (within a group). The numbered ranges are a table in the shared folder."""
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_at", F.monotonically_increasing_id())
    table = saved(ranged, "ranges")
    placed = table.select("*", F.shiftright("_at", _PLACES).alias("_part"), F.col("_at").bitwiseAND((1 << _PLACES) - 1).alias("_place")).drop("_at")
    # of each range, and of each group in it: rows, and the first one's place
    counts = placed.groupBy(*group, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    if group:
        # only a group that goes on in the next range is in more than one of them
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    offsets = counts.select(*(F.col(g).alias(f"_of_{g}") for g in group), F.col("_part").alias("_of_part"), (before - F.col("_first") + 1).alias("_add"))
    same = [F.col("_part") == F.col("_of_part"), *(F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group)]
    offsets = offsets if group else F.broadcast(offsets)
    return placed.join(offsets, _all(same)).select(*df.columns, (F.col("_place") + F.col("_add")).cast("long").alias(name))


def value_ranges(df: DataFrame, value: Column, group: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The distinct values (_v) of a group that are not null, with how many rows have each (_n), stored in ranges (_part) of values."""
    counts = df.select(*group, value.alias("_v")).where("_v IS NOT NULL").groupBy(*group, "_v").agg(F.count("*").alias("_n"))
    return saved(counts.repartitionByRange(*group, "_v").withColumn("_part", F.spark_partition_id()), "value-ranges")


def selected(ranges: DataFrame, at: dict[str, Column], group: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """A row a group with, for each name, the value at a place in the order of the group's rows. ``at`` gives the place, from 0, in terms of
    the group's rows ``_all``; between two places the value is between their values in proportion. How many rows each range has tells
    in which one a place is, and only the values of those are added up, each range by itself."""
    totals = ranges.groupBy(*group, "_part").agg(F.sum("_n").alias("_rows"))
    own = Window.partitionBy(*group)  # a row a range
    totals = totals.withColumns({"_all": F.sum("_rows").over(own), "_before": F.coalesce(F.sum("_rows").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    places = F.array(*(F.struct(F.lit(f"{name}_{side}").alias("name"), f(place.cast("double")).cast("long").alias("k")) for name, place in at.items() for side, f in (("lo", F.floor), ("hi", F.ceil))))
    wanted = totals.withColumn("_places", F.filter(places, lambda x: (x["k"] >= F.col("_before")) & (x["k"] < F.col("_before") + F.col("_rows")))).where(F.size("_places") > 0)
    names = {c: f"_w{c}" for c in (*group, "_part")}
    wanted = wanted.select(*(F.col(c).alias(n) for c, n in names.items()), "_places", "_before", "_all")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    found = ranges.join(wanted if group else F.broadcast(wanted), _all(same))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*group, "_part").orderBy("_v"))
    hit = found.withColumn("_upto", upto).withColumn("_hit", F.explode(F.filter("_places", lambda x: (x["k"] < F.col("_upto")) & (x["k"] >= F.col("_upto") - F.col("_n")))))
    side = lambda name: F.max(F.when(F.col("_hit.name") == name, F.col("_v")))
    picked = hit.groupBy(*group).agg(F.max("_all").alias("_all"), *(side(f"{n}_{x}").alias(f"_{n}_{x}") for n in at for x in ("lo", "hi")))
    part = lambda place: place.cast("double") - F.floor(place.cast("double"))
    return picked.select(*group, *((F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * part(place)).alias(n) for n, place in at.items()))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def share(p: float) -> Column:
    """The place of a quantile: SQL's, between neighbours."""
    return (F.col("_all") - 1) * F.lit(p)
