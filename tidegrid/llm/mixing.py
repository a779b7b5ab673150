"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]. Its integral is the source's share of all
taken words; where a share would pass ``max_repeats`` times the source's size, the excess goes to the others
by weight until none is above. Within a source, documents stand in the order of a digest of their id; document
i takes floor(r c_i) - floor(r c_(i-1)) words, with r the source's target over its size and c the running
size, so the source's sum is its target to within one word and no document passes ceil(r size). A document's
position is the time at which the source's cumulative demand, the integral of its schedule, reaches the
middle of the words that it takes; the result is range-sorted by position.

Running sums over a source are taken in two steps, over digest buckets and within a bucket, so that a source
that holds most rows is spread over groups of about ``BUCKET_ROWS`` rows. The table of buckets is sent to all tasks while it
has ``SENT_ROWS`` rows at most. Only the table of sources passes one task.

Null texts and texts without words have size 0 and take nothing; a null source is a source, the last; null ids are alike.
Equal ids keep apart by their size and text; repeated rows are alike, so either may take the odd word. Long texts are
counted whole. An empty table gives no rows. Columns other than those read pass through ``mix_documents``; those named like an output are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm._frames import saved

WORDS = r"[^\x20\x09-\x0D]+"
#: Source weights, repeating in the order of the sources; and the words that the mix takes, as a share of all.
WEIGHTS, SHARE, MAX_REPEATS = (3, 1, 2), 1.5, 2
#: Documents of a bucket, if all were of one source; and rows of the table of buckets that may be broadcast, at 100 bytes each.
BUCKET_ROWS, SENT_ROWS = 20_000, 100_000
#: How a weight runs from the start of training to its end, as multiples of its mean, repeating in the order of
#: the sources: falling, level, rising. Each schedule's integral over [0, 1] is 1.
SLOPES = (-0.5, 0.0, 0.5)
OUTPUT = ("size", "source_size", "target", "taken", "position")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """For (source, source_size): target and slope. Water-filling in closed form: by cap over weight, the least first, a
    source is capped if the level that the rest would get passes its cap."""
    everything = Window.partitionBy(F.lit(1))
    ranked = sizes.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    pick = lambda values, kind: F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("rank") % len(values) + 1)
    ranked = ranked.withColumns({"weight": pick(weights, "double"), "slope": pick(SLOPES, "double"), "cap": F.col("source_size").cast("double") * max_repeats})
    order = everything.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = ranked.withColumns({
        "demand": F.sum(F.col("source_size").cast("double")).over(everything) * share,
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    filled = filled.withColumn("level", (F.col("demand") - F.col("cap_before")) / F.col("weight_left"))
    free = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(everything).getField("level")
    return filled.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))).select("source", "source_size", "target", "slope")


def _sized(documents: DataFrame) -> list[Column]:
    """size, the digest that orders a source, and a hash that tells texts of one id apart."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    return [size.alias("size"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("__tg_digest"), F.xxhash64("text").alias("__tg_text")]


def mix_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """documents with size, source_size, target, taken and position, range-sorted by position."""
    kept = [c for c in documents.columns if c.lower() not in OUTPUT]
    sized = documents.select(*(F.col(f"`{c}`") for c in kept), *_sized(documents))
    return _placed(sized, kept, weights, share, max_repeats)


def place_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The same of doc_id and source alone: texts are read once, for their sizes, and go nowhere."""
    sized = saved(documents.select("doc_id", "source", *_sized(documents)), "mixing-sizes")
    return _placed(sized, ["doc_id", "source"], weights, share, max_repeats)


def _placed(sized: DataFrame, kept: list[str], weights: tuple[int, ...], share: float, max_repeats: int) -> DataFrame:
    digits = max(2, math.ceil(math.log(max(1, sized.count() / BUCKET_ROWS), 16)))  # hex digits of the digest that name a bucket
    slim = sized.select("source", "size", F.substring("__tg_digest", 1, digits).alias("__tg_bucket"))
    buckets = saved(slim.groupBy("source", "__tg_bucket").agg(F.sum("size").alias("bucket_size")), "mixing-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, max_repeats)
    run = Window.partitionBy("source").orderBy("__tg_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.withColumn("__tg_offset", F.coalesce(F.sum("bucket_size").over(run), F.lit(0))).alias("b")
    targets = targets.withColumnRenamed("source", "__tg_s").alias("t")
    offsets = offsets.join(targets, F.col("b.source").eqNullSafe(F.col("t.__tg_s"))).select(F.col("b.source").alias("__tg_s"), F.col("b.__tg_bucket").alias("__tg_b"), "__tg_offset", "source_size", "target", F.col("slope").alias("__tg_slope"))
    if buckets.count() <= SENT_ROWS:
        offsets = F.broadcast(offsets)
    placed = sized.join(offsets, sized["source"].eqNullSafe(offsets["__tg_s"]) & (F.substring(sized["__tg_digest"], 1, digits) == offsets["__tg_b"]))
    inside = Window.partitionBy("__tg_s", "__tg_b").orderBy("__tg_digest", "doc_id", "size", "__tg_text").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("__tg_upto", F.col("__tg_offset") + F.sum("size").over(inside))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto, since = F.floor(F.col("__tg_upto") * ratio), F.floor((F.col("__tg_upto") - F.col("size")) * ratio)
    placed = placed.withColumn("taken", F.when(F.col("size") > 0, upto - since).otherwise(F.lit(0)).cast("long"))
    # demand D(t) = (1 - a) t + a t^2 for the schedule 1 + a (2 t - 1); its inverse at the middle of the words taken
    middle = F.when(F.col("target") > 0, (upto + since) / (F.lit(2.0) * F.col("target"))).otherwise(F.lit(0.0))
    middle, a = F.least(F.lit(1.0), middle), F.col("__tg_slope")
    inverse = F.when(a == 0, middle).otherwise((a - 1 + F.sqrt((F.lit(1.0) - a) * (F.lit(1.0) - a) + F.lit(4.0) * a * middle)) / (F.lit(2.0) * F.when(a != 0, a)))
    placed = placed.withColumn("position", F.round(inverse, 6))
    return placed.select(*(F.col(f"`{c}`") for c in kept), *OUTPUT).orderBy("position", "doc_id")
