from pyspark.sql import functions as F

from tidegrid.operators.ranking import numbered, selected, share, value_ranges
from tidegrid.sources import scratch


def test_numbers_equal_a_window_over_all(spark):
    rows = [(i % 7 if i % 3 else None, (i * 37) % 101, i) for i in range(500)] + [(1, None, 1000 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "g int, x int, i int")
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    with scratch.run(spark):
        got = {r["i"]: r["n"] for r in numbered(df, ["x", "i"], "n").collect()}
        assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=key), 1)}
        got = {r["i"]: r["n"] for r in numbered(df, ["x", "i"], "n", ["g"]).collect()}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=key)
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))


def test_no_window_holds_all_rows_and_a_run_leaves_nothing(spark):
    before = set(scratch._OPEN)
    with scratch.run(spark):
        df = numbered(spark.range(1000).withColumn("g", F.lit(1)), ["id"], "n", ["g"])
        assert df.where("n != id + 1").count() == 0
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "windowspecdefinition(g" in plan and "windowspecdefinition(id" not in plan
    assert set(scratch._OPEN) == before
    assert numbered(spark.range(0), ["id"], "n").count() == 0


def interpolated(values, p):
    place = p * (len(values) - 1)
    lo = int(place)
    return values[lo] + (values[min(lo + 1, len(values) - 1)] - values[lo]) * (place - lo)


def test_quantiles_equal_sorted_lists(spark):
    rows = [(i % 5 if i % 7 else None, ((i * 7919) % 1000) / 4) for i in range(2000)] + [(9, 1.5)] * 700 + [(10, 2.0), (11, None)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(5)
    at = {"least": share(0.0), "q1": share(0.25), "median": share(0.5), "most": share(1.0), "element": F.floor(F.col("_all") * 0.15)}
    with scratch.run(spark):
        one = selected(value_ranges(df, F.col("x")), at).first()
        groups = {r["g"]: r for r in selected(value_ranges(df, F.col("x"), ["g"]), at, ["g"]).collect()}
    for own, got in [(sorted(x for _, x in rows if x is not None), one), *((sorted(x for g, x in rows if g == k and x is not None), r) for k, r in groups.items())]:
        for name, p in (("least", 0.0), ("q1", 0.25), ("median", 0.5), ("most", 1.0)):
            assert abs(got[name] - interpolated(own, p)) < 1e-9
        assert got["element"] == own[int(len(own) * 0.15)]
    assert set(groups) == {None, 0, 1, 2, 3, 4, 9, 10}  # a group without a value has no row
    assert selected(value_ranges(df.where("false"), F.col("x")), at).first()["median"] is None


def test_no_task_holds_more_than_a_range(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions are joined up to the advised size otherwise
    try:
        _ranges_are_even(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _ranges_are_even(spark):
    with scratch.run(spark):
        df = spark.range(0, 100_000, numPartitions=8).withColumn("x", F.xxhash64("id"))
        ranges = value_ranges(df, F.col("x"))
        sizes = [r["count"] for r in ranges.groupBy("_part").count().collect()]
        assert len(sizes) > 1 and max(sizes) < 100_000 / len(sizes) * 2
        plan = selected(ranges, {"m": share(0.5)})._jdf.queryExecution().optimizedPlan().toString()
        assert "windowspecdefinition(_part" in plan and "percentile" not in plan
