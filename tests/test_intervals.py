"""Points joined with intervals, no key shared, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tierwell.operators.intervals import interval_join

from conftest import rows


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    points = [(i, rnd.choice([rnd.randint(-300, 300), 7])) for i in range(300)] + [(900, None), (7, 7), (7, 7)]
    intervals = [(f"i{k}", a, a + rnd.choice([0, 1, 2, 3, 50, 64, 500, -4])) for k in range(120)
                 for a in [rnd.randint(-320, 320)]]
    intervals += [("all", -10**12, 10**12), ("open", None, 5), ("open", 5, None), ("i0", *intervals[0][1:]), ("one", 7, 8)]
    p = spark.createDataFrame(points, "p long, at long")
    i = spark.createDataFrame(intervals, "name string, lo long, hi long")
    got = interval_join(p, F.col("at"), i, F.col("lo"), F.col("hi"))
    want = sorted((a, x, n, lo, hi) for a, x in points if x is not None for n, lo, hi in intervals
                  if lo is not None and hi is not None and lo <= x < hi)
    assert rows(got) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_sides_and_clashing_names(spark):
    p = spark.createDataFrame([], "p long, at long")
    i = spark.createDataFrame([], "name string, lo long, hi long")
    full = spark.createDataFrame([("x", 1, 5)], i.schema)
    assert interval_join(p, F.col("at"), full, F.col("lo"), F.col("hi")).collect() == []
    one = spark.createDataFrame([(1, 2)], p.schema)
    assert interval_join(one, F.col("at"), i, F.col("lo"), F.col("hi")).collect() == []
    with pytest.raises(ValueError):
        interval_join(one, F.col("at"), full.withColumnRenamed("lo", "at"), F.col("at"), F.col("hi"))


def test_spine_and_plan_on_dates_alone(spark, wh):
    from tierwell.plans.reports import plan_on_spine
    got = plan_on_spine(wh.spine, wh.stg_rso_plan)
    assert rows(got) == rows(wh.plan_days)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_points_are_never_broadcast(spark):
    # many points of one narrow column look small to Spark before they are repeated per level
    points = spark.range(50000).select((F.col("id") % 1000).alias("at"))
    few = spark.createDataFrame([("a", 0, 300), ("b", 250, 1000)], "name string, lo long, hi long")
    many = spark.range(3000).select(F.col("id").cast("string").alias("name"), (F.col("id") % 900).alias("lo"),
                                    (F.col("id") % 900 + 7).alias("hi"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, intervals, kind in (("10m", few, "BroadcastHashJoin"), ("-1", few, "SortMergeJoin"),
                                       ("1k", many, "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            got = interval_join(points, F.col("at"), intervals, F.col("lo"), F.col("hi"))
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert kind in plan and "BuildLeft" not in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        got = interval_join(points, F.col("at"), few, F.col("lo"), F.col("hi")).groupBy("name").count()
        assert rows(got) == [("a", 15000), ("b", 37500)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
