"""The interval join against comparing everything with everything."""

import math
import random

import pytest
from pyspark.sql import functions as F

from brightloom.operators import relations as J


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(8)
    nan, inf = float("nan"), float("inf")
    points = [(i, rng.choice(["hot"] * 5 + ["a", "b", None]), rng.choice([rng.uniform(-50, 50), 0.0, -7.5, 1e9])) for i in range(300)]
    points += [(900, "hot", None), (901, "hot", nan)]
    intervals = []
    for i in range(120):
        low = rng.uniform(-60, 50)
        intervals.append((i, rng.choice(["hot", "a", "b"]), low, low + rng.choice([0.0, 0.3, 1.0, 7.0, 90.0, 2e9])))
    intervals += [(500, "hot", 3.0, 2.0), (501, "hot", None, 4.0), (502, "hot", 1.0, nan), (503, "hot", -7.5, -7.5), (504, "a", 0.0, 1e9)]
    return (points, intervals, spark.createDataFrame(points, "p long, k string, v double").repartition(4),
            spark.createDataFrame(intervals, "i long, k string, low double, high double").repartition(2))


def brute(points, intervals, keyed):
    return sorted((p, i) for p, k, v in points for i, q, low, high in intervals
                  if (not keyed or (k is not None and k == q)) and None not in (v, low, high) and not math.isnan(v) and low <= v <= high)


@pytest.mark.parametrize("keyed, width, limit", [(True, 1.0, None), (True, 100.0, None), (False, 0.5, None), (True, 1.0, -1)])
def test_pairs_equal_brute_force(sides, monkeypatch, keyed, width, limit):
    if limit is not None:
        monkeypatch.setattr(J, "BROADCAST_BYTES", limit)
    points, intervals, left, right = sides
    right = right if keyed else right.drop("k")
    joined = J.interval_join(left, right, "v", "low", "high", ["k"] if keyed else [], width)
    assert sorted((r.p, r.i) for r in joined.collect()) == brute(points, intervals, keyed)
    assert set(joined.columns) == {"p", "k", "v", "i", "low", "high"}


def test_plan_has_no_nested_loop(sides):
    _, _, left, right = sides
    joined = J.interval_join(left, right, "v", "low", "high", ["k"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_intervals_and_no_points(sides):
    _, _, left, right = sides
    assert J.interval_join(left, right.where("i < 0"), "v", "low", "high", ["k"]).count() == 0
    assert J.interval_join(left.where("p < 0"), right, "v", "low", "high", ["k"]).count() == 0


@pytest.mark.parametrize("broadcast", [1 << 24, -1])
def test_tasks_follow_the_pairs(spark, monkeypatch, broadcast):
    """A few rows in one file can make many pairs: neither side's size decides on the tasks."""
    monkeypatch.setattr(J, "PAIRS_PER_TASK", 100)
    monkeypatch.setattr(J, "BROADCAST_BYTES", broadcast)
    left = spark.range(60).select("id", F.when(F.col("id") < 50, "hot").otherwise("rare").alias("k"), (F.col("id") / 60.0).alias("v")).coalesce(1)
    right = spark.range(40).select(F.col("id").alias("r"), F.when(F.col("id") < 30, "hot").otherwise("rare").alias("k"),
                                   (F.col("id") / 80.0).alias("low"), (F.col("id") / 80.0 + 0.5).alias("high")).coalesce(1)
    got = J.interval_join(left, right, "v", "low", "high", ["k"])
    want = left.crossJoin(right.withColumnRenamed("k", "k2")).where("k = k2 and v between low and high")
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))
    tasks = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(tasks) >= 4 and max(tasks) < sum(tasks) / 2
