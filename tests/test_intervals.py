import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import bag
from tradeloom.operators import intervals
from tradeloom.operators.intervals import interval_join


def overlaps(a, b):
    """Do two half-open intervals, NULL limits unbounded, share a whole number?"""
    low = max([x for x in (a[0], b[0]) if x is not None], default=None)
    high = min([x for x in (a[1], b[1]) if x is not None], default=None)
    empty = any(s is not None and e is not None and s >= e for s, e in (a, b))
    return not empty and (low is None or high is None or low < high)


def spans(draw, n, low=-3000, high=3000):
    rows = []
    for i in range(n):
        start = draw.randint(low, high)
        length = draw.choice([0, 1, 1, 2, 5, 30, 700, 100_000, -3])
        limits = (start, start + length)
        limits = draw.choice([limits] * 8 + [(None, start), (start, None), (None, None)])
        rows.append((i, *limits))
    return rows


@pytest.mark.parametrize("seed, width, levels", [(1, 1, 4), (2, 7, 2), (3, 5000, 1), (4, 3, 0), (5, 16, 3)])
def test_equals_comparing_all_pairs(spark, seed, width, levels):
    draw = random.Random(seed)
    ones, twos = spans(draw, 80), spans(draw, 90)
    twos += [(100 + k, 5, 6) for k in range(40)]  # hot
    left = spark.createDataFrame(ones, "a int, s bigint, e bigint")
    right = spark.createDataFrame(twos, "b int, t bigint, u bigint")
    expected = sorted(((a, b) for a, *x in ones for b, *y in twos if overlaps(x, y)), key=repr)
    assert bag(interval_join(left, right, ("s", "e"), ("t", "u"), width, levels).select("a", "b")) == expected
    kept = interval_join(left, right, ("s", "e"), ("t", "u"), width, levels, left_key=["a"])
    alone = {a for a, *_ in ones} - {a for a, _ in expected}
    assert sorted(bag(kept.select("a", "b")), key=repr) == sorted([*expected, *((a, None) for a in alone)], key=repr)


def test_points_dates_and_timestamps(spark):
    draw, day = random.Random(6), date(1969, 12, 20)
    points = [(i, day + timedelta(draw.randint(0, 60)) if i % 9 else None) for i in range(70)]
    stays = [(i, day + timedelta(k), day + timedelta(k + draw.randint(0, 9))) for i, k in enumerate(draw.choices(range(60), k=50))]
    left = spark.createDataFrame(points, "p int, d date")
    right = spark.createDataFrame(stays, "b int, t date, u date")
    expected = sorted(((p, b) for p, d in points for b, t, u in stays if d and t <= d < u), key=repr)
    assert bag(interval_join(left, right, ("d", None), ("t", "u"), 4).select("p", "b")) == expected
    hours = lambda df, *c: df.select(
        df.columns[0], *(F.col(x).cast("timestamp").alias(x) for x in c)
    )
    as_times = interval_join(hours(left, "d"), hours(right, "t", "u"), ("d", None), ("t", "u"), 4 * 86_400_000_000)
    assert bag(as_times.select("p", "b")) == expected
    late = spark.createDataFrame([(1, datetime(2020, 1, 1, 23, 59, 59, 999_999))], "p int, d timestamp")
    night = spark.createDataFrame(
        [(1, datetime(2020, 1, 1, 22), datetime(2020, 1, 2)), (2, datetime(2020, 1, 2), datetime(2020, 1, 3))],
        "b int, t timestamp, u timestamp",
    )
    assert bag(interval_join(late, night, ("d", None), ("t", "u"), 3_600_000_000).select("b")) == [(1,)]


def test_limits_at_the_ends_of_the_axis(spark):
    top, low = 2**63 - 1, -(2**63)
    left = spark.createDataFrame([(1, low, top), (2, top - 1, top), (3, low, low + 1)], "a int, s bigint, e bigint")
    right = spark.createDataFrame([(1, 0, 1), (2, low, low + 1), (3, top - 1, top)], "b int, t bigint, u bigint")
    got = bag(interval_join(left, right, ("s", "e"), ("t", "u"), 16).select("a", "b"))
    assert got == [(1, 1), (1, 2), (1, 3), (2, 3), (3, 2)]


def test_empty_sides_and_clashing_names(spark):
    left = spark.createDataFrame([(1, 1, 2)], "a int, s bigint, e bigint")
    right = left.limit(0).toDF("b", "t", "u")
    assert bag(interval_join(left, right, ("s", "e"), ("t", "u"), 5)) == []
    assert bag(interval_join(left, right, ("s", "e"), ("t", "u"), 5, left_key=["a"])) == [(1, 1, 2, None, None, None)]
    assert bag(interval_join(right, left, ("t", "u"), ("s", "e"), 5, left_key=["b"])) == []
    with pytest.raises(ValueError, match="'a'"):
        interval_join(left, left, ("s", "e"), ("s", "e"), 5)


def test_no_pair_of_fine_rows_meets_on_a_coarse_level(spark):
    """Rows that lie far apart are not compared, although all of them show up on the level of the whole axis."""
    some = spark.range(2000).select("id", (F.col("id") * 1000).alias("s"), (F.col("id") * 1000 + 3).alias("e"))
    other = some.toDF("b", "t", "u").unionAll(spark.createDataFrame([(-1, None, None)], "b bigint, t bigint, u bigint"))
    one, two = (
        intervals._entries(df, *span, [4, 64], side)
        for df, span, side in ((some, ("s", "e"), "left"), (other, ("t", "u"), "right"))
    )
    compared = one.join(two, ["__level", "__bin", "__role"]).count()
    assert interval_join(some, other, ("s", "e"), ("t", "u"), 4, 2).count() == 4000
    assert compared < 10_000


def test_plan_joins_on_keys(spark):
    left = spark.range(10).selectExpr("id AS a", "id AS s", "id + 1 AS e")
    right = left.toDF("b", "t", "u")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = interval_join(left, right, ("s", "e"), ("t", "u"), 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[__level#\d+, __bin#\d+L, __role#\d+\]", plan)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
