import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import bag
from tradeloom.operators.distinct_counts import counts_of_bitmaps, id_bitmaps
from tradeloom.plans import shop


@pytest.fixture(scope="module")
def orders(spark):
    draw, first = random.Random(3), date(2016, 12, 20)
    ids = [-40_000, -1, 0, 1, 32_767, 32_768, 32_769, 2**40, 2**62, None]
    rows = []
    for k in range(600):
        day = first + timedelta(draw.randint(0, 70))
        customer = draw.choice([*ids, *range(50)])
        rows.append((draw.randint(0, 300), customer, day, draw.random() < 0.8, draw.choice(["Approved"] * 4 + ["Cancelled"])))
    return spark.createDataFrame(rows, "order_id bigint, customer_id bigint, order_date date, online_order boolean, order_status string")


@pytest.mark.parametrize("period", ["day", "week", "month", "quarter", "year"])
def test_equal_to_counting_distinct_rows(orders, tmp_path, period):
    first, last = date(2016, 12, 25), date(2017, 2, 20)
    shop.daily_online_ids(orders, first, last).write.parquet(str(tmp_path / "days"))
    days = orders.sparkSession.read.parquet(str(tmp_path / "days"))
    online = orders.filter("online_order AND order_status = 'Approved'").filter(F.col("order_date").between(first, last))
    expected = online.groupBy(F.date_trunc(period, "order_date").cast("date").alias("d")).agg(
        F.count_distinct("order_id"), F.count_distinct("customer_id")
    )
    got = shop.distinct_by_period(days, [period])
    assert bag(got.select("first_day", "cnt_order", "cnt_customers")) == bag(expected)


def test_days_are_the_daily_report(orders):
    span = date(2017, 1, 1), date(2017, 1, 31)
    by_day = shop.distinct_by_period(shop.daily_online_ids(orders, *span), ["day"]).drop("period")
    assert bag(by_day) == bag(shop.daily_online_orders(orders, *span))


def test_days_appended_later_add_up(orders):
    days = [shop.daily_online_ids(orders, *s) for s in [(date(2017, 1, 1), date(2017, 1, 9)), (date(2017, 1, 10), date(2017, 1, 31))]]
    whole = shop.daily_online_ids(orders, date(2017, 1, 1), date(2017, 1, 31))
    assert bag(shop.distinct_by_period(days[0].unionAll(days[1]), ["month"])) == bag(shop.distinct_by_period(whole, ["month"]))


def test_groups_without_ids_and_no_rows(spark):
    rows = spark.createDataFrame([("x", 1, None), ("x", 1, None), ("y", None, None)], "g string, a int, b bigint")
    bitmaps = id_bitmaps(rows, ["g"], ["a", "b"])
    assert bag(counts_of_bitmaps(bitmaps, [F.col("g")], ["a", "b"])) == [("x", 1, 0)]
    assert bag(counts_of_bitmaps(id_bitmaps(rows.limit(0), ["g"], ["a"]), [F.col("g")], ["a"])) == []


def test_rows_are_read_once_and_combined_before_the_shuffle(orders):
    text = shop.daily_online_ids(orders, date(2017, 1, 1), date(2017, 1, 31))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_bitmap_construct_agg" in text
