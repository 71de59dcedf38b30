"""Booking questions against plain Python, the occupancy also against the range join it replaces."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradeloom import schemas
from tradeloom.plans import bookings
from tradeloom.sources.calendar import calendar, calendar_spanning


def booking(i, rng):
    return dict(
        ID=f"B{i % 40}", n_adults=rng.choice([1, 2, None]), n_children=rng.choice([0, 1]),
        weekend_nights=rng.choice([0, 0, 2, -1]), week_nights=rng.choice([0, 1, 5]), meal_plan=None,
        car_parking_space=0, room_type="R", lead_time=rng.choice([0, 7, 30, None]), year=rng.choice([2017, 2018]),
        month=rng.choice([1, 2, 12]), date=rng.choice([1, 28, 29, 30, 31]), market_segment=rng.choice(["Online", "Offline"]),
        repeated_guest=rng.choice([0, 1]), previous_cancellations=0, previous_bookings_not_canceled=0,
        avg_room_price=rng.choice([Decimal("0.00"), Decimal("99.99"), Decimal("100.50"), None]), special_requests=0,
        status=rng.choice(["Canceled", "Not_Canceled", "Not_Canceled", None]),
    )


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rng = random.Random(request.param)
    data = [booking(i, rng) for i in range(300)]
    df = spark.createDataFrame([tuple(b.values()) for b in data], schemas.BOOKING)
    return data, df


def kept(data):
    return [b for b in data if b["status"] not in (None, "Canceled")]


def nights(b):
    return b["weekend_nights"] + b["week_nights"]


def arrival(b):
    try:
        return date(b["year"], b["month"], b["date"])
    except ValueError:
        return None


def rounded(value, digits):
    return float(Decimal(value).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def mean(values, digits):
    known = [Decimal(v) for v in values if v is not None]
    return rounded(sum(known) / len(known), digits) if known else None


def by_month(data):
    grouped = defaultdict(list)
    for b in data:
        grouped[b["year"], b["month"]].append(b)
    return sorted(grouped.items())


def test_enriched(case):
    data, df = case
    got = bookings.enriched(df).select("arrival_date", "total_nights", "booking_revenue", "total_guests").collect()
    assert len(got) == len(data)
    for b, r in zip(data, got):
        assert r["arrival_date"] == arrival(b)
        assert r["total_nights"] == nights(b)
        price = b["avg_room_price"]
        assert r["booking_revenue"] == (None if price is None else pytest.approx(price * nights(b)))
        assert r["total_guests"] == (None if b["n_adults"] is None else b["n_adults"] + b["n_children"])


def test_means_per_month(case):
    data, df = case
    groups = by_month(kept(data))
    assert rows(bookings.mean_nights(df)) == [(*k, mean([nights(b) for b in v], 2)) for k, v in groups]
    assert rows(bookings.mean_lead_time(df)) == [(*k, mean([b["lead_time"] for b in v], 1)) for k, v in groups]


def test_worst_cancellation_months(case):
    data, df = case
    expected = []
    for (_, month), group in by_month([b for b in data if b["year"] == 2018]):
        canceled = sum(b["status"] == "Canceled" for b in group)
        expected.append((month, len(group), canceled, rounded(Decimal(100 * canceled) / len(group), 2)))
    expected.sort(key=lambda r: (-r[3], r[0]))
    assert rows(bookings.worst_cancellation_months(df, 2018, 2)) == expected[:2]


def test_pivot(case):
    data, df = case
    given = bookings.revenue_by_segment(df, ["Offline", "Online", "Never"])
    assert given.columns == ["year", "month", "Offline", "Online", "Never"]
    assert all(r["Never"] is None for r in given.collect())
    found = bookings.revenue_by_segment(df)
    assert rows(found) == rows(given.drop("Never"))
    assert [tuple(r)[:2] for r in found.collect()] == [k for k, _ in by_month(kept(data))]


def test_top_repeat_guests(case):
    data, df = case
    sums = defaultdict(list)
    for b in kept(data):
        if b["repeated_guest"] == 1:
            price = b["avg_room_price"]
            sums[b["ID"]].append(None if price is None else round(price * nights(b), 2))
    totals = {k: sum(v for v in vs if v is not None) for k, vs in sums.items() if any(v is not None for v in vs)}
    best = sorted(totals.items(), key=lambda t: (-round(t[1], 6), t[0]))[:5]
    overall = sum(totals.values())
    got = bookings.top_repeat_guests(df, 5).collect()
    assert [r["ID"] for r in got] == [k for k, _ in best]
    for r, (_, value) in zip(got, best):
        assert r["total_guest_revenue"] == pytest.approx(value)
        assert r["revenue_share_percent"] == pytest.approx(100 * value / overall, abs=0.0051)


def test_occupancy_equals_range_join(case, spark):
    data, df = case
    days = calendar(spark, date(2017, 1, 1), date(2018, 12, 31))
    assert days.count() == 730
    got = rows(bookings.daily_occupancy(df, days, capacity=400))

    expected = []
    for offset in range(729, -1, -1):
        day = date(2017, 1, 1) + timedelta(days=offset)
        guests = 0
        for b in kept(data):
            start = arrival(b)
            if start and start <= day < start + timedelta(days=nights(b)) and b["n_adults"] is not None:
                guests += b["n_adults"] + b["n_children"]
        expected.append((day, guests, rounded(Decimal(100 * guests) / 400, 2)))
    assert got == expected

    stays = bookings.enriched(df).filter("status <> 'Canceled'")
    joined = (
        days.join(
            stays,
            (days.calendar_dt >= stays.arrival_date)
            & (days.calendar_dt < F.date_add(stays.arrival_date, stays.total_nights)),
            "left",
        )
        .groupBy("calendar_dt")
        .agg(F.sum(F.coalesce("total_guests", F.lit(0))).alias("n"))
        .orderBy(F.desc("calendar_dt"))
    )
    assert rows(joined) == [r[:2] for r in got]


def test_occupancy_of_a_calendar_that_cuts_stays(spark):
    columns = "ID string, year int, month int, date int, week_nights int, weekend_nights int, n_adults int, n_children int, avg_room_price double, status string"
    df = spark.createDataFrame(
        [
            ("before", 2016, 12, 30, 5, 0, 2, 0, 1.0, "x"),
            ("after", 2017, 1, 3, 9, 0, 1, 0, 1.0, "x"),
            ("zero", 2017, 1, 2, 0, 0, 7, 0, 1.0, "x"),
            ("bad", 2017, 2, 30, 3, 0, 9, 0, 1.0, "x"),
        ],
        columns,
    )
    got = bookings.daily_occupancy(df, calendar(spark, date(2017, 1, 1), date(2017, 1, 4)), 10)
    assert rows(got) == [
        (date(2017, 1, 4), 1, 10.0), (date(2017, 1, 3), 3, 30.0), (date(2017, 1, 2), 2, 20.0), (date(2017, 1, 1), 2, 20.0),
    ]


def test_spanning_calendar_covers_whole_years(spark):
    df = spark.createDataFrame([(date(2016, 5, 1),), (date(2017, 1, 1),), (None,)], "d date")
    days = [r[0] for r in calendar_spanning(df, "d").collect()]
    assert (min(days), max(days), len(days)) == (date(2016, 1, 1), date(2017, 12, 31), 366 + 365)
