"""Questions about hotel bookings and the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.constants import CANCELED
from tradeloom.functions import date_from_parts, percent_of, rounded_mean
from tradeloom.operators.intervals import interval_join
from tradeloom.operators.ranking import top_k


def enriched(bookings: DataFrame) -> DataFrame:
    """Add arrival date, nights, revenue and guests. A date that does not exist is NULL."""
    nights = F.col("week_nights") + F.col("weekend_nights")
    return bookings.withColumns(
        {
            "arrival_date": date_from_parts(F.col("year"), F.col("month"), F.col("date")),
            "total_nights": nights,
            "booking_revenue": F.col("avg_room_price") * nights,
            "total_guests": F.col("n_adults") + F.col("n_children"),
        }
    )


def _kept(bookings: DataFrame) -> DataFrame:
    """Bookings not canceled; one without a status counts as neither."""
    return bookings.filter(F.col("status") != CANCELED)


def _year_and_month() -> list[Column]:
    return [F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first()]


def mean_nights(bookings: DataFrame) -> DataFrame:
    stays = _kept(enriched(bookings))
    mean = rounded_mean(stays, "total_nights", 2).alias("avg_nights")
    return stays.groupBy("year", "month").agg(mean).orderBy(*_year_and_month())


def mean_lead_time(bookings: DataFrame) -> DataFrame:
    stays = _kept(bookings)
    mean = rounded_mean(stays, "lead_time", 1).alias("avg_lead_time_days")
    return stays.groupBy("year", "month").agg(mean).orderBy(*_year_and_month())


def worst_cancellation_months(bookings: DataFrame, year: int, k: int = 3) -> DataFrame:
    """The `k` months of `year` with the highest rounded cancellation rate; ties by month."""
    counted = (
        bookings.filter(F.col("year") == year)
        .groupBy("month")
        .agg(
            F.count("*").alias("total_bookings"),
            F.count_if(F.col("status") == CANCELED).alias("canceled_bookings"),
        )
    )
    rate = percent_of(F.col("canceled_bookings"), F.col("total_bookings"))
    return top_k(
        counted.withColumn("cancellation_rate_percent", rate),
        [F.col("cancellation_rate_percent").desc_nulls_last(), F.col("month").asc()],
        k,
    )


def revenue_by_segment(bookings: DataFrame, segments: Sequence[str] | None = None) -> DataFrame:
    """Mean booking revenue per month, one column per market segment.

    With `segments` given the columns are fixed and Spark need not look for the values first.
    """
    stays = _kept(enriched(bookings))
    return (
        stays.groupBy("year", "month")
        .pivot("market_segment", list(segments) if segments else None)
        .agg(rounded_mean(stays, "booking_revenue", 2))
        .orderBy(*_year_and_month())
    )


def top_repeat_guests(bookings: DataFrame, k: int = 5) -> DataFrame:
    """The `k` repeat guests with most revenue and their share in the revenue of all repeat guests.

    A booking's revenue is rounded before it is summed. The overall sum is a scalar subquery over the
    sums per guest, whose shuffle it shares.
    """
    repeat = _kept(enriched(bookings)).filter(F.col("repeated_guest") == 1)
    amounts = repeat.select("ID", F.round("booking_revenue", 2).alias("amount"))
    per_guest = amounts.groupBy("ID").agg(F.sum("amount").alias("total_guest_revenue"))
    overall = per_guest.agg(F.sum("total_guest_revenue")).scalar()
    order = [F.col("total_guest_revenue").desc_nulls_last(), F.col("ID").asc()]
    share = percent_of(F.col("total_guest_revenue"), overall)
    return (
        top_k(per_guest, order, k)
        .withColumn("revenue_share_percent", share)
        .orderBy(*order)
    )


def daily_occupancy(bookings: DataFrame, calendar: DataFrame, capacity: int = 400) -> DataFrame:
    """Guests in the house on every day of `calendar` (column `calendar_dt`, one row per day).

    A stay covers its arrival day up to the day before departure. Instead of matching days with stays
    each stay adds its guests on arrival and takes them away on departure; summed per date, the
    running total is the number of guests. That is one aggregation over twice the bookings, whatever
    the length of the stays. The running total is the only step in a single task, over one row per
    date that occurs.
    """
    stays = (
        _kept(enriched(bookings))
        .filter(F.col("arrival_date").isNotNull() & (F.col("total_nights") > 0))
        .select("arrival_date", "total_nights", F.coalesce("total_guests", F.lit(0)).alias("guests"))
    )
    departure = F.date_add("arrival_date", F.col("total_nights"))
    change = F.explode(
        F.array(
            F.struct(F.col("arrival_date").alias("day"), F.col("guests").alias("guests")),
            F.struct(departure.alias("day"), (-F.col("guests")).alias("guests")),
        )
    )
    changes = stays.select(change.alias("change")).select("change.*", F.lit(False).alias("wanted"))
    days = calendar.select(
        F.col("calendar_dt").alias("day"), F.lit(0).alias("guests"), F.lit(True).alias("wanted")
    )
    per_day = (
        changes.unionByName(days)
        .groupBy("day")
        .agg(F.sum("guests").alias("guests"), F.bool_or("wanted").alias("wanted"))
    )
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_day.withColumn("total_guests_on_day", F.sum("guests").over(running))
        .filter("wanted")
        .select(
            F.col("day").alias("calendar_dt"),
            "total_guests_on_day",
            percent_of(F.col("total_guests_on_day"), F.lit(capacity)).alias("occupancy_percent"),
        )
        .orderBy(F.col("calendar_dt").desc())
    )


def stays_in_house(bookings: DataFrame, calendar: DataFrame, width: int = 8) -> DataFrame:
    """What kind of stays are in the house on every day of `calendar` (column `calendar_dt`): number of
    stays, longest and mean length, room types and guests who have been before; zeros and NULLs on days
    without any.

    Unlike the number of guests these cannot be told from arrivals and departures alone: every day meets
    the stays that cover it, in bins of `width` days, and what is shuffled for the days are sums.
    """
    stays = (
        _kept(enriched(bookings))
        .filter(F.col("arrival_date").isNotNull() & (F.col("total_nights") > 0))
        .select(
            "arrival_date", F.date_add("arrival_date", F.col("total_nights")).alias("departure_date"),
            "total_nights", "room_type", "repeated_guest",
        )
    )
    days = calendar.select("calendar_dt")
    met = interval_join(
        days, stays, ("calendar_dt", None), ("arrival_date", "departure_date"), width, levels=2, left_key=["calendar_dt"]
    )
    return (
        met.groupBy("calendar_dt")
        .agg(
            F.count("arrival_date").alias("stays"),
            F.max("total_nights").alias("longest_stay"),
            rounded_mean(met, "total_nights", 2).alias("avg_nights"),
            F.count_distinct("room_type").alias("room_types"),
            F.count_if(F.col("repeated_guest") == 1).alias("repeat_guests"),
        )
        .orderBy("calendar_dt")
    )
