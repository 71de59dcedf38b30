"""Generated date tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: date, end: date, column: str = "calendar_dt") -> DataFrame:
    """Every day from `start` to `end`, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias(column))


def calendar_spanning(df: DataFrame, day: str, column: str = "calendar_dt") -> DataFrame:
    """Every day of the calendar years that the dates in `df` fall into."""
    first = F.trunc(F.min(day), "year")
    last = F.date_add(F.add_months(F.trunc(F.max(day), "year"), 12), -1)
    bounds = df.agg(first.alias("first"), last.alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias(column))
