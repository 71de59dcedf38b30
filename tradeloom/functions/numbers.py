"""Money and ratios. Rounding is half away from zero throughout."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType


def decimal_from_text(text: Column) -> Column:
    """`12,5` or `12.50` as decimal(10,2); text that is no number is NULL.

    A number that does not fit fails the query (ANSI mode, Spark's default), as a database's column would.
    """
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("decimal(38,10)").cast("decimal(10,2)")


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    """`part` in percent of `whole`, NULL for an empty whole. One division, so one rounding."""
    return F.round(F.try_divide(part * 100, whole), digits)


def rounded_mean(df: DataFrame, column: str, digits: int = 2) -> Column:
    """Aggregate: mean rounded to `digits`.

    The mean of a decimal is kept to ten more digits before it is rounded: Spark's own `avg` stops at
    four more, which on large groups can round a value just under half a cent up twice.
    """
    kind = df.schema[column].dataType
    if not isinstance(kind, DecimalType):
        return F.round(F.avg(column), digits)
    return mean_of_sums(F.sum(column), F.count(column), kind, digits)


def mean_of_sums(total: Column, count: Column, kind: DataType, digits: int = 2) -> Column:
    """A mean, rounded to `digits`, from a total of values of type `kind` and their number."""
    if not isinstance(kind, DecimalType):
        return F.round(F.try_divide(total, count), digits)
    total = total.cast(DecimalType(24, kind.scale))
    return F.round(F.try_divide(total, count.cast("decimal(14,0)")), digits)


def summed_product(df: DataFrame, quantity: str, price: str) -> Column:
    """Aggregate: exact sum of `quantity * price`; rows where either is missing do not count.

    Whole quantities and prices in cents, the usual case, are summed as two integers, whole units and
    remaining cents, which is nearly twice as fast as a sum of wide decimals. An integer sum holds up
    to 9e18 units; beyond that the query fails (ANSI mode, Spark's default).
    """
    kind = df.schema[price].dataType
    in_cents = isinstance(kind, DecimalType) and kind.scale == 2 and kind.precision <= 15
    if not (in_cents and isinstance(df.schema[quantity].dataType, IntegralType)):
        return F.sum(F.col(quantity) * F.col(price))
    count = F.col(quantity).cast("bigint")
    units = F.col(price).cast("bigint")
    cents = (F.col(price) * 100).cast("bigint") - units * 100
    whole = F.sum(count * units).cast("decimal(19,0)")
    rest = F.sum(count * cents).cast("decimal(19,0)")
    return (whole + rest * F.lit(Decimal("0.01"))).cast("decimal(24,2)")
