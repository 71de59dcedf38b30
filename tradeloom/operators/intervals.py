"""Joining rows whose intervals overlap.

A comparison of starts and ends gives Spark no key to join on, so that it would compare all rows with all
rows. Here both sides are cut into bins of the axis and meet by bin. Bins come in levels, each `FACTOR`
times as wide as the one below, and a last one that is the whole axis. An interval's own level is the first
whose bins are as wide as it is, so it lies in two bins of it at most, however long or unbounded it is; it
shows up there and on the coarser levels. Two intervals are compared on the coarser of their own levels, in
the bin in which the later one starts, which is one place for each pair. Rows that are both finer than a
level do not meet there: the key holds which of the two sides is at home on the level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

FACTOR = 16


def _position(df: DataFrame, column: str) -> Column:
    """Whole numbers in the order of the values: days of dates, microseconds of timestamps."""
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    return F.col(column).cast("bigint")


_AT_HOME, _VISITING = 1, 2


def _entries(df: DataFrame, start: str, end: str | None, widths: Sequence[int], side: str) -> DataFrame:
    """The rows once per bin that they lie in, with (level, bin, role) to join on, and their limits.

    A left row at home on a level meets all right rows there (role 1), one that is finer than the level
    those at home (role 2). NULL limits are unbounded; empty intervals have no entry. Without `end` the
    values are points.
    """
    first, last, own = f"__{side}_first", f"__{side}_last", f"__{side}_own"
    begin = _position(df, start)
    placed = df.withColumns({first: begin, last: F.try_subtract(_position(df, end), F.lit(1)) if end else begin})
    if not end:
        placed = placed.filter(F.col(first).isNotNull())
    placed = placed.filter(F.coalesce(F.col(first) <= F.col(last), F.lit(True)))
    level = F.lit(len(widths))
    for k in reversed(range(len(widths))):
        fits = F.coalesce(F.try_subtract(F.col(last), F.col(first)) < widths[k], F.lit(False))
        level = F.when(fits, k).otherwise(level)
    placed = placed.withColumn(own, level)

    def roles(k: int) -> list[tuple[Column, int]]:
        home, visits = F.col(own) == k, F.col(own) < k
        if side == "left":
            return [(home, _AT_HOME), (visits, _VISITING)]
        return [(home | visits, _AT_HOME), (home, _VISITING)]

    entry = lambda k, place, role: F.struct(
        F.lit(k).alias("__level"), place.alias("__bin"), F.lit(role).alias("__role")
    )
    at = lambda k, role: lambda place: entry(k, place, role)
    none = F.array().cast("array<struct<__level:int,__bin:bigint,__role:int>>")
    entries = []
    for k, width in enumerate(widths):
        bins = F.sequence(_bin(F.col(first), width), _bin(F.col(last), width))
        for there, role in roles(k):
            entries.append(F.when(there, F.transform(bins, at(k, role))).otherwise(none))
    for there, role in roles(len(widths)):
        whole = F.array(entry(len(widths), F.lit(0).cast("bigint"), role))
        entries.append(F.when(there, whole).otherwise(none))
    spread = placed.withColumn("__entry", F.explode(F.concat(*entries)))
    return spread.select(*df.columns, first, last, "__entry.*")


def _bin(position: Column, width: int) -> Column:
    """Number of the bin, in whole numbers: bins count downwards below zero."""
    return F.call_function("div", position - F.pmod(position, F.lit(width)), F.lit(width).cast("bigint"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str | None],
    right_span: tuple[str, str | None],
    width: int,
    levels: int = 4,
    left_key: Sequence[str] = (),
) -> DataFrame:
    """Pairs of rows whose half-open intervals share a point: all columns of both sides.

    A span names the columns with the first point and with the end, which is not part of it; without an end
    the column holds single points, of which NULL is none. Columns are whole numbers, dates or timestamps,
    the same on both sides. A NULL limit is unbounded; an interval that ends before or where it starts is
    empty and meets nothing. `width` is that of the finest bins, in days for dates and in microseconds for
    timestamps: best about the length of the shorter intervals. `levels` counts the widths of bins below
    the whole axis.

    With `left_key`, columns that tell left rows apart, left rows that meet nothing are kept, with NULL in
    the columns of the right side.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    widths = [width * FACTOR**k for k in range(levels)]
    one, two = _entries(left, *left_span, widths, "left"), _entries(right, *right_span, widths, "right")
    starts = F.greatest("__left_first", "__right_first")
    meets = F.coalesce(F.col("__left_first") <= F.col("__right_last"), F.lit(True))
    meets &= F.coalesce(F.col("__right_first") <= F.col("__left_last"), F.lit(True))
    of_bin = F.lit(True)
    for k, w in enumerate(widths):
        of_bin = F.when(F.col("__level") == k, _bin(starts, w) == F.col("__bin")).otherwise(of_bin)
    pairs = one.join(two, ["__level", "__bin", "__role"]).filter(meets & of_bin).select(*left.columns, *right.columns)
    if not left_key:
        return pairs
    met = pairs.select(*left_key).distinct()
    return pairs.unionByName(left.join(met, list(left_key), "left_anti"), allowMissingColumns=True)
