"""Integrity checks that stand in for the constraints a database would enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_column: str = "n_rows") -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_column)).filter(F.col(count_column) > 1)


def missing_parents(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None, count_column: str = "n_rows"
) -> DataFrame:
    """Foreign key values without a parent row, with the number of child rows holding each.

    Child rows are counted per key first, so a hot key reaches the join as a single row. A NULL key
    refers to nothing and is no violation.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(count_column))
    known = parent.select(F.col(parent_key or key).alias(key))
    return used.join(known, key, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_nulls) of all `columns` from one pass."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], list(columns), "column_name", "n_nulls")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULL with the column's default, keeping the column type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.coalesce(c, F.lit(v).cast(types[c])) for c, v in defaults.items()})


def report_status(reports: Mapping[str, DataFrame]) -> DataFrame:
    """(report, n_rows, ok): how many rows each report has, and whether it has any."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
        for name, df in reports.items()
    ]
    return reduce(DataFrame.unionByName, counted).withColumn("ok", F.col("n_rows") > 0)
