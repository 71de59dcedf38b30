"""Top-k overall, top-k / n-th per group, and the two ways of removing duplicates.

Every order must end in a unique column so that ties at the cut are settled the same way each time.
The per-group forms filter `row_number()` by a literal: Spark then keeps at most that many rows per
group in each map task (`WindowGroupLimit`), so a group with a third of all rows costs one sort of
the task's own input and no big partition after the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    return _ranked(df, keys, order).filter(F.col(_RANK) <= k).drop(_RANK)


def nth_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The n-th row of each group; groups with fewer rows give none."""
    return _ranked(df, keys, order).filter(F.col(_RANK) == n).drop(_RANK)


def keep_first(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """One row per key: the one that comes first in the input, `sequence` telling the input order."""
    return top_k_per_group(df, keys, [F.col(sequence).asc_nulls_last()], 1)


def keep_best(df: DataFrame, keys: Sequence[str], best: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the largest `best`, a missing value counting as largest."""
    order = [F.col(best).desc_nulls_first(), *(F.col(c).asc_nulls_last() for c in tie_break)]
    return top_k_per_group(df, keys, order, 1)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
