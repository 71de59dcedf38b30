"""Exact distinct counts that can be added up, as bitmaps.

A plain distinct count of a day says nothing about the week: the same customer may be in several days.
Here each day keeps the set of its ids as bitmaps, one for each stretch of 32768 ids, and the set of a
longer period is the union of its days' sets. The stored table is small, new days are appended, and any
period or share of it is counted without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, by: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(by..., id_column, bucket, ids): for each group and each column of whole numbers `ids` its distinct
    values, NULL left out. One pass: the columns are unpivoted, and bitmaps are built before the shuffle."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("id_column"), F.col(c).cast("bigint").alias("id")) for c in ids]))
    rows = df.select(*by, values.alias("__value")).select(*by, "__value.*").filter("id IS NOT NULL")
    return rows.groupBy(*by, "id_column", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids")
    )


def counts_of_bitmaps(bitmaps: DataFrame, by: Sequence[Column], ids: Sequence[str]) -> DataFrame:
    """Distinct values of each id column in groups of whatever the stored groups add up to: a column for
    each of `ids`, 0 where a group has none."""
    keys = [f"__by{k}" for k in range(len(by))]
    keyed = bitmaps.select(*(c.alias(k) for c, k in zip(by, keys)), "id_column", "bucket", "ids")
    unions = keyed.groupBy(*keys, "id_column", "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("id_column") == c, F.bitmap_count("ids"))), F.lit(0)).alias(c) for c in ids
    ]
    return unions.groupBy(*keys).agg(*sums)
