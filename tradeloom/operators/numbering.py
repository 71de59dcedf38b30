"""Surrogate keys for new dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Members are spread over 4096 buckets by a digest of their name (three hexadecimal digits).
BUCKET_DIGITS = 3
_DIGITS = "0123456789abcdef"


def number_members(
    fresh: DataFrame,
    existing: DataFrame,
    names: Sequence[str],
    within: Sequence[str] = (),
    id_column: str = "id",
) -> DataFrame:
    """Give each row of `fresh` an id above the largest in `existing`, without gaps.

    `fresh` holds distinct members that `existing` lacks; with `within`, every combination of those
    columns is numbered on its own. Ids depend on the member names only, so a repeated or recomputed
    run gives the same ids, and members that have an id keep it.

    Numbering is in levels, so that no task sees all members: each bucket counts its own, a running total
    says where it starts among the buckets with the same first digit, and 16 sums say where these start.

    The windows are cut by one column made of `within`. A plan that looks members up by one value of these
    columns after the other then shares the pass that found them: a filter on the columns themselves would
    move below the windows, down to the rows the members come from, and every lookup would read these anew.
    """
    keys = list(within)
    digest = F.md5(F.concat_ws("|", *names))
    spread = fresh.withColumn("__bucket", F.left(digest, F.lit(BUCKET_DIGITS)))
    group = [F.struct(*keys)] if keys else []

    sizes = spread.groupBy(*keys, "__bucket").agg(F.count("*").alias("__size"))
    together = group
    if not keys:
        sizes = sizes.withColumn("__digit", F.left("__bucket", F.lit(1)))
        together = ["__digit"]
    earlier = Window.partitionBy(*together).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("__size").over(earlier), F.lit(0))
    if not keys:
        before = [F.sum(F.when(F.col("__digit") < digit, F.col("__size")).otherwise(0)) for digit in _DIGITS]
        start += F.get(sizes.agg(F.array(*before)).scalar(), F.conv("__digit", 16, 10).cast("int"))
    starts = sizes.select(*keys, "__bucket", start.alias("__start"))

    in_bucket = Window.partitionBy(*group, "__bucket").orderBy(*names)
    numbered = spread.withColumn("__position", F.row_number().over(in_bucket)).join(
        starts, [*keys, "__bucket"]
    )

    if keys:
        highest = existing.groupBy(*keys).agg(F.max(id_column).alias("__highest"))
        numbered = numbered.join(highest, keys, "left")
        base = F.col("__highest")
    else:
        base = existing.agg(F.max(id_column)).scalar()
    new_id = F.coalesce(base, F.lit(0)) + F.col("__start") + F.col("__position")
    return numbered.select(*keys, new_id.cast("bigint").alias(id_column), *names)
