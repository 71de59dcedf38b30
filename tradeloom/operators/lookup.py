"""Matches nested in the documents that they belong to, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.matching import join_side_keys


def lookup(docs: DataFrame, others: DataFrame, key: str, field: str, part_size: int = 1000, part: str = "part") -> DataFrame:
    """The rows of `docs` with an array `field` of the rows of `others` that have the same `key`, as structs
    of their other columns, sorted by these; an empty array where there are none (a left outer join).

    An array has at most `part_size` elements: documents with more matches come as several rows, told by the
    number in column `part`. So no row, and no task, has to hold all that belongs to one document. Keys with
    more matches than that are dealt into as many shares before they are grouped.
    """
    columns = [c for c in others.columns if c != key]
    if field in docs.columns or part in docs.columns:
        raise ValueError(f"{field} or {part} is a column of the documents already")
    # Drawn before any shuffle, so that a repeated task draws the same.
    drawn = F.xxhash64(F.monotonically_increasing_id())
    found = others.withColumn("__drawn", drawn).filter(F.col(key).isNotNull())
    counts = found.groupBy(*join_side_keys(key)).agg(F.count("*").alias("__n"))
    large = counts.filter(F.col("__n") > part_size).select(key, F.ceil(F.col("__n") / part_size).cast("int").alias("__shares"))
    spread = found.join(large, key, "left").withColumn("__shares", F.coalesce("__shares", F.lit(1)))
    spread = spread.withColumn("__share", F.pmod("__drawn", "__shares").cast("int"))
    # A share has about `part_size` rows; what is beyond goes to a further part.
    lists = spread.groupBy(key, "__shares", "__share").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("__all"))
    begins = F.sequence(F.lit(0), F.size("__all") - 1, F.lit(part_size))
    pieces = lists.select(key, "__shares", "__share", "__all", F.posexplode(begins).alias("__chunk", "__begin"))
    pieces = pieces.select(
        key,
        (F.col("__chunk") * F.col("__shares") + F.col("__share")).alias(part),
        F.slice("__all", F.col("__begin") + 1, F.lit(part_size)).alias(field),
    )
    element = F.array().cast(pieces.schema[field].dataType)
    joined = docs.join(pieces, key, "left")
    return joined.select(
        *(docs[c] if c != key else F.col(key) for c in docs.columns),
        F.coalesce(part, F.lit(0)).alias(part),
        F.coalesce(F.col(field), element).alias(field),
    )


def unwind(docs: DataFrame, field: str, keep_empty: bool = False) -> DataFrame:
    """One row per element of the array `field`, whose struct fields become columns; documents without
    elements go or, with `keep_empty`, stay as one row of NULL fields."""
    explode = F.explode_outer if keep_empty else F.explode
    others = [F.col(f"`{c}`") for c in docs.columns if c != field]
    return docs.select(*others, explode(field).alias("__element")).select(*others, "__element.*")
