"""Matching rows against other tables: id lookup, new rows, orphans.

No join here carries a `broadcast` hint. Spark broadcasts a side only while its size, estimated or
measured after the shuffle, is below `spark.sql.autoBroadcastJoinThreshold`; beyond that both sides
are shuffled and adaptive execution splits a partition that a hot key made too big. It can do that
only where both sides come straight from a shuffle; `join_side_keys` sees to it for aggregated sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# A key of a lookup with few keys is dealt into this many shares.
LOOKUP_SHARES = 256


def join_side_keys(*keys: str) -> list[Column]:
    """Grouping columns for a table that is aggregated by `keys` and then joined on them to a table in
    which a key may be hot.

    The hash column changes no group, only the partitioning: after grouping by the keys alone the join
    would read the result as it lies, and Spark could not split the other side's hot partition. The
    price is one more shuffle of the aggregated side, the smaller one.
    """
    return [*(F.col(k) for k in keys), F.xxhash64(*keys).alias("__key_hash")]


def resolve_id(
    df: DataFrame, column: str, lookup: DataFrame, name: str, id_column: str, default: int | None = None
) -> DataFrame:
    """Add `id_column`: the lookup's `id` for the value in `column`, `default` where there is none.

    `lookup` has one row per `name`.
    """
    ids = lookup.select(F.col(name).alias(column), F.col("id").alias(id_column))
    found = df.join(ids, column, "left")
    if default is None:
        return found
    return found.withColumn(id_column, F.coalesce(id_column, F.lit(default).cast("bigint")))


def join_few(df: DataFrame, lookup: DataFrame, key: str, spread_by: str, shares: int = LOOKUP_SHARES) -> DataFrame:
    """Left join of a large table with a lookup of few keys, one row per key.

    Shuffled by the key alone, all rows would go to as many tasks as there are keys, and adaptive execution
    does not broadcast a lookup that leaves most partitions empty. The rows of a key are dealt into `shares`
    by a hash of `spread_by`, and the lookup is repeated for each share.
    """
    share = "__share"
    dealt = lookup.withColumn(share, F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    by_share = df.withColumn(share, F.pmod(F.xxhash64(spread_by), F.lit(shares)).cast("int"))
    return by_share.join(dealt, [key, share], "left").drop(share)


def new_rows(
    incoming: DataFrame,
    existing: DataFrame | Sequence[DataFrame],
    keys: Sequence[str],
    arrived: DataFrame | None = None,
) -> DataFrame:
    """Rows of `incoming` whose key is not in `existing` yet: appending them is safe to repeat.

    A list of tables that are laid out by key (see `sources.key_index`) is matched as it lies, one after the
    other: the incoming rows are shuffled once, into the tables' buckets, and the history not at all.

    `arrived`, any table with all keys of `incoming`, is for an `existing` that is a long history, which is
    then narrowed down to these keys first. While they are few enough to be broadcast, the history is
    filtered where it is read and not shuffled; an anti join alone would shuffle its keys on every load.
    Beyond that size both sides are shuffled by key.
    """
    if not isinstance(existing, DataFrame):
        for known in existing:
            incoming = incoming.join(known.select(*keys), list(keys), "left_anti")
        return incoming
    known = existing.select(*keys)
    if arrived is not None:
        met = arrived.groupBy(*join_side_keys(*keys)).agg(F.lit(True).alias("__met")).select(*keys)
        known = known.join(met, list(keys), "left_semi")
    return incoming.join(known, list(keys), "left_anti")


def flag_parent(df: DataFrame, parent: DataFrame, key: str, flag: str) -> DataFrame:
    """Add boolean `flag`: does `key` exist in `parent`? A missing key has no parent."""
    known = (
        parent.filter(F.col(key).isNotNull())
        .groupBy(*join_side_keys(key))
        .agg(F.lit(True).alias(flag))
        .select(key, flag)
    )
    return df.join(known, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def reject_orphans(
    df: DataFrame, parent: DataFrame, key: str, seen: Observation | None = None
) -> DataFrame:
    """Rows with a parent. `seen` receives `kept` and `dropped` from the same pass that uses them.

    Spark may count a row twice in `seen` if it has to repeat a lost task, so the counts are for logs.
    """
    if seen is None:
        return df.join(parent.select(key), key, "left_semi").select(*df.columns)
    flag = "__has_parent"
    flagged = flag_parent(df, parent, key, flag).observe(
        seen,
        F.count_if(F.col(flag)).alias("kept"),
        F.count_if(~F.col(flag)).alias("dropped"),
    )
    return flagged.filter(flag).select(*df.columns)
