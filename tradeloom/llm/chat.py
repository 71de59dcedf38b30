"""Chat formatting of logged conversations, after cumulative snapshots are collapsed.

Logs often hold a conversation many times, each time with some more turns. Rolling hashes over the turns
identify every prefix of every conversation; a conversation whose whole hash is a proper prefix of another
one goes, and of equal ones that with the smallest id stays. What is left is rendered.

Only built-in functions are used. A turn's hash covers its place, role and text, and a prefix's hash is
the running exclusive-or of its turns' hashes (two of 64 bits), so partial aggregation and chunks of
turns can be combined in any order: no task needs all turns of a long conversation at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 256

_HASHES = ("hash_a", "hash_b")


def _ordinals(turns: DataFrame) -> DataFrame:
    """`turns` with `place`, each turn's number from 1 in its conversation.

    Turns are numbered within chunks of turn numbers; the chunks' sizes are then added up, one row per
    chunk, so that a conversation with a large share of all rows is spread over many tasks.
    """
    turns = turns.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(1 << 62)))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_last(), *_HASHES)
    sizes = turns.groupBy("conv_id", "chunk").agg(F.count("*").alias("size"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        F.col("conv_id").alias("c"), F.col("chunk").alias("k"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")
    )
    numbered = turns.withColumn("inside", F.row_number().over(inside))
    joined = numbered.join(bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    return joined.withColumn("place", F.col("base") + F.col("inside")).drop("c", "k", "base", "inside")


def _prefixes(turns: DataFrame) -> DataFrame:
    """`conv_id`, `place` and the hashes of the conversation's first `place` turns."""
    hashed = turns.select(
        "conv_id", "chunk", "place", *(F.xxhash64("place", h).alias(h) for h in _HASHES)
    )
    totals = hashed.groupBy("conv_id", "chunk").agg(*(F.bit_xor(h).alias(h) for h in _HASHES))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("conv_id").alias("c"), F.col("chunk").alias("k"),
        *(F.coalesce(F.bit_xor(h).over(before), F.lit(0)).alias(f"base_{h}") for h in _HASHES),
    )
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select("conv_id", "chunk", "place", *(F.bit_xor(h).over(so_far).alias(h) for h in _HASHES))
    joined = running.join(bases, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    return joined.select("conv_id", "place", *(F.col(h).bitwiseXOR(F.col(f"base_{h}")).alias(h) for h in _HASHES))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no prefix of a longer one, one of equal ones."""
    prefixes = _prefixes(_ordinals(turns))
    ends = prefixes.groupBy("conv_id").agg(
        F.max("place").alias("n_turns"), *(F.max_by(h, "place").alias(h) for h in _HASHES)
    )
    whole = ends.select("conv_id", "n_turns")
    inner = (
        prefixes.join(whole, prefixes.conv_id.eqNullSafe(whole.conv_id))
        .filter(F.col("place") < F.col("n_turns"))
        .select(F.col("place").alias("n_turns"), *_HASHES)
        .distinct()
    )
    # One conversation per sequence of turns first: then no key is hot on either side of the anti-join.
    distinct = ends.groupBy("n_turns", *_HASHES).agg(F.min("conv_id").alias("conv_id"))
    return distinct.join(inner, ["n_turns", *_HASHES], "left_anti").select("conv_id", "n_turns")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def format_conversations(turns: DataFrame, part_turns: int = 512) -> DataFrame:
    """One row per part of each conversation that stays: conv_id, part, n_turns, text.

    `turns` has conv_id, turn, role, text. A conversation is its turns by turn number; equal rows count
    once, rows that share a number come in the order of a hash of role and text, rows without a number
    last. NULL roles are `unknown`, NULL texts empty. Rows without conv_id are one conversation of their
    own. Other columns are not read.

    A conversation whose turns (roles and texts, in order) begin a longer one goes; of equal ones that
    with the smallest conv_id stays. The text of a part renders `part_turns` turns, so that a
    conversation of any length is split into rows of bounded size; most have part 0 only. n_turns is the
    conversation's.
    """
    known = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({"hash_a": F.xxhash64("role", "text"), "hash_b": F.xxhash64(F.lit(1), "text", "role")})
    narrow = known.select("conv_id", "turn", *_HASHES).distinct()
    kept = maximal_conversations(narrow).withColumnRenamed("conv_id", "kept_id")
    rows = known.dropDuplicates(["conv_id", "turn", *_HASHES])
    rows = rows.join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id"))).drop("kept_id")
    placed = _ordinals(rows).withColumn("part", F.floor((F.col("place") - 1) / part_turns))
    pieces = F.sort_array(F.collect_list(F.struct("place", _rendered(F.col("role"), F.col("text")).alias("piece"))))
    return placed.groupBy("conv_id", "part", "n_turns").agg(
        F.array_join(F.transform(pieces, lambda x: x["piece"]), "").alias("text")
    )
