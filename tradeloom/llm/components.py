"""Connected components of a graph given as a table of edges.

Randomised contraction: in every round each node moves to the neighbour (or itself) with the smallest
priority, edges between moved nodes are kept once, and what is left shrinks by a constant factor, so
that the number of rounds grows with the logarithm of the graph whatever its shape (Bögeholz, Brand,
Todor: In-database connected component analysis, 2020). The first round uses the ids themselves as
priorities, which folds stars around a smallest id at once. Edges, moves and labels stay in tables; the
driver only learns whether any edge is left. Nothing is collected per node: a hub with a third of all
edges is one partial row per task in the aggregation, and the joins' hot partitions can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.scratch import drop, save
from tradeloom.operators.matching import join_side_keys


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller id first; loops and edges with a missing end go."""
    return (
        edges.filter("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _priority(node: Column, turn: int) -> Column:
    return F.xxhash64(node, F.lit(turn)) if turn else node


def _moves(edges: DataFrame, turn: int) -> DataFrame:
    """(node, rep): the member of each node's closed neighbourhood with the smallest priority."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    nearest = ends.groupBy(*join_side_keys("node")).agg(
        F.min_by("other", _priority(F.col("other"), turn)).alias("other")
    )
    stays = _priority(F.col("node"), turn) <= _priority(F.col("other"), turn)
    return nearest.select("node", F.when(stays, F.col("node")).otherwise(F.col("other")).alias("rep"))


def _moved(edges: DataFrame, column: str, moves: DataFrame) -> DataFrame:
    target = moves.select(F.col("node").alias(column), F.col("rep").alias("__rep"))
    return edges.join(target, column, "left").withColumn(column, F.coalesce("__rep", column)).drop("__rep")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b), component being its smallest reachable id.

    Edges are undirected and may repeat. Loops and edges with a NULL end join nothing and give no row.
    An empty table gives an empty result. The result is a stored table.
    """
    spark = edges.sparkSession
    current, path = save(_ordered(edges), "edges")
    paths: list[str] = []
    labels, turn = None, 0
    while not current.isEmpty():
        moves, moves_path = save(_moves(current, turn), "moves")
        step = moves.select("node", "rep") if labels is None else _moved(labels, "rep", moves)
        contracted = _ordered(_moved(_moved(current, "a", moves), "b", moves))
        following, following_path = save(contracted, "edges")
        labels, labels_path = save(step, "labels")
        drop(spark, path, moves_path, *paths)
        current, path, paths = following, following_path, [labels_path]
        turn += 1
    drop(spark, path)
    if labels is None:
        return spark.createDataFrame([], "node bigint, component bigint")
    smallest = labels.groupBy(*join_side_keys("rep")).agg(F.min("node").alias("component"))
    found, _ = save(labels.join(smallest.select("rep", "component"), "rep").select("node", "component"), "components")
    drop(spark, *paths)
    return found
