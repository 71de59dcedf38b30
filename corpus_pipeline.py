"""A training corpus from raw documents: five stages, each one's result the next one's input.

Language ID, near-duplicate groups, repeated passages, benchmark leaks, packing. The first four return
the columns of `documents`, the last one the packed pieces. Rows are judged one by one: stages tell them
apart by their place in the table they read, as ids may be missing or repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import decontam, langid, ngram_join, packing, substring
from tradeloom.llm.queries import language_model, table, tokenizer
from tradeloom.llm.scratch import drop, new_path, save
from tradeloom.operators.matching import join_side_keys

#: SQL cannot express the learned, tokenising and template stages; tests hold every stage against brute force.
ORACLE_SQL = None

_ROW = "__row_of_documents"


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number in front, the same whenever the stored table is read."""
    return docs.select(F.monotonically_increasing_id().alias(_ROW), "*")


def _without(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    """The rows whose numbers are not in `gone`, which is stored first: Spark knows its size then, and
    shuffles the texts only if it is beyond its broadcast threshold."""
    gone, _ = save(gone.groupBy(*join_side_keys(_ROW)).agg(F.lit(1).alias("__n")).select(_ROW), label)
    return _numbered(docs).join(gone, _ROW, "left_anti").drop(_ROW)


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the model knows; texts that are NULL or have no letter go, rows
    without id are judged like others."""
    return langid.in_known_language(docs, language_model(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id (the first one of equal ids, one
    without id only if none has any); rows in no group stay."""
    rows = _numbered(docs)
    groups = ngram_join.near_duplicate_groups(rows.select(F.col(_ROW).alias("doc_id"), "text"))
    linked = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(_ROW), F.col("component_id").alias("group"))
    linked, path = save(linked, "linked-rows")
    members = linked.unionAll(linked.select(F.col("group").alias(_ROW), "group").distinct())
    known = rows.select(_ROW, "doc_id").join(members, _ROW)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", _ROW))
    firsts = known.groupBy(*join_side_keys("group")).agg(best.alias("best")).select("group", F.col(f"best.{_ROW}").alias("first"))
    kept = _without(docs, members.join(firsts, "group").filter(F.col(_ROW) != F.col("first")).select(_ROW), "repeated-rows")
    drop(spark, path)
    return kept


def passages_cut(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the 50-word passages of earlier ones; unchanged documents keep their spacing,
    those of which nothing is left go."""
    cut = substring.without_repeated_windows(docs, width=50).filter("n_removed = 0 OR text <> ''")
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).drop("n_removed")


def no_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    texts = _numbered(docs).select(F.col(_ROW).alias("doc_id"), "text")
    found = decontam.contaminated(texts, table(spark, folder, "benchmark"))
    return _without(docs, found.select(F.col("doc_id").alias(_ROW)), "leaked-rows")


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", passages_cut),
    ("decontamination", no_leaks),
    ("packing", packed),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs, before = table(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, folder)
