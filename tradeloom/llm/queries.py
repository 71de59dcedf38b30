"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import (
    chat,
    decontam,
    katz,
    langid,
    neardup,
    ngram_join,
    packing,
    quality,
    spelling,
    substring,
    urls,
    vector_codes,
    warc,
)
from tradeloom.llm.sql import STATEMENTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Rules of the URL filter: verdict, host, path prefix.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
TRAIN_QUALITY, TRAIN_LANGUAGE, TRAIN_MODEL = (4, 2), (5, 0), (10, 0)


def _query(build):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _held_out(fold: tuple[int, int]):
    folds, own = fold
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == own, F.lit(False))


def tokenizer() -> dict:
    """Where the public tokenizer's files are."""
    import public_tokenizers

    return {
        "path": str(public_tokenizers.path("byte_bpe_50k.json")),
        "ranks": str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        "pattern": public_tokenizers.PATTERN,
    }


def language_model(docs: DataFrame):
    """The languages and the model learned from the training fold."""
    return langid.learn_languages(docs.filter(~_held_out(TRAIN_LANGUAGE)))


@_query
def op1_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(~_held_out(TRAIN_QUALITY))
    scored = quality.score_quality(docs, quality.learn_quality(docs, labels))
    return scored.select(
        "doc_id", _held_out(TRAIN_QUALITY).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@_query
def op2_substring_dedup(spark, folder):
    found = substring.cut_repeated_windows(table(spark, folder, "documents"), width=50, with_text=False)
    return found.drop("kept")


@_query
def op3_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages"), min_bytes=0).drop("url")


@_query
def op4_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, language_model(docs))
    return found.select("doc_id", _held_out(TRAIN_LANGUAGE).alias("held_out"), "lang_pred", "score")


@_query
def op5_chat_format(spark, folder):
    return chat.format_conversations(table(spark, folder, "conversations"))


@_query
def op6_decontamination(spark, folder):
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query
def op7_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), tokenizer())


@_query
def op8_ngram_jaccard_join(spark, folder):
    return ngram_join.near_duplicate_groups(table(spark, folder, "documents"))


@_query
def op9_url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@_query
def op10_embedding_neardup(spark, folder):
    return neardup.near_duplicate_vectors(table(spark, folder, "embeddings"))


@_query
def op11_vector_codes(spark, folder):
    return vector_codes.encode_vectors(table(spark, folder, "embeddings"))


@_query
def op12_spelling_variants(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"), misspelt_one_in=199)


@_query
def op13_lm_scoring(spark, folder):
    return katz.score_texts(table(spark, folder, "documents"), ~_held_out(TRAIN_MODEL))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
