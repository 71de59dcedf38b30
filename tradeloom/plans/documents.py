"""Finds and aggregations over document collections (nested structs and arrays)."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tradeloom.constants import NO_TITLE, NO_YEAR
from tradeloom.functions import title_with_year
from tradeloom.functions.criteria import matches
from tradeloom.operators.lookup import lookup
from tradeloom.operators.ranking import top_k


def find(docs: DataFrame, criteria: Mapping[str, object]) -> DataFrame:
    """Whole documents that match a filter document (see `functions.criteria`)."""
    return docs.filter(matches(docs.schema, criteria))


def find_one(docs: DataFrame, criteria: Mapping[str, object], order_by: str = "_id") -> DataFrame:
    """The first matching document by `order_by`, or no row."""
    return top_k(find(docs, criteria), [F.col(order_by).asc()], 1)


def count_first_genre(movies: DataFrame, genre: str) -> DataFrame:
    return find(movies, {"genres.0": genre}).agg(F.count("*").alias("n_movies"))


def _released(movies: DataFrame, genres: Collection[str], first_year: int, last_year: int) -> DataFrame:
    first = [{"genres.0": genre} for genre in genres]
    return find(movies, {"$or": first, "year": {"$gte": first_year, "$lte": last_year}})


def released_with_first_genre(
    movies: DataFrame,
    genres: Collection[str],
    first_year: int,
    last_year: int,
    seen: Observation | None = None,
) -> DataFrame:
    """(title, year, genres) of the movies whose first genre is one of `genres`, in a range of years.

    Fields a document lacks are shown by their default text. `seen` receives `total`, the number of
    movies, from the pass that reads the result.
    """
    found = _released(movies, genres, first_year, last_year)
    if seen is not None:
        found = found.observe(seen, F.count(F.lit(1)).alias("total"))
    return found.select(
        F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
        F.coalesce(F.col("year").cast("string"), F.lit(NO_YEAR)).alias("year"),
        F.coalesce("genres", F.array().cast("array<string>")).alias("genres"),
    )


def released_title_and_year(
    movies: DataFrame, genres: Collection[str], first_year: int, last_year: int
) -> DataFrame:
    """The same movies, projected to the stored title and year."""
    return _released(movies, genres, first_year, last_year).select("title", "year")


def movies_with_comments(comments: DataFrame, movies: DataFrame, part_size: int = 1000) -> DataFrame:
    """Every movie with its comments nested, oldest first; movies without any have an empty list. Of a movie
    with more than `part_size` comments there are several rows, each with a part of them."""
    nested = comments.select(F.col("movie_id").alias("_id"), "date", F.col("_id").alias("comment_id"), "name")
    return lookup(movies.select("_id", "title"), nested, "_id", "comments", part_size)


def _commented(comments: DataFrame, movies: DataFrame) -> DataFrame:
    """Comments are counted per movie first, so each movie joins as one row; unknown movies drop out."""
    counted = comments.groupBy(F.col("movie_id").alias("_id")).agg(F.count("*").alias("count"))
    return counted.join(movies.select("_id", "title", "year"), "_id")


def _most_commented_first() -> list[Column]:
    return [F.col("count").desc(), F.col("_id").asc()]


def comment_counts(comments: DataFrame, movies: DataFrame) -> DataFrame:
    return _commented(comments, movies).orderBy(*_most_commented_first()).select("count", "title", "year")


def most_commented(comments: DataFrame, movies: DataFrame, k: int = 20) -> DataFrame:
    """The `k` most commented movies with their position and a `title (year)` label.

    The position is a window over the `k` rows that are left.
    """
    best = top_k(_commented(comments, movies), _most_commented_first(), k)
    position = F.row_number().over(Window.orderBy(*_most_commented_first()))
    return best.select(
        position.alias("position"),
        title_with_year(F.col("title"), F.col("year")).alias("label"),
        "count",
    ).orderBy("position")
