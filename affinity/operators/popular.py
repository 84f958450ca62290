"""Lists that need no model: most rated, least rated, newest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rating_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("c"))


def ranked(rows: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows with their ``rank``; only those ``n`` reach the window."""
    top = rows.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def popular(ratings: DataFrame, n: int = 5, ascending: bool = False) -> DataFrame:
    """The ``n`` most rated items; ties go to the smaller id."""
    by_count = F.col("c").asc() if ascending else F.col("c").desc()
    top = ranked(rating_counts(ratings), [by_count, F.col("movieId")], n)
    return top.select("rank", "movieId", "c")


def newest(ratings: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` items whose first rating is the latest."""
    first = ratings.groupBy("movieId").agg(F.min("timestamp").alias("first_seen"))
    top = ranked(first, [F.col("first_seen").desc(), F.col("movieId")], n)
    return top.select("rank", "movieId", "first_seen")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId").distinct()


def nth_user(ratings: DataFrame, n: int) -> DataFrame:
    """The n-th smallest user id, or the largest when there are fewer."""
    first = distinct_users(ratings).orderBy("userId").limit(n)
    return first.agg(F.max("userId").alias("userId"))


def one_title(movies: DataFrame) -> DataFrame:
    """(movieId, title): the smallest title of each id, however often the catalogue has it."""
    return movies.groupBy("movieId").agg(F.min("title").alias("title"))


def list_titles(top: DataFrame, movies: DataFrame) -> DataFrame:
    """Titles for a top-n list. The list is n rows long, so it is the broadcast side."""
    few = F.broadcast(top.select("movieId").distinct())
    named = one_title(movies.select("movieId", "title").join(few, "movieId", "left_semi"))
    return named.join(F.broadcast(top), "movieId")


def lookup_titles(rows: DataFrame, movies: DataFrame) -> DataFrame:
    """``rows`` with a title each, null where the item is unknown.

    The catalogue is first cut down to the ids that occur, each once, so an id
    shared by a third of the rows meets a single catalogue row.
    """
    ids = rows.select("movieId").distinct()
    named = one_title(movies.select("movieId", "title").join(ids, "movieId", "left_semi"))
    return rows.join(named, "movieId", "left")
