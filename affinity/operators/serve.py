"""Suggestions for a batch of requests: model lists for known users, the popular
list for new ones. A batch is any DataFrame, so streams and tables share this code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.messages import user_id
from affinity.operators.model import Model, direction, titled, top_lists

MODEL, POPULAR, REJECT = "model", "popular", "reject"
NEW_USER = 2


def decode(messages: DataFrame) -> DataFrame:
    """Messages with their ``userId``, null where malformed."""
    return messages.withColumn("userId", user_id(F.col("value")))


def known_among(known: DataFrame, requests: DataFrame, few: bool = False) -> DataFrame:
    """The rows of ``known`` (one per user) whose users occur in ``requests``.

    ``few`` says the requests have been counted and may be broadcast; the known
    users are then scanned without a shuffle.
    """
    ids = requests.select("userId").distinct()
    return known.join(F.broadcast(ids) if few else ids, "userId", "left_semi")


def known_requests(requests: DataFrame, known: DataFrame) -> DataFrame:
    """Requests of users in ``known``, which has one row per user."""
    return requests.join(known.select("userId"), "userId", "left_semi")


def new_requests(requests: DataFrame, known: DataFrame) -> DataFrame:
    """Readable requests of users not in ``known``."""
    readable = requests.filter(F.col("userId").isNotNull())
    return readable.join(known.select("userId"), "userId", "left_anti")


def per_user(requests: DataFrame, *within: str) -> DataFrame:
    """Each user once (``within`` each value of other columns) with the number of requests: a busy user is one row."""
    return requests.groupBy("userId", *within).agg(F.count(F.lit(1)).alias("requests"))


def serving_lists(model: Model, popular: DataFrame, movies: DataFrame, n: int = 5) -> DataFrame:
    """The model's lists and the popular list, with titles: at most 4n rows."""
    ranked = top_lists(model.items, n).drop("item_factor")
    default = popular.filter(F.col("rank") <= n).select(
        F.lit(NEW_USER).alias("direction"), "rank", "movieId"
    )
    return titled(ranked.union(default), movies)


def fallback(users: DataFrame, popular: DataFrame, movies: DataFrame, n: int = 5) -> DataFrame:
    """The popular list for each of ``users``: one row per rank, matched by rank."""
    lists = titled(popular.select("rank", "movieId"), movies)
    ranks = users.withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return ranks.join(F.broadcast(lists), "rank")


def suggest(
    requests: DataFrame, model: Model, lists: DataFrame, few: bool = False, within: tuple[str, ...] = ()
) -> DataFrame:
    """(userId, requests, source, rank, movieId, title) for decoded requests, by the columns ``within`` if any.

    Malformed requests come back as one row without a user.
    """
    asked = per_user(requests, *within)
    routed = asked.join(known_among(model.users, asked, few), "userId", "left")
    known = F.col("factor").isNotNull()
    source = (
        F.when(F.col("userId").isNull(), REJECT).when(known, MODEL).otherwise(POPULAR)
    )
    to_list = (
        F.when(F.col("userId").isNull(), F.lit(None).cast("int"))
        .when(known, direction(F.col("factor")))
        .otherwise(F.lit(NEW_USER))
    )
    return (
        routed.withColumn("source", source)
        .withColumn("direction", to_list)
        .join(F.broadcast(lists), "direction", "left")
        .select("userId", "requests", "source", "rank", "movieId", "title", *within)
    )
