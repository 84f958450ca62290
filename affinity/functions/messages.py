"""The message format: ``userId|movieId|rating`` under a topic key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def encode(ratings: DataFrame, topic: str | None, *keep: str) -> DataFrame:
    """One message per rating, beside the columns to ``keep``.

    The key is the name of the ``topic``, or the user if that is None. A broker is sent
    user keys: one shared key would put every message into one partition.
    """
    key = F.lit(topic) if topic is not None else F.col("userId").cast("string")
    return ratings.select(
        *keep, key.alias("key"), F.concat_ws("|", "userId", "movieId", "rating").alias("value")
    )


# A message starts with an integer, possibly among blanks, and a bar.
_USER = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*\|"


def user_id(value: Column) -> Column:
    """The user of a message, or null for a malformed one."""
    return F.when(value.rlike(_USER), F.substring_index(value, "|", 1).try_cast("int"))
