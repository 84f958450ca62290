"""Rating-shaped views over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineitem_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_returnflag"
    )
    half_steps = (F.col("l_quantity").cast("int") - 1) % 10
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (F.lit(0.5) + half_steps * F.lit(0.5)).alias("rating"),
        (F.unix_date(F.col("l_shipdate").cast("date")) * 86400).cast("int").alias("timestamp"),
        "l_returnflag",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_ratings(spark, sf_dir).drop("l_returnflag")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue. Parts of size 2 or 3 are in it twice, with a later or an earlier title."""
    parts = _table(spark, sf_dir, "part")
    title = F.concat("p_name", F.lit(', The "'), "p_brand", F.lit('"'))
    other = F.when(F.col("p_size") == 2, F.concat(title, F.lit(" again"))).otherwise(
        F.concat(F.lit("A "), title)
    )

    def rows(of: DataFrame, name) -> DataFrame:
        return of.select(
            F.col("p_partkey").cast("int").alias("movieId"),
            name.alias("title"),
            F.concat("p_type", F.lit("|"), "p_brand").alias("genres"),
        )

    return rows(parts, title).union(rows(parts.filter("p_size in (2, 3)"), other))


# What is wrong with a nation's line in each file, by its key modulo 4.
# ``k`` is the key and ``name`` the name of the nation.
WRONG_LINES = {
    "links": ("{k}", "{k},{k},{k},{k}", "{k},,{k}", "{k},{k},"),
    "movies": ("{k},{name}", "{k},{name}, The,Drama", ",{name},Drama", "{k},{name},"),
    "ratings": ("{k},{k},4.0", "{k},{k},4.0,{k},{k}", "{k},,4.0,{k}", "{k},{k},4.0,"),
    "tags": ("{k},{name},{k}", "{k},{k},{name}, {name},{k}", "{k},,{name},{k}", "{k},{k},{name},"),
}


def wrong_lines(
    spark: SparkSession, sf_dir: str, table: str, source: str = "nation", key: str = "n_nationkey", name: str = "n_name"
) -> DataFrame:
    """A line of each nation that is short, has a field too many, a null one or no last one.

    Or of each row of another ``source`` with a ``key`` and a ``name``. Only in tags is the second
    form no error: a tag may hold commas.
    """
    key, value = F.col(key), None
    for case, line in enumerate(WRONG_LINES[table]):
        text = F.lit(line)
        for mark, column in (("{k}", key.cast("string")), ("{name}", F.col(name))):
            text = F.replace(text, F.lit(mark), column)
        value = (F if value is None else value).when(key % 4 == case, text)
    return _table(spark, sf_dir, source).select(value.alias("value"))


def link_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with blanks and a leading zero; parts of size 1 have no last field."""
    key = F.col("p_partkey")
    last = F.when(F.col("p_size") == 1, "").otherwise((key * 3).cast("string"))
    return _table(spark, sf_dir, "part").select(
        F.concat(
            key.cast("string"),
            F.lit(", 0"),
            (key * 7 + 100000).cast("string"),
            F.lit(" ,"),
            last,
        ).alias("value")
    )


def links_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        key.cast("int").alias("movieId"),
        (key * 7 + 100000).cast("int").alias("imdbId"),
        F.when(F.col("p_size") != 1, (key * 3).cast("int")).alias("tmdbId"),
    )


def movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return movies(spark, sf_dir).select(
        F.concat(
            F.col("movieId").cast("string"),
            F.lit(',"'),
            F.replace("title", F.lit('"'), F.lit('""')),
            F.lit('",'),
            "genres",
        ).alias("value")
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all ratings; those of returned items (flag R) start with an ``x``."""
    return _lineitem_ratings(spark, sf_dir).select(
        F.concat(
            F.when(F.col("l_returnflag") == "R", "x").otherwise(""),
            F.concat_ws(",", "userId", "movieId", "rating", "timestamp"),
        ).alias("value")
    )


def tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as quoted tags, with line breaks made blanks."""
    text = F.translate("text", "\n\r", "  ")
    return _table(spark, sf_dir, "documents").select(
        F.concat(
            F.col("doc_id").cast("string"),
            F.lit(","),
            F.col("n_chars").cast("string"),
            F.lit(',"'),
            text,
            F.lit('",'),
            (F.col("doc_id") + 1442943290).cast("string"),
        ).alias("value")
    )


def tags_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as tags, with line breaks made blanks; null texts stay null."""
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("int").alias("userId"),
        F.col("n_chars").cast("int").alias("movieId"),
        F.translate("text", "\n\r", "  ").alias("tag"),
        (F.col("doc_id") + 1442943290).cast("int").alias("timestamp"),
    )


def visitor_messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Site events as messages of visitors without ratings (ids below zero).

    Events of type ``error`` carry their raw properties, which do not decode.
    """
    visitor = (-1 - F.col("user_id")).cast("string")
    good = F.concat_ws("|", visitor, F.col("event_id").cast("string"), F.lit("4.0"))
    return _table(spark, sf_dir, "events").select(
        F.lit(topic).alias("key"),
        F.when(F.col("event_type") == "error", F.col("props")).otherwise(good).alias("value"),
    )
