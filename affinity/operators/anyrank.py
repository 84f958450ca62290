"""Models of any rank, by ``pyspark.ml``.

Rank 1 has its own operator (:mod:`affinity.operators.factor`). For higher ranks
this hands over to the estimator Spark brings along. That estimator keeps all
ratings of one user, and of one item, in one block, so the largest group is
measured first and a group beyond the bound is refused before any work is done.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.config import GROUP_ROWS
from affinity.operators.evaluate import root_mean_square

# Ratings of one user or item that a block may hold: 8 bytes each, under 1 GB.
BLOCK_GROUP_ROWS = 100_000_000


def fit(
    train: DataFrame,
    rank: int,
    iterations: int = 10,
    lam: float = 0.01,
    seed: int = 1,
    group_rows: int = BLOCK_GROUP_ROWS,
) -> ALSModel:
    """Fit on a written table, so that a lost executor re-reads the same rows."""
    total = 0
    for key in ("userId", "movieId"):
        sizes = train.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
        largest, total = sizes.agg(
            F.coalesce(F.max("size"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))
        ).first()
        if largest > group_rows:
            raise ValueError(f"one {key} has {largest} ratings; use rank 1 for such data")
    als = ALS(
        userCol="userId",
        itemCol="movieId",
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=lam,
        seed=seed,
        coldStartStrategy="drop",
    ).setNumBlocks(max(10, -(-total // GROUP_ROWS)))
    return als.fit(train)


def error(model: ALSModel, rows: DataFrame) -> DataFrame:
    """(rmse, n) on weighted rows; ids unknown to the model are left out."""
    weight = F.col("weight")
    return model.transform(rows).agg(
        root_mean_square(F.col("prediction") - F.col("rating"), weight).alias("rmse"),
        F.coalesce(F.sum(weight), F.lit(0.0)).cast("long").alias("n"),
    )


def for_users(model: ALSModel, users: DataFrame, n: int = 5) -> DataFrame:
    """(userId, rank, movieId, rating) of the given users; unknown users give no row."""
    lists = model.recommendForUserSubset(users.select("userId").distinct(), n)
    return lists.select("userId", F.posexplode("recommendations").alias("pos", "rec")).select(
        "userId",
        (F.col("pos") + 1).alias("rank"),
        F.col("rec.movieId").alias("movieId"),
        F.col("rec.rating").cast("double").alias("rating"),
    )


def equation_gaps(model: ALSModel, train: DataFrame, lam: float) -> DataFrame:
    """(userId, gap): the largest gradient of each user's own equation, per rating."""
    users = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("v"))
    of = lambda side, c: F.col(side)[c].cast("double")
    ranks = range(model.rank)
    score = reduce(lambda a, b: a + b, [of("u", c) * of("v", c) for c in ranks])
    pairs = train.groupBy("userId", "movieId").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")
    )
    rows = pairs.join(users, "userId").join(items, "movieId")
    rows = rows.withColumn("miss", F.col("n") * score - F.col("s"))
    sums = rows.groupBy("userId").agg(
        F.first("u").alias("u"),
        F.sum("n").alias("n"),
        *[F.sum(F.col("miss") * of("v", c)).alias(f"g{c}") for c in ranks],
    )
    gaps = [
        F.abs(F.col(f"g{c}") / F.col("n") + F.lit(lam) * of("u", c)).alias(f"gap{c}") for c in ranks
    ]
    return sums.select("userId", F.greatest(*gaps, F.lit(0.0)).alias("gap"))
