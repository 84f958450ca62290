"""Factor models: choose, save, load, list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.evaluate import best
from affinity.operators.factor import GridFit
from affinity.operators.popular import list_titles, ranked
from affinity.operators.registry import Registry


@dataclass(frozen=True)
class Model:
    """One factor per user and item, and how they were fitted."""

    users: DataFrame  # userId int, factor double
    items: DataFrame  # movieId int, factor double
    lam: float
    iterations: int
    rmse: float | None = None


def from_grid(fit: GridFit, lam: float, iterations: int, rmse: float | None = None) -> Model:
    column = next(c for l, i, c in fit.points() if (l, i) == (lam, iterations))
    return Model(
        fit.users.select("userId", F.col(column).alias("factor")),
        fit.items.select("movieId", F.col(column).alias("factor")),
        lam,
        iterations,
        rmse,
    )


def best_model(fit: GridFit, errors: DataFrame) -> Model:
    """The model of least error; a grid without any error to compare is refused."""
    row = best(errors).first()
    if row is None:
        raise ValueError("no grid point could be scored")
    return from_grid(fit, row["lambda"], row["iterations"], row["rmse"])


def save(model: Model, path: str) -> None:
    model.users.write.mode("overwrite").parquet(f"{path}/users")
    model.items.write.mode("overwrite").parquet(f"{path}/items")
    spark = model.users.sparkSession
    facts = spark.range(1).select(
        F.lit(model.lam).cast("double").alias("lambda"),
        F.lit(model.iterations).cast("int").alias("iterations"),
        F.lit(model.rmse).cast("double").alias("rmse"),
    )
    facts.write.mode("overwrite").parquet(f"{path}/params")


def load(spark: SparkSession, path: str) -> Model:
    facts = spark.read.parquet(f"{path}/params").first()
    return Model(
        spark.read.schema("userId int, factor double").parquet(f"{path}/users"),
        spark.read.schema("movieId int, factor double").parquet(f"{path}/items"),
        facts["lambda"],
        facts["iterations"],
        facts["rmse"],
    )


def publish(model: Model, root: str) -> str:
    """Save under a new path and make it the current model of ``root``; see ``registry``."""
    registry = Registry(model.users.sparkSession, root)
    return registry.publish(model.users, model.items, lambda path: save(model, path))


def current_path(spark: SparkSession, root: str) -> str:
    return Registry(spark, root).current().path


def top_lists(items: DataFrame, n: int = 5) -> DataFrame:
    """(direction, rank, movieId, item_factor): the three lists any user can get.

    A score is the product of two factors. Users with a positive factor order the
    items by falling factor, users with a negative one by rising factor, and users
    at zero score everything 0 and fall back to the id. So the best ``n`` items of
    every user are among 3n rows, whatever the size of the catalogue.
    """
    factor, movie = F.col("factor"), F.col("movieId")
    orders = {1: [factor.desc(), movie], -1: [factor.asc(), movie], 0: [movie]}
    lists = [
        ranked(items, order, n).select(
            F.lit(direction).alias("direction"),
            "rank",
            "movieId",
            F.col("factor").alias("item_factor"),
        )
        for direction, order in orders.items()
    ]
    return lists[0].union(lists[1]).union(lists[2])


def direction(factor: Column) -> Column:
    return F.signum(factor).cast("int")


def suggestions_for(users: DataFrame, lists: DataFrame) -> DataFrame:
    """(userId, rank, movieId, rating, ...) for rows (userId, factor).

    Only the lists travel; users are not shuffled. Items a user has rated stay in.
    """
    extra = [c for c in lists.columns if c not in ("direction", "rank", "movieId", "item_factor")]
    return (
        users.withColumn("direction", direction(F.col("factor")))
        .join(F.broadcast(lists), "direction")
        .select(
            "userId",
            "rank",
            "movieId",
            (F.col("factor") * F.col("item_factor")).alias("rating"),
            *extra,
        )
    )


def titled(lists: DataFrame, movies: DataFrame) -> DataFrame:
    """Lists with a title each, null for an item without one."""
    names = list_titles(lists.select("movieId").distinct(), movies)
    return lists.join(F.broadcast(names), "movieId", "left")


def for_users(model: Model, users: DataFrame, n: int = 5) -> DataFrame:
    """Top-n of the given users; users unknown to the model give no row."""
    wanted = model.users.join(users.select("userId").distinct(), "userId", "left_semi")
    return suggestions_for(wanted, top_lists(model.items, n))


def for_all(model: Model, n: int = 5) -> DataFrame:
    return suggestions_for(model.users, top_lists(model.items, n))
