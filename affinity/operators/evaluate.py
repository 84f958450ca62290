"""Root mean square error of predictions.

Rows alike are counted before they are joined, so copies of one rating cost one
row. No scored row gives a null error, which is never the best one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.config import may_broadcast
from affinity.operators.factor import GridFit
from affinity.operators.walk import Walked


def weighted(rows: DataFrame) -> DataFrame:
    """(userId, movieId, rating, weight): each different rating once."""
    return rows.groupBy("userId", "movieId", "rating").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )


def overlap(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test ratings of pairs that also occur in training.

    A join of the rows would give each test row once per training row of its pair;
    here that number is the ``weight``, and no pair is ever multiplied out.
    """
    trained = train.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("n_train"))
    tested = test.groupBy("userId", "movieId", "rating").agg(F.count(F.lit(1)).alias("n_test"))
    return tested.join(trained, ["userId", "movieId"]).select(
        "userId",
        "movieId",
        "rating",
        (F.col("n_train") * F.col("n_test")).cast("double").alias("weight"),
    )


def root_mean_square(error: Column, weight: Column) -> Column:
    """Null when there is nothing to average."""
    total = F.sum(weight)
    return F.sqrt(F.sum(weight * error * error) / F.when(total > 0, total))


def _lookup(rows: DataFrame, table: DataFrame, key: str, table_rows: int) -> DataFrame:
    """Inner join with a table that has one row per key, counted beforehand."""
    small = may_broadcast(table_rows, len(table.columns) - 1)
    return rows.join(F.broadcast(table) if small else table, key)


def grid_errors(fit: GridFit, rows: DataFrame) -> DataFrame:
    """(lambda, iterations, rmse, n) of every grid point, in one pass over ``rows``.

    ``rows`` come from :func:`weighted` or :func:`overlap`; ids unknown to the
    model are left out.
    """
    points = fit.points()
    columns = [name for _, _, name in points]
    if fit.walked:
        scores = [(fit.walked.users.columns.index(c),) for c in columns]
        return _error_table(walked_squares(fit.walked, rows, scores), points)
    users = fit.users.select("userId", *[F.col(c).alias(f"u_{c}") for c in columns])
    items = fit.items.select("movieId", *[F.col(c).alias(f"v_{c}") for c in columns])
    joined = _lookup(
        _lookup(rows, users, "userId", fit.user_rows), items, "movieId", fit.item_rows
    )
    weight = F.col("weight")
    errors = joined.agg(
        F.coalesce(F.sum(weight), F.lit(0.0)).cast("long").alias("n"),
        *[
            root_mean_square(F.col("rating") - F.col(f"u_{c}") * F.col(f"v_{c}"), weight).alias(c)
            for c in columns
        ],
    )
    return _error_table(errors, points)


def walked_squares(fit: Walked, rows: DataFrame, scores: list[tuple[int, ...]]) -> DataFrame:
    """(n, e0, e1, ...): the error of every score, by a walk through the blocks of both sides' factors.

    A score is the sum of products of the two sides' factors in the columns it names.
    """
    laid = fit.lay_out(rows.select("userId", "movieId", "rating", "weight"))

    def terms(values, own, other):
        rating, weight = (v.astype("float64") for v in values)
        out = [weight]
        for columns in scores:
            error = rating - sum(own[c] * other[c] for c in columns)
            out.append(weight * error * error)
        return out

    names = ["weight", *[f"e{i}" for i in range(len(scores))]]
    found = fit.sums(laid, names, terms, by_key=False)
    total = F.sum("weight")
    return found.agg(
        F.coalesce(total, F.lit(0.0)).cast("long").alias("n"),
        *[F.sqrt(F.sum(e) / F.when(total > 0, total)).alias(e) for e in names[1:]],
    )


def _error_table(errors: DataFrame, points: list[tuple[float, int, str]]) -> DataFrame:
    errors = errors.toDF("n", *[name for _, _, name in points])
    table = F.array(
        *[
            F.struct(
                F.lit(lam).alias("lambda"),
                F.lit(steps).alias("iterations"),
                F.col(name).alias("rmse"),
                F.col("n"),
            )
            for lam, steps, name in points
        ]
    )
    return errors.select(F.inline(table))


def item_mean_error(train: DataFrame, test: DataFrame) -> DataFrame:
    """Error of predicting the mean training rating of each item."""
    means = train.groupBy("movieId").agg(F.avg("rating").alias("p"))
    tested = test.groupBy("movieId", "rating").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )
    weight = F.col("weight")
    return tested.join(means, "movieId").agg(
        root_mean_square(F.col("p") - F.col("rating"), weight).alias("rmse"),
        F.coalesce(F.sum(weight), F.lit(0.0)).cast("long").alias("n"),
    )


def best(errors: DataFrame) -> DataFrame:
    """The grid point of least error; the first in (lambda, iterations) of equals."""
    order = F.struct("rmse", "lambda", "iterations")
    return (
        errors.filter(F.col("rmse").isNotNull())
        .agg(F.min_by(F.struct("lambda", "iterations", "rmse", "n"), order).alias("b"))
        .filter(F.col("b").isNotNull())
        .select("b.*")
    )
