"""Rank-1 explicit matrix factorization by alternating least squares.

With one factor per user and item the two normal equations are sums:

    u = sum(v * r) / (sum(v * v) + lambda * n_u)
    v = sum(u * r) / (sum(u * u) + lambda * n_v)

so each half-step is a join and a grouping. Groupings combine before they
shuffle, so a user or item with a third of all ratings is summed everywhere at
once. All values of lambda share the joins and shuffles as columns, and the runs
of different length share their first iterations, so a whole grid costs as much
as its longest run. Users start at 1, the one-dimensional unit vector.

The ratings are laid out once, hashed on the user, and never shuffled again:
item factors are broadcast to them when their number is known to be small, and
otherwise joined with a second layout hashed on the item. Beyond ``WALK_PAIRS`` pairs
tasks read the factors block by block in place of that (``walk``): a step then neither
broadcasts nor shuffles. Pairs (user, item) rated more than once are one row, and
count once per rating.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.config import (
    BROADCAST_COLUMNS,
    BROADCAST_ROWS,
    GROUP_ROWS,
    MAX_BUCKETS,
    PERSIST_ROWS,
    TASK_ROWS,
    WALK_PAIRS,
    may_broadcast,
)
from affinity.operators import walk
from affinity.workspace import Workspace


@dataclass(frozen=True)
class Limits:
    """Sizes above which a table is not broadcast, not persisted, a group is split, or blocks are walked."""

    broadcast_rows: int = BROADCAST_ROWS
    persist_rows: int = PERSIST_ROWS
    group_rows: int = GROUP_ROWS
    walk_pairs: int = WALK_PAIRS


@dataclass(frozen=True)
class GridFit:
    """Factors of every grid point, one column ``f<iterations>_<lambda index>`` each.

    ``user_rows`` and ``item_rows`` bound the rows of the two tables from above. ``walked`` has
    both tables by blocks, after a fit that walked.
    """

    users: DataFrame
    items: DataFrame
    user_rows: int
    item_rows: int
    lambdas: tuple[float, ...]
    iterations: tuple[int, ...]
    walked: walk.Walked | None = None

    def points(self) -> list[tuple[float, int, str]]:
        return [
            (lam, steps, f"f{steps}_{j}")
            for j, lam in enumerate(self.lambdas)
            for steps in self.iterations
        ]


@dataclass(frozen=True)
class _Side:
    """One of the two keys: at most how many values it has, its hot groups, and the
    pairs laid out by it."""

    key: str
    rows: int
    small: bool
    buckets: int
    hot: DataFrame | None
    pairs: DataFrame | None
    few_hot: bool = True

    @property
    def keys(self) -> list[str]:
        return [self.key] if self.hot is None else [self.key, "part"]


def _measure(pairs: DataFrame, key: str) -> tuple[int, int]:
    """(values, largest group) of a key, exactly."""
    sizes = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    return tuple(sizes.agg(F.count(F.lit(1)), F.max("size")).first())


def _hot_groups(pairs: DataFrame, key: str, group_rows: int) -> DataFrame:
    """Keys with more pairs than a group may hold, and the parts to split each into.

    There are fewer than pairs / group_rows of them.
    """
    sizes = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    parts = F.ceil(F.col("size") / F.lit(group_rows)).cast("int")
    return sizes.filter(F.col("size") > group_rows).select(key, parts.alias("parts"))


def _layout(
    workspace: Workspace,
    name: str,
    pairs: DataFrame,
    key: str,
    other: str,
    limits: Limits,
    columns: int,
) -> _Side:
    """Measure a key and lay the pairs out by it where some step needs that.

    The user's layout always exists; the item's only when items cannot be broadcast.
    """
    total = pairs.count()
    rows = largest = total  # no key has more values or a larger group than that
    if total > min(limits.broadcast_rows, limits.group_rows) or columns > BROADCAST_COLUMNS:
        rows, largest = _measure(pairs, key)
    small = may_broadcast(rows, columns, limits.broadcast_rows)
    cores = workspace.spark.sparkContext.defaultParallelism
    buckets = max(min(cores, -(-total // TASK_ROWS)), -(-total // limits.group_rows), 1)
    buckets = min(buckets, MAX_BUCKETS)
    if small and key == "movieId":
        return _Side(key, rows, small, buckets, None, None)
    hot, few_hot = None, True
    if largest > limits.group_rows:
        hot = workspace.write(f"{name}/hot_{key}", _hot_groups(pairs, key, limits.group_rows))
        few_hot = may_broadcast(hot.count(), 1, max(limits.broadcast_rows, TASK_ROWS))
        parts = F.coalesce(F.col("parts"), F.lit(1))
        pairs = (
            pairs.join(F.broadcast(hot) if few_hot else hot, key, "left")
            .withColumn("part", F.pmod(F.xxhash64(other), parts).cast("int"))
            .drop("parts")
        )
    keys = [key] if hot is None else [key, "part"]
    if small and total <= limits.persist_rows:
        kept = pairs.repartition(buckets, *keys).persist(StorageLevel.MEMORY_AND_DISK)
        return _Side(key, rows, small, buckets, hot, kept, few_hot)
    table = workspace.write_bucketed(f"{name}/by_{key}", pairs, keys, buckets)
    return _Side(key, rows, small, buckets, hot, table, few_hot)


def _per_part(factors: DataFrame, side: _Side) -> DataFrame:
    """Factors once per part of their key."""
    if side.hot is None:
        return factors
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    return (
        factors.join(F.broadcast(side.hot) if side.few_hot else side.hot, side.key, "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), last)))
        .drop("parts")
    )


def _with_factors(factors: DataFrame, side: _Side, by_user: _Side) -> DataFrame:
    """The pairs with the factors of one side.

    Laid out pairs are streamed past the factors of their bucket, a hash table with
    at most as many rows as the bucket has pairs: nothing is shuffled or sorted.
    """
    if side.small:
        return by_user.pairs.join(F.broadcast(factors), side.key)
    return side.pairs.join(_per_part(factors, side).hint("shuffle_hash"), side.keys)


def _quotient(top: str, bottom: str) -> str:
    return f"if({bottom} > 0, {top} / ({bottom}), 0D)"


def _solved(sums: DataFrame, key: str, lambdas: Sequence[float]) -> DataFrame:
    """Factors ``f0 f1 ...`` from ``sums(key, n, top0, bottom0, ...)``."""
    factors = [
        f"{_quotient(f'top{j}', f'bottom{j} + {lam!r}D * n')} as f{j}" for j, lam in enumerate(lambdas)
    ]
    return sums.selectExpr(key, *factors)


def _solve(joined: DataFrame, key: str, lambdas: Sequence[float]) -> DataFrame:
    """Factors ``f0 f1 ...`` of ``key`` from rows with the other side's factors."""
    sums = ["sum(n) as n"]
    for j in range(len(lambdas)):
        sums += [f"sum(s * f{j}) as top{j}", f"sum(n * f{j} * f{j}) as bottom{j}"]
    return _solved(joined.groupBy(key).agg(*map(F.expr, sums)), key, lambdas)


def _first_items(pairs: DataFrame, lambdas: Sequence[float]) -> DataFrame:
    """Item factors while every user factor is 1."""
    ones = [f"1D as f{j}" for j in range(len(lambdas))]
    return _solve(pairs.selectExpr("movieId", "n", "s", *ones), "movieId", lambdas)


def _write_factors(workspace: Workspace, name: str, factors: DataFrame, side: _Side) -> DataFrame:
    """Written factors; large ones in the buckets of the layout they will be joined with."""
    if side.small or side.hot is not None:
        return workspace.write(name, factors)
    return workspace.write_bucketed(name, factors, side.keys, side.buckets)


def fit_grid(
    workspace: Workspace,
    train: DataFrame,
    lambdas: Sequence[float] = (0.001, 0.005, 0.01),
    iterations: Sequence[int] = (10, 12, 16),
    limits: Limits = Limits(),
    cut_every: int = 2,
    name: str = "fit",
) -> GridFit:
    """Fit every (lambda, iterations) in one run of ``max(iterations)`` steps.

    Factors are written every ``cut_every`` steps, which bounds both the plan and
    what a lost executor can cost.
    """
    lambdas, iterations = tuple(lambdas), tuple(sorted(set(iterations)))
    pairs = workspace.write(
        f"{name}/pairs",
        train.groupBy("userId", "movieId").agg(
            F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")
        ),
    )
    total = pairs.count()
    if total > limits.walk_pairs:
        return _walked_grid(workspace, pairs, total, lambdas, iterations, limits, name)
    by_user = _layout(workspace, name, pairs, "userId", "movieId", limits, len(lambdas))
    by_item = _layout(workspace, name, pairs, "movieId", "userId", limits, len(lambdas))

    users = items = None
    snapshots = {"userId": [], "movieId": []}
    for step in range(1, iterations[-1] + 1):
        if users is None:
            items = _first_items(by_user.pairs, lambdas)
        else:
            items = _solve(_with_factors(users, by_user, by_user), "movieId", lambdas)
        if step in iterations:
            items = _write_factors(workspace, f"{name}/items_{step}", items, by_item)
        users = _solve(_with_factors(items, by_item, by_user), "userId", lambdas)
        if step in iterations or step % cut_every == 0:
            users = _write_factors(workspace, f"{name}/users_{step}", users, by_user)
        if step in iterations:
            for key, factors in (("userId", users), ("movieId", items)):
                named = [f"f{j} as f{step}_{j}" for j in range(len(lambdas))]
                snapshots[key].append(factors.selectExpr(key, *named))

    def wide(key: str) -> DataFrame:
        joined = reduce(lambda a, b: a.join(b, key), snapshots[key])
        return workspace.write(f"{name}/factors_{key}", joined)

    fit = GridFit(
        wide("userId"), wide("movieId"), by_user.rows, by_item.rows, lambdas, iterations
    )
    by_user.pairs.unpersist()
    return fit


def _walked_grid(
    workspace: Workspace, pairs: DataFrame, total: int, lambdas: tuple, iterations: tuple, limits: Limits, name: str
) -> GridFit:
    """The same fit, with every half-step a walk through the blocks of the other side's factors."""
    steps = walk.Steps(workspace, name, pairs, total, limits.group_rows)
    wanted = {"n": ("n", ())}
    for j in range(len(lambdas)):
        wanted |= {f"top{j}": ("s", (j,)), f"bottom{j}": ("n", (j, j))}
    users = None
    snapshots = {"userId": [], "movieId": []}
    for step in range(1, iterations[-1] + 1):
        items = _solved(steps.half("movieId", users, wanted), "movieId", lambdas)
        items = steps.write(f"items_{step}", items, "movieId")
        users = _solved(steps.half("userId", items, wanted), "userId", lambdas)
        users = steps.write(f"users_{step}", users, "userId")
        if step in iterations:
            for factors in (users, items):
                named = [f"f{j} as f{step}_{j}" for j in range(len(lambdas))]
                snapshots[factors.key].append(factors.table.selectExpr(factors.key, *named))
    users, items = (
        steps.write(f"factors_{key}", reduce(lambda a, b: a.join(b, key), snapshots[key]), key)
        for key in ("userId", "movieId")
    )
    rows = (users.table.count(), items.table.count())
    walked = walk.Walked(workspace, users, items, steps.blocks, f"{name}/walk")
    return GridFit(users.table, items.table, *rows, lambdas, iterations, walked)


def equation_gaps(model, train: DataFrame, item_rows: int) -> DataFrame:
    """(userId, gap): how far each user factor is from solving its own equation."""
    items = model.items.select("movieId", F.col("factor").alias("v"))
    if item_rows <= BROADCAST_ROWS:
        items = F.broadcast(items)
    sums = (
        train.groupBy("userId", "movieId")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"))
        .join(items, "movieId")
        .groupBy("userId")
        .agg(
            F.expr("sum(v * s)").alias("top"),
            F.expr(f"sum(v * v * n) + {model.lam!r}D * sum(n)").alias("bottom"),
        )
    )
    return model.users.join(sums, "userId").select(
        "userId",
        F.expr(f"abs(factor - {_quotient('top', 'bottom')})").alias("gap"),
    )
