"""Explicit matrix factorization of any rank on the layout of the rank-1 grid.

With k factors per user and item the normal equations of a key are k (k + 1) / 2 + k sums over
its pairs, which combine before they are shuffled: a user or item with a third of all ratings is
summed everywhere at once, and no block of one key's ratings has to fit into a task. What is
left per key is a k x k system, solved by a Cholesky factorization in columns: each step is a
projection of its own, so expressions stay as small as the formulas.

Users start at (1, h1, h2, ...), where h are fixed numbers of the id between -1/2 and 1/2, so
that runs are repeatable and the factors differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.config import may_broadcast
from affinity.operators import walk
from affinity.operators.evaluate import best, root_mean_square, walked_squares
from affinity.operators.factor import Limits, _layout, _with_factors, _write_factors
from affinity.workspace import Workspace

# How an id's number for each further factor is made; see _start.
STEP, MODULUS = 37, 101
# A pivot below this share of its diagonal is zero, and so is its factor.
LEAST_PIVOT = 1e-12


@dataclass(frozen=True)
class RankModel:
    """``rank`` factors f0, f1, ... per user and item, and how they were fitted."""

    users: DataFrame  # userId int, f0 double, ...
    items: DataFrame  # movieId int, f0 double, ...
    rank: int
    lam: float
    iterations: int
    user_rows: int
    item_rows: int
    rmse: float | None = None
    walked: walk.Walked | None = None  # both sides by blocks, after a fit that walked

    @property
    def columns(self) -> list[str]:
        return [f"f{i}" for i in range(self.rank)]


def _start(keys: DataFrame, rank: int) -> DataFrame:
    """Factor c of a user is (STEP * c * userId mod MODULUS) / MODULUS - 1/2, and the first is 1."""
    return keys.selectExpr(
        "userId", "1D as f0",
        *[f"pmod(cast(userId as long) * {STEP * c}, {MODULUS}) / {float(MODULUS)}D - 0.5D as f{c}" for c in range(1, rank)],
    )


def _less(first: str, products: list[str]) -> str:
    return " - ".join([first, *products])


def solved(sums: DataFrame, key: str, rank: int) -> DataFrame:
    """``f0 f1 ...`` of ``sums(key, a<i>_<j>, b<i>)``, the lower half of a positive matrix and a right side."""
    state, ranks = sums, range(rank)
    for j in ranks:
        pivot = _less(f"a{j}_{j}", [f"l{j}_{k} * l{j}_{k}" for k in range(j)])
        state = state.selectExpr("*", f"{pivot} as p{j}")
        state = state.selectExpr("*", f"if(p{j} > {LEAST_PIVOT!r}D * a{j}_{j}, sqrt(p{j}), 0D) as l{j}_{j}")
        below = [
            (i, _less(f"a{i}_{j}", [f"l{i}_{k} * l{j}_{k}" for k in range(j)])) for i in range(j + 1, rank)
        ]
        if below:
            state = state.selectExpr("*", *[f"if(l{j}_{j} > 0, ({top}) / l{j}_{j}, 0D) as l{i}_{j}" for i, top in below])
    for i in ranks:
        top = _less(f"b{i}", [f"l{i}_{k} * z{k}" for k in range(i)])
        state = state.selectExpr("*", f"if(l{i}_{i} > 0, ({top}) / l{i}_{i}, 0D) as z{i}")
    for i in reversed(ranks):
        top = _less(f"z{i}", [f"l{k}_{i} * f{k}" for k in range(i + 1, rank)])
        state = state.selectExpr("*", f"if(l{i}_{i} > 0, ({top}) / l{i}_{i}, 0D) as f{i}")
    return state.select(key, *[f"f{i}" for i in ranks])


def _solve(joined: DataFrame, key: str, rank: int, lam: float) -> DataFrame:
    """Factors of ``key`` from its pairs with the other side's factors."""
    sums = [
        F.expr(f"sum(n * f{i} * f{j})" + (f" + {lam!r}D * sum(n)" if i == j else "")).alias(f"a{i}_{j}")
        for i in range(rank) for j in range(i + 1)
    ]
    sums += [F.expr(f"sum(s * f{i})").alias(f"b{i}") for i in range(rank)]
    return solved(joined.groupBy(key).agg(*sums), key, rank)


def fit(
    workspace: Workspace,
    train: DataFrame,
    rank: int,
    lambdas: Sequence[float] = (0.01,),
    iterations: Sequence[int] = (10,),
    limits: Limits = Limits(),
    cut_every: int = 2,
    name: str = "rank",
) -> list[RankModel]:
    """A model for every (lambda, iterations), in this order.

    Pairs are laid out once for all of them, and shorter runs are stops on the way of the
    longest. Lambda counts once per rating, as at rank 1.
    """
    if rank < 1 or min(iterations) < 1:
        raise ValueError("rank and iterations must be 1 at least")
    iterations = sorted(set(iterations))
    pairs = workspace.write(
        f"{name}/pairs",
        train.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")),
    )
    first = _start(pairs.select("userId").distinct(), rank)
    total = pairs.count()
    if total > limits.walk_pairs:
        return _walked_fit(workspace, pairs, total, first, rank, lambdas, iterations, limits, name)
    by_user = _layout(workspace, name, pairs, "userId", "movieId", limits, rank)
    by_item = _layout(workspace, name, pairs, "movieId", "userId", limits, rank)
    first = _write_factors(workspace, f"{name}/users_0", first, by_user)
    out = []
    for number, lam in enumerate(lambdas):
        users = first
        for step in range(1, iterations[-1] + 1):
            here = f"{name}/{number}_{step}"
            items = _solve(_with_factors(users, by_user, by_user), "movieId", rank, lam)
            if step in iterations:
                items = _write_factors(workspace, f"{here}_items", items, by_item)
            users = _solve(_with_factors(items, by_item, by_user), "userId", rank, lam)
            if step in iterations or step % cut_every == 0:
                users = _write_factors(workspace, f"{here}_users", users, by_user)
            if step in iterations:
                out.append(RankModel(users, items, rank, lam, step, by_user.rows, by_item.rows))
    by_user.pairs.unpersist()
    return out


def _walked_fit(
    workspace: Workspace, pairs: DataFrame, total: int, first: DataFrame, rank: int,
    lambdas: Sequence[float], iterations: list[int], limits: Limits, name: str,
) -> list[RankModel]:
    """The same models, with every half-step a walk through the blocks of the other side's factors."""
    steps = walk.Steps(workspace, name, pairs, total, limits.group_rows)
    wanted = {"n": ("n", ())}
    wanted |= {f"a{i}_{j}": ("n", (i, j)) for i in range(rank) for j in range(i + 1)}
    wanted |= {f"b{i}": ("s", (i,)) for i in range(rank)}

    def half(key: str, other: walk.Factors, lam: float, part: str) -> walk.Factors:
        more = {f"a{i}_{i}": F.expr(f"a{i}_{i} + {lam!r}D * n") for i in range(rank)}
        return steps.write(part, solved(steps.half(key, other, wanted).withColumns(more), key, rank), key)

    first = steps.write("users_0", first, "userId")
    user_rows, out = first.table.count(), []
    for number, lam in enumerate(lambdas):
        users = first
        for step in range(1, iterations[-1] + 1):
            items = half("movieId", users, lam, f"{number}_{step}_items")
            users = half("userId", items, lam, f"{number}_{step}_users")
            if step in iterations:
                walked = walk.Walked(workspace, users, items, steps.blocks, f"{name}/walk")
                rows = (user_rows, items.table.count())
                out.append(RankModel(users.table, items.table, rank, lam, step, *rows, walked=walked))
    return out


def _dot(model: RankModel) -> str:
    return " + ".join(f"u{c} * v{c}" for c in range(model.rank))


def error(model: RankModel, rows: DataFrame) -> DataFrame:
    """(lambda, iterations, rmse, n) on weighted rows; ids unknown to the model are left out."""
    if model.walked:
        found = walked_squares(model.walked, rows, [tuple(range(model.rank))])
        return found.select(F.lit(model.lam).alias("lambda"), F.lit(model.iterations).alias("iterations"), F.col("e0").alias("rmse"), "n")
    users = model.users.selectExpr("userId", *[f"f{c} as u{c}" for c in range(model.rank)])
    items = model.items.selectExpr("movieId", *[f"f{c} as v{c}" for c in range(model.rank)])
    for table, key, n in ((users, "userId", model.user_rows), (items, "movieId", model.item_rows)):
        rows = rows.join(F.broadcast(table) if may_broadcast(n, model.rank) else table, key)
    weight = F.col("weight")
    return rows.agg(
        root_mean_square(F.expr(f"rating - ({_dot(model)})"), weight).alias("rmse"),
        F.coalesce(F.sum(weight), F.lit(0.0)).cast("long").alias("n"),
    ).select(F.lit(model.lam).alias("lambda"), F.lit(model.iterations).alias("iterations"), "rmse", "n")


def errors(models: Sequence[RankModel], rows: DataFrame) -> DataFrame:
    """The same for every model; ``rows`` should be written, as each model reads them."""
    return reduce(DataFrame.union, [error(m, rows) for m in models])


def best_model(models: Sequence[RankModel], found: DataFrame) -> RankModel:
    """The model of least error by :func:`errors`; no error to compare is refused."""
    row = best(found).first()
    if row is None:
        raise ValueError("no model could be scored")
    chosen = next(m for m in models if (m.lam, m.iterations) == (row["lambda"], row["iterations"]))
    return RankModel(**{**chosen.__dict__, "rmse": row["rmse"]})


def save(model: RankModel, path: str) -> None:
    model.users.write.mode("overwrite").parquet(f"{path}/users")
    model.items.write.mode("overwrite").parquet(f"{path}/items")
    facts = model.users.sparkSession.range(1).select(
        F.lit(model.rank).alias("rank"), F.lit(model.lam).cast("double").alias("lambda"),
        F.lit(model.iterations).alias("iterations"), F.lit(model.rmse).cast("double").alias("rmse"),
    )
    facts.write.mode("overwrite").parquet(f"{path}/params")


def load(spark: SparkSession, path: str) -> RankModel:
    facts = spark.read.parquet(f"{path}/params").first()
    factors = ", ".join(f"f{i} double" for i in range(facts["rank"]))
    users = spark.read.schema(f"userId int, {factors}").parquet(f"{path}/users")
    items = spark.read.schema(f"movieId int, {factors}").parquet(f"{path}/items")
    return RankModel(
        users, items, facts["rank"], facts["lambda"], facts["iterations"], users.count(), items.count(), facts["rmse"]
    )


def equation_gaps(model: RankModel, train: DataFrame) -> DataFrame:
    """(userId, gap): the largest residual of each user's own equations, per rating."""
    if model.walked:
        return _walked_gaps(model, train)
    users = model.users.selectExpr("userId", *[f"f{c} as u{c}" for c in range(model.rank)])
    items = model.items.selectExpr("movieId", *[f"f{c} as v{c}" for c in range(model.rank)])
    if may_broadcast(model.item_rows, model.rank):
        items = F.broadcast(items)
    pairs = train.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"))
    rows = pairs.join(items, "movieId").join(users, "userId").withColumn("miss", F.expr(f"n * ({_dot(model)}) - s"))
    sums = [F.sum(F.expr(f"miss * v{c} + {model.lam!r}D * n * u{c}")).alias(f"g{c}") for c in range(model.rank)]
    gaps = rows.groupBy("userId").agg(F.sum("n").alias("n"), *sums)
    return gaps.select("userId", F.greatest(F.lit(0.0), *[F.expr(f"abs(g{c}) / n") for c in range(model.rank)]).alias("gap"))


def _walked_gaps(model: RankModel, train: DataFrame) -> DataFrame:
    pairs = train.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"))
    ranks, lam = range(model.rank), model.lam

    def terms(values, own, other):
        n, s = (v.astype("float64") for v in values)
        miss = n * sum(own[c] * other[c] for c in ranks) - s
        return [n, *[miss * other[c] + lam * n * own[c] for c in ranks]]

    names = ["n", *[f"g{c}" for c in ranks]]
    laid = model.walked.lay_out(pairs.select("userId", "movieId", "n", "s"))
    gaps = model.walked.sums(laid, names, terms)
    return gaps.select("userId", F.greatest(F.lit(0.0), *[F.expr(f"abs(g{c}) / n") for c in ranks]).alias("gap"))
