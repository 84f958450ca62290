"""The best items of users at any rank, exactly, without scoring every pair.

A score is at most the product of the two norms (Cauchy and Schwarz). Items are taken in blocks of
falling norm; a user whose n-th best score so far is above what the next block could reach has
its list. Users never move: item blocks are sent to them, a bounded chunk of the catalogue
at a time, and beyond one chunk the users' lists are written and go on with the next.

Scores are compared after rounding to ``DIGITS`` places, so that sums that were added in another
order do not change the order of equal items; ties go to the smaller id.

This is the one place outside the training-data operators where Python works on rows: numpy, in
Arrow batches, with a product of blocks that no built-in function has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.config import BROADCAST_COLUMNS, BROADCAST_ROWS
from affinity.workspace import Workspace

DIGITS = 9
# Users and items that are scored against each other at once.
USERS, ITEMS = 1_024, 1_024


def merged(score: np.ndarray, item: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` best of every row of candidates by (rounded score, smaller item), best first.

    Rows may have fewer: what is missing has a score of minus infinity.
    """
    rounded = np.round(score, DIGITS)
    if score.shape[1] > n:
        least = np.partition(rounded, score.shape[1] - n, axis=1)[:, score.shape[1] - n]
        row, column = np.nonzero(rounded >= least[:, None])  # ties at the end included
    else:
        row, column = np.nonzero(np.ones(score.shape, bool))
    value, name = score[row, column], item[row, column]
    order = np.lexsort((name, -rounded[row, column], row))
    row, value, name = row[order], value[order], name[order]
    first = np.searchsorted(row, np.arange(len(score)))
    place = np.arange(len(row)) - first[row]
    own = place < n
    best = np.full((len(score), n), -np.inf)
    names = np.full((len(score), n), np.iinfo(np.int64).max)
    best[row[own], place[own]], names[row[own], place[own]] = value[own], name[own]
    return best, names


def scan(
    users: np.ndarray, best: np.ndarray, names: np.ndarray, items: np.ndarray, ids: np.ndarray, norms: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists (best, names) after the items, which come in order of falling norm; items scored by user."""
    n = best.shape[1]
    lengths = np.sqrt((users * users).sum(axis=1))
    scored, left = np.zeros(len(users), np.int64), np.arange(len(users))
    for at in range(0, len(ids), ITEMS):
        # Somewhat more than the bound, for its own rounding and that of scores.
        reach = lengths[left] * norms[at] * (1 + 1e-9) + 2 * 10.0**-DIGITS
        left = left[reach >= best[left, n - 1]]
        if not len(left):
            break
        block = items[at : at + ITEMS]
        score = np.zeros((len(left), len(block)))
        for c in range(users.shape[1]):  # in order, so that equal factors have equal scores
            score += users[left, c][:, None] * block[None, :, c]
        score = np.concatenate([best[left], score], axis=1)
        name = np.concatenate([names[left], np.broadcast_to(ids[at : at + ITEMS], (len(left), len(block)))], axis=1)
        best[left], names[left] = merged(score, name, n)
        scored[left] += len(block)
    return best, names, scored


def _visit(sent, factors: list[str], n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, ids, norms = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, USERS):
                batch = whole.slice(at, USERS)
                users = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in factors], axis=1)
                best = np.full((len(users), n), -np.inf)
                names = np.full((len(users), n), np.iinfo(np.int64).max)
                for i, (s, m) in enumerate(zip(batch["scores"].to_pylist(), batch["ids"].to_pylist(), strict=True)):
                    best[i, : len(s)], names[i, : len(m)] = s, m
                best, names, scored = scan(users, best, names, items, ids, norms)
                there = [b > -np.inf for b in best]
                new = {
                    "scores": pa.array([b[t] for b, t in zip(best, there, strict=True)], pa.list_(pa.float64())),
                    "ids": pa.array([m[t].astype(np.int32) for m, t in zip(names, there, strict=True)], pa.list_(pa.int32())),
                    "scored": pa.array(scored + batch["scored"].to_numpy(), pa.int64()),
                }
                yield pa.RecordBatch.from_arrays(
                    [new.get(c, batch[c]) for c in batch.schema.names], names=batch.schema.names
                )

    return run


def chunks_of(items: DataFrame, rows: int, chunk_rows: int) -> list[DataFrame]:
    """``items(..., norm)`` in parts of falling norm and some ``chunk_rows`` rows."""
    parts = -(-rows // chunk_rows)
    if parts <= 1:
        return [items]
    shares = [i / parts for i in range(1, parts)]
    cuts = items.agg(F.percentile_approx("norm", shares, 100 * parts)).first()[0]
    limits = [None, *sorted(set(cuts), reverse=True), None]
    out = []
    for high, low in zip(limits[:-1], limits[1:], strict=True):
        part = items if high is None else items.filter(F.col("norm") < high)
        out.append(part if low is None else part.filter(F.col("norm") >= low))
    return out


def lists(
    workspace: Workspace,
    users: DataFrame,
    items: DataFrame,
    factors: Sequence[str],
    n: int = 5,
    chunk_rows: int | None = None,
    name: str = "lists",
) -> DataFrame:
    """(userId, ids, scores, scored) for ``users(userId, *factors)`` and ``items(movieId, *factors)``.

    The ``n`` best items of every user, best first, and how many items it was scored against.
    """
    factors = list(factors)
    spark = users.sparkSession
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in factors), F.lit(0.0)))
    items = items.select("movieId", *factors, norm.alias("norm"))
    if chunk_rows is None:
        chunk_rows = BROADCAST_ROWS * BROADCAST_COLUMNS // max(len(factors) + 2, BROADCAST_COLUMNS)
    state = users.select(
        "userId", *factors, F.array().cast("array<int>").alias("ids"),
        F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("scored"),
    )
    for i, chunk in enumerate(chunks_of(items, items.count(), chunk_rows)):
        rows = chunk.toPandas()  # chunk_rows rows, about
        rows = rows.sort_values(["norm", "movieId"], ascending=[False, True])
        sent = spark.sparkContext.broadcast(
            (rows[factors].to_numpy(np.float64), rows["movieId"].to_numpy(np.int64), rows["norm"].to_numpy(np.float64))
        )
        state = workspace.write(f"{name}_{i}", state.mapInArrow(_visit(sent, factors, n), state.schema))
    return state.select("userId", "ids", "scores", "scored")


def for_users(
    workspace: Workspace, model, users: DataFrame | None = None, n: int = 5, chunk_rows: int | None = None, name: str = "lists"
) -> DataFrame:
    """(userId, rank, movieId, rating) of the given users, or of all; unknown users give no row."""
    wanted = model.users
    if users is not None:
        wanted = wanted.join(users.select("userId").distinct(), "userId", "left_semi")
    found = lists(workspace, wanted, model.items, model.columns, n, chunk_rows, name)
    return exploded(found)


def exploded(found: DataFrame) -> DataFrame:
    """(userId, rank, movieId, rating) of lists (userId, ids, scores)."""
    each = F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "one")
    return found.select("userId", each).select(
        "userId", (F.col("at") + 1).alias("rank"), F.col("one.ids").alias("movieId"), F.col("one.scores").alias("rating")
    )
