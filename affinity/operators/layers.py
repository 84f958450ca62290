"""The best items of users at rank 2, looked up by angle.

An item is a point, a user a direction, and a score how far the point lies in that direction. The n
best points of any direction are on the first n *convex layers*: the hull, the hull of what is left
within it, and so on. Points inside the n-th layer are in no list.

1. *Peel.* Tasks keep the first n layers of their own items; what is kept meets in fewer and fewer
   tasks and is peeled again. A point on the first n layers of all is on those of any part.
2. *Look up.* The corners of a layer are in order of angle, and so are the edges between them; a user's
   farthest corner is found by bisection. Scores fall off to either side, so n - 1 neighbours
   on each side, on each of n layers, are all that is scored: n (2n - 1) points for a user.
3. *Ties.* Equal points are one corner with its n smallest ids. Where the last neighbour that was
   scored, or the best of one layer more, ties with the end of the list, or the user has no
   direction, the exact search of ``bestitems`` answers.

Users do not move, and no pair of user and item is formed but these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators import bestitems
from affinity.workspace import Workspace

# Tasks whose points meet in one, and points that one task may be left with: more go the other way.
FAN_IN, MOST_POINTS = 16, 500_000


def hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Corners of the hull of different points in order of (x, y), counter-clockwise."""
    n = len(x)
    if n < 3:
        return np.arange(n)

    def chain(order) -> list[int]:
        out: list[int] = []
        for i in order:
            while len(out) > 1:
                a, b = out[-2], out[-1]
                if (x[b] - x[a]) * (y[i] - y[a]) - (y[b] - y[a]) * (x[i] - x[a]) > 0:
                    break
                out.pop()
            out.append(i)
        return out

    return np.array(chain(range(n))[:-1] + chain(range(n - 1, -1, -1))[:-1])


def peel(x: np.ndarray, y: np.ndarray, ids: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """The first ``n`` layers as (x, y, ids of each corner); of equal points the ``n`` smallest ids."""
    order = np.lexsort((ids, y, x))
    x, y, ids = x[order], y[order], ids[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(x))
    x, y = x[first], y[first]
    left, out = np.arange(len(x)), []
    while len(left) and len(out) < n:
        corners = left[hull(x[left], y[left])]
        out.append((x[corners], y[corners], [ids[a : min(b, a + n)] for a, b in zip(first[corners], ends[corners], strict=True)]))
        left = np.setdiff1d(left, corners, assume_unique=True)
    return out


def _keep(n: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame])
            layers = peel(held["f0"].to_numpy(), held["f1"].to_numpy(), held["movieId"].to_numpy(), n)
            rows = [(i, a, b) for x, y, ids in layers for a, b, own in zip(x, y, ids, strict=True) for i in own]
            held = pd.DataFrame(rows, columns=["movieId", "f0", "f1"])
        if held is not None:
            yield held.astype({"movieId": "int32", "f0": "float64", "f1": "float64"})

    return run


def outer(workspace: Workspace, items: DataFrame, n: int, name: str = "layers") -> DataFrame | None:
    """The items on the first ``n + 1`` layers, or none if they are more than ``MOST_POINTS``."""
    schema = "movieId int, f0 double, f1 double"
    rows = items.select("movieId", "f0", "f1").filter("not (isnan(f0) or isnan(f1))")
    found = workspace.write(f"{name}_0", rows.mapInPandas(_keep(n + 1), schema))
    tasks, step = max(1, len(found.inputFiles())), 0
    while tasks > 1:
        tasks, step = -(-tasks // FAN_IN), step + 1
        if tasks == 1 and found.count() > MOST_POINTS:
            return None
        dealt = found.repartition(tasks, F.xxhash64("movieId")) if tasks > 1 else found.coalesce(1)
        found = workspace.write(f"{name}_{step}", dealt.mapInPandas(_keep(n + 1), schema))
    return found if found.count() <= MOST_POINTS else None


class Angles:
    """Layers whose corners are found by direction."""

    def __init__(self, layers: list, n: int):
        self.n, self.layers = n, []
        for x, y, ids in layers:
            # The corner k is farthest from the normal of the edge before it to that of the edge after it.
            normals = np.arctan2(-(np.roll(x, -1) - x), np.roll(y, -1) - y)  # of the edge after each corner
            turn = int(np.argmin(normals)) if len(x) > 1 else 0
            names = np.full((len(x), n), np.iinfo(np.int64).max)
            for i, own in enumerate(ids):
                names[i, : len(own[:n])] = own[:n]
            self.layers.append((np.roll(normals, -turn), turn, x, y, names))

    def corners(self, angle: np.ndarray, layer: int) -> np.ndarray:
        normals, turn, x, _, _ = self.layers[layer]
        return (np.searchsorted(normals, angle) + turn) % len(x)

    def search(self, users: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, ids, sure) of the best items; not ``sure`` where a tie may reach further."""
        n = self.n
        angle = np.arctan2(users[:, 1], users[:, 0])
        # Rounded scores of points that were the last to be looked at, on either side of a layer.
        last = np.full(len(users), -np.inf)
        best = np.full((len(users), n), -np.inf)
        found = np.full((len(users), n), np.iinfo(np.int64).max)
        for number, (_, _, x, y, names) in enumerate(self.layers):
            at = self.corners(angle, number)
            reach = n - 1 if len(x) > 2 * n - 1 else len(x)  # short layers are scored whole
            near = (at[:, None] + np.arange(-reach, reach + 1)) % len(x) if reach == n - 1 else np.broadcast_to(
                np.arange(len(x)), (len(users), len(x))
            )
            score = np.zeros(near.shape)
            score += users[:, :1] * x[near]
            score += users[:, 1:] * y[near]
            if number == n:  # one layer more than needed: nothing within it scores higher
                last = np.maximum(last, np.round(score.max(axis=1), bestitems.DIGITS))
            elif reach == n - 1:
                last = np.maximum(last, np.round(np.maximum(score[:, 0], score[:, -1]), bestitems.DIGITS))
            each = np.repeat(score, n, axis=1)
            ids = names[near].reshape(len(users), -1)
            each[ids == np.iinfo(np.int64).max] = -np.inf
            best, found = bestitems.merged(np.concatenate([best, each], axis=1), np.concatenate([found, ids], axis=1), n)
        sure = (last < np.round(best[:, n - 1], bestitems.DIGITS)) & (np.abs(users).max(axis=1) > 0)
        return best, found, sure


def _look_up(sent, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            users = np.stack([batch[c].to_numpy(zero_copy_only=False) for c in ("f0", "f1")], axis=1)
            best, ids, sure = sent.value.search(users)
            there = best > -np.inf
            yield pa.RecordBatch.from_arrays(
                [batch["userId"], batch["f0"], batch["f1"],
                 pa.array([i[t].astype(np.int32) for i, t in zip(ids, there, strict=True)], pa.list_(pa.int32())),
                 pa.array([b[t] for b, t in zip(best, there, strict=True)], pa.list_(pa.float64())), pa.array(sure)],
                names=["userId", "f0", "f1", "ids", "scores", "sure"],
            )

    return run


def for_users(workspace: Workspace, model, users: DataFrame | None = None, n: int = 5, name: str = "angles") -> DataFrame:
    """(userId, rank, movieId, rating) of the given users, or of all, for a model of rank 2.

    The same lists as :func:`bestitems.for_users`, in the same order.
    """
    points = outer(workspace, model.items, n, f"{name}_layers")
    if points is None:
        return bestitems.for_users(workspace, model, users, n, name=f"{name}_search")
    wanted = model.users
    if users is not None:
        wanted = wanted.join(users.select("userId").distinct(), "userId", "left_semi")
    rows = points.toPandas()  # MOST_POINTS rows at most
    layers = peel(rows["f0"].to_numpy(np.float64), rows["f1"].to_numpy(np.float64), rows["movieId"].to_numpy(np.int64), n + 1)
    sent = workspace.spark.sparkContext.broadcast(Angles(layers, n))
    found = workspace.write(
        f"{name}_found",
        wanted.select("userId", "f0", "f1").mapInArrow(
            _look_up(sent, n), "userId int, f0 double, f1 double, ids array<int>, scores array<double>, sure boolean"
        ),
    )
    out = found.filter("sure").select("userId", "ids", "scores")
    unsure = found.filter("not sure")
    if unsure.head(1):
        rest = bestitems.lists(
            workspace, unsure.select("userId", "f0", "f1"), model.items, ["f0", "f1"], n, name=f"{name}_rest"
        )
        out = out.union(rest.select("userId", "ids", "scores"))
    return bestitems.exploded(out)
