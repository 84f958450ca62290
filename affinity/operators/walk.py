"""Sums over rows with the factors of both their keys, where these are too many to broadcast.

Every id has a block, by hash. Rows are laid out once, in a folder for each block of their key, and
sorted in it by the block of the other key. Factors are written in a folder for each block. A
task takes one block of rows and walks through it: it opens one block of the other side's factors after the
other from the shared folder, adds up its own keys, and hands over their sums. So a step shuffles
nothing and broadcasts nothing; it writes each factor once. A task holds one block of factors of either
side and the sums of its own keys. Every task reads all factors of the other side: there are at
most ``MOST_BLOCKS`` tasks or as many as the cluster has cores, so reading grows no faster than the factors.

A key with more rows than a group may hold is split by the other key, and its parts are added up
by a grouping, which then shuffles the sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.config import GROUP_ROWS
from affinity.workspace import Workspace

# Blocks beyond the number of cores: more rows make larger blocks, which are streamed.
MOST_BLOCKS = 64
# Rows that a task looks at together.
ROWS = 100_000
# Sums that a task keeps before it adds those of equal keys.
PENDING = 4_000_000
# Stands in for a null id inside a task; no factor has it.
NO_ID = -(1 << 62)


def number_of_blocks(workspace: Workspace, rows: int, group_rows: int = GROUP_ROWS) -> int:
    cores = workspace.spark.sparkContext.defaultParallelism
    return max(cores, min(MOST_BLOCKS, -(-rows // group_rows)))


@dataclass(frozen=True)
class Rows:
    """Rows (key, other, *values) in a folder for each block of ``key``, sorted by the block of ``other``."""

    spark: SparkSession
    path: str
    kind: str  # the type of the key
    key: str
    other: str
    values: tuple[str, ...]
    blocks: int
    split: bool


@dataclass(frozen=True)
class Folder:
    """Where factors lie, in a folder for each block of ``key``; what tasks know of them."""

    path: str
    key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Factors:
    """Factors by blocks."""

    table: DataFrame
    folder: Folder

    @property
    def key(self) -> str:
        return self.folder.key

    @property
    def columns(self) -> tuple[str, ...]:
        return self.folder.columns


def block_of(key: str, blocks: int):
    return F.pmod(F.hash(key), F.lit(blocks))


def lay_out(
    workspace: Workspace, name: str, rows: DataFrame, key: str, other: str, blocks: int, group_rows: int | None = None
) -> Rows:
    """Write ``rows``; with ``group_rows``, larger keys are split, and their own factors cannot be asked for."""
    values = tuple(c for c in rows.columns if c not in (key, other))
    kind, split = dict(rows.dtypes)[key], False
    rows = rows.withColumns({"_from": block_of(other, blocks), "_at": block_of(key, blocks)})
    if group_rows:
        sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > group_rows)
        hot = workspace.write(f"{name}_hot", sizes.select(key, F.ceil(F.col("_n") / group_rows).cast("int").alias("_parts")))
        if hot.head(1):
            parts = F.coalesce("_parts", F.lit(1))
            part = F.pmod(F.xxhash64(other), parts)
            rows = rows.join(hot, key, "left").withColumn("_at", F.pmod(F.col("_at") + part, F.lit(blocks)).cast("int")).drop("_parts")
            split = True
    path = workspace.path(name)
    own = [F.coalesce(F.col(c).cast("long"), F.lit(NO_ID)).alias(to) for c, to in ((key, "_key"), (other, "_other"))]
    (
        rows.select("_at", "_from", *own, *values)
        .repartitionById(blocks, "_at")
        .sortWithinPartitions("_at", "_from", "_other")
        .write.mode("overwrite")
        .partitionBy("_at")
        .parquet(path)
    )
    return Rows(workspace.spark, path, kind, key, other, values, blocks, split)


def write(workspace: Workspace, name: str, factors: DataFrame, key: str, blocks: int) -> Factors:
    """Write ``factors(key, ...)``, one row per key, by their blocks."""
    path, columns = workspace.path(name), tuple(c for c in factors.columns if c != key)
    rows = factors.withColumn("_block", block_of(key, blocks))
    rows.write.mode("overwrite").partitionBy("_block").parquet(path)
    table = workspace.spark.read.schema(rows.schema).parquet(path).drop("_block")
    return Factors(table, Folder(path, key, columns))


def _open(path: str) -> ds.Dataset | None:
    """The files of a block, if it has any."""
    system, inside = fs.FileSystem.from_uri(path)
    if system.get_file_info(inside).type == fs.FileType.NotFound:
        return None
    return ds.dataset(inside, filesystem=system, format="parquet")


def _load(factors: Folder, block: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ids, columns) of a block, by rising id."""
    files = _open(f"{factors.path}/_block={block}")
    if files is None:
        return np.zeros(0, np.int64), [np.zeros(0)] * len(factors.columns)
    table = files.to_table(columns=[factors.key, *factors.columns], use_threads=False)
    table = table.filter(pa.compute.is_valid(table[factors.key]))
    ids = table[factors.key].to_numpy().astype(np.int64)
    order = np.argsort(ids)
    return ids[order], [table[c].to_numpy()[order] for c in factors.columns]


class _Blocks:
    """The block of factors that is open, and rows looked up in it."""

    def __init__(self, factors: Folder | None):
        self.factors, self.block = factors, None

    def find(self, block: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the ids are there, their places)."""
        if self.factors is None:
            return np.ones(len(wanted), bool), np.zeros(len(wanted), np.int64)
        if block != self.block:
            self.ids, self.columns = _load(self.factors, block)
            self.block = block
        if not len(self.ids):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        return self.ids[at] == wanted, at

    def take(self, at: np.ndarray) -> list[np.ndarray]:
        return [] if self.factors is None else [c[at] for c in self.columns]


class _Sums:
    """Sums by key; a sum that saw nothing but nulls is null."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pending, self.limit = 0, PENDING

    def add(self, keys: np.ndarray, terms: np.ndarray, seen: np.ndarray | None = None) -> None:
        """``terms`` (sums, rows); NaN is a null unless ``seen`` tells."""
        if seen is None:
            null = np.isnan(terms)
            seen, terms = ~null, (np.where(null, 0.0, terms) if null.any() else terms)
        unique, at = np.unique(keys, return_inverse=True)
        total = np.stack([np.bincount(at, t, len(unique)) for t in terms])
        if seen.all():
            seen = np.ones(total.shape, bool)
        else:
            seen = np.stack([np.bincount(at, s, len(unique)) > 0 for s in seen])
        self.parts.append((unique, total, seen))
        self.pending += total.size
        if self.pending > self.limit:
            self.merge()
            self.limit = max(PENDING, 2 * self.pending)

    def merge(self) -> None:
        parts, self.parts, self.pending = self.parts, [], 0
        if len(parts) > 1:
            self.limit = np.inf
            self.add(*(np.concatenate(p, axis=-1) for p in zip(*parts, strict=True)))
        else:
            self.parts, self.pending = parts, sum(t.size for _, t, _ in parts)


# (values of the rows, own factors, the other side's factors) to the terms of every sum
Terms = Callable[[list[np.ndarray], list[np.ndarray], list[np.ndarray]], Sequence[np.ndarray]]


def sums(rows: Rows, names: Sequence[str], terms: Terms, other: Factors | None, own: Factors | None = None, by_key: bool = True) -> DataFrame:
    """(key, *names): the sums of ``terms`` by key, or per task without keys.

    Rows without factors, on a side that is given, are left out.
    """
    if own and rows.split:
        raise ValueError("rows of split keys have no factors of their own at hand")

    own_folder, other_folder = (side and side.folder for side in (own, other))
    path, columns = rows.path, ["_key", "_other", "_from", *rows.values]

    def block_sums(number: int) -> Iterator[pa.RecordBatch]:
        files = _open(f"{path}/_at={number}")
        if files is None:
            return
        found, mine, theirs = _Sums(), _Blocks(own_folder), _Blocks(other_folder)
        read = {"use_threads": False, "batch_readahead": 1, "fragment_readahead": 1}
        for batch in files.to_batches(columns=columns, batch_size=ROWS, **read):
            key, there, block = (batch[i].to_numpy() for i in range(3))
            values = [c.to_numpy(zero_copy_only=False) for c in batch.columns[3:]]
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1), len(block)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                here, place = theirs.find(int(block[low]), there[low:high])
                also, own_place = mine.find(number, key[low:high])
                keep = here & also
                if not keep.any():
                    continue
                part = terms([v[low:high][keep] for v in values], mine.take(own_place[keep]), theirs.take(place[keep]))
                keys = key[low:high][keep]
                found.add(keys if by_key else np.zeros(len(keys), np.int64), np.stack(part).astype(np.float64))
        found.merge()
        for key, total, seen in found.parts:
            arrays = [pa.array(key)] + [pa.array(t, mask=~s) for t, s in zip(total, seen, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["_key", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch["id"].to_pylist():
                yield from block_sums(number)

    # One task for each block.
    out = rows.spark.range(0, rows.blocks, 1, rows.blocks).mapInArrow(run, "_key long, " + ", ".join(f"{c} double" for c in names))
    if not by_key:
        return out.select(*names)
    if rows.split:
        out = out.groupBy("_key").agg(*[F.sum(c).alias(c) for c in names])
    return out.select(F.nullif("_key", F.lit(NO_ID)).cast(rows.kind).alias(rows.key), *names)


def products(wanted: dict[str, tuple[str, tuple[int, ...]]]) -> tuple[list[str], Terms]:
    """Sums of n or s times factors of the other side, for rows with the values (n, s): {name: ("n", (0, 1))}."""
    spec = [(("n", "s").index(value), columns) for value, columns in wanted.values()]

    def terms(values, own, other):
        out = []
        for value, columns in spec:
            term = values[value].astype(np.float64)
            for c in columns:
                if other:
                    term = term * other[c]
            out.append(term)
        return out

    return list(wanted), terms


class Steps:
    """Pairs (userId, movieId, n, s) laid out by either key, for the half-steps of a fit."""

    def __init__(self, workspace: Workspace, name: str, pairs: DataFrame, total: int, group_rows: int):
        self.workspace, self.name = workspace, name
        self.blocks = number_of_blocks(workspace, total, group_rows)
        pairs = pairs.select("userId", "movieId", "n", "s")
        self.rows = {
            key: lay_out(workspace, f"{name}/walk_{key}", pairs, key, other, self.blocks, group_rows)
            for key, other in (("userId", "movieId"), ("movieId", "userId"))
        }

    def write(self, part: str, factors: DataFrame, key: str) -> Factors:
        return write(self.workspace, f"{self.name}/{part}", factors, key, self.blocks)

    def half(self, key: str, other: Factors | None, wanted: dict[str, tuple[str, tuple[int, ...]]]) -> DataFrame:
        """Sums of the pairs of every ``key``; without ``other``, the other side's factors are all 1."""
        return sums(self.rows[key], *products(wanted), other)


@dataclass(frozen=True)
class Walked:
    """Both sides' factors of a fit by blocks, and where rows are laid out to meet them."""

    workspace: Workspace
    users: Factors
    items: Factors
    blocks: int
    name: str

    def lay_out(self, rows: DataFrame) -> Rows:
        """Rows (userId, movieId, ...) by user."""
        name = f"{self.name}_{uuid.uuid4().hex[:8]}"
        return lay_out(self.workspace, name, rows, "userId", "movieId", self.blocks)

    def sums(self, rows: Rows, names: Sequence[str], terms: Terms, by_key: bool = True) -> DataFrame:
        return sums(rows, names, terms, self.items, self.users, by_key)
