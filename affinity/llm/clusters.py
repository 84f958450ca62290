"""Centroid clustering of integer vectors over subvector dictionaries.

Vectors are turned into integers. Their dimensions are cut into blocks, and each block has a
*dictionary*: the distinct subvectors that occur there, each with a code. A vector is then a
list of codes, which loses nothing. In every round the squared distances of all dictionary
entries to all centroids are computed once, exactly; the distance of a vector is the sum of
what its codes look up. Sums per cluster leave a task as one row each.

Adjacent dimensions share a block as long as their subvectors stay few (``BLOCK_ENTRIES``); so
dimensions of two values go ten or more to a block, and those of some hundred values stand alone. All
dictionaries together have at most ``ENTRIES`` entries, which bounds what is sent to the
executors; dimensions of more values than that allows keep their numbers in place of a code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import worker
from affinity.llm.common import workspace

# Fixed values of the contract: length, scale, number of centroids, rounds and start.
WIDTH, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
# Entries of one dictionary of several dimensions, and of all dictionaries.
BLOCK_ENTRIES, ENTRIES = 4_096, 100_000
# Largest number that a component may become: squared distances then fit into 64 bits.
MOST = 1 << 27
# Vectors whose distances are summed at once, and distinct values a task gathers before it sends them.
AT_ONCE, HELD = 4_096, 100_000


def kept(vectors: DataFrame, width: int) -> DataFrame:
    """(vec_id, embedding) of the vectors of ``width`` finite numbers."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select("vec_id", "embedding").filter(F.size("embedding") == width).filter(~bad)
    return rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))


def integers(column, width: int, scale: float) -> np.ndarray:
    """Rows of floor(scale * x); what is too large for exact distances becomes just too large."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * flat), -MOST - 1, MOST + 1).astype(np.int64)


def _values(width: int, scale: float):
    """(dim, value): the distinct values of each dimension that a task meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * width

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(width), [len(h) for h in held]), pa.int32()),
                 pa.array(np.concatenate(held), pa.int64())],
                names=["dim", "value"],
            )

        for batch in batches:
            x = integers(batch["embedding"], width, scale)
            held = [np.union1d(h, x[:, i]) for i, h in enumerate(held)]
            if sum(map(len, held)) > HELD:
                yield out()
                held = [np.zeros(0, np.int64)] * width
        yield out()

    return run


def blocks_of(sizes: list[int], most: int = BLOCK_ENTRIES) -> list[tuple[int, int]]:
    """Ranges of dimensions whose values, multiplied, are at most ``most``; one dimension at least."""
    out, begin, product = [], 0, 1
    for i, size in enumerate(sizes):
        if i > begin and product * size > most:
            out.append((begin, i))
            begin, product = i, 1
        product *= size
    return [*out, (begin, len(sizes))] if sizes else []


class Dictionary:
    """Blocks of the coded dimensions, their distinct subvectors, and the dimensions without codes."""

    def __init__(self, values: dict[int, np.ndarray], width: int):
        self.dims = np.array(sorted(values), np.int64)
        self.raw = np.setdiff1d(np.arange(width), self.dims)
        self.values = [values[d] for d in self.dims.tolist()]
        self.blocks = blocks_of([len(v) for v in self.values])
        # By block, the numbers of the subvectors that occur; at first all that could.
        self.entries = [np.arange(np.prod([len(v) for v in self.values[a:b]], dtype=np.int64)) for a, b in self.blocks]

    def numbers(self, x: np.ndarray, block: int) -> np.ndarray:
        """Subvectors of a block as mixed-radix numbers of their values' places."""
        a, b = self.blocks[block]
        out = np.zeros(len(x), np.int64)
        for i in range(a, b):
            out = out * len(self.values[i]) + np.searchsorted(self.values[i], x[:, self.dims[i]])
        return out

    def subvectors(self, block: int) -> np.ndarray:
        """The entries of a block as rows of numbers."""
        a, b = self.blocks[block]
        left, columns = self.entries[block], []
        for i in range(b - 1, a - 1, -1):
            columns.append(self.values[i][left % len(self.values[i])])
            left = left // len(self.values[i])
        return np.stack(columns[::-1], axis=1)

    def wide(self) -> list[int]:
        return [i for i, (a, b) in enumerate(self.blocks) if b - a > 1]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes by block, then the dimensions without codes."""
        codes = [np.searchsorted(e, self.numbers(x, i)) for i, e in enumerate(self.entries)]
        return np.stack([*codes, *x[:, self.raw].T], axis=1).astype(np.int32)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), len(self.dims) + len(self.raw)), np.int64)
        for i, (a, b) in enumerate(self.blocks):
            out[:, self.dims[a:b]] = self.subvectors(i)[codes[:, i]]
        out[:, self.raw] = codes[:, len(self.blocks) :]
        return out

    def distances(self, centroids: np.ndarray) -> list[np.ndarray]:
        """By block, the squared distance of every entry to every centroid."""
        out = []
        for i, (a, b) in enumerate(self.blocks):
            away = self.subvectors(i)[:, None, :] - centroids[None, :, self.dims[a:b]]
            out.append((away * away).sum(axis=2))
        return out


def _occurring(dictionary: Dictionary, width: int, scale: float):
    """(dim, value): the distinct subvectors of the blocks of several dimensions, as numbers."""
    wide = dictionary.wide()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        held = {i: np.zeros(0, np.int64) for i in wide}  # at most BLOCK_ENTRIES each
        for batch in batches:
            x = integers(batch["embedding"], width, scale)
            held = {i: np.union1d(h, dictionary.numbers(x, i)) for i, h in held.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(wide, [len(h) for h in held.values()]), pa.int32()),
             pa.array(np.concatenate([*held.values()]), pa.int64())],
            names=["dim", "value"],
        )

    return run


def dictionary_of(rows: DataFrame, width: int, scale: float, entries: int = ENTRIES) -> Dictionary:
    """The dictionary of all ``rows(embedding)``; two passes, the second for blocks of several dimensions."""
    work = workspace(rows.sparkSession)
    only = rows.select("embedding")
    found = work.write("values", only.mapInArrow(_values(width, scale), "dim int, value long").distinct())
    sizes = found.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("value")).alias("most")).collect()
    if any(s.most > MOST for s in sizes):
        raise ValueError(f"components beyond {MOST} / {scale:g} have no exact 64-bit distances")
    coded, total = [], 0
    for s in sorted(sizes, key=lambda s: (s.n, s.dim)):
        total += s.n
        if total <= entries:
            coded.append(s.dim)
    values: dict[int, list[int]] = {d: [] for d in coded}
    for r in found.filter(F.col("dim").isin(coded)).collect():  # ``entries`` rows at most
        values[r.dim].append(r.value)
    out = Dictionary({d: np.array(sorted(v), np.int64) for d, v in values.items()}, width)
    if out.wide():
        some = only.mapInArrow(_occurring(out, width, scale), "dim int, value long").distinct()
        occur: dict[int, list[int]] = {i: [] for i in out.wide()}
        for r in some.collect():  # BLOCK_ENTRIES rows a block at most
            occur[r.dim].append(r.value)
        for i, numbers in occur.items():
            out.entries[i] = np.array(sorted(numbers), np.int64)
    return out


def _encode(sent, width: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        for batch in batches:
            codes = sent.value.encode(integers(batch["embedding"], width, scale))
            packed = [c.tobytes() for c in codes]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(packed, pa.binary())], names=["vec_id", "codes"])

    return run


def nearest(
    dictionary: Dictionary, tables: list[np.ndarray], centroids: np.ndarray, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of coded vectors; of equally near ones the first."""
    total = np.zeros((len(codes), len(centroids)), np.int64)
    for i, table in enumerate(tables):
        total += table[codes[:, i]]
    for k, dim in enumerate(dictionary.raw.tolist()):
        away = codes[:, len(tables) + k].astype(np.int64)[:, None] - centroids[None, :, dim]
        total += away * away
    best = total.argmin(axis=1)
    return best, total[np.arange(len(codes)), best]


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    packed = batch["codes"]
    for at in range(0, len(packed), AT_ONCE):
        part = packed.slice(at, AT_ONCE).to_pylist()
        yield at, np.frombuffer(b"".join(part), np.int32).reshape(len(part), -1)


def _sums(sent, sent_round):
    """One row per cluster and task: its vectors, and their sum by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        dictionary, (tables, centroids) = sent.value, sent_round.value
        count = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for _, codes in _unpacked(batch):
                cluster, _ = nearest(dictionary, tables, centroids, codes)
                order = np.argsort(cluster, kind="stable")
                here, first = np.unique(cluster[order], return_index=True)
                sums[here] += np.add.reduceat(dictionary.decode(codes)[order], first, axis=0)
                count += np.bincount(cluster, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some], pa.int64()), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return run


def _assign(sent, sent_round):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker.release()
        dictionary, (tables, centroids) = sent.value, sent_round.value
        for batch in batches:
            for at, codes in _unpacked(batch):
                cluster, distance = nearest(dictionary, tables, centroids, codes)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].slice(at, len(codes)), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def first_centroids(rows: DataFrame, k: int, scale: float, seed: int) -> np.ndarray:
    """The ``k`` vectors of smallest sha256 of ``seed:vec_id``, as integers; of equal ids by their numbers."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    numbers = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x))
    some = rows.filter("vec_id is not null").select(hashed.alias("hash"), numbers.alias("numbers"))
    return np.array([r.numbers for r in some.orderBy("hash", "numbers").limit(k).collect()], np.int64)


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: float = SCALE,
    seed: int = SEED,
    entries: int = ENTRIES,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the kept vectors.

    Of ``vectors(vec_id, embedding)`` those with ``width`` components, none null or non-finite,
    are kept; others are not returned. Components become floor(scale * x). Centroids start as the
    ``k`` kept vectors that come first by the hash of seed and vec_id, or all if there are fewer. In
    each round vectors go to the nearest centroid, ties to the smaller number, and centroids that
    have vectors become their mean, rounded down; then vectors are assigned once more.

    A row without a vec_id is clustered and never a first centroid. Rows that repeat a vec_id are
    vectors of their own; equal vectors have equal results. Without any kept vector, or with none
    that has a vec_id, the result is empty. Numbers beyond 2**27 after scaling, whose distances
    64 bits would not hold, raise ``ValueError``. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, width)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    dictionary = dictionary_of(rows, width, scale, entries)
    centroids = first_centroids(rows, k, scale, seed)
    if not len(centroids):
        empty = f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    work = workspace(spark)
    sent = spark.sparkContext.broadcast(dictionary)
    coded = schema.split(",")[0] + ", codes binary"
    encoded = work.write("encoded", rows.mapInArrow(_encode(sent, width, scale), coded))
    for _ in range(rounds):
        this = spark.sparkContext.broadcast((dictionary.distances(centroids), centroids))
        sums = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        found = (
            encoded.mapInArrow(_sums(sent, this), "cluster int, n long, sums array<long>")
            .groupBy("cluster")
            .agg(F.sum("n").alias("n"), *sums)
            .collect()  # one row per centroid
        )
        centroids = centroids.copy()
        for r in found:
            centroids[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(width)]
        this.destroy()
    last = spark.sparkContext.broadcast((dictionary.distances(centroids), centroids))
    assigned = work.write("assigned", encoded.mapInArrow(_assign(sent, last), schema))
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(r.cluster_inertia for r in inertia)
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    facts = spark.createDataFrame(
        [(r.cluster, r.cluster_inertia, total, digest(centroids[r.cluster])) for r in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])
