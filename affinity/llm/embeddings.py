"""Near-duplicate embeddings by cross-polytope hashing.

Equal vectors are one *class*, known by its smallest vec_id; what follows deals with classes and
counts their members, so that copies are never compared with one another.

A table of the index turns vectors by fast Hadamard rotations (three times: random signs, then
the Hadamard transform) and hashes them to the nearest of the 2 d signed axes, for each of k
functions. A vector is stored in the bucket of its axes, and looks for partners there and in
the buckets that differ in one axis and nearly fit as well (multiprobe).

All cosines within a bucket are computed exactly; a pair counts where it meets first: each
vector carries its buckets in all tables, so no list of pairs is kept to find repeated ones.
What leaves a task is a count per vector and a spanning forest of its links. A bucket that is
too large for a task is cut into blocks, and every pair of blocks is a task of its own.

More functions make buckets small and pairs meet in fewer tables, so the number of tables
follows from the share of random pairs, at just the least cosine, that meet in one table.

Recall at cosine 0.9 and more is measured against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import worker
from affinity.llm.common import components, partitions, small, workspace

# Tables at least, and probes of each.
TABLES, PROBES = 10, 4
# Share of pairs at the least cosine that may meet in no table, and random pairs it is measured on.
MISSED, PAIRS = 0.01, 1_000
# With more tables than this, functions are left out: buckets grow, and no pair is lost.
MOST_TABLES = 100
# Next best axes of a function that probes are chosen from.
NEXT_AXES = 4
# Vectors of a bucket that one task compares with one another.
BLOCK = 2_000
# Classes of several members that may be broadcast, with their vectors.
BROADCAST_CLASSES = 20_000
SEED = 20_231
_ROWS = "width int, tab int, bucket long, probe int, vec_id long, members long, vector binary, codes binary"


def unit(rows: np.ndarray) -> np.ndarray:
    """The rows as doubles of norm 1; scaled first, so that no square is too large or too small."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the rows, scaled to keep their norms."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def functions_for(rows: int, d: int) -> int:
    """Functions per table, so that unlike vectors meet in buckets of a few rows each."""
    k = 1
    while (2 * d) ** k < rows / 4:
        k += 1
    return k


def probe_codes(x: np.ndarray, tables: int, probes: int, k: int, seed: int = SEED) -> np.ndarray:
    """Buckets (rows x tables x probes) of unit vectors; the first probe is the own bucket."""
    n, width = x.shape
    d = 1 << max(width - 1, 0).bit_length()
    padded = np.zeros((n, d))
    padded[:, :width] = x
    next_axes = min(NEXT_AXES, 2 * d - 1)
    out = np.zeros((n, tables, probes), np.int64)
    for t in range(tables):
        random = np.random.default_rng([seed, d, t])
        axes, loss = [], []
        for _ in range(k):
            y = padded
            for _ in range(3):
                y = hadamard(y * random.choice([-1.0, 1.0], d))
            both = np.concatenate([y, -y], axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, : next_axes + 1]
            value = np.take_along_axis(both, best, axis=1)
            axes.append(best)
            loss.append((value[:, :1] - value[:, 1:]) ** 2)
        power = (2 * d) ** np.arange(k)
        own = sum(a[:, 0] * p for a, p in zip(axes, power, strict=True))
        other = np.concatenate(
            [own[:, None] + (a[:, 1:] - a[:, :1]) * p for a, p in zip(axes, power, strict=True)], axis=1
        )
        order = np.argsort(np.concatenate(loss, axis=1), axis=1, kind="stable")[:, : probes - 1]
        out[:, t, 0] = own
        # Fewer alternatives than probes: the own bucket again, which changes nothing.
        out[:, t, 1:] = own[:, None]
        out[:, t, 1 : 1 + order.shape[1]] = np.take_along_axis(other, order, axis=1)
    return out


def pairs_at(cosine: float, n: int, width: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """``n`` random pairs of unit vectors with just this cosine; of one number, equal vectors."""
    random = np.random.default_rng([seed, width])
    x, y = random.standard_normal((2, n, width))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    if width == 1:
        return x, x
    y -= (x * y).sum(axis=1)[:, None] * x
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * y


def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By pair and table, whether one of two vectors looks into the other's bucket."""
    return (a == b[:, :, :1]).any(axis=2) | (b == a[:, :, :1]).any(axis=2)


@cache
def tables_for(least: float, width: int, k: int, probes: int, missed: float = MISSED) -> int:
    """Tables in which all but ``missed`` of the pairs at cosine ``least`` meet."""
    x, y = pairs_at(min(max(least, -1.0), 1.0), max(200, min(PAIRS, (1 << 18) // width)), width)
    met = meet(*(probe_codes(v, TABLES, probes, k) for v in (x, y)))
    # Half a pair more or less, so that the share is neither none nor all.
    share = min(max(met.sum(), 0.5), met.size - 0.5) / met.size
    return max(1, int(np.ceil(np.log(missed) / np.log1p(-share))))


def layout(rows: int, width: int, least: float, tables: int | None, probes: int) -> tuple[int, int]:
    """(functions, tables) for so many vectors; ``tables`` as given, or as many as are needed."""
    k = functions_for(rows, 1 << max(width - 1, 0).bit_length())
    if tables is not None:
        return k, tables
    while k > 1 and tables_for(least, width, k, probes) > MOST_TABLES:
        k -= 1
    return k, max(TABLES, tables_for(least, width, k, probes))


def _hash(probes: int, layouts: dict[int, tuple[int, int]]):
    # Every table holds a copy of each vector.
    at_once = max(1, 1_000 * TABLES // max(tables for _, tables in layouts.values()))

    @worker.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                batch = whole.slice(at, at_once)
                ids, members = batch["vec_id"].to_numpy(), batch["members"].to_numpy()
                lists = batch["embedding"]
                widths = np.diff(np.asarray(lists.offsets))
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(widths)
                for width in np.unique(widths).tolist():
                    own = np.flatnonzero(widths == width)
                    rows = flat[(ends[own] - width)[:, None] + np.arange(width)]
                    functions, tables = layouts[width]
                    codes = probe_codes(unit(rows), tables, probes, functions)
                    vectors = [r.tobytes() for r in rows]
                    packed = [c.tobytes() for c in codes]
                    n = len(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n * tables * probes, width), pa.int32()),
                         pa.array(np.tile(np.repeat(np.arange(tables), probes), n), pa.int32()),
                         pa.array(codes.reshape(-1), pa.int64()),
                         pa.array(np.tile(np.arange(probes), n * tables), pa.int32()),
                         pa.array(np.repeat(ids[own], tables * probes), pa.int64()),
                         pa.array(np.repeat(members[own], tables * probes), pa.int64()),
                         pa.array([v for v in vectors for _ in range(tables * probes)], pa.binary()),
                         pa.array([c for c in packed for _ in range(tables * probes)], pa.binary())],
                        names=[f.split()[0] for f in _ROWS.split(", ")],
                    )

    return run


def _compare(probes: int, kind, least: float):
    """Links of one bin: (a, b, n) with a partner in the forest, or a null b and a count of members."""

    @worker.lean
    def run(table: pa.Table) -> pa.Table:
        cell = [table[c].to_numpy() for c in ("width", "tab", "bucket", "row_block", "own_block")]
        ids, probe = table["vec_id"].to_numpy(), table["probe"].to_numpy()
        members = table["members"].to_numpy()
        stored = table["stored"].to_numpy(zero_copy_only=False).astype(bool)
        vectors, codes = table["vector"].to_pylist(), table["codes"].to_pylist()
        order = np.lexsort((ids, *cell))
        new = np.ones(len(order), bool)
        new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in cell], axis=0)
        limits = np.append(np.flatnonzero(new), len(order))
        found: list[tuple[int, int]] = []
        counts: dict[int, int] = {}
        for begin, end in zip(limits[:-1], limits[1:], strict=True):
            rows = order[begin:end]
            asks, own = rows[~stored[rows]], rows[stored[rows]]
            if len(own) == 0 or len(asks) == 0:
                continue
            t = int(cell[1][rows[0]])
            a, b = (unit(np.stack([np.frombuffer(vectors[i], kind) for i in x])) for x in (asks, own))
            code_a, code_b = (
                np.stack([np.frombuffer(codes[i], np.int64) for i in x]).reshape(len(x), -1, probes)
                for x in (asks, own)
            )
            x, y = np.nonzero(a @ b.T >= least)
            # A repeated probe, or the vector itself, is no pair.
            good = ids[asks[x]] != ids[own[y]]
            x, y = x[good], y[good]
            for u in range(t + 1):
                met = (code_a[x, u] == code_b[y, u, :1]).any(axis=1)
                back = (code_b[y, u] == code_a[x, u, :1]).any(axis=1)
                if u < t:
                    good = ~(met | back)
                else:
                    # Both will ask for each other: the smaller id does.
                    good = ~back | (ids[asks[x]] < ids[own[y]])
                    first = (code_a[x, u] == code_b[y, u, :1]).argmax(axis=1)
                    good &= probe[asks[x]] == first
                x, y = x[good], y[good]
            root = {}

            def find(i: int, root=root) -> int:
                while root.setdefault(i, i) != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            many = zip(members[asks[x]].tolist(), members[own[y]].tolist(), strict=True)
            for p, q, (m, n) in zip(ids[asks[x]].tolist(), ids[own[y]].tolist(), many, strict=True):
                counts[p] = counts.get(p, 0) + n
                counts[q] = counts.get(q, 0) + m
                r, s = find(p), find(q)
                if r != s:
                    root[max(r, s)] = min(r, s)
                    found.append((p, q))
        return pa.table(
            {
                "a": pa.array([p for p, _ in found] + list(counts), pa.int64()),
                "b": pa.array([q for _, q in found] + [None] * len(counts), pa.int64()),
                "n": pa.array([0] * len(found) + list(counts.values()), pa.int64()),
            }
        )

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """Vectors with an id that have a direction: no null or non-finite component, not zero."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad & some)


def near_duplicates(
    vectors: DataFrame, least: float = 0.9, tables: int | None = None, probes: int = PROBES
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors(vec_id, embedding)``.

    Pairs that the index finds link if their cosine, in double precision, is ``least`` or
    more. Without ``tables`` there are so many that about a hundredth of the pairs at just ``least``
    is missed, whatever the number of rows. ``n_links`` counts the other vec_ids linked directly, ``component_id`` is the
    smallest that links lead to, and the vector with that id is kept. Only vectors of equal
    length are compared; numbers of any size are, as vectors are scaled before they are squared.
    Equal vectors link whatever the index finds; ``least`` is 1 at most.

    Null, empty and zero vectors, and those with a null or non-finite component, link with
    nothing, and so do rows without a vec_id, whose component is null and which are kept.
    Of rows that repeat a vec_id one is indexed, and all get its result. An empty table gives
    an empty result; other columns are not read.
    """
    if least > 1:
        raise ValueError("no cosine is above 1")
    spark = vectors.sparkSession
    work = workspace(spark)
    rows = vectors.select("vec_id", "embedding")
    one = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    found = work.write("vectors", usable(one).dropDuplicates(["vec_id"]))
    classes = found.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("members"))
    own = work.write("classes", classes)
    sizes = own.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not sizes:
        links = spark.createDataFrame([], "a long, b long, n long")
    else:
        layouts = {s.d: layout(s.n, s.d, least, tables, probes) for s in sizes}
        hashed = work.write("hashed", own.mapInArrow(_hash(probes, layouts), _ROWS))
        bucket = ["width", "tab", "bucket"]
        per_bucket = hashed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"))
        full = work.write(
            "full",
            per_bucket.filter(F.col("n") > BLOCK)
            .select(*bucket, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")),
        )
        dealt = hashed.join(small(full, full.count()), bucket, "left").withColumn(
            "blocks", F.coalesce("blocks", F.lit(1))
        )
        block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        asking = dealt.select("*", F.lit(False).alias("stored"), block.alias("row_block"), every.alias("own_block"))
        stored = dealt.filter("probe = 0").select(
            "*", F.lit(True).alias("stored"), every.alias("row_block"), block.alias("own_block")
        )
        n = partitions(spark)
        cell = F.xxhash64(*bucket, "row_block", "own_block")
        kind = {"float": np.float32}.get(own.schema["embedding"].dataType.elementType.simpleString(), np.float64)
        links = work.write(
            "links",
            asking.union(stored)
            .drop("blocks")
            .withColumn("bin", F.pmod(cell, F.lit(8 * n)).cast("int"))
            .groupBy("bin")
            .applyInArrow(_compare(probes, kind, least), "a long, b long, n long"),
        )
    # What a class has, all its members have, and each other besides.
    repeated = own.filter("members > 1")
    n_repeated = repeated.count()
    of_class = found.join(
        small(repeated.select("embedding", F.col("vec_id").alias("rep"), "members"), n_repeated, BROADCAST_CLASSES),
        "embedding", "left",
    ).select("vec_id", F.coalesce("rep", "vec_id").alias("rep"), F.coalesce("members", F.lit(1)).alias("members"))
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n")).filter("n > 0")
    linked = components(work, "components", links.filter("b is not null").select("a", "b"))
    linked = linked.withColumnRenamed("id", "rep")
    facts = work.write("facts", counts.join(linked, "rep", "full"))
    n_facts = facts.count()
    linked = of_class.join(small(facts, n_facts), "rep", "left").select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    ).filter("n_links > 0")
    out = rows.select("vec_id").join(linked, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
