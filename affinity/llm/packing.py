"""Best-fit packing of token sequences, in bulk-synchronous supersteps.

Pieces of one length are interchangeable, and so are sequences with equal free space. So the
state of a superstep is not a row per document but *runs*: "pieces number first to first + n
of this length", "sequences first to first + n with this gap". There are at most as many piece
runs as token positions in a sequence, and some times that many gap runs, whatever the corpus.

1. Pieces over half a sequence open one each, by prefix sums.
2. A superstep range-sorts piece and gap runs by size. Each range is swept from the largest
   size down: a piece run takes its successor, the smallest gap that holds it. Where a
   gap run is shorter than the piece run, or longer, the first ranks match and the rest goes
   on. What is left of a gap is a smaller gap: it stays in its range or moves to a lower
   one for the next superstep.
3. Each superstep has half as many ranges, so pieces meet larger gaps. In the last one there
   is a single range, and pieces that fit nowhere open sequences.

The pieces themselves move twice: to learn their rank among those of equal length (counts per
task and length, prefix sums over tasks, so a hot length is no hot group), and to be
returned with their place, joined on length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import worker
from affinity.llm.common import small, workspace
from affinity.llm.tokens import Encoder

CAPACITY = 2048
# Ranges of the first superstep.
RANGES = 4
BLOCK = 500
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
RUNS = "kind string, size int, first long, n long, sequence_id long, offset int"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first."""
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, head if s == 0 and head else capacity) for s in starts]


def _pieces(tokenizer: str, end_id: int, capacity: int):
    @worker.trimmed
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder.of(tokenizer), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                rows = []
                for doc_id, ids in zip(block.column(0).to_pylist(), encoder.each(block.column(1)), strict=True):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for number, (start, length) in enumerate(cut(len(ids), capacity)):
                        crc = zlib.crc32(ids[start : start + length].tobytes())
                        rows.append((doc_id, number, start, length, crc, task, met[length]))
                        met[length] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = [f.split()[0] for f in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                )

    return encode


def sweep(rows: list[tuple], lowest: int, opening: int | None, capacity: int) -> list[tuple]:
    """One best-fit sweep over the runs of a range; rows are as in RUNS.

    Returns placed runs, gap runs and piece runs. Gaps below ``lowest`` belong to other
    ranges. With ``opening``, pieces without a gap open sequences from that number on.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    out = []

    def put(gap: int, first: int, n: int) -> None:
        if gap < lowest:
            if gap:
                out.append(("gap", gap, first, n, None, None))
            return
        if gap not in gaps:
            insort(order, gap)
            gaps[gap] = []
        gaps[gap].append((first, n))

    for kind, size, first, n, *_ in rows:
        if kind == "gap":
            put(size, first, n)
    for _, size, first, n, *_ in sorted((r for r in rows if r[0] == "piece"), key=lambda r: (-r[1], r[2])):
        while n:
            at = bisect_left(order, size)
            if at == len(order):
                if opening is None:
                    out.append(("piece", size, first, n, None, None))
                    break
                new = -(-n // (capacity // size))
                put(capacity, opening, new)
                opening += new
                continue
            gap = order[at]
            base, room = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            taken = min(n, room)
            out.append(("placed", size, first, taken, base, capacity - gap))
            put(gap - size, base, taken)
            if taken < room:
                put(gap, base + taken, room - taken)
            first, n = first + taken, n - taken
    out += [("gap", g, first, n, None, None) for g, runs in gaps.items() for first, n in runs]
    return out


def _superstep(opening: int | None, capacity: int):
    names = [f.split()[0] for f in RUNS.split(", ")]

    @worker.lean
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [r for f in frames for r in f[names].itertuples(index=False, name=None)]
        rows = [(k, int(s), int(a), int(n), None, None) for k, s, a, n, *_ in rows]
        lowest = min((r[1] for r in rows), default=1) if opening is None else 1
        frame = pd.DataFrame(sweep(rows, lowest, opening, capacity), columns=names)
        yield frame.astype({"sequence_id": "Int64", "offset": "Int32"})

    return run


def plan(work, counts: DataFrame, capacity: int = CAPACITY, ranges: int = RANGES) -> DataFrame:
    """Placed runs (size, first, n, sequence_id, offset) for ``counts(size, n)`` of pieces."""
    over = counts.filter(F.col("size") * 2 > capacity)
    # At most capacity / 2 rows: one task sums them.
    before = F.sum("n").over(Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1))
    opened = work.write(
        "opened",
        over.select(
            "size", F.lit(0).cast("long").alias("first"), "n",
            F.coalesce(before, F.lit(0)).cast("long").alias("sequence_id"),
            F.lit(0).alias("offset"),
        ),
    )
    n_opened = opened.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    none = [F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("int").alias("offset")]
    state = (
        counts.filter(F.col("size") * 2 <= capacity)
        .select(F.lit("piece").alias("kind"), "size", F.lit(0).cast("long").alias("first"), "n", *none)
        .union(
            opened.filter(F.col("size") < capacity).select(
                F.lit("gap").alias("kind"), (F.lit(capacity) - F.col("size")).cast("int").alias("size"),
                F.col("sequence_id").alias("first"), "n", *none,
            )
        )
    )
    placed = opened
    while True:
        last = ranges <= 1
        dealt = state.coalesce(1) if last else state.repartitionByRange(ranges, "size")
        done = work.write(
            f"superstep_{ranges}",
            dealt.mapInPandas(_superstep(n_opened if last else None, capacity), RUNS),
        )
        placed = placed.union(
            done.filter("kind = 'placed'").select("size", "first", "n", "sequence_id", "offset")
        )
        if last:
            return placed
        state, ranges = done.filter("kind <> 'placed'"), ranges // 2


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, ranges: int = RANGES
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece's place.

    A document of ``docs(doc_id, text)`` is the ids of its text and ``end_id``; null text is
    empty, so every row has one id at least. Only documents over ``capacity`` are cut, into
    pieces of ``capacity`` ids of which the first may be shorter. Sequences are filled
    without gaps from offset 0 and hold at most ``capacity`` ids. Rows with a null or
    repeated doc_id are packed like any others. An empty table gives no rows; other columns
    are not read.
    """
    work = workspace(docs.sparkSession)
    pieces = work.write(
        "pieces", docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, end_id, capacity), PIECES)
    )
    per_task = work.write(
        "per_task", pieces.groupBy(F.col("length").alias("size"), "task").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = per_task.groupBy(F.col("size").cast("int").alias("size")).agg(F.sum("n").alias("n"))
    runs = work.write("runs", plan(work, counts, capacity, ranges))
    n_runs = runs.count()
    earlier = F.sum("n").over(
        Window.partitionBy("size").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = per_task.select(
        F.col("size").alias("length"), "task", F.coalesce(earlier, F.lit(0)).alias("base")
    )
    ranked = pieces.join(bases, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    where = (
        (F.col("length") == F.col("size"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("first") + F.col("n"))
    )
    return ranked.join(small(runs, n_runs), where).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence_id") + F.col("rank") - F.col("first")).alias("sequence_id"),
        F.col("offset").cast("long").alias("offset"),
    )


def sequences(
    docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 0
) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, for rows with different doc_ids."""

    @worker.trimmed
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                ids = [
                    np.append(x, np.uint32(end_id)).astype(np.int32)
                    for x in encoder.each(block["text"])
                ]
                yield pa.RecordBatch.from_arrays(
                    [block["doc_id"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    ids = docs.select("doc_id", "text").mapInArrow(spell, "doc_id long, ids array<int>")
    piece = F.struct("offset", F.slice("ids", F.col("start") + 1, F.col("length")).alias("part"))
    return (
        packed.join(ids, "doc_id")
        .groupBy("sequence_id")  # a group holds one sequence, so capacity ids at most
        .agg(F.sort_array(F.collect_list(piece)).alias("parts"))
        .select("sequence_id", F.flatten("parts.part").alias("ids"))
    )
