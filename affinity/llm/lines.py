"""Line dedup: two Bloom filters choose the lines whose keys are counted exactly.

1. Every task sets the bits of its lines' keys. A bit is *once* if it was set, and *twice* if
   it was set for two documents. Tasks send bit positions, not keys; they meet by slice of the
   filter: twice = twice of a task, or once of two tasks.
2. A key held by two documents has all its bits in the twice filter. Only lines whose keys
   pass it are shuffled. They are counted exactly, by the key itself.
3. Keys in enough documents keep their lines in the largest doc_id only; the numbers of the
   lines that go are joined with the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from affinity.llm import worker
from affinity.llm.common import compact, few, fresh, workspace
from affinity.llm.text import mix

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HASHES = 4
BITS_PER_LINE = 16
# The filter has at most so many bits (128 MB). A fuller one lets more lines pass; the exact
# count that follows makes results the same.
MAX_BITS = 1 << 30
MIN_BITS = 1 << 16
SLICES = 64
# Documents whose lines are held at once.
BLOCK = 1_000


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the batches that are small enough to be held as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def line_key(line: str) -> str:
    return line.strip(BLANKS).translate(LOWER)


def _keys(text: str | None, min_length: int) -> dict[str, list[int]]:
    """The numbers of the lines of every long enough key."""
    out: dict[str, list[int]] = {}
    for i, line in enumerate((text or "").split("\n")):
        if len(line) >= min_length and len(key := line_key(line)) >= min_length:
            out.setdefault(key, []).append(i)
    return out


def _positions(keys: list[str], bits: int) -> np.ndarray:
    """The HASHES bit positions of every key, one row each."""
    raw = b"".join(
        hashlib.blake2b(k.encode("utf-8", "surrogatepass"), digest_size=16).digest() for k in keys
    )
    pair = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (mix(pair[:, :1] + steps * (pair[:, 1:] | np.uint64(1))) % np.uint64(bits)).astype(np.int64)


def _set_bits(bits: int, min_length: int):
    width = bits // SLICES

    @worker.lean
    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            found = [k for t in batch["text"].to_pylist() for k in _keys(t, min_length)]
            if not found:
                continue
            # Each document sets a bit once at most for a key; two keys may share a bit.
            at, count = np.unique(_positions(found, bits), return_counts=True)
            cut = np.searchsorted(at, np.arange(SLICES + 1) * width)
            rows = [
                (s, (at[a:b] - s * width).astype(np.uint32).tobytes(),
                 (at[a:b][count[a:b] > 1] - s * width).astype(np.uint32).tobytes())
                for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.binary())],
                names=["slice", "once", "twice"],
            )

    def merge(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = np.zeros(width, bool), np.zeros(width, bool)
        for frame in frames:
            for a, b in zip(frame["once"], frame["twice"], strict=True):
                a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                twice[b] = True
                twice[a[once[a]]] = True
                once[a] = True
        yield pd.DataFrame({"slice": [key[0]], "bits": [np.packbits(twice).tobytes()]})

    return sparse, merge


def twice_filter(docs: DataFrame, min_length: int = 20, max_bits: int = MAX_BITS) -> bytes:
    """The bits of keys that two documents may hold; its size is bounded by ``max_bits``."""
    # Lines, counted without splitting; sizes the filter.
    lines = docs.agg(
        F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    ).first()[0]
    bits = MIN_BITS
    while bits < min(max_bits, BITS_PER_LINE * (lines or 0)):
        bits *= 2
    sparse, merge = _set_bits(bits, min_length)
    parts = (
        docs.filter("doc_id is not null")
        .select("text")
        .mapInArrow(sparse, "slice int, once binary, twice binary")
        .groupBy("slice")
        .applyInPandas(merge, "slice int, bits binary")
        .collect()
    )
    out = bytearray(bits // 8)
    for part in parts:
        start = part.slice * (bits // SLICES // 8)
        out[start : start + bits // SLICES // 8] = part.bits
    return bytes(out)


def _suspects(filter_bits, min_length: int):
    """Lines whose key passes the filter: (key, doc_id, numbers of its lines)."""

    @worker.lean
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(filter_bits.value, np.uint8)
        for batch in _blocks(batches):
            keys, ids, numbers = [], [], []
            for doc_id, text in zip(
                batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True
            ):
                own = _keys(text, min_length)
                keys += own
                numbers += own.values()
                ids += [doc_id] * len(own)
            if not keys:
                continue
            at = _positions(keys, 8 * len(data))
            hit = ((data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
            hit = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in hit], pa.string()),
                 pa.array([ids[i] for i in hit], pa.int64()),
                 pa.array([numbers[i] for i in hit], pa.list_(pa.int32()))],
                names=["key", "doc_id", "numbers"],
            )

    return pick


def _keep(columns: list[str], drops: str, n_lines: str, n_dropped: str):
    """All columns, with the text that is left and two counts in place of ``drops``."""

    @worker.lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            kept, lines, dropped = [], [], []
            for text, numbers in zip(
                batch["text"].to_pylist(), batch[drops].to_pylist(), strict=True
            ):
                if not numbers:
                    kept.append(text)
                    lines.append((text or "").count("\n") + 1)
                    dropped.append(0)
                    continue
                all_lines, gone = (text or "").split("\n"), set(numbers)
                kept.append("\n".join(x for i, x in enumerate(all_lines) if i not in gone))
                lines.append(len(all_lines))
                dropped.append(len(gone))
            new = {"text": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_arrays(
                [new.get(c, batch[c]) for c in columns]
                + [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*columns, n_lines, n_dropped],
            )

    return run


def dedup_lines(
    docs: DataFrame, min_length: int = 20, min_documents: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every row of ``docs(doc_id, text)``, lines deduplicated.

    A line's key is the line without blanks at both ends, A-Z lower-cased. A key of at least
    ``min_length`` code points that occurs in ``min_documents`` (2 at least) different doc_ids
    keeps its lines in the largest doc_id that holds it; the other documents lose theirs.
    ``n_lines`` counts lines before that.

    Null text stays null and counts one line; a document that loses all lines has empty text.
    Rows with a null doc_id neither lose lines nor count as holders. Rows that repeat a doc_id
    are one holder and lose the same lines; they are taken to repeat its text as well. Other
    columns are not read.
    """
    return drop_lines(
        docs.select("doc_id", "text"), "n_lines", "n_dropped", min_length, min_documents, max_bits
    )


def drop_lines(
    docs: DataFrame,
    n_lines: str,
    n_dropped: str,
    min_length: int = 20,
    min_documents: int = 3,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``dedup_lines`` with all columns of ``docs``; the two counts get the given new names."""
    if min_documents < 2:
        raise ValueError("min_documents must be 2 at least")
    spark = docs.sparkSession
    work = workspace(spark)
    named = docs.filter("doc_id is not null").select("doc_id", "text")
    bits = spark.sparkContext.broadcast(twice_filter(docs, min_length, max_bits))
    found = named.mapInArrow(_suspects(bits, min_length), "key string, doc_id long, numbers array<int>")
    suspects = work.write("suspects", compact(found, docs))
    # Rows that repeat a doc_id must not count twice: equal (key, doc_id) meet first.
    holders = suspects.groupBy("key", "doc_id").agg(F.first("numbers").alias("numbers"))
    # Written, so that both sides of the join below are plain shuffles and a hot key is split.
    keepers = (
        holders.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= min_documents)
        .select("key", "keeper")
    )
    repeated = work.write("repeated", few(keepers, suspects.count()))
    numbers = fresh("numbers")
    drops = (
        suspects.join(repeated, "key")
        .filter("doc_id < keeper")
        .groupBy("doc_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("numbers"))).alias(numbers))
    )
    schema = StructType(
        [*docs.schema.fields, StructField(n_lines, LongType()), StructField(n_dropped, LongType())]
    )
    return docs.join(drops, "doc_id", "left").select(*docs.columns, numbers).mapInArrow(
        _keep(docs.columns, numbers, n_lines, n_dropped), schema
    )
