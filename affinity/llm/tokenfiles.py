"""Token ids of a corpus as flat binary files with 64-bit document offsets.

A folder holds one group of files per range of doc_ids, in ascending order:

* ``part-00000.bin``  the ids, little-endian unsigned, 16 bits wide if all ids of the
  vocabulary fit and 32 otherwise;
* ``part-00000.off``  uint64: where each document starts in the part, and the part's end;
* ``part-00000.ids``  int64 doc_ids (rows without one come first, their number is in the manifest);
* ``manifest.json``   width, and per part its documents, ids and *base*: the prefix sum of the
  ids of all parts before it. A document's place in the corpus is base + offset.

Tasks write under a name of their own attempt and rename at the end, so a repeated task
replaces whole files by equal ones.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import worker
from affinity.llm.common import fresh, partitions
from affinity.llm.tokens import Encoder

# Documents that are encoded together.
BLOCK = 500
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def local_path(path: str) -> str:
    """A folder that driver and executors can open: a plain path or a ``file:`` one."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"token files are memory-mapped and need a mounted folder: {path}")
    return path


def _part(folder: str, part: int, kind: str) -> str:
    return f"{folder}/part-{part:05d}.{kind}"


def _writer(folder: str, tokenizer: str, end_id: int | None):
    @worker.trimmed
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        task = TaskContext.get()
        names = {
            kind: f"{_part(folder, task.partitionId(), kind)}.{task.taskAttemptId()}"
            for kind in ("bin", "off", "ids")
        }
        kind = id_type(encoder, end_id)
        end = np.array([] if end_id is None else [end_id], kind)
        n_docs = n_ids = n_null = 0
        with open(names["bin"], "wb") as b, open(names["off"], "wb") as o, open(names["ids"], "wb") as i:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    block = batch.slice(at, BLOCK)
                    doc_ids = block.column(0)
                    n_null += doc_ids.null_count
                    i.write(doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                    for ids in encoder.each(block.column(1)):
                        o.write(np.uint64(n_ids).tobytes())
                        b.write(ids.astype(kind).tobytes() + end.tobytes())
                        n_ids += len(ids) + len(end)
                        n_docs += 1
            o.write(np.uint64(n_ids).tobytes())
        for what, name in names.items():
            os.replace(name, _part(folder, task.partitionId(), what))
        yield pa.RecordBatch.from_pydict(
            {"part": [task.partitionId()], "docs": [n_docs], "ids": [n_ids], "nulls": [n_null]}
        )

    return write


def id_type(encoder: Encoder, end_id: int | None) -> str:
    largest = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
    return "<u2" if largest < 1 << 16 else "<u4"


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0, parts: int | None = None
) -> dict:
    """Write the ids of every text of ``docs(doc_id, text)`` in ascending doc_id order.

    ``end_id`` follows each document (None: nothing does). Null text is empty. Rows without
    a doc_id come first; rows that repeat one are all written, next to each other. An empty
    table gives a manifest without ids. Other columns are not read. Returns the manifest.
    """
    folder = local_path(folder)
    os.makedirs(folder)
    tie = fresh("tie")
    spark = docs.sparkSession
    summaries = (
        docs.select("doc_id", "text")
        .repartitionByRange(parts or partitions(spark), F.col("doc_id").asc_nulls_first())
        .withColumn(tie, F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
        .select("doc_id", "text")
        .mapInArrow(_writer(folder, tokenizer, end_id), "part long, docs long, ids long, nulls long")
        .collect()  # one row per part
    )
    summaries = sorted(summaries, key=lambda s: s.part)
    bases = accumulate((s.ids for s in summaries), initial=0)
    manifest = {
        "type": id_type(Encoder.of(tokenizer), end_id),
        "parts": [
            {"part": s.part, "docs": s.docs, "nulls": s.nulls, "ids": s.ids, "base": base}
            for s, base in zip(summaries, bases, strict=False)
        ],
    }
    with open(f"{folder}/manifest.json.new", "w") as out:
        json.dump(manifest, out)
    os.replace(f"{folder}/manifest.json.new", f"{folder}/manifest.json")
    return manifest


def documents_of(folder: str, manifest: dict, number: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, place in the corpus, ids) of every document of a part, from mapped files."""
    folder, part = local_path(folder), manifest["parts"][number]
    offsets = np.fromfile(_part(folder, part["part"], "off"), "<u8").astype(np.int64)
    doc_ids = np.fromfile(_part(folder, part["part"], "ids"), "<i8")
    if part["ids"]:
        ids = np.memmap(_part(folder, part["part"], "bin"), manifest["type"], mode="r")
    else:
        ids = np.zeros(0, manifest["type"])
    for i, doc_id in enumerate(doc_ids):
        yield (
            None if i < part["nulls"] else int(doc_id),
            part["base"] + int(offsets[i]),
            ids[offsets[i] : offsets[i + 1]],
        )


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    with open(f"{local_path(folder)}/manifest.json") as source:
        manifest = json.load(source)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                rows = [
                    (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in documents_of(folder, manifest, number)
                ]
                columns = zip(*rows, strict=True) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in columns],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    n = len(manifest["parts"])
    return spark.range(0, n, 1, max(n, 1)).mapInArrow(read, RESULT)
