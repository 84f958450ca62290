"""Compact exchange of hashes between documents and hash ranges.

A corpus has about as many word windows as words. Moving one row each would cost far more
than the hashes themselves, so a task sends one row per slice of documents (*batch*) and hash
range (*bucket*), whose columns are packed arrays. Hashes are spread evenly over buckets; a
window that a third of all documents share adds one entry per document to one bucket and
nothing more. The number of buckets is ``spark.sql.shuffle.partitions``: set it, as for any
shuffle, so that a bucket (its share of some 10 bytes a word) fits into a task.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext


def planes(values: np.ndarray) -> bytes:
    """Byte 0 of all values, then byte 1 and so on: small numbers compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(raw.T).view(kind).reshape(-1)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket by the upper 32 bits, below 2**16."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.uint16)


def by_bucket(buckets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(stable order by bucket, n + 1 limits of the buckets in it)."""
    order = np.argsort(buckets, kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(n + 1))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, length) of the runs of equal values."""
    if not len(values):
        return values, np.zeros(0, np.uint32)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.diff(np.append(first, len(values))).astype(np.uint32)


class Batches:
    """Numbers of the batches of a task, the same whenever it is run again."""

    def __init__(self):
        self.task, self.made = TaskContext.get().partitionId(), 0

    def next(self) -> int:
        self.made += 1
        return (self.task << 32) | self.made
