"""A replayed log of messages as a streaming source, ``format("replay")``.

The log (``replay.write_log``) holds runs of messages by position. An offset is the position
before which everything has been read, so a restarted query goes on where its checkpoint ends. A
batch is planned as slices of positions; a task opens the folders of the ranges that its slice
touches, and the file statistics keep it to the runs that it needs.

With ``batchesTogether`` the log is numbered: message i is in batch i div ``messagesPerBatch``, which
comes as a column ``batch``, and one trigger takes up to so many whole batches. What a trigger costs by
itself is then paid once for all of them.

Options: ``path``; ``messagesPerBatch``, what one batch takes (0, the default: all there is);
``messagesPerTask``; ``batchesTogether``. The trigger's interval sets the pace. A query with ``availableNow`` asks for
the newest offset only once, so there ``messagesPerBatch`` bounds the whole run: end a paced replay
with ``stream.to_the_end`` in its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

MESSAGES_PER_TASK = 1_000_000
# Messages that a task hands over at once, however many copies of one there are.
HANDED_OVER = 10_000


@dataclass
class Slice(InputPartition):
    """Positions from ``first`` to before ``until``, which lie in ``ranges``."""

    first: int
    until: int
    ranges: list[int]


def _open(path: str, columns: ds.Partitioning | None = None) -> ds.Dataset:
    system, inside = fs.FileSystem.from_uri(path)
    return ds.dataset(inside, filesystem=system, format="parquet", partitioning=columns)


def slices(ranges: np.ndarray, first: int, until: int, per_task: int) -> list[Slice]:
    """Cut positions into slices, each with its ranges; ``ranges`` are sorted (first, until, range) rows."""
    out = []
    for low in range(first, until, per_task):
        high = min(low + per_task, until)
        touched = (ranges[:, 0] < high) & (ranges[:, 1] > low)
        out.append(Slice(low, high, ranges[touched, 2].tolist()))
    return out


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"]
        self.per_batch = int(options.get("messagesPerBatch", 0))
        self.per_task = int(options.get("messagesPerTask", MESSAGES_PER_TASK))
        self.together = int(options.get("batchesTogether", 0))
        if self.per_batch < 0 or self.per_task < 1:
            raise ValueError("messagesPerBatch must be 0 or more, messagesPerTask 1 or more")
        if self.together < 0 or (self.together and not self.per_batch):
            raise ValueError("batchesTogether must be 0 or more, and needs messagesPerBatch")
        self.planned = 0

    def _ranges(self) -> np.ndarray:
        table = _open(f"{self.path}/ranges").to_table(columns=["first", "until", "range"])
        rows = np.stack([c.to_numpy().astype(np.int64) for c in table.columns], axis=1)
        return rows[np.argsort(rows[:, 0])]

    def initialOffset(self) -> dict:
        return {"position": 0}

    def latestOffset(self) -> dict:
        """The end of the log, or one trigger's batches beyond what has been planned."""
        end = int(self._ranges()[:, 1].max(initial=0))
        step = self.per_batch * max(self.together, 1)
        return {"position": min(end, (self.planned // step + 1) * step if self.together else self.planned + step) if step else end}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        # A restarted query asks once for the empty batch at the end of its checkpoint.
        self.planned = max(self.planned, end["position"])
        return slices(self._ranges(), start["position"], end["position"], self.per_task)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        low, high = partition.first, partition.until
        wanted = (ds.field("first") < high) & (ds.field("until") > low)
        for number in partition.ranges:
            runs = _open(f"{self.path}/runs/range={number}")
            for batch in runs.to_batches(columns=["first", "until", "key", "value"], filter=wanted):
                first, until = (batch[c].to_numpy() for c in ("first", "until"))
                start = np.maximum(first, low)
                ends = np.cumsum(np.minimum(until, high) - start)
                for at in range(0, int(ends[-1]) if len(ends) else 0, HANDED_OVER):
                    some = np.arange(at, min(at + HANDED_OVER, ends[-1]))
                    run = np.searchsorted(ends, some, side="right")
                    rows = batch.select(["key", "value"]).take(pa.array(run))
                    if self.together:
                        # A run ends where its last position is taken.
                        position = np.minimum(until, high)[run] - (ends[run] - some)
                        rows = rows.append_column("batch", pa.array(position // self.per_batch, pa.int64()))
                    yield rows


class Replay(DataSource):
    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        numbered = int(self.options.get("batchesTogether", 0))
        return "key string, value string" + (", batch long" if numbered else "")

    def streamReader(self, schema) -> ReplayReader:
        return ReplayReader(self.options)
