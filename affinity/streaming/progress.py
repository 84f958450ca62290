"""What every batch of a query took, refused and answered, and an end between batches.

Counts are observed while the rows pass; nothing is read twice for them.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "batch_id long, kept long, rejected long, answered long"
# Seconds to wait for the last events of a query that has ended.
SETTLE = 60.0


@dataclass(frozen=True)
class Counts:
    """Readable and malformed messages of a batch, and rows written in answer."""

    batch_id: int
    kept: int
    rejected: int
    answered: int


class Report(StreamingQueryListener):
    """The counts of every finished batch of one query, also over its restarts.

    A batch counts when the query reports it as done. One that runs again after a failure
    counts once, with the numbers of its last run. Where a trigger takes several numbered batches
    (``source``), each of them is counted by itself. ``close`` takes the listener away.
    """

    def __init__(self, spark: SparkSession, enough: Callable[[Counts], bool] | None = None):
        self.spark, self._enough = spark, enough
        self._name = f"asked-{uuid.uuid4().hex[:8]}"
        self._lock = threading.Condition()
        self._answered: dict[int, int] = {}
        self._numbered: dict[int, list[Counts]] = {}
        self._batches: dict[int, list[Counts]] = {}  # by trigger
        self._ended: set[str] = set()
        self._stopping = False
        spark.streams.addListener(self)

    def asked(self, decoded: DataFrame) -> DataFrame:
        """``decoded`` messages, counted by whether they have a user."""
        known = F.col("userId").isNotNull()
        return decoded.observe(
            self._name, F.count_if(known).alias("kept"), F.count_if(~known).alias("rejected")
        )

    def write(self, batch_id: int, answer: DataFrame, path: str, numbered: DataFrame | None = None) -> None:
        """Write the answer to a batch, and count its rows; those of every batch of ``numbered`` messages."""
        seen = Observation()
        answer.observe(seen, F.count(F.lit(1)).alias("answered")).write.mode("overwrite").parquet(path)
        counts = None if numbered is None else self._by_number(numbered, answer, path)
        with self._lock:
            self._answered[batch_id] = seen.get["answered"]
            if counts is not None:
                self._numbered[batch_id] = counts

    def _by_number(self, messages: DataFrame, answer: DataFrame, path: str) -> list[Counts]:
        """Counts of the batches of one trigger: as many rows as it takes batches."""
        known = F.col("userId").isNotNull()
        asked = messages.groupBy("batch").agg(F.count_if(known).alias("kept"), F.count_if(~known).alias("rejected"))
        written = self.spark.read.schema(answer.schema).parquet(path)
        answered = written.groupBy("batch").agg(F.count(F.lit(1)).alias("answered"))
        rows = asked.join(answered, "batch", "left").collect()
        return [Counts(r["batch"], r["kept"], r["rejected"], r["answered"] or 0) for r in rows]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self._name)
        batch = event.progress.batchId
        with self._lock:
            if found is None or batch not in self._answered:
                return
            whole = Counts(batch, found["kept"], found["rejected"], self._answered[batch])
            self._batches[batch] = self._numbered.get(batch, [whole])
            self._stopping |= bool(self._enough and any(map(self._enough, self._batches[batch])))
            self._lock.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait(self, query: StreamingQuery) -> list[Counts]:
        """Wait until ``query`` ends, or stop it after the batch that was ``enough``.

        A batch begun in the meantime is given up: the next start runs it again, and it
        replaces its own folder. A failed query raises.
        """
        run = str(query.runId)
        with self._lock:
            self._lock.wait_for(lambda: self._stopping or run in self._ended)
            stop, self._stopping = self._stopping, False
        if stop:
            query.stop()
        else:
            query.awaitTermination()
        return self.settled(query)

    def settled(self, query: StreamingQuery) -> list[Counts]:
        """The batches of a query that was stopped or has ended, when its last event is here."""
        run = str(query.runId)
        with self._lock:
            if not self._lock.wait_for(lambda: run in self._ended, SETTLE):
                raise TimeoutError(f"no end of query {run} was reported")
        return self.batches()

    def batches(self) -> list[Counts]:
        with self._lock:
            found: dict[int, Counts] = {}
            for c in (c for trigger in self._batches.values() for c in trigger):
                # A batch at the end of a log that has grown since comes in two triggers.
                was = found.get(c.batch_id, Counts(c.batch_id, 0, 0, 0))
                found[c.batch_id] = Counts(
                    c.batch_id, was.kept + c.kept, was.rejected + c.rejected, was.answered + c.answered
                )
            return [found[batch] for batch in sorted(found)]

    def table(self) -> DataFrame:
        """One row per batch."""
        rows = [(c.batch_id, c.kept, c.rejected, c.answered) for c in self.batches()]
        return self.spark.createDataFrame(rows, SCHEMA)

    def close(self) -> None:
        self.spark.streams.removeListener(self)
