"""Structured Streaming around the batch operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinity.config import BROADCAST_ROWS
from affinity.functions.messages import user_id
from affinity.operators import model as models
from affinity.operators.model import Model
from affinity.operators.registry import Registry
from affinity.operators.serve import (
    known_among,
    known_requests,
    new_requests,
    serving_lists,
    suggest,
)
from affinity.schemas import MESSAGE
from affinity.streaming.progress import Report
from affinity.streaming.source import Replay

# Messages that one batch takes from a topic unless told otherwise.
OFFSETS_PER_BATCH = 10_000_000


def read_messages(
    spark: SparkSession,
    fmt: str,
    location: str,
    topics: str | None = None,
    files_per_batch: int | None = None,
    starting: str = "latest",
    offsets_per_batch: int | None = OFFSETS_PER_BATCH,
    options: dict[str, str] | None = None,
    batches_together: int = 0,
) -> DataFrame:
    """A stream of (key, value) strings.

    With ``batches_together``, a log comes in numbered batches of ``offsets_per_batch`` messages, so
    many to a trigger; their number is the column ``batch`` (``source``).

    ``offsets_per_batch`` bounds what one batch takes from a topic or log, also after a pause;
    ``options`` go to the reader as they are.

    ``fmt`` is ``kafka`` (``location`` = brokers, ``topics`` = comma list), ``replay`` (``location`` =
    a log by ``replay.write_log``) or a file format (``location`` = folder).
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", location)
            .option("subscribe", topics)
            .option("startingOffsets", starting)
        )
        if offsets_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
        stream = reader.options(**(options or {})).load()
        return stream.select(F.col("key").cast("string"), F.col("value").cast("string"))
    if fmt == Replay.name():
        spark.dataSource.register(Replay)
        reader = spark.readStream.format(fmt).option("messagesPerBatch", offsets_per_batch or 0)
        if batches_together:
            reader = reader.option("batchesTogether", batches_together)
        return reader.options(**(options or {})).load(location)
    reader = spark.readStream.format(fmt).schema(MESSAGE).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(location)


def decoded(messages: DataFrame) -> DataFrame:
    return messages.select("key", "value", user_id(F.col("value")).alias("userId"), *_numbered(messages))


def _numbered(messages: DataFrame) -> tuple[str, ...]:
    """The column with the number of a message's batch, where a trigger takes several."""
    return ("batch",) if "batch" in messages.columns else ()


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def to_the_end(query: StreamingQuery) -> None:
    """Let a query with an interval read all there is, then stop it; a failed batch raises."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def to_files(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Append a stream to parquet, exactly once per checkpoint.

    Without an ``interval`` the query stops when it has read what there is.
    """
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def to_console(stream: DataFrame, checkpoint: str, interval: str | None = None):
    return (
        stream.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def _few(batch: DataFrame) -> bool:
    """Whether a batch, and so any set of its users, may be broadcast."""
    return batch.count() <= BROADCAST_ROWS


def routed(batch: DataFrame, known: DataFrame) -> DataFrame:
    """(userId, value, route) of a batch: ``known`` or ``new``; malformed ones left out."""
    found = known_among(known, batch, _few(batch))
    parts = [
        part.select("userId", "value", F.lit(name).alias("route"))
        for name, part in (
            ("known", known_requests(batch, found)),
            ("new", new_requests(batch, found)),
        )
    ]
    return parts[0].union(parts[1])


class CurrentModel:
    """The published model and its lists, loaded again only when another is published.

    The user factors stay persisted between batches, hashed on the user: a batch moves its
    own users to them and never the model. What is lost is read again. The lists are at most
    4n rows and stay with the server; nothing is written into the registry, which servers
    with other lists may share. ``close`` releases the factors.
    """

    def __init__(self, spark: SparkSession, root: str, popular: DataFrame, movies: DataFrame, n: int):
        self.spark, self.registry, self.n = spark, Registry(spark, root), n
        self.popular, self.movies = popular, movies
        self._path: str | None = None
        self._loaded: tuple[Model, DataFrame] | None = None

    def get(self) -> tuple[Model, DataFrame]:
        path = self.registry.current().path
        if path != self._path:
            model = models.load(self.spark, path)
            lists = serving_lists(model, self.popular, self.movies, self.n)
            lists = self.spark.createDataFrame(lists.collect(), lists.schema)
            self.close()
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            users = model.users.repartition(parts, "userId").persist(StorageLevel.MEMORY_AND_DISK)
            self._loaded = replace(model, users=users), lists
            self._path = path
        return self._loaded

    def close(self) -> None:
        if self._loaded:
            self._loaded[0].users.unpersist()
        self._loaded = self._path = None


def by_batch(
    stream: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    interval: str | None = None,
    report: Report | None = None,
) -> StreamingQuery:
    """Write ``answer(batch)`` of every batch to its own folder, or of all batches of a trigger to one.

    A batch that runs again after a failure replaces its own folder, so its rows
    are never repeated. A ``report`` counts decoded messages and answers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # The answer looks at a batch more than once; read it from the source once.
        batch.persist()
        try:
            numbered = _numbered(batch)
            found, path = answer(batch), f"{out}/{'trigger' if numbered else 'batch_id'}={batch_id}"
            if report:
                report.write(batch_id, found, path, batch if numbered else None)
            else:
                found.write.mode("overwrite").parquet(path)
        finally:
            batch.unpersist()

    rows = report.asked(stream) if report else stream
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval))
        .start()
    )


def serve(
    messages: DataFrame,
    current: CurrentModel,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    report: Report | None = None,
) -> StreamingQuery:
    """Answer every batch of messages with the model that is current then."""

    def answer(batch: DataFrame) -> DataFrame:
        model, lists = current.get()
        return suggest(batch, model, lists, _few(batch), _numbered(batch))

    return by_batch(decoded(messages), answer, out, checkpoint, interval, report)
