"""Replay of messages in a fixed order: a bounded head, or a whole table as a log to stream from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.workspace import Workspace

# Rows of a range that one task sorts while a table is numbered.
RANGE_ROWS = 1_000_000


def first_rows(rows: DataFrame, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows with their ``position`` from 0."""
    head = rows.orderBy(*order).limit(limit)
    return head.withColumn("position", F.row_number().over(Window.orderBy(*order)) - 1)


def runs(workspace: Workspace, name: str, rows: DataFrame, order: list[str]) -> DataFrame:
    """All rows as runs of copies, with the positions from ``first`` to before ``until``.

    Positions count from 0 in ``order``, which must tell all but copies apart. A row with any
    number of copies stays one run. Runs are in ranges of the order, ``range``, and sorted in
    each; a range knows where it starts from the counts of those before it. ``rows`` are read twice.
    """
    alike = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    stage = name.rsplit("/", 1)[-1]
    sorted_rows = workspace.write(
        stage,
        alike.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("range", F.spark_partition_id())
        # Counts up within a range, in the order of its rows.
        .withColumn("_nth", F.monotonically_increasing_id()),
    )
    sizes = sorted_rows.groupBy("range").agg(F.sum("_copies").alias("n"))
    # One row per range: the window over all of them is small.
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("range", F.coalesce(before, F.lit(0)).alias("_start"))
    until = F.col("_start") + F.sum("_copies").over(
        Window.partitionBy("range").orderBy("_nth").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        sorted_rows.join(F.broadcast(starts), "range")
        .withColumn("until", until)
        .select("range", (F.col("until") - F.col("_copies")).alias("first"), "until", *order)
    )


def write_log(messages: DataFrame, path: str) -> None:
    """Write (range, first, until, key, value) runs where ``source.Replay`` reads them.

    One job writes a folder for each range, sorted; a list of the ranges' positions lies beside.
    """
    (
        messages.sortWithinPartitions("range", "first")
        .select("first", "until", "key", "value", "range")
        .write.mode("overwrite")
        .partitionBy("range")
        .parquet(f"{path}/runs")
    )
    written = messages.sparkSession.read.schema("until long, first long, range int").parquet(f"{path}/runs")
    (
        written.groupBy("range")
        .agg(F.min("first").alias("first"), F.max("until").alias("until"))
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{path}/ranges")
    )
