"""Counts of every batch, over restarts, and an end between batches."""

import pytest
from pyspark.sql import functions as F

from affinity.streaming import progress, replay, stream


@pytest.fixture
def log(spark, workspace):
    """150 messages in order; every tenth has no user."""
    rows = spark.range(150).select(
        F.concat(F.format_string("%03d", "id"), F.expr("if(id % 10 = 0, '', '|1|2.0')")).alias("value")
    )
    runs = replay.runs(workspace, "progress-runs", rows, ["value"])
    path = workspace.path("progress-log")
    replay.write_log(runs.withColumn("key", F.lit("t")), path)
    return path


def start(spark, log, out, report, answer=lambda batch: batch.filter("userId is not null")):
    rows = stream.decoded(stream.read_messages(spark, "replay", log, offsets_per_batch=25))
    return stream.by_batch(rows, answer, out, f"{out}-checkpoint", interval="0 seconds", report=report)


def expected(batches):
    bad = [3, 2, 3, 2, 3, 2]  # multiples of ten among 25 numbers
    return [progress.Counts(b, 25 - bad[b], bad[b], 25 - bad[b]) for b in range(batches)]


def test_every_batch_is_counted_once(spark, workspace, log):
    report = progress.Report(spark)
    try:
        query = start(spark, log, workspace.path("counted"), report)
        stream.to_the_end(query)
        assert report.settled(query) == expected(6)
        assert report.table().count() == 6
    finally:
        report.close()


def test_stops_when_it_is_enough_and_goes_on(spark, workspace, log):
    out = workspace.path("enough")
    report = progress.Report(spark, enough=lambda batch: batch.batch_id == 2)
    try:
        query = start(spark, log, out, report)
        stopped = report.wait(query)
        assert not query.isActive and stopped[:3] == expected(3) and len(stopped) < 6
        again = start(spark, log, out, report)
        stream.to_the_end(again)
        assert report.settled(again) == expected(6)
    finally:
        report.close()
    rows = spark.read.parquet(out)
    assert rows.count() == 135 and rows.select("value").distinct().count() == 135


def test_a_failed_batch_is_counted_when_it_is_done(spark, workspace, log):
    out, seen = workspace.path("failed"), []

    def answer(batch):
        seen.append(1)
        if len(seen) == 3:
            raise RuntimeError("lost")
        return batch.filter("userId is not null")

    report = progress.Report(spark)
    try:
        with pytest.raises(Exception, match="lost"):
            report.wait(start(spark, log, out, report, answer))
        assert report.batches() == expected(2)
        again = start(spark, log, out, report, answer)
        stream.to_the_end(again)
        assert report.settled(again) == expected(6)
    finally:
        report.close()


@pytest.mark.parametrize("together", [2, 4, 100])
def test_batches_of_one_trigger_are_counted_each(spark, workspace, log, together):
    report = progress.Report(spark)
    out = workspace.path(f"together-{together}")
    try:
        messages = stream.read_messages(
            spark, "replay", log, offsets_per_batch=25, options={"messagesPerTask": "7"}, batches_together=together
        )
        query = stream.by_batch(
            stream.decoded(messages), lambda b: b.filter("userId is not null"), out, f"{out}-checkpoint",
            interval="0 seconds", report=report,
        )
        stream.to_the_end(query)
        assert report.settled(query) == expected(6)
        assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == -(-6 // together)
    finally:
        report.close()
    rows = spark.read.parquet(out).select("batch", F.expr("int(userId)").alias("u")).collect()
    assert sorted((r.batch, r.u) for r in rows) == [(i // 25, i) for i in range(150) if i % 10]
