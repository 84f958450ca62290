"""The replayed log as a streaming source: order, admission, restarts and runs of copies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.functions import messages
from affinity.streaming import replay, source, stream

RATING = "userId int, movieId int, rating double"
ORDER = ["userId", "movieId", "rating"]


def logged(workspace, rows, name="log"):
    runs = replay.runs(workspace, f"{name}-runs", rows, ORDER)
    path = workspace.path(name)
    replay.write_log(messages.encode(runs, "t", "range", "first", "until"), path)
    return path


def replayed(spark, path, out, per_batch, tasks=1_000_000):
    rows = stream.read_messages(
        spark, "replay", path, offsets_per_batch=per_batch, options={"messagesPerTask": tasks}
    )
    query = stream.by_batch(rows, lambda b: b, out, f"{out}-checkpoint", interval="0 seconds")
    stream.to_the_end(query)
    return query


@pytest.fixture
def ratings(spark, monkeypatch):
    monkeypatch.setattr(replay, "RANGE_ROWS", 40)
    return spark.range(0, 150, 1, 5).selectExpr(
        "cast((id * 37) % 101 as int) as userId", "cast(id % 7 as int) as movieId", "id % 3 + 0.5D as rating"
    )


def test_batches_follow_the_order(spark, workspace, ratings):
    ratings = ratings.union(ratings.limit(20)).union(spark.createDataFrame([(None, 1, 2.0)], RATING))
    path, out = logged(workspace, ratings), workspace.path("out")
    replayed(spark, path, out, 25, tasks=10)
    found = spark.read.parquet(out).collect()
    in_order = sorted(map(tuple, ratings.collect()), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    expected = {}
    for at, (user, movie, rating) in enumerate(in_order):
        value = "|".join(str(x) for x in (user, movie, rating) if x is not None)
        expected.setdefault(at // 25, []).append(value)
    assert len(expected) == 7
    for number, values in expected.items():
        assert sorted(r["value"] for r in found if r["batch_id"] == number) == sorted(values)
    assert {r["key"] for r in found} == {"t"}


def test_a_restart_repeats_nothing(spark, workspace, ratings):
    """A failed batch runs again; a query that is started again goes on from its checkpoint."""
    path, out = logged(workspace, ratings), workspace.path("out")
    stop = {"at": 2}

    def answer(batch):
        if len(served) == stop["at"]:
            raise RuntimeError("lost")
        served.append(batch.count())
        return batch

    served = []

    def start():
        rows = stream.read_messages(spark, "replay", path, offsets_per_batch=40)
        return stream.by_batch(rows, answer, out, f"{out}-checkpoint", interval="0 seconds")

    with pytest.raises(Exception, match="lost"):
        stream.to_the_end(start())
    stop["at"] = -1
    stream.to_the_end(start())
    assert served == [40, 40, 40, 30]
    stream.to_the_end(start())  # at the end: nothing more
    assert served == [40, 40, 40, 30]
    values = sorted(r["value"] for r in spark.read.parquet(out).collect())
    assert values == sorted(r["value"] for r in messages.encode(ratings, "t").collect())


def test_an_ended_query_goes_on_with_a_longer_log(spark, workspace, ratings):
    path, out = logged(workspace, ratings.filter("userId < 50")), workspace.path("out")
    replayed(spark, path, out, 30)
    first = spark.read.parquet(out).count()
    path = logged(workspace, ratings)
    replayed(spark, path, out, 30)
    found = [r["value"] for r in spark.read.parquet(out).collect()]
    assert 0 < first < len(found)
    assert sorted(found) == sorted(r["value"] for r in messages.encode(ratings, "t").collect())


def test_copies_stay_one_run(spark, workspace):
    """A rating repeated many times is one stored run, and is handed over in bounded pieces."""
    rows = spark.range(0, 300_000, 1, 4).select(
        F.lit(7).alias("userId"), F.lit(1).alias("movieId"), F.lit(3.0).alias("rating")
    )
    path = logged(workspace, rows.union(spark.createDataFrame([(8, 1, 1.0)], RATING)))
    assert spark.read.parquet(f"{path}/runs").count() == 2
    reader = source.ReplayReader({"path": path, "messagesPerTask": "120000"})
    assert reader.latestOffset() == {"position": 300_001}
    parts = reader.partitions({"position": 0}, {"position": 300_001})
    sizes = [[b.num_rows for b in reader.read(part)] for part in parts]
    assert [sum(s) for s in sizes] == [120_000, 120_000, 60_001]
    assert max(map(max, sizes)) <= source.HANDED_OVER
    values = [v for b in reader.read(parts[-1]) for v in b["value"].to_pylist()]
    assert values[-2:] == ["7|1|3.0", "8|1|1.0"]


def test_empty_log(spark, workspace):
    path = logged(workspace, spark.createDataFrame([], RATING))
    query = replayed(spark, path, workspace.path("out"), 10)
    assert query.exception() is None
    assert source.ReplayReader({"path": path}).latestOffset() == {"position": 0}


def test_slices_name_only_their_ranges():
    ranges = np.array([[0, 10, 0], [10, 30, 1], [30, 31, 4]])
    cut = source.slices(ranges, 5, 31, 10)
    assert [(s.first, s.until, s.ranges) for s in cut] == [(5, 15, [0, 1]), (15, 25, [1]), (25, 31, [1, 4])]
    assert source.slices(ranges, 31, 31, 10) == []


def test_options_are_checked():
    with pytest.raises(ValueError):
        source.ReplayReader({"path": "x", "messagesPerBatch": "-1"})
