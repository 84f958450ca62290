"""Decoding, routing and serving, in batches and streams."""

import pytest
from pyspark.sql import functions as F

from affinity.functions import messages
from affinity.operators import model, serve
from affinity.sinks import writers
from affinity.streaming import stream

MESSAGE = "key string, value string"


@pytest.fixture
def small(spark):
    m = model.Model(
        spark.createDataFrame([(1, 2.0), (2, -1.0)], "userId int, factor double"),
        spark.createDataFrame([(10, 1.0), (11, 2.0), (12, -1.0)], "movieId int, factor double"),
        0.01,
        10,
        0.5,
    )
    popular = spark.createDataFrame([(1, 12, 9), (2, 10, 5)], "rank int, movieId int, c long")
    movies = spark.createDataFrame(
        [(10, "ten"), (11, "eleven"), (12, "twelve")], "movieId int, title string"
    )
    return m, popular, movies


def test_decode(spark):
    rows = [("139|50|4.0",), ("abc",), ("",), (None,), ("-7|1|2",), ("x|1|2",), ("99999999999|1|2",)]
    df = spark.createDataFrame([("t", v) for (v,) in rows], MESSAGE)
    assert [r["userId"] for r in serve.decode(df).collect()] == [139, None, None, None, -7, None, None]


def test_encode_then_decode(spark):
    ratings = spark.createDataFrame([(139, 50, 4.0)], "userId int, movieId int, rating double")
    encoded = messages.encode(ratings, "topic").first()
    assert tuple(encoded) == ("topic", "139|50|4.0")
    assert messages.encode(ratings, None).first()["key"] == "139"


def test_suggest(spark, small):
    m, popular, movies = small
    asked = spark.createDataFrame(
        [("t", v) for v in ("1|0|1", "1|5|1", "2|0|1", "3|0|1", "bad")], MESSAGE
    )
    lists = serve.serving_lists(m, popular, movies, 2)
    rows = sorted(
        map(tuple, serve.suggest(serve.decode(asked), m, lists).collect()),
        key=lambda r: (r[0] or 0, r[3] or 0),
    )
    assert rows == [
        (None, 1, "reject", None, None, None),
        (1, 2, "model", 1, 11, "eleven"),
        (1, 2, "model", 2, 10, "ten"),
        (2, 1, "model", 1, 12, "twelve"),
        (2, 1, "model", 2, 10, "ten"),
        (3, 1, "popular", 1, 12, "twelve"),
        (3, 1, "popular", 2, 10, "ten"),
    ]


def send(spark, path, *values):
    df = spark.createDataFrame([("t", v) for v in values], MESSAGE).coalesce(1)
    writers.send_messages(df, "parquet", path)


def test_stream_equals_batch_and_restart_adds_nothing(spark, workspace, small):
    m, popular, movies = small
    root, inbox, out = (workspace.path(p) for p in ("registry", "inbox", "out"))
    model.publish(m, root)
    send(spark, inbox, "1|0|1", "3|0|1", "bad")
    send(spark, inbox, "1|0|1", "2|0|1")

    def run():
        source = stream.read_messages(spark, "parquet", inbox, files_per_batch=1)
        current = stream.CurrentModel(spark, root, popular, movies, 2)
        stream.serve(source, current, out, f"{out}-checkpoint").awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).drop("batch_id").collect()), key=str)

    first = run()
    assert run() == first
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches == 2
    whole = serve.suggest(
        serve.decode(spark.read.parquet(inbox)), m, serve.serving_lists(m, popular, movies, 2)
    )
    streamed = (
        spark.read.parquet(out)
        .groupBy("userId", "source", "rank", "movieId", "title")
        .agg(F.sum("requests").alias("requests"))
        .select(*whole.columns)
    )
    assert streamed.exceptAll(whole).count() == 0 and whole.exceptAll(streamed).count() == 0

    # Later messages meet a newly published model.
    swapped = model.Model(m.users, m.items.withColumn("factor", -F.col("factor")), 0.01, 10, 0.4)
    model.publish(swapped, root)
    send(spark, inbox, "1|9|1")
    run()
    last = spark.read.parquet(out).filter("batch_id = 2").orderBy("rank").collect()
    assert [r["movieId"] for r in last] == [12, 10]


def test_route_in_stream(spark, workspace):
    inbox, out = workspace.path("inbox"), workspace.path("out")
    known = spark.createDataFrame([(1,), (2,)], "userId int")
    send(spark, inbox, "1|0|1", "1|0|1", "3|0|1", "bad")
    rows = stream.decoded(stream.read_messages(spark, "parquet", inbox))
    stream.by_batch(
        rows, lambda batch: stream.routed(batch, known), out, f"{out}-checkpoint"
    ).awaitTermination()
    got = sorted((r["userId"], r["route"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "known"), (1, "known"), (3, "new")]


def test_console_and_interval(spark, workspace):
    inbox = workspace.path("inbox")
    send(spark, inbox, "1|0|1")
    rows = stream.decoded(stream.read_messages(spark, "parquet", inbox))
    query = stream.to_console(rows, workspace.path("checkpoint"), "1 second")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


class Recorder:
    """Stands in for a reader or writer of a connector that is not installed."""

    def __init__(self, result=None):
        self.settings, self.result, self.done = {}, result, False

    def format(self, name):
        self.settings["format"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **more):
        self.settings.update(more)
        return self

    def load(self):
        return self.result

    def save(self):
        self.done = True


def test_kafka_source_settings(spark, monkeypatch):
    binary = spark.createDataFrame([(b"t", b"1|2|3.0")], "key binary, value binary")
    recorder = Recorder(binary)
    monkeypatch.setattr(type(spark), "readStream", property(lambda self: recorder))
    rows = stream.read_messages(
        spark, "kafka", "host:9092", "movie_topic,other", options={"failOnDataLoss": "false"}
    )
    assert tuple(rows.first()) == ("t", "1|2|3.0")
    assert recorder.settings == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "movie_topic,other",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": stream.OFFSETS_PER_BATCH,
        "failOnDataLoss": "false",
    }


def test_kafka_sink_settings(spark, monkeypatch):
    rows = spark.createDataFrame([("t", "1|2|3.0")], MESSAGE)
    recorder = Recorder()
    monkeypatch.setattr(type(rows), "write", property(lambda self: recorder))
    writers.send_messages(rows, "kafka", "host:9092", "movie_topic")
    assert recorder.done and recorder.settings == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "topic": "movie_topic",
    }


def test_servers_with_other_lists_share_a_registry(spark, small, workspace):
    m, popular, movies = small
    root = workspace.path("registry")
    model.publish(m, root)
    servers = [stream.CurrentModel(spark, root, popular, movies, n) for n in (1, 2)]
    for _ in range(2):
        for server, n in zip(servers, (1, 2)):
            lists = server.get()[1]
            assert lists.filter("direction = 1").count() == n
    for server in servers:
        server.close()
        assert not server._loaded
    assert servers[0].get()[1].count() > 0
    servers[0].close()


def test_a_batch_moves_its_users_and_not_the_model(spark, small, workspace):
    m, popular, movies = small
    root = workspace.path("registry")
    model.publish(m, root)
    server = stream.CurrentModel(spark, root, popular, movies, 2)
    loaded, lists = server.get()
    asked = serve.decode(spark.createDataFrame([("t", "1|0|1"), ("t", "3|0|1")], MESSAGE))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        text = serve.suggest(asked, loaded, lists)._jdf.queryExecution().sparkPlan().toString()
        known = serve.known_among(loaded.users, asked.select("userId"))
        executed = known._jdf.queryExecution().executedPlan().toString()
        # One exchange: the distinct users of the batch.
        assert executed.split("InMemoryRelation")[0].count("Exchange hashpartitioning") <= 1
        assert "InMemoryTableScan" in executed and text
    finally:
        spark.conf.set(setting, before)
        server.close()
