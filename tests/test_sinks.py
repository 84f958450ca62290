"""Writers. Targets that need a server are replaced by recorders."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from affinity.config import JdbcTarget, shared_folder
from affinity.schemas import LINKS
from affinity.sinks import writers
from affinity.sources import readers


def test_few_files(spark, workspace):
    df = workspace.write("rows", spark.range(1000))
    assert writers.write_few_files(df, workspace.path("one")) == 1
    assert writers.write_few_files(df, workspace.path("more"), file_rows=300) == 4
    assert writers.write_few_files(df.limit(0), workspace.path("none")) <= 1
    for name in ("one", "more"):
        assert spark.read.parquet(workspace.path(name)).count() == 1000
    assert spark.read.parquet(workspace.path("one")).inputFiles().__len__() == 1


@pytest.mark.parametrize("by", [None, "k"])
def test_files_by_size_are_written_in_one_pass(spark, workspace, by):
    """Nine tenths of the rows have one key: its rows are split, and small parts share a file."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 200_000, 1, 16).selectExpr(
        "cast(if(id % 10 = 0, id, 7) as int) as k", "xxhash64(id) as a", "xxhash64(id, 1) as b"
    )
    path = workspace.path(f"sized-{by}")
    files = writers.write_few_files(rows.mapInArrow(count, rows.schema), path, by, file_bytes=600_000)
    assert seen.value == 200_000
    stored = spark.read.parquet(path)
    assert sorted(stored.collect()) == sorted(rows.collect())
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    # Some 24 bytes a row, so 25,000 rows fit; parts are split between what single tasks sent.
    assert 4 <= files <= 16 and max(sizes) <= 30_000
    if by:
        named = stored.filter("k <> 7").select("k", F.input_file_name().alias("file")).distinct()
        assert named.count() == 20_000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst", "true") == "true"


def test_replace_table(spark, workspace):
    path = workspace.path("t")
    writers.replace_table(spark.range(5), "replaced", path)
    assert writers.replace_table(spark.range(3), "replaced", path).count() == 3


def test_csv_links(spark, workspace):
    path = workspace.path("csv")
    rows = [(1, 2, 3), (4, 5, None)]
    spark.createDataFrame(rows, LINKS).write.csv(path, header=True)
    assert [tuple(r) for r in readers.links_with_tmdb(spark, path, LINKS).collect()] == [(1, 2, 3)]


def test_pending_rows_leave_out_what_is_stored(spark):
    results = spark.createDataFrame(
        [(1, 1, 10, 4.0), (1, 2, 11, 3.0)], "userId int, rank int, movieId int, rating double"
    )
    stored = spark.createDataFrame(
        [("a", 1, 1), ("b", 1, 2)], "run_id string, userId int, rank int"
    )
    left = writers.pending_rows(results, stored, "a").collect()
    assert [(r["run_id"], r["userId"], r["rank"]) for r in left] == [("a", 1, 2)]


def test_append_jdbc_is_one_append(spark, monkeypatch):
    target = JdbcTarget("jdbc:x:y", "als", "a.Driver", "me", "secret")
    results = spark.createDataFrame(
        [(1, 1, 10, 4.0)], "userId int, rank int, movieId int, rating double"
    )
    stored = spark.createDataFrame([], "run_id string, userId int, rank int")
    calls, reads = [], []

    def read(self, url, table, **options):
        reads.append((table, options))
        if "information_schema" in table:
            return spark.range(1 if there else 0)
        return stored

    there = False
    monkeypatch.setattr(type(spark.read), "jdbc", read, raising=True)
    monkeypatch.setattr(
        type(results.write), "jdbc",
        lambda self, url, table, properties: calls.append((url, table, properties)),
    )
    writers.append_jdbc(results, target, "run")
    assert calls == [("jdbc:x:y", "als", target.properties())]
    assert len(reads) == 1  # an absent target is not read
    there = True
    writers.append_jdbc(results, target, "it's a run", connections=4)
    assert len(calls) == 2
    table, options = reads[-1]
    assert "run_id = 'it''s a run'" in table
    assert (options["column"], options["lowerBound"], options["numPartitions"]) == ("userId", 1, 4)


def test_a_broker_is_sent_user_keys(spark, monkeypatch):
    sent = []

    class Writer:
        def __init__(self, df):
            self.df = df

        def format(self, name):
            return self

        option = lambda self, *a: self

        def save(self):
            sent.extend(tuple(r) for r in self.df.collect())

    df = spark.createDataFrame([("t", "7|1|2.0"), ("own", "8|1|2.0"), ("t", "bad")], "key string, value string")
    monkeypatch.setattr(type(df), "write", property(Writer))
    writers.send_messages(df, "kafka", "host:1", "t")
    assert sorted(k for k, _ in sent) == ["7", "own", "t"]


def test_close_leaves_nothing_behind(spark):
    import os

    from affinity.workspace import Workspace

    workspace = Workspace(spark)
    workspace.write_bucketed("b", spark.range(10), ["id"], 2)
    workspace.write("rows", spark.range(3))
    tables = list(workspace._tables)
    root = workspace.root.removeprefix("file:")
    assert os.path.isdir(root) and all(spark.catalog.tableExists(t) for t in tables)
    workspace.close()
    assert not os.path.exists(root)
    assert not any(spark.catalog.tableExists(t) for t in tables)


def test_jdbc_settings_come_from_the_environment():
    env = {f"AFFINITY_JDBC_{k}": k.lower() for k in ("URL", "TABLE", "DRIVER", "USER", "PASSWORD")}
    assert JdbcTarget.from_env(env).properties()["password"] == "password"
    with pytest.raises(KeyError):
        JdbcTarget.from_env({})


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_only_a_local_session_gets_a_folder_of_its_own():
    def unset(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)

    assert shared_folder(unset("local[2]")) == shared_folder(unset("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(unset("spark://host:7077"))
