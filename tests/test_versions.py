"""Tables replaced in one step."""

import pytest
from pyspark.sql import functions as F

from affinity.plans.ingest import ingest
from affinity.sinks import versions, writers
from affinity.sinks.versions import Versions


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_a_write_that_fails_leaves_the_old_rows(spark, workspace):
    root = workspace.path("failing")
    writers.replace_table(spark.range(5), "v_failing", root)
    before = Versions(spark, root).names()
    # Some tasks write their rows before one fails.
    broken = spark.range(0, 1000, 1, 4).select(F.expr("if(id = 999, raise_error('half-way'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        writers.replace_table(broken, "v_failing", root)
    assert ids(spark.table("v_failing")) == list(range(5))
    assert Versions(spark, root).names() == before


def test_a_reader_sees_one_version_whole(spark, workspace):
    root = workspace.path("reading")
    writers.replace_table(spark.range(0, 40, 1, 4), "v_reading", root)
    begun = spark.table("v_reading")
    rows = begun.toLocalIterator()
    first = next(rows)[0]
    assert ids(writers.replace_table(spark.range(100, 103), "v_reading", root)) == [100, 101, 102]
    assert sorted([first, *(r[0] for r in rows)]) == list(range(40))  # the files it began with
    assert ids(spark.table("v_reading")) == [100, 101, 102]


def test_a_table_may_be_replaced_from_itself(spark, workspace):
    root = workspace.path("own")
    writers.replace_table(spark.range(4), "v_own", root)
    for _ in range(3):
        writers.replace_table(spark.table("v_own").select((F.col("id") + 1).alias("id")), "v_own", root)
    assert ids(spark.table("v_own")) == [3, 4, 5, 6]
    assert len(Versions(spark, root).names()) == versions.KEEP


def test_other_columns_make_the_table_anew(spark, workspace):
    root = workspace.path("other")
    writers.replace_table(spark.range(2), "v_other", root)
    out = writers.replace_table(spark.range(2).selectExpr("id", "cast(id as string) as s"), "v_other", root)
    assert sorted(map(tuple, out.collect())) == [(0, "0"), (1, "1")]


def test_default_root_is_beside_the_table(spark):
    writers.replace_table(spark.range(3), "v_default")
    writers.replace_table(spark.range(2), "v_default")
    assert ids(spark.table("v_default")) == [0, 1]
    assert len(Versions(spark, versions.default_root(spark, "v_default")).names()) == 2
    spark.sql("drop table v_default")


def test_retention_spares_other_writers(spark, workspace, monkeypatch):
    found = Versions(spark, workspace.path("kept"))
    paths = [found.write(lambda p: spark.range(1).write.parquet(p)) for _ in range(4)]
    unfinished = found.new()
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(unfinished)
    newest = found.write(lambda p: spark.range(1).write.parquet(p))
    found.retain(paths[3], 2)
    name = lambda p: p.rsplit("/", 1)[1]
    assert found.names() == [name(p) for p in (paths[2], paths[3], unfinished, newest)]
    found.retain(newest, 1)
    assert found.names() == [name(unfinished), name(newest)]
    monkeypatch.setattr(versions, "ABANDONED_HOURS", 0)
    found.retain(newest, 1)
    assert found.names() == [name(newest)]


def test_a_failed_ingest_leaves_the_table(spark, workspace):
    path = workspace.path("ingested")
    lines = spark.createDataFrame([("1,2,3",), ("x",), ("4,5,6",)], "value string")
    ingest(lines, "links", path, "v_links")
    broken = lines.select(F.expr("if(value = 'x', raise_error('no line'), value)").alias("value"))
    with pytest.raises(Exception, match="no line"):
        ingest(broken, "links", path, "v_links")
    assert ids(spark.table("v_links")) == [1, 4]
    done = ingest(lines.limit(1), "links", path, "v_links")
    assert ids(spark.table("v_links")) == ids(done.table) == [1]
    assert (done.kept, done.rejected) == (1, 0)
