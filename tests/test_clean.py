"""Line cleaners on literal lines."""

import pytest

from affinity.operators import clean
from affinity.schemas import TABLES
from affinity.sources import readers


def classified(spark, table, *lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return clean.classify(df, table)


def cleaned(spark, table, *lines):
    return [tuple(r) for r in clean.kept(classified(spark, table, *lines), table).collect()]


def reason(spark, table, line):
    rows = clean.rejected(classified(spark, table, line)).collect()
    return rows[0]["reason"] if rows else None


@pytest.mark.parametrize(
    "line, row",
    [
        ('3064,260,"action, scifi",1442943290', (3064, 260, "action scifi", 1442943290)),
        ("1,2,funny,10", (1, 2, "funny", 10)),
        ("1,2,,10", (1, 2, "", 10)),
        ('1,2,"a,b,,c",10', (1, 2, "abc", 10)),
        ("1,2, \t padded \t ,10", (1, 2, "padded", 10)),
        ('1,2,"say ""hi""",10', (1, 2, "say hi", 10)),
    ],
)
def test_tag_repair(spark, line, row):
    assert cleaned(spark, "tags", line) == [row]


@pytest.mark.parametrize("line", ["1,2", "1,2,10", "a,b,c", "", "x"])
def test_short_tag_lines_are_rejected(spark, line):
    assert reason(spark, "tags", line) == clean.TOO_FEW


def test_links(spark):
    assert cleaned(spark, "links", "1, 0114709 ,862") == [(1, 114709, 862)]
    assert reason(spark, "links", "1,2,3,more") == clean.TOO_MANY
    assert reason(spark, "ratings", "1,2,3.0,4,more") == clean.TOO_MANY
    assert reason(spark, "movies", "5,A, B,X|Y") == clean.TOO_MANY
    assert cleaned(spark, "movies", '5,"A, B",X|Y') == [(5, "A, B", "X|Y")]
    assert reason(spark, "links", "101,102,") == clean.EMPTY_LAST
    assert reason(spark, "links", "1,x,862") == clean.BAD_VALUE
    assert reason(spark, "links", "1,2.5,862") == clean.BAD_VALUE
    assert reason(spark, "links", "1,99999999999,862") == clean.BAD_VALUE
    assert reason(spark, "links", "1,862") == clean.TOO_FEW


def test_movies(spark):
    assert cleaned(
        spark,
        "movies",
        '11,"American President, The (1995)",Comedy|Drama',
        '12,"say ""hi""",Drama',
        "13, Heat (1995) ,Action",
    ) == [
        (11, "American President, The (1995)", "Comedy|Drama"),
        (12, 'say "hi"', "Drama"),
        (13, "Heat (1995)", "Action"),
    ]
    assert reason(spark, "movies", "14,Heat (1995),") == clean.EMPTY_LAST
    assert reason(spark, "movies", "14,Heat (1995)") == clean.TOO_FEW
    assert reason(spark, "movies", "one,Heat (1995),Action") == clean.BAD_VALUE


def test_ratings(spark):
    assert cleaned(spark, "ratings", "1, 2 ,4.5,10") == [(1, 2, 4.5, 10)]
    assert reason(spark, "ratings", "1,2,NaN,10") == clean.BAD_VALUE
    assert reason(spark, "ratings", "1,2,Infinity,10") == clean.BAD_VALUE
    assert reason(spark, "ratings", "1,2,four,10") == clean.BAD_VALUE


def test_every_line_is_kept_dropped_or_rejected(spark):
    lines = ["1,2,3", "1,2,", "1,x,3", "", "4,5,6"]
    row = clean.counts(classified(spark, "links", *lines), "links").first()
    assert (row["kept"], row["dropped"], row["rejected"]) == (2, 1, 2)


def test_ingest_writes_both_tables_in_one_pass(spark, workspace):
    from affinity.plans.ingest import ingest

    lines = spark.createDataFrame(
        [(v,) for v in ("1,2,3", "1,2,", "1,x,3", "", "4,5,6")], "value string"
    )
    done = ingest(lines, "links", workspace.path("links"), "ingested_links")
    assert (done.kept, done.dropped, done.rejected) == (2, 1, 2)
    assert sorted(map(tuple, done.table.collect())) == [(1, 2, 3), (4, 5, 6)]
    assert sorted(map(tuple, spark.table("ingested_links").collect())) == [(1, 2, 3), (4, 5, 6)]
    assert sorted(map(tuple, done.rejects.collect())) == [
        ("", clean.TOO_FEW),
        ("1,2,", clean.EMPTY_LAST),
        ("1,x,3", clean.BAD_VALUE),
    ]
    again = ingest(lines.limit(0), "links", workspace.path("none"))
    assert again.kept == 0 and again.table.count() == 0


@pytest.mark.parametrize(
    "table, line, row",
    [
        ("movies", '1,"Who, me ""now""?",A|B', (1, 'Who, me "now"?', "A|B")),
        ("tags", '1,2,"a, ""b"", c",10', (1, 2, 'a, "b", c', 10)),
        ("tags", '1,2,"",10', (1, 2, "", 10)),
        ("links", '"1"," 0114 ",3', (1, 114, 3)),
        ("ratings", "1,2,3.5,4", (1, 2, 3.5, 4)),
    ],
)
def test_csv_records_are_kept(spark, table, line, row):
    df = spark.createDataFrame([(line,)], "value string")
    assert [tuple(r) for r in clean.kept(clean.classify_csv(df, table), table).collect()] == [row]


@pytest.mark.parametrize(
    "table, line, why",
    [
        ("links", "1,2", clean.TOO_FEW),
        ("links", "x", clean.TOO_FEW),
        ("links", "1,2,3,4", clean.TOO_MANY),
        ("links", "1,2,3,4,5,6", clean.TOO_MANY),
        ("links", "1,,3", clean.BAD_VALUE),
        ("links", "1,x,3", clean.BAD_VALUE),
        ("links", "1,2,99999999999", clean.BAD_VALUE),
        ("links", "1,2,", clean.EMPTY_LAST),
        ("movies", '1,"a, b"', clean.TOO_FEW),
        ("movies", '1,"a, ""b"", c",D,E', clean.TOO_MANY),
        ("movies", "movieId,name,genres", clean.BAD_VALUE),
        ("tags", "1,2,a, b,10", clean.TOO_MANY),
        ("tags", "1,2,,10", clean.BAD_VALUE),
        ("ratings", "1,2,NaN,4", clean.BAD_VALUE),
    ],
)
def test_broken_csv_records_are_rejected_whole(spark, table, line, why):
    df = spark.createDataFrame([(line,)], "value string")
    found = clean.rejected(clean.classify_csv(df, table)).collect()
    assert [tuple(r) for r in found] == [(line, why)]


@pytest.mark.parametrize("line", ['1,"open, end,A', '1,"a" b,A', '1,a"b,A', '"', '1,"a""', ""])
def test_no_csv_record_is_lost_or_raises(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    assert clean.classify_csv(df, "movies").count() == 1


def test_csv_lines_leave_out_headers_only(spark, workspace):
    path = workspace.path("csv-headers")
    lines = ["movieId,imdbId,tmdbId", "1,2,3", "imdbId,movieId,tmdbId", "", "movieId,imdbId,tmdbId", "4,5,6,7"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    found = [r["value"] for r in readers.csv_lines(spark, path, TABLES["links"]).collect()]
    assert sorted(found) == ["1,2,3", "4,5,6,7", "imdbId,movieId,tmdbId"]
    every = readers.csv_lines(spark, path, TABLES["links"], header=False)
    assert every.count() == 5
