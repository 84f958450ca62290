"""Every registered query against its SQL twin, and the plans of the heavy ones."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from affinity.operators import evaluate, factor, model, popular, serve, split
from affinity.plans import queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert ordered(map(tuple, df.select(*columns).collect())) == ordered(expected)


def test_entry(spark):
    assert entry.entry(spark).columns == ["userId", "rank", "movieId", "rating", "title"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_is_a_filter_on_the_scan(spark):
    s = queries.stages(spark, SF_DIR)
    for half in split.time_split(s.ratings()):
        text = plan(half)
        assert "Exchange" not in text and "Sort" not in text and "Window" not in text
        assert "LessThanOrEqual(timestamp" in text or "GreaterThanOrEqual(timestamp" in text


def test_top_k_needs_no_global_sort(spark):
    s = queries.stages(spark, SF_DIR)
    text = plan(popular.popular(s.train()))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_users_are_not_shuffled_for_lists(spark):
    s = queries.stages(spark, SF_DIR)
    chosen = s.model()
    lists = s.workspace.write("lists", model.top_lists(chosen.items))
    text = plan(model.suggestions_for(chosen.users, lists))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text and "CartesianProduct" not in text


def test_large_layouts_move_only_partial_sums(spark):
    """Beyond the broadcast bound a half-step shuffles sums, not pairs or factors."""
    s = queries.stages(spark, SF_DIR)
    pairs = s.workspace.write(
        "plan/pairs",
        s.train()
        .groupBy("userId", "movieId")
        .agg(F.count("*").alias("n"), F.sum("rating").alias("s")),
    )
    limits = factor.Limits(broadcast_rows=0, persist_rows=0, group_rows=1_000)
    by_user = factor._layout(s.workspace, "plan", pairs, "userId", "movieId", limits, 1)
    by_item = factor._layout(s.workspace, "plan", pairs, "movieId", "userId", limits, 1)
    items = factor._first_items(by_user.pairs, (0.01,))
    items = factor._write_factors(s.workspace, "plan/items", items, by_item)
    text = plan(factor._solve(factor._with_factors(items, by_item, by_user), "userId", (0.01,)))
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(userId" in text
    assert "partial_sum" in text.split("Exchange")[1]
    assert "ShuffledHashJoin" in text and "Sort" not in text


def test_no_cross_joins_and_no_python(spark):
    s = queries.stages(spark, SF_DIR)
    asked = serve.decode(queries.requests(spark, SF_DIR))
    lists = serve.serving_lists(s.model(), s.popular(), s.movies)
    for df in (
        serve.suggest(asked, s.model(), lists),
        serve.fallback(serve.new_requests(asked, s.known_users()), s.popular(), s.movies),
        evaluate.grid_errors(s.fit(), evaluate.weighted(s.test())),
        popular.lookup_titles(s.test(), s.movies),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Python" not in text and "Arrow" not in text


def test_scans_read_only_what_they_need(spark):
    s = queries.stages(spark, SF_DIR)
    assert "ReadSchema: struct<movieId:int>" in plan(popular.rating_counts(s.train()))
    assert "ReadSchema: struct<userId:int>" in plan(popular.distinct_users(s.train()))


def test_a_hot_user_is_split_in_routing_joins(spark):
    """With a shuffle join, the partition of a user with most requests is split."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        asked = spark.range(0, 60_000, 1, 8).selectExpr(
            "cast(if(id % 3 = 0, 7, id) as int) as userId", "uuid() as value"
        )
        known = spark.range(0, 60_000, 2, 8).selectExpr("cast(id as int) as userId")
        for join in (serve.known_requests, serve.new_requests):
            df = join(asked, known)
            rows = df.collect()
            odd = join is serve.new_requests
            assert len(rows) == (40_000 if odd else 20_000)
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in text
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
