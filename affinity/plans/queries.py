"""The checked queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.config import Config
from affinity.functions import messages
from affinity.operators import anyrank, bestitems, clean, evaluate, factor, factor2, layers, model, popular, rankk, serve
from affinity.plans import ingest
from affinity.plans.stages import Stages
from affinity.schemas import LINKS, TABLES
from affinity.sinks import writers
from affinity.sources import readers, views
from affinity.streaming import progress, replay, stream
from affinity.workspace import Workspace

CONFIG = Config()
TOPIC = CONFIG.topic
# Fixed values of the workload: messages of a bounded replay, and whose list is shown.
REPLAY_LIMIT = 10_000
NTH_USER = 139
RANK2_LAMBDA, RANK2_STEPS = 0.05, 4
# Rank, lambdas and steps of the grid at rank 3, and of one fit at rank 8.
RANK3 = (3, (0.02, 0.05), (2, 4))
RANK8 = (8, (0.05,), (2,))
REPLAY_BATCH = 10_000
# Whole batches that one trigger takes, and messages of them that a task reads.
BATCHES_TOGETHER = 100
REPLAY_TASK = 100_000
REPLAY_ORDER = ["userId", "movieId", "rating"]

_GOOD_LINES = {
    "links": views.link_lines,
    "movies": views.movie_lines,
    "ratings": views.rating_lines,
    "tags": views.tag_lines,
}


def _lines(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _GOOD_LINES[table](spark, sf_dir).union(
        views.wrong_lines(spark, sf_dir, table)
    )


_LINES = {table: _lines(table) for table in _GOOD_LINES}
_stages: dict[tuple[str, str], Stages] = {}


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    """Stages of this session and data set; queries share what is written already."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stages(
            Workspace(spark), views.ratings(spark, sf_dir), views.movies(spark, sf_dir), CONFIG
        )
    return _stages[key]


def _name(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex[:8]}"


def _fresh(s: Stages, name: str) -> str:
    return s.workspace.path(_name(name))


def raw_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Raw text files of a table, as lines."""
    return stages(spark, sf_dir).workspace.text_stage(
        f"raw/{table}", lambda: _LINES[table](spark, sf_dir)
    )


def _cleaned(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: clean.clean(raw_lines(spark, sf_dir, table), table)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        clean.rejected(clean.classify(raw_lines(spark, sf_dir, table), table)).select(
            F.lit(table).alias("table_name"), "value", "reason"
        )
        for table in _LINES
    ]
    return reduce(DataFrame.union, parts)


def etl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        clean.counts(clean.classify(raw_lines(spark, sf_dir, table), table), table)
        for table in _LINES
    ]
    return reduce(DataFrame.union, parts)


def ingest_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw file put into a catalog table, and the rows then found there."""
    s = stages(spark, sf_dir)
    found = []
    for table in _LINES:
        path = _fresh(s, f"ingested-{table}")
        name = f"{table}_{uuid.uuid4().hex[:8]}"
        done = ingest.ingest(raw_lines(spark, sf_dir, table), table, path, name)
        found.append(
            spark.table(name)
            .agg(F.count(F.lit(1)).alias("stored"))
            .selectExpr(
                f"'{table}' as table_name", "stored", "0L as rejects", f"{done.kept}L as counted"
            )
        )
        found.append(
            done.rejects.agg(F.count(F.lit(1)).alias("rejects"))
            .selectExpr(f"'{table}' as table_name", "0L as stored", "rejects", "0L as counted")
        )
    return (
        reduce(DataFrame.union, found)
        .groupBy("table_name")
        .agg(*[F.sum(c).alias(c) for c in ("stored", "rejects", "counted")])
    )


def _as_text(rows: DataFrame, table: str) -> DataFrame:
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TABLES[table].names]
    return rows.select(F.lit(table).alias("table_name"), F.concat_ws("|", *texts).alias("fields"))


def ingest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that every catalog table holds after its raw file was put in."""
    s = stages(spark, sf_dir)
    parts = []
    for table in _LINES:
        name = f"{table}_{uuid.uuid4().hex[:8]}"
        ingest.ingest(raw_lines(spark, sf_dir, table), table, _fresh(s, f"rows-{table}"), name)
        parts.append(_as_text(spark.table(name), table))
    return reduce(DataFrame.union, parts)


def ingest_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of raw files, a line per customer, in which none can be kept: they are there, and empty."""
    s = stages(spark, sf_dir)
    parts = []
    for table in ("links", "movies", "ratings"):
        name = f"{table}_{uuid.uuid4().hex[:8]}"
        lines = s.workspace.text_stage(
            f"wrong/{table}",
            lambda t=table: views.wrong_lines(spark, sf_dir, t, "customer", "c_custkey", "c_name"),
        )
        done = ingest.ingest(lines, table, _fresh(s, f"nothing-{table}"), name)
        stored = spark.table(name).agg(F.count(F.lit(1)).alias("stored"))
        parts.append(
            stored.selectExpr(
                f"'{table}' as table_name", "stored", f"{done.rejected}L as rejected",
                f"{done.dropped}L as dropped",
            )
        )
    return reduce(DataFrame.union, parts)


_CSV_TABLES = {
    "links": views.links_table,
    "movies": views.movies,
    "ratings": views.ratings,
    "tags": views.tags_table,
}


def csv_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """CSV files of a table with headers, and a broken record for every customer beside them."""
    s = stages(spark, sf_dir)
    path = _fresh(s, f"csv-{table}")
    as_it_is = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    _CSV_TABLES[table](spark, sf_dir).write.options(**as_it_is).csv(f"{path}/good", header=True)
    views.wrong_lines(spark, sf_dir, table, "customer", "c_custkey", "c_name").write.text(f"{path}/broken")
    return readers.csv_lines(spark, [f"{path}/good", f"{path}/broken"], TABLES[table])


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files put into catalog tables: the rows kept there, and the rejected records."""
    s = stages(spark, sf_dir)
    parts = []
    for table in _CSV_TABLES:
        name = f"{table}_{uuid.uuid4().hex[:8]}"
        lines = csv_lines(spark, sf_dir, table)
        done = ingest.ingest(lines, table, _fresh(s, f"from-csv-{table}"), name, clean.classify_csv)
        kept = _as_text(spark.table(name), table)
        parts.append(kept.select("table_name", F.lit(None).cast("string").alias("reason"), F.col("fields").alias("value")))
        parts.append(done.rejects.select(F.lit(table).alias("table_name"), "reason", "value"))
    return reduce(DataFrame.union, parts)


def links_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links as CSV with a header, filtered, written as few files, read back."""
    s = stages(spark, sf_dir)
    source, target = _fresh(s, "links-csv"), _fresh(s, "links")
    views.links_table(spark, sf_dir).write.csv(source, header=True)
    writers.write_few_files(readers.links_with_tmdb(spark, source, LINKS), target)
    return spark.read.schema(LINKS).parquet(target)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned tags put into a table twice: the second time replaces the first."""
    s = stages(spark, sf_dir)
    name = f"tags_{uuid.uuid4().hex[:8]}"
    rows = clean.clean(raw_lines(spark, sf_dir, "tags"), "tags")
    path = s.workspace.path(name)
    writers.replace_table(rows.select("userId", "movieId", "tag", "timestamp"), name, path)
    return writers.replace_table(rows, name, path)


def ratings_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).ratings().agg(F.count(F.lit(1)).alias("n"))


def distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular.distinct_users(stages(spark, sf_dir).train()).orderBy("userId")


def nth_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular.nth_user(stages(spark, sf_dir).train(), NTH_USER)


def movie_rating_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular.rating_counts(stages(spark, sf_dir).train())


def popular_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular.popular(stages(spark, sf_dir).train())


def unpopular_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular.popular(stages(spark, sf_dir).train(), ascending=True)


def popular_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return popular.list_titles(popular.popular(s.train()), s.movies).select(
        "rank", "movieId", "title", "c"
    )


def newest_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular.newest(stages(spark, sf_dir).ratings())


def time_split_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).halves()[0]


def time_split_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).halves()[1]


def train_test_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return evaluate.overlap(s.train(), s.test())


def rmse_item_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return evaluate.item_mean_error(s.train(), s.test()).select(
        F.round("rmse", 6).alias("rmse"), "n"
    )


def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode(stages(spark, sf_dir).test(), TOPIC)


def _head(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay.first_rows(stages(spark, sf_dir).test(), REPLAY_ORDER, REPLAY_LIMIT)
    return messages.encode(rows, TOPIC, "position")


def replay_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded replay: the first messages of the test half in a fixed order."""
    return _head(spark, sf_dir).select("key", "value")


def title_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test rating with its title."""
    s = stages(spark, sf_dir)
    return popular.lookup_titles(s.test(), s.movies).select("userId", "movieId", "rating", "title")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages to serve: the test half, and events of visitors without ratings."""
    s = stages(spark, sf_dir)

    def build() -> DataFrame:
        rated = messages.encode(s.test(), TOPIC)
        return rated.union(views.visitor_messages(spark, sf_dir, TOPIC))

    return s.workspace.stage("requests", build)


def route_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = serve.decode(requests(spark, sf_dir))
    return serve.known_requests(asked, stages(spark, sf_dir).known_users()).select("userId", "value")


def route_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = serve.decode(requests(spark, sf_dir))
    return serve.new_requests(asked, stages(spark, sf_dir).known_users()).select("userId", "value")


def cold_start_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    asked = serve.per_user(serve.decode(requests(spark, sf_dir)))
    return serve.fallback(serve.new_requests(asked, s.known_users()), s.popular(), s.movies).select(
        "userId", "requests", "rank", "movieId", "title"
    )


def als_user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = stages(spark, sf_dir).model()
    return chosen.users.select("userId", F.round("factor", 6).alias("factor"))


def als_item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = stages(spark, sf_dir).model()
    return chosen.items.select("movieId", F.round("factor", 6).alias("factor"))


def als_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every user factor solves its own equation, given the item factors."""
    s = stages(spark, sf_dir)
    return factor.equation_gaps(s.model(), s.train(), s.fit().item_rows).select(
        "userId", (F.col("gap") < 1e-9).alias("ok")
    )


def als_rank3_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a rank-3 model of ``pyspark.ml``, whose factors are floats."""
    train = stages(spark, sf_dir).train()
    fitted = anyrank.fit(train, rank=3, iterations=5, lam=0.05)
    return anyrank.equation_gaps(fitted, train, 0.05).select(
        "userId", (F.col("gap") < 1e-3).alias("ok")
    )


def _rank2(spark: SparkSession, sf_dir: str) -> factor2.Rank2:
    s = stages(spark, sf_dir)
    if s.rank2 is None:
        s.rank2 = factor2.fit(s.workspace, s.train(), RANK2_LAMBDA, RANK2_STEPS)
    return s.rank2


def als_rank2_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of a rank-2 model."""
    fitted = _rank2(spark, sf_dir)
    sides = [
        side.select(F.lit(part).alias("part"), F.col(key).alias("id"), "f0", "f1")
        for part, key, side in (("user", "userId", fitted.users), ("item", "movieId", fitted.items))
    ]
    return sides[0].union(sides[1]).withColumns({c: F.round(c, 4) for c in ("f0", "f1")})


def als_rank2_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = evaluate.weighted(stages(spark, sf_dir).test())
    return factor2.error(_rank2(spark, sf_dir), tested).select(F.round("rmse", 4).alias("rmse"), "n")


def als_rank2_topn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    found = layers.for_users(s.workspace, _rank2(spark, sf_dir), name=_name("angles"))
    return found.withColumn("rating", F.round("rating", 4))


def _factors(fitted: rankk.RankModel) -> DataFrame:
    """(part, id, f0, ...) of both sides."""
    sides = [
        side.select(F.lit(part).alias("part"), F.col(key).alias("id"), *fitted.columns)
        for part, key, side in (("user", "userId", fitted.users), ("item", "movieId", fitted.items))
    ]
    return sides[0].union(sides[1]).withColumns({c: F.round(c, 6) for c in fitted.columns})


def als_rank8_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _factors(stages(spark, sf_dir).rank_models(*RANK8)[0])


def als_rank8_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the factors of every user solve their equations."""
    s = stages(spark, sf_dir)
    gaps = rankk.equation_gaps(s.rank_models(*RANK8)[0], s.train())
    return gaps.select("userId", (F.col("gap") < 1e-9).alias("ok"))


def als_rank3_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).rank_errors(*RANK3).select(
        "lambda", "iterations", F.round("rmse", 6).alias("rmse"), "n"
    )


def als_rank3_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best model of the grid as it was saved: both sides, and lambda, steps and error."""
    loaded = stages(spark, sf_dir).rank_best(*RANK3)
    facts = spark.range(1).select(
        F.lit("params").alias("part"), F.lit(0).alias("id"), F.lit(loaded.lam).alias("f0"),
        F.lit(float(loaded.iterations)).alias("f1"), F.round(F.lit(loaded.rmse), 6).alias("f2"),
    )
    return _factors(loaded).union(facts)


def _rank3_lists(spark: SparkSession, sf_dir: str, users: DataFrame | None = None) -> DataFrame:
    s = stages(spark, sf_dir)
    return bestitems.for_users(s.workspace, s.rank_best(*RANK3), users, CONFIG.list_size, name=_name("lists"))


def als_rank3_topn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_rank3_lists(spark, sf_dir))


def als_rank3_topn_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    nth = popular.nth_user(stages(spark, sf_dir).train(), NTH_USER)
    return _rounded(_rank3_lists(spark, sf_dir, nth))


def als_rank3_topn_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _rank3_lists(spark, sf_dir)
    return _rounded(popular.lookup_titles(found, stages(spark, sf_dir).movies), "title")


def als_rmse_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best(stages(spark, sf_dir).errors()).select(
        F.round("rmse", 6).alias("rmse"), "n"
    )


def als_rmse_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).overlap_errors().select(
        "lambda", "iterations", F.round("rmse", 6).alias("rmse"), "n"
    )


def als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages(spark, sf_dir).errors().select(
        "lambda", "iterations", F.round("rmse", 6).alias("rmse"), "n"
    )


def als_grid_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.best(stages(spark, sf_dir).errors()).select(
        "lambda", "iterations", F.round("rmse", 6).alias("rmse")
    )


def _rounded(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        "userId", "rank", "movieId", F.round("rating", 6).alias("rating"), *extra
    )


def als_topn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(model.for_all(stages(spark, sf_dir).model()))


def topn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of all users, put into a result table."""
    s = stages(spark, sf_dir)
    name = f"top_items_{uuid.uuid4().hex[:8]}"
    rows = model.for_all(s.model(), CONFIG.list_size)
    return _rounded(writers.replace_table(rows, name, s.workspace.path(name)))


def als_topn_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return _rounded(model.for_users(s.model(), popular.nth_user(s.train(), NTH_USER)))


def als_topn_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    chosen = s.model()
    return _rounded(
        model.suggestions_for(chosen.users, model.titled(model.top_lists(chosen.items), s.movies)),
        "title",
    )


def als_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published model as a reader finds it: factors of both sides and parameters."""
    root = stages(spark, sf_dir).published()
    loaded = model.load(spark, model.current_path(spark, root))
    facts = spark.createDataFrame(
        [("lambda", loaded.lam), ("iterations", float(loaded.iterations)), ("rmse", loaded.rmse)],
        "part string, value double",
    )
    rows = [
        loaded.users.select(F.lit("user").alias("part"), F.col("userId").alias("id"), "factor"),
        loaded.items.select(F.lit("item").alias("part"), F.col("movieId").alias("id"), "factor"),
        facts.select("part", F.lit(0).alias("id"), F.col("value").alias("factor")),
    ]
    return reduce(DataFrame.union, rows).withColumn("factor", F.round("factor", 6))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests as a stream of message files, two files to a batch."""
    s = stages(spark, sf_dir)
    requests(spark, sf_dir)
    return stream.read_messages(
        spark, "parquet", s.workspace.path("requests"), files_per_batch=2
    )


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    out = _fresh(s, "decoded")
    rows = stream.decoded(_replayed(spark, sf_dir))
    stream.to_files(rows, out, f"{out}-checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def _numbered_batches(spark: SparkSession, log: str) -> DataFrame:
    """The log in batches of REPLAY_BATCH messages, of which a trigger takes many."""
    return stream.read_messages(
        spark, "replay", log, offsets_per_batch=REPLAY_BATCH,
        options={"messagesPerTask": str(REPLAY_TASK)}, batches_together=BATCHES_TOGETHER,
    )


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole test half as a paced stream: which batch brings which message."""
    s = stages(spark, sf_dir)
    log = _fresh(s, "replay")
    runs = replay.runs(s.workspace, _name("runs"), s.test(), REPLAY_ORDER)
    replay.write_log(messages.encode(runs, TOPIC, "range", "first", "until"), log)
    rows = stream.decoded(_numbered_batches(spark, log))
    stream.to_the_end(
        stream.by_batch(
            rows, lambda batch: batch, f"{log}-out", f"{log}-checkpoint", interval="0 seconds"
        )
    )
    return spark.read.parquet(f"{log}-out").select(F.col("batch").cast("int").alias("batch_id"), "userId", "value")


def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routing inside the stream: joins of every batch with the known users."""
    s = stages(spark, sf_dir)
    out = _fresh(s, "routed")
    known = s.known_users()
    rows = stream.decoded(_replayed(spark, sf_dir))
    stream.by_batch(
        rows, lambda batch: stream.routed(batch, known), out, f"{out}-checkpoint"
    ).awaitTermination()
    return spark.read.parquet(out).select("userId", "value", "route")


def stream_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suggestions of all batches; requests of a user are added up over the batches."""
    s = stages(spark, sf_dir)
    out = _fresh(s, "served")
    current = stream.CurrentModel(
        spark, s.published(), s.popular(), s.movies, CONFIG.list_size
    )
    try:
        stream.serve(
            _replayed(spark, sf_dir), current, out, f"{out}-checkpoint"
        ).awaitTermination()
    finally:
        current.close()
    return (
        spark.read.parquet(out)
        .groupBy("userId", "source", "rank", "movieId", "title")
        .agg(F.sum("requests").alias("requests"))
    )


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests replayed in the order of their text and served: what each batch took and gave."""
    s = stages(spark, sf_dir)
    log = _fresh(s, "report")
    runs = replay.runs(s.workspace, _name("request-runs"), requests(spark, sf_dir), ["value"])
    replay.write_log(runs.withColumn("key", F.lit(TOPIC)), log)
    rows = _numbered_batches(spark, log)
    current = stream.CurrentModel(spark, s.published(), s.popular(), s.movies, CONFIG.list_size)
    report = progress.Report(spark)
    try:
        query = stream.serve(
            rows, current, f"{log}-out", f"{log}-checkpoint", interval="0 seconds", report=report
        )
        stream.to_the_end(query)
        report.settled(query)
        return report.table()
    finally:
        report.close()
        current.close()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_links": _cleaned("links"),
    "clean_movies": _cleaned("movies"),
    "clean_ratings": _cleaned("ratings"),
    "clean_tags": _cleaned("tags"),
    "rejects": rejects,
    "etl_counts": etl_counts,
    "ingest_tables": ingest_tables,
    "ingest_rows": ingest_rows,
    "ingest_nothing": ingest_nothing,
    "csv_ingest": csv_ingest,
    "links_not_null": links_not_null,
    "table_roundtrip": table_roundtrip,
    "ratings_count": ratings_count,
    "distinct_users": distinct_users,
    "nth_user": nth_user,
    "movie_rating_counts": movie_rating_counts,
    "popular_top5": popular_top5,
    "unpopular_top5": unpopular_top5,
    "popular_titles": popular_titles,
    "newest_top5": newest_top5,
    "time_split_train": time_split_train,
    "time_split_test": time_split_test,
    "train_test_overlap": train_test_overlap,
    "rmse_item_mean": rmse_item_mean,
    "encode_messages": encode_messages,
    "replay_head": replay_head,
    "title_lookup": title_lookup,
    "route_known": route_known,
    "route_new": route_new,
    "cold_start_fallback": cold_start_fallback,
    "als_user_factors": als_user_factors,
    "als_item_factors": als_item_factors,
    "als_normal_equations": als_normal_equations,
    "als_rank3_equations": als_rank3_equations,
    "als_rank2_factors": als_rank2_factors,
    "als_rank2_rmse": als_rank2_rmse,
    "als_rank2_topn_all": als_rank2_topn_all,
    "als_rank8_factors": als_rank8_factors,
    "als_rank8_equations": als_rank8_equations,
    "als_rank3_grid": als_rank3_grid,
    "als_rank3_saved": als_rank3_saved,
    "als_rank3_topn_all": als_rank3_topn_all,
    "als_rank3_topn_one": als_rank3_topn_one,
    "als_rank3_topn_titles": als_rank3_topn_titles,
    "als_rmse_holdout": als_rmse_holdout,
    "als_rmse_overlap": als_rmse_overlap,
    "als_grid": als_grid,
    "als_grid_best": als_grid_best,
    "als_topn_all": als_topn_all,
    "topn_table": topn_table,
    "als_topn_one": als_topn_one,
    "als_topn_titles": als_topn_titles,
    "als_save_load": als_save_load,
    "stream_decode": stream_decode,
    "stream_replay": stream_replay,
    "stream_route": stream_route,
    "stream_serve": stream_serve,
    "stream_report": stream_report,
}
