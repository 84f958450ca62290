"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.config import JdbcTarget, settings
from affinity.functions.messages import user_id
from affinity.sinks import versions

# Bytes, as they are shuffled, that go into one output file when few files are asked for,
# and rows after which a file is closed in any case.
FILE_BYTES = 128 << 20
FILE_ROWS = 5_000_000


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_few_files(
    df: DataFrame, path: str, by: str | None = None, file_bytes: int = FILE_BYTES, file_rows: int = FILE_ROWS
) -> int:
    """One file while the rows fit into one, else as few as hold them; how many there are.

    The rows are read once: they are shuffled, and the sizes of the shuffle decide which parts
    share a file and which are split. With ``by``, rows of one value lie together, and a value
    with more than a file's bytes has files of its own. A part is split between the tasks
    that made it, so a file may exceed ``file_bytes`` by what one of them sent.
    """
    sizes = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": min(file_bytes // 5, 1 << 20),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": file_bytes,
    }
    spark = df.sparkSession
    with settings(spark, sizes):
        rows = df.hint("rebalance", by) if by else df.hint("rebalance")
        rows.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    return len(spark.read.schema(df.schema).parquet(path).inputFiles())


def replace_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a table with the rows of ``df``, in one step for its readers; see ``versions``."""
    return versions.replace(df, table, path)


def pending_rows(results: DataFrame, stored: DataFrame, run_id: str) -> DataFrame:
    """The rows of a run that the target does not hold yet."""
    mine = stored.filter(F.col("run_id") == run_id).select("userId", "rank")
    return results.withColumn("run_id", F.lit(run_id)).join(mine, ["userId", "rank"], "left_anti")


def table_exists(spark: SparkSession, target: JdbcTarget) -> bool:
    """Whether the database has the target, by its standard catalogue."""
    name = target.table.rsplit(".", 1)[-1].strip('"`').lower().replace("'", "''")
    found = spark.read.jdbc(
        target.url,
        f"(select 1 as there from information_schema.tables where lower(table_name) = '{name}') as t",
        properties=target.properties(),
    )
    return bool(found.head(1))


def stored_rows(spark: SparkSession, target: JdbcTarget, run_id: str, users: tuple, connections: int) -> DataFrame:
    """(run_id, userId, rank) of the run in the target, read by ranges of users."""
    run = run_id.replace("'", "''")
    return spark.read.jdbc(
        target.url,
        f"(select run_id, userId, rank from {target.table} where run_id = '{run}') as stored",
        column="userId",
        lowerBound=users[0],
        upperBound=users[1] + 1,
        numPartitions=connections,
        properties=target.properties(),
    )


def append_jdbc(results: DataFrame, target: JdbcTarget, run_id: str, connections: int = 16) -> None:
    """Append a run's top-n rows in one write over a bounded number of connections.

    Rows of the run that are already stored are left out, so a rerun adds nothing; the first
    write makes the table. A unique key on (run_id, userId, rank) in the database also covers
    a task that fails after its commit.
    """
    spark: SparkSession = results.sparkSession
    rows = results.withColumn("run_id", F.lit(run_id))
    users = tuple(results.agg(F.min("userId"), F.max("userId")).first())
    if users[0] is not None and table_exists(spark, target):
        rows = pending_rows(results, stored_rows(spark, target, run_id, users, connections), run_id)
    rows.write.mode("append").option("numPartitions", connections).jdbc(
        target.url, target.table, properties=target.properties()
    )


def send_messages(messages: DataFrame, fmt: str, location: str, topic: str | None = None) -> None:
    """Write (key, value) rows to ``kafka`` brokers, or as files of another format.

    For brokers, a key that is the topic's name gives way to the user of the message.
    """
    rows = messages.select("key", "value")
    if fmt == "kafka":
        by_user = F.coalesce(user_id(F.col("value")).cast("string"), F.col("key"))
        rows = rows.withColumn("key", F.when(F.col("key") == topic, by_user).otherwise(F.col("key")))
        rows.write.format("kafka").option("kafka.bootstrap.servers", location).option(
            "topic", topic
        ).save()
    else:
        rows.write.mode("append").format(fmt).save(location)


def show(df: DataFrame, rows: int = 20) -> None:
    df.show(rows, truncate=False)
