"""Small helpers shared by the operators: tables, stages and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.workspace import Workspace

# Rows of ids or small values up to which a counted table may be broadcast (some 50 MB).
BROADCAST_ROWS = 500_000

# Bytes read by one task where files are read in smaller parts than that.
TASK_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession) -> Workspace:
    """A fresh folder under ``spark.checkpoint.dir`` for the stages of one call."""
    return Workspace(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within the bound."""
    return F.broadcast(df) if rows <= limit else df


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most ``rows`` rows, in as few tasks and files as hold them.

    Small tables would else be written as one file for every partition of their shuffle.
    """
    return df.coalesce(max(1, -(-rows // BROADCAST_ROWS)))


def compact(df: DataFrame, source: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``df``, made of the rows of ``source``, in tasks and files that are not tiny.

    A task gets ``task_bytes`` of what ``source`` reads, or less where that would leave cores idle;
    tables that are read in larger parts stay as they are.
    """
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(min(max(2 * cores, -(-size // task_bytes)), (1 << 31) - 1))


def components(work: Workspace, name: str, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges(a, b)``, for ids that have one.

    Labels take the smallest label of all neighbours and then the label of their label, so
    that chains shorten by doubling. Every round is written; minima combine before they are
    shuffled, and a hub's rows are split by the adaptive join.
    """
    ways = F.inline(F.expr("array(struct(a, b), struct(b as a, a as b))"))
    both = edges.filter("a <> b").select(ways).distinct()
    both = work.write(f"{name}/edges", both)
    rows = both.count()  # and no more ids than that
    first = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component"))
    labels = work.write(f"{name}/labels_0", few(first, rows))
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        met = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("c")
        )
        jump = labels.select(F.col("id").alias("c"), F.col("component").alias("next"))
        moved = met.join(jump, "c").select(
            "id", F.least("c", "next").alias("component"),
            (F.least("c", "next") < F.col("old")).alias("moved"),
        )
        written = work.write(f"{name}/labels_{step}", few(moved, rows))
        labels = written.select("id", "component")
        if not written.filter("moved").head(1):
            return labels
