"""Raw or CSV lines to a catalog table and a reject table, in one pass over the lines."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from affinity.config import settings
from affinity.operators import clean
from affinity.schemas import TABLES
from affinity.sinks import versions


@dataclass(frozen=True)
class Ingested:
    table: DataFrame
    rejects: DataFrame
    kept: int
    dropped: int
    rejected: int


def ingest(
    lines: DataFrame,
    table: str,
    path: str,
    name: str | None = None,
    classify: Callable[[DataFrame, str], DataFrame] = clean.classify,
) -> Ingested:
    """Clean ``lines`` as ``table`` under ``path``; ``name`` registers the kept rows.

    ``classify`` tells how lines are read: ``clean.classify``, or ``clean.classify_csv`` for
    those of ``readers.csv_lines``.

    Kept and rejected lines go to two folders of one write, and are counted on the
    way. The catalog table lies over the kept files; nothing is copied into it. Each call
    writes a version of its own, and the table is switched to it at the end.
    """
    spark = lines.sparkSession
    columns = TABLES[table].names
    reason = F.col("reason")
    seen = Observation(f"ingest {table}")
    rows = classify(lines, table).observe(
        seen,
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason == clean.EMPTY_LAST).alias("dropped"),
        F.count_if(reason.isNotNull() & (reason != clean.EMPTY_LAST)).alias("rejected"),
    )
    # A kept line is not stored beside its fields.
    split = rows.select(
        *columns,
        F.when(reason.isNotNull(), F.col("value")).alias("value"),
        "reason",
        F.when(reason.isNull(), "kept").otherwise("rejected").alias("status"),
    )
    found = versions.Versions(spark, path)

    def write(to: str) -> None:
        with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": 2}):  # one for each status, so rows need not be sorted by it
            split.write.partitionBy("status").parquet(to)

    here = found.write(write)
    kept_path = f"{here}/status=kept"
    counts = seen.get
    if not counts["kept"]:
        spark.createDataFrame([], TABLES[table]).write.parquet(kept_path)
    if name:
        versions.switch(spark, name, kept_path, TABLES[table])
    found.retain(here)
    stored = spark.read.schema(f"{_ddl(table)}, value string, reason string, status string")
    everything = stored.parquet(here)
    return Ingested(
        everything.filter(F.col("status") == "kept").select(*columns),
        everything.filter(F.col("status") == "rejected").select("value", "reason"),
        **{key: counts[key] for key in ("kept", "dropped", "rejected")},
    )


def _ddl(table: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[table])
