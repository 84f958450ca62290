"""Written stages of one run.

A stage is computed once, written to the shared folder and read back. That cuts
the lineage, so a lost executor costs a re-read and not a recomputation, and every
reader sees the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from affinity.config import shared_folder


class Workspace:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.tag = uuid.uuid4().hex[:12]
        self.root = root or f"{shared_folder(spark)}/affinity-{self.tag}"
        self._stages: dict[str, DataFrame] = {}
        self._tables: list[str] = []

    def close(self) -> None:
        """Drop the tables and delete the folder; nothing read from them works afterwards."""
        for table in self._tables:
            self.spark.sql(f"drop table if exists {table}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(path, True)
        self._tables, self._stages = [], {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage ``name``, written on first use."""
        if name not in self._stages:
            self._stages[name] = self.write(name, build())
        return self._stages[name]

    def text_stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The same for lines, kept as text files."""
        if name not in self._stages:
            build().write.mode("overwrite").text(self.path(name))
            self._stages[name] = self.spark.read.text(self.path(name))
        return self._stages[name]

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_bucketed(
        self, name: str, df: DataFrame, keys: Sequence[str], buckets: int
    ) -> DataFrame:
        """Write ``df`` hashed on ``keys``: later joins and groupings on them need no shuffle."""
        table = f"affinity_{self.tag}_{name.replace('/', '_')}"
        (
            df.repartition(buckets, *keys)
            .write.bucketBy(buckets, *keys)
            .mode("overwrite")
            .option("path", self.path(name))
            .saveAsTable(table)
        )
        self._tables.append(table)
        return self.spark.table(table)
