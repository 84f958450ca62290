"""Tables that are replaced as a whole, so that readers always meet one version of them.

Every version is a folder of its own under a root. It is written first; then the table's
location is switched to it, by one call to the catalogue. A write that fails leaves the old version
as it was, and a reader that has begun goes on with the files it began with, as the
last versions are kept.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Versions of a table that stay: the current one, and those before it.
KEEP = 2
# Hours after which a version that was never finished is taken for given up.
ABANDONED_HOURS = 24


class Versions:
    """The version folders under a root, by age."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def new(self) -> str:
        return f"{self.root}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def names(self) -> list[str]:
        """All versions, the oldest first, unfinished ones included."""
        fs, root = self._fs(), self._path(self.root)
        if not fs.exists(root):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n for n in found if n.startswith("v-"))

    def finished(self, name: str) -> bool:
        return self._fs().exists(self._path(f"{self.root}/{name}/_SUCCESS"))

    def drop(self, name: str) -> None:
        self._fs().delete(self._path(f"{self.root}/{name}"), True)

    def write(self, write: Callable[[str], None]) -> str:
        """The path of a new version that ``write`` has filled; nothing is left of one that failed."""
        path = self.new()
        try:
            write(path)
        except BaseException:
            self.drop(path.rsplit("/", 1)[1])
            raise
        return path

    def retain(self, current: str, keep: int = KEEP) -> None:
        """Delete what is older than the ``keep`` last finished versions up to ``current``.

        Newer versions belong to other writers, and so do unfinished ones, unless they are a
        day old.
        """
        name = current.rsplit("/", 1)[1]
        older = [n for n in self.names() if n < name]
        done = [n for n in older if self.finished(n)]
        late = time.time_ns() - ABANDONED_HOURS * 3_600 * 10**9
        for old in older:
            given_up = old not in done and int(old.split("-")[1]) < late
            if given_up or old in done[: max(len(done) - (keep - 1), 0)]:
                self.drop(old)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def switch(spark: SparkSession, table: str, path: str, schema: StructType) -> None:
    """Lay ``table`` over ``path``.

    One step where the table is there with the same columns. A table of other columns is dropped
    and made anew, in two; its files are not touched if it was made here.
    """
    if spark.catalog.tableExists(table):
        divided = any(c.isPartition for c in spark.catalog.listColumns(table))
        if _shape(spark.table(table).schema) == _shape(schema) and not divided:
            quoted = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"alter table {table} set location '{quoted}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"drop table {table}")
    spark.catalog.createTable(table, path=path, source="parquet", schema=schema)


def default_root(spark: SparkSession, table: str) -> str:
    """A folder beside the table's own in its database."""
    *database, name = table.replace("`", "").split(".")
    found = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase())
    return f"{found.locationUri.rstrip('/')}/{name}-versions"


def replace(df: DataFrame, table: str, root: str | None = None, keep: int = KEEP) -> DataFrame:
    """Replace the rows of ``table`` by ``df``, which may read the table itself."""
    spark = df.sparkSession
    versions = Versions(spark, root or default_root(spark, table))
    path = versions.write(lambda p: df.write.parquet(p))
    switch(spark, table, path, spark.read.parquet(path).schema)
    versions.retain(path, keep)
    return spark.table(table)
