"""The published models of a root: a log of entries, of which readers take the newest.

A model is saved first, under a path of its own. Its entry comes last: one small file, renamed into
the log when it is whole, with the rows and a checksum of either side. A reader lists the log, which
retention keeps short, and takes the newest entry whose model is there as published; it checks a
model once. So neither a torn entry nor a torn model is ever served, and the time that a reader
takes does not grow with the number of publications.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Models of a root that stay; a reader may be this many publications late.
KEEP = 5


@dataclass(frozen=True)
class Entry:
    path: str
    users: int
    items: int
    users_sum: str
    items_sum: str


def facts(side: DataFrame) -> tuple[int, str]:
    """(rows, checksum) of the rows, whatever their order."""
    row = side.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*side.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")
    ).first()
    return row[0], row[1]


class Registry:
    def __init__(self, spark: SparkSession, root: str, keep: int = KEEP):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self._checked: dict[str, bool] = {}

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        """Entries of the log, the newest first."""
        fs, log = self._fs(), self._path("log")
        if not fs.exists(log):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(log)]
        return sorted((n for n in found if n.startswith("e-")), reverse=True)

    def read(self, name: str) -> Entry | None:
        """An entry, or none if it cannot be read as one."""
        rows = self.spark.read.text(self._path("log", name).toString(), wholetext=True).head(1)
        try:
            return Entry(**json.loads(rows[0][0]))
        except (IndexError, TypeError, ValueError):
            return None

    def append(self, entry: Entry) -> str:
        name = f"e-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        fs, draft = self._fs(), self._path("log", f"_{name}")
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(asdict(entry)).encode()))
        finally:
            out.close()
        if not fs.rename(draft, self._path("log", name)):
            raise OSError(f"{name} could not be put into the log of {self.root}")
        return name

    def publish(self, users: DataFrame, items: DataFrame, save: Callable[[str], None]) -> str:
        """Save under a new path by ``save`` and make it current; returns the path."""
        path = f"{self.root}/models/{uuid.uuid4().hex}"
        (n_users, users_sum), (n_items, items_sum) = facts(users), facts(items)
        save(path)
        entry = Entry(path, n_users, n_items, users_sum, items_sum)
        if not self.whole(entry):
            raise OSError(f"the model in {path} is not the one that was saved")
        self.append(entry)
        self.retain()
        return path

    def whole(self, entry: Entry) -> bool:
        """Whether the model of the entry is there as published; looked at once."""
        if entry.path not in self._checked:
            fs = self._fs()
            found = []
            for side, key in (("users", "userId"), ("items", "movieId")):
                if not fs.exists(self._path("models", entry.path.rsplit("/", 1)[1], side)):
                    break
                rows = self.spark.read.schema(f"{key} int, factor double").parquet(f"{entry.path}/{side}")
                found.append(facts(rows))
            self._checked[entry.path] = found == [(entry.users, entry.users_sum), (entry.items, entry.items_sum)]
        return self._checked[entry.path]

    def current(self) -> Entry:
        """The newest entry whose model is whole."""
        for name in self.names():
            entry = self.read(name)
            if entry is not None and self.whole(entry):
                return entry
        raise LookupError(f"no model is published under {self.root}")

    def retain(self) -> None:
        """Delete entries and models beyond the newest ``keep``; the entry goes first."""
        fs = self._fs()
        for name in self.names()[self.keep :]:
            entry = self.read(name)
            fs.delete(self._path("log", name), False)
            if entry is not None:
                fs.delete(self._path("models", entry.path.rsplit("/", 1)[1]), True)
