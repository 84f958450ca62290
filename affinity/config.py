"""Settings, the session and the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Rows of a keyed table that may be broadcast: 1,000,000 rows of an int and
# nine doubles stay under about 200 MB once hashed. Larger tables are joined by
# shuffle or by bucket.
BROADCAST_ROWS = 1_000_000

# Numbers beside the key that the bound above is meant for.
BROADCAST_COLUMNS = 9

# Rows up to which a table that is read in every step of a loop stays persisted.
PERSIST_ROWS = 100_000_000

# Rows below which splitting a table further costs more than it saves.
TASK_ROWS = 50_000

# Rows that one bucket or one group of a join key may hold before it is split.
GROUP_ROWS = 4_000_000

# Pairs above which a fit walks through blocks of factors and broadcasts none.
WALK_PAIRS = 1_000_000

# Fixed value: the number of buckets Spark allows a table by default.
MAX_BUCKETS = 100_000


@dataclass(frozen=True)
class Config:
    """What a run needs to know."""

    app_name: str = "affinity"
    master: str | None = None
    shuffle_partitions: int | None = None
    # Share of training rows, grid, list length and topic of the workload.
    train_share: float = 0.6
    lambdas: tuple[float, ...] = (0.001, 0.005, 0.01)
    iterations: tuple[int, ...] = (10, 12, 16)
    list_size: int = 5
    topic: str = "movie_topic"


@dataclass(frozen=True)
class JdbcTarget:
    """Where a result table lives. The password comes from the environment only."""

    url: str
    table: str
    driver: str
    user: str
    password: str

    @classmethod
    def from_env(cls, env=os.environ) -> JdbcTarget:
        return cls(
            url=env["AFFINITY_JDBC_URL"],
            table=env["AFFINITY_JDBC_TABLE"],
            driver=env["AFFINITY_JDBC_DRIVER"],
            user=env["AFFINITY_JDBC_USER"],
            password=env["AFFINITY_JDBC_PASSWORD"],
        )

    def properties(self) -> dict[str, str]:
        return {"driver": self.driver, "user": self.user, "password": self.password}


def session(config: Config = Config()) -> SparkSession:
    """A session with runtime re-planning and skew handling on."""
    builder = (
        SparkSession.builder.appName(config.app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if config.master:
        builder = builder.master(config.master)
    if config.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(config.shuffle_partitions))
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]):
    """Session settings for the time of a block; what was set before comes back."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def may_broadcast(rows: int, columns: int = 1, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a counted table with ``columns`` numbers beside its key is small enough."""
    return rows * max(columns, BROADCAST_COLUMNS) <= limit * BROADCAST_COLUMNS


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for written stages: ``spark.checkpoint.dir`` as the cluster set it.

    Only a local session may go without it; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="affinity-")
    return _local_folders[app]
