"""Session settings and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import cache, wraps
from typing import ParamSpec, TypeVar

from pyspark.sql import DataFrame, SparkSession

# Joins start as sort-merge unless a side is measured to be small; AQE re-plans from
# the measured sizes, splits skewed partitions and merges tiny ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("hazardbook")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="hazardbook-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches: ``spark.checkpoint.dir`` of the session. Only a
    local session, as in tests, may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


_staged: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar(
    "staged", default=None
)


def stage(df: DataFrame, split_by: str | None = None) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Used where several actions need the same parsed rows: the lineage is cut at a
    table that outlives lost executors, and the source is parsed only once. Inside a
    ``staged_job`` the table is dropped when the job ends. With ``split_by`` a filter
    on that column later reads its own files only.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    scope = _staged.get()
    if scope is not None:
        scope.append((spark, path))
    writer = df.write.partitionBy(split_by) if split_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder through its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)


P = ParamSpec("P")
R = TypeVar("R")


def staged_job(job: Callable[P, R]) -> Callable[P, R]:
    """Drop the tables a job staged once it has ended, also after a failure."""

    @wraps(job)
    def run(*args: P.args, **kwargs: P.kwargs) -> R:
        tables: list[tuple[SparkSession, str]] = []
        token = _staged.set(tables)
        try:
            return job(*args, **kwargs)
        finally:
            _staged.reset(token)
            for spark, path in tables:
                drop_path(spark, path)

    return run
