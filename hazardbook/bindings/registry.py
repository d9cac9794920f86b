"""Registration of a query together with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_A_TASK = 100_000


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a given table over all cores, for queries that write feed text from it: the
    tables are compact files, and parsing costs far more than moving their rows. A larger
    table makes more tasks, not larger ones. Rows are dealt by a hash, which needs no sort."""
    tasks = -(-scan.count() // ROWS_A_TASK)  # only footers are read
    wanted = max(scan.sparkSession.sparkContext.defaultParallelism, tasks)
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, *scan.columns[:2])
