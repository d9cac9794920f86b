"""Sorted Parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Sort keys plus a hash of the row, so that a key with very many rows is cut into
    several ranges instead of landing in one task."""
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
    return [*[F.col(k) for k in keys], F.xxhash64(*hashable)]


def ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in sorted partitions whose key ranges do not overlap. The ranges come from a
    sample, for which the rows are read once more: pass rows that are written already."""
    return df.repartitionByRange(*range_keys(df, keys)).sortWithinPartitions(*keys)


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in sorted partitions, dealt by a hash of the keys in one pass over the input.
    AQE merges the partitions of a small batch into one, whose range overlaps no other."""
    return df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One directory of zstd files that are sorted and do not overlap in key range. The
    directory is replaced."""
    ranged(df, keys).write.mode("overwrite").option("compression", "zstd").parquet(path)


ROWS_A_CHUNK = 10_000


def file_ranges(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per stored file: its rows, the smallest and the greatest key, how many rows are out
    of order in it, and whether its range overlaps that of the file before.

    Files of one batch touch at most in an equal key, of which each holds some rows.

    A file's rows are compared in chunks, which then are compared at their ends, so no task
    holds a file. Rows name their file by a number, not by its long path.
    """
    path, key = F.col("_metadata.file_path"), F.struct(*keys)
    numbered = Window.orderBy("file")  # one row a file
    files = stored.groupBy(path.alias("file")).agg(F.count("*").alias("rows")).withColumn(
        "id", F.row_number().over(numbered)
    )
    placed = stored.select(
        path.alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key")
    ).join(F.broadcast(files.select("file", "id")), "file").drop("file")
    in_chunk = Window.partitionBy("id", "chunk").orderBy("at")
    chunks = (
        placed.withColumn("chunk", F.floor(F.col("at") / ROWS_A_CHUNK))
        .withColumn("before", F.lag("key").over(in_chunk))
        .groupBy("id", "chunk")
        .agg(
            F.min("key").alias("low"),
            F.max("key").alias("high"),
            F.min_by("key", "at").alias("first"),
            F.max_by("key", "at").alias("last"),
            F.count_if(F.col("before") > F.col("key")).alias("unsorted_rows"),
        )
    )
    in_file = Window.partitionBy("id").orderBy("chunk")
    ranges = chunks.withColumn("before", F.lag("last").over(in_file)).groupBy("id").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        (F.sum("unsorted_rows") + F.count_if(F.col("before") > F.col("first"))).alias("unsorted_rows"),
    )
    in_order = Window.orderBy("low", "high")  # one row a file
    return files.join(ranges, "id").drop("id").withColumn(
        "overlaps", F.coalesce(F.lag("high").over(in_order) > F.col("low"), F.lit(False))
    )
