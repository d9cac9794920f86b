"""Integrity and freshness of a lake, one report row per base table."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardbook.schemas import TABLES, TableRules
from hazardbook.sinks.lake import YEAR_BATCH, Lake


def staleness_limit(rules: TableRules, max_age_days: int | None) -> int | None:
    """Days without news that are still fine; None when the table is never stale."""
    if max_age_days is None or rules.min_age_days is None:
        return None
    return max(max_age_days, rules.min_age_days)


def is_stale(newest: Column, today: date, limit: int | None) -> Column:
    if limit is None:
        return F.lit(False)
    return F.coalesce(F.datediff(F.lit(today), newest) > limit, F.lit(False))


def keeps_up(newest: Column, newest_batch: Column) -> Column:
    """The newest row is at most one day older than the newest dated batch."""
    return F.when(newest_batch.isNull(), True).otherwise(
        F.coalesce(newest >= F.date_sub(newest_batch, 1), F.lit(False))
    )


def files_compared(lake: Lake) -> DataFrame:
    """Per table: files and rows in storage and in the catalog, files on one side only, and
    files whose rows changed. One aggregation over the files of all tables."""
    stored = lake.stored_files()
    none = F.lit(None).cast("long")
    sides = stored.select("table_name", "file", F.col("rows").alias("s"), none.alias("c")).unionByName(
        lake.data_files().select("table_name", "file", none.alias("s"), F.col("rows").alias("c"))
    )
    files = sides.groupBy("table_name", "file").agg(F.max("s").alias("s"), F.max("c").alias("c"))
    in_storage, in_catalog = F.col("s").isNotNull(), F.col("c").isNotNull()
    return files.groupBy("table_name").agg(
        F.count_if(in_storage).alias("files_in_storage"),
        F.count_if(in_catalog).alias("files_in_catalog"),
        F.count_if(in_storage & ~in_catalog).alias("stray_files"),
        F.count_if(~in_storage & in_catalog).alias("missing_files"),
        F.count_if(in_storage & in_catalog & (F.col("s") != F.col("c"))).alias("changed_files"),
    )


def statistics(lake: Lake) -> DataFrame:
    """Row count, range of the order column, newest dated batch and oldest year of every
    table that has rows. One column per table is read and everything is aggregated in
    one pass."""
    days = reduce(
        DataFrame.unionByName,
        [
            lake.stored(name).select(
                F.lit(name).alias("table_name"),
                F.col(rules.order).cast("date").alias("day"),
                "year",
                "batch",
            )
            for name, rules in TABLES.items()
        ],
    )
    dated = F.when(F.col("batch") != YEAR_BATCH, F.col("batch").try_cast("date"))
    return days.groupBy("table_name").agg(
        F.count("*").alias("row_count"),
        F.min("day").alias("min_date"),
        F.max("day").alias("max_date"),
        F.max(dated).alias("newest_batch"),
        F.min("year").alias("oldest_year"),
    )


def consistent(rules: TableRules) -> Column:
    """Stored and registered files agree and the rows fit the names of the batches."""
    ok = (F.col("stray_files") == 0) & (F.col("missing_files") == 0) & (F.col("changed_files") == 0)
    newest, oldest = F.col("newest_batch"), F.col("oldest_year")
    if rules.name == "epss":
        ok &= newest.isNull() | F.coalesce(F.col("max_date") == newest, F.lit(False))
        return ok & (
            oldest.isNull() | F.coalesce(F.year("min_date") == oldest, F.lit(False))
        )
    if rules.dated_updates_follow:
        ok &= keeps_up(F.col("max_date"), newest)
    return ok


def verify(lake: Lake, today: date, max_age_days: int | None = None) -> DataFrame:
    """One report row per base table; without a catalog one row that says so."""
    if not lake.exists():
        return lake.stored_paths().agg(F.count("*").alias("files_in_storage")).select(
            F.lit("catalog not found").alias("table_name"),
            "files_in_storage",
            F.lit(False).alias("ok"),
            F.lit(False).alias("stale"),
        )
    lake.refresh()
    counts = [
        "files_in_storage", "files_in_catalog", "stray_files", "missing_files", "changed_files",
    ]
    names = lake.spark.createDataFrame([(name,) for name in TABLES], "table_name string")
    joined = (
        names.join(statistics(lake), "table_name", "left")
        .join(files_compared(lake), "table_name", "left")
        .na.fill(0, [*counts, "row_count"])
    )
    ok, stale = F.lit(None), F.lit(None)
    for name, rules in TABLES.items():
        here = F.col("table_name") == name
        limit = staleness_limit(rules, max_age_days)
        ok = F.when(here, consistent(rules)).otherwise(ok)
        stale = F.when(here, is_stale(F.col("max_date"), today, limit)).otherwise(stale)
    return joined.select(
        "table_name",
        *counts,
        "row_count",
        "min_date",
        "max_date",
        ok.alias("ok"),
        stale.alias("stale"),
    )


def overall(report: DataFrame) -> DataFrame:
    """One row: everything is fine, anything is stale."""
    return report.agg(F.bool_and("ok").alias("ok"), F.bool_or("stale").alias("stale"))
