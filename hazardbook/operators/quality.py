"""Separating malformed records without failing, and counting them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hazardbook.functions.times import usual_timestamp


def screen(df: DataFrame, valid: Column, observation: Observation | None = None) -> DataFrame:
    """Keep valid rows. Totals are observed while the rows pass, without a second scan;
    they can be read from the observation once an action has run.

    The rows are observed in any case: the filter then stays above the parser, where it
    reads a parsed column. Pushed below, it would parse every record a second time.
    """
    counted = [
        F.count_if(F.col("__valid")).alias("records"),
        F.count_if(~F.col("__valid")).alias("bad"),
    ]
    rows = df.withColumn("__valid", F.coalesce(valid, F.lit(False)))
    rows = rows.observe(observation or "quality", *counted)
    return rows.where("__valid").drop("__valid")


def held(df: DataFrame) -> DataFrame:
    """The same rows, worked out as far as they are here: a filter that comes later reads
    their columns, and nothing above is merged with the expressions that made them."""
    return df.observe(f"held {uuid.uuid4().hex}", F.count(F.lit(1)).alias("records"))


def left_after(
    documents: DataFrame, read: Column, key: str, dates: Sequence[str], is_key: Column, since: Column
) -> DataFrame:
    """The documents (``value``) that a light read does not settle, for a feed of which only
    what changed ``since`` then is wanted.

    ``read`` is a struct of few fields, named ``__read``. Where it has its ``key``, it tells
    what a whole parse would tell: whether the key is one (``is_key``), and the date, which
    is the first of ``dates`` that is there, if that is in the usual form. Documents from
    before are left out, and those whose key is none lose their text, so that they are
    counted without being parsed. Others stay as they are.
    """
    dated, missing = F.lit(None).cast("timestamp_ntz"), F.lit(True)
    for date in dates:
        dated = F.coalesce(dated, F.when(missing, usual_timestamp(F.col(date))))
        missing = missing & F.col(date).isNull()
    seen = documents.select("*", read.alias("__read"))
    seen = held(seen.select("*", F.coalesce(is_key, F.lit(False)).alias("__is_key"), dated.alias("__dated")))
    known, is_key = F.col(key).isNotNull(), F.col("__is_key")
    old = F.coalesce(F.col("__dated") < since, F.lit(False))
    text = F.when(~known | is_key, F.col("value"))
    return seen.where(~(known & is_key & old)).withColumn("value", text).select(*documents.columns)


def quality_counts(df: DataFrame, valid: Column, *groups: str) -> DataFrame:
    """Valid and bad record counts per group."""
    ok = F.coalesce(valid, F.lit(False))
    return df.groupBy(*groups).agg(
        F.count_if(ok).alias("records"), F.count_if(~ok).alias("bad")
    )


def table_statistics(df: DataFrame, column: str) -> DataFrame:
    """Row count and range of one column; only that column is read."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
    )


def path_differences(stored: DataFrame, registered: DataFrame, on: str) -> DataFrame:
    """Paths on one side only: ``stray`` is stored but not registered, ``missing`` is
    registered but not stored."""
    sides = (
        stored.select(on, F.lit(1).alias("__stored"))
        .unionByName(registered.select(on, F.lit(0).alias("__stored")))
        .groupBy(on)
        .agg(F.max("__stored").alias("hi"), F.min("__stored").alias("lo"))
    )
    return sides.where("hi = lo").select(
        on, F.when(F.col("hi") == 1, "stray").otherwise("missing").alias("problem")
    )
