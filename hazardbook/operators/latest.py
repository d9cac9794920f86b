"""One row per key: newest, first, newest snapshot, state at a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # A filter on row_number() <= 1 makes Spark keep one row per key in every map task
    # before the shuffle, so a key holding a third of the rows stays harmless.
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col(_RANK) <= 1).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Newest row of every key; a NULL order value is the oldest.

    ``tiebreak`` columns (greatest wins) make the choice among equal order values
    repeatable. They are read by the window, so name narrow columns only.
    """
    order = [F.col(order_by).desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    return _one_per_key(df, keys, order)


def first_per_key(
    df: DataFrame, keys: Sequence[str], position: Sequence[str]
) -> DataFrame:
    """First row of every key by feed or path position; the first one wins."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_first() for c in position])


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """All rows of the newest snapshot, by the snapshot's own date column.

    The maximum is a scalar subquery over one column; the wide rows are filtered where
    they are read and never shuffled.
    """
    return df.where(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


def as_of(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    moment: Column,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """State of every key at a moment: the newest row not after it."""
    return latest_per_key(df.where(F.col(order_by) <= moment), keys, order_by, tiebreak)


def record_history(df: DataFrame, key: str, value, order_by: str) -> DataFrame:
    """Every version of one record, oldest first."""
    return df.where(F.col(key) == F.lit(value)).orderBy(F.col(order_by).asc_nulls_last())
