"""Operators on array columns: membership, counting, joining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardbook.operators.skew import own_shuffle

_ITEM = "__item"
_MATCH = "__match"
_FOUND = "__found"


def where_contains(df: DataFrame, array: str, value) -> DataFrame:
    return df.where(F.array_contains(F.col(array), F.lit(value)))


def unnest(df: DataFrame, array: str, item: str, *, keep_empty: bool = False) -> DataFrame:
    """One row per array entry. Rows with an empty or NULL array vanish, or stay once
    with a NULL entry when ``keep_empty`` is set."""
    expand = F.explode_outer if keep_empty else F.explode
    return df.withColumn(item, expand(F.col(array)))


def count_per_item(
    df: DataFrame, array: str, item: str, count: str, where: Column | None = None
) -> DataFrame:
    """How many entries name each item. Repeats inside one array count each time."""
    rows = df if where is None else df.where(where)
    return (
        rows.select(F.explode(F.col(array)).alias(item))
        .where(F.col(item).isNotNull())
        .groupBy(item)
        .agg(F.count("*").alias(count))
    )


def join_on_item(
    left: DataFrame,
    right: DataFrame,
    array: str,
    item: str,
    how: str = "inner",
    row_key: Sequence[str] = (),
) -> DataFrame:
    """Join where ``left.array`` contains ``right.item``; one row per matching pair.

    A membership predicate would be a nested-loop join. The distinct entries are
    expanded instead and joined by equality, which AQE can broadcast or split by the
    sizes it measures.

    ``how="left"`` also keeps left rows without any match, once. It needs ``row_key``,
    columns that identify a left row and are never NULL: a row's matches are gathered
    again by its key, so the left side is read once. A row holds its own matches only.
    """
    right = right.withColumn(_MATCH, own_shuffle(F.col(item)))
    if how == "inner":
        expanded = left.withColumn(_ITEM, F.explode(F.array_distinct(F.col(array))))
        return expanded.join(right, F.col(_ITEM) == F.col(_MATCH)).drop(_ITEM, _MATCH)
    if how != "left":
        raise ValueError(f"unsupported join type {how!r}")
    if not row_key:
        raise ValueError("a left array join needs the key of a left row")
    found = F.when(F.col(_MATCH).isNotNull(), F.struct(*[c for c in right.columns if c != _MATCH]))
    expanded = left.withColumn(_ITEM, F.explode_outer(F.array_distinct(F.col(array))))
    joined = expanded.join(right, F.col(_ITEM) == F.col(_MATCH), "left")
    rest = [c for c in left.columns if c not in row_key]
    rows = joined.groupBy(*row_key).agg(
        *[F.any_value(c).alias(c) for c in rest], F.collect_list(found).alias(_FOUND)
    )
    return rows.select(*left.columns, F.inline_outer(_FOUND))
