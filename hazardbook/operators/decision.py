"""Matching rows with gaps against a small fixed decision table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_literal(rows: Sequence[Mapping[str, object]]) -> Column:
    """The table as one constant array of structs."""
    return F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in rows]
    )


def matching_rows(
    df: DataFrame,
    table: Sequence[Mapping[str, object]],
    parameters: Sequence[str],
    alias: str,
) -> DataFrame:
    """Add ``alias``, one row per table row that agrees with every given parameter.

    A NULL parameter agrees with all values. The table is a plan constant of a few
    dozen rows, so filtering it per row is a map-side step without any join.
    """

    def agrees(entry: Column) -> Column:
        verdict = F.lit(True)
        for name in parameters:
            verdict = verdict & (F.col(name).isNull() | (F.col(name) == entry[name]))
        return verdict

    hits = F.filter(table_literal(table), agrees)
    return df.withColumn(alias, F.explode(hits))
