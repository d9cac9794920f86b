"""Change data capture: what to append to a history, given the current feed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ShrunkSnapshot(RuntimeError):
    """The current snapshot lost more than half of the active records."""


def high_watermark(history: DataFrame, column: str):
    """Greatest stored value, None for an empty history. One column, one scalar."""
    return history.agg(F.max(column)).head()[0]


def newer_than(feed: DataFrame, column: str, watermark) -> DataFrame:
    """Strict delta: rows after the watermark. Equal and NULL values are left out."""
    return feed.where(F.col(column) > F.lit(watermark))


def newer_or_unseen(
    feed: DataFrame, history: DataFrame, key: str, column: str, watermark
) -> DataFrame:
    """Day-grain delta: rows after the watermark day, and rows of that very day whose
    key the history does not hold for the day. NULL days are left out."""
    day = F.lit(watermark)
    seen = history.where(F.col(column) == day).select(
        F.col(key).alias("__seen_key"), F.col(column).alias("__seen_day")
    )
    candidates = feed.where(F.col(column) >= day)
    return candidates.join(
        seen,
        (F.col(key) == F.col("__seen_key")) & (F.col(column) == F.col("__seen_day")),
        "left_anti",
    )


def any_difference(previous: Column, current: Column, columns: Sequence[str]) -> Column:
    """True when a column differs; NULL equals NULL, arrays compare in order."""
    return reduce(
        lambda a, b: a | b,
        [~previous[c].eqNullSafe(current[c]) for c in columns],
    )


def classify_snapshot(
    current: DataFrame, latest: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """Full outer join of the current snapshot with the newest stored row per key.

    Returns ``current`` and ``previous`` structs and a ``change``: added, changed,
    revived, removed, or NULL when there is nothing to store. Both sides hold a key
    once, so no key can be hot. Keys are never NULL. They stay plain columns for the
    join: a side that is partitioned by its key already is then not shuffled again.
    """

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(
            *[F.col(k).alias(f"__{name}_{k}") for k in keys], F.struct("*").alias(name)
        )

    cur, prev = F.col("current"), F.col("previous")
    same_key = [F.col(f"__current_{k}") == F.col(f"__previous_{k}") for k in keys]
    change = (
        F.when(cur.isNotNull() & prev.isNull(), "added")
        .when(cur.isNotNull() & prev["removed"], "revived")
        .when(cur.isNotNull() & any_difference(prev, cur, compare), "changed")
        .when(cur.isNull() & ~prev["removed"], "removed")
    )
    joined = side(current, "current").join(
        side(latest, "previous"), same_key, "full_outer"
    )
    return joined.select("current", "previous", change.alias("change"))


def snapshot_changes(
    current: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    run_date,
) -> DataFrame:
    """Rows to append: new state of added, changed and revived records, and a tombstone
    with the last known values for each record that is gone."""
    rows = classify_snapshot(current, latest, keys, compare).where(
        F.col("change").isNotNull()
    )
    gone = F.col("change") == "removed"
    columns = []
    for name in latest.columns:
        if name == "fetched_date":
            columns.append(F.lit(run_date).cast("date").alias(name))
        elif name == "removed":
            columns.append(gone.alias(name))
        else:
            previous, now = F.col("previous")[name], F.col("current")[name]
            columns.append(F.when(gone, previous).otherwise(now).alias(name))
    return rows.select(*columns)


def snapshot_sizes(current: DataFrame, latest: DataFrame) -> DataFrame:
    """One row: records in the current snapshot, stored keys, and stored active keys."""
    none = F.lit(0)
    stacked = current.select(
        F.lit(1).alias("c"), none.alias("s"), none.alias("a")
    ).unionByName(
        latest.select(
            none.alias("c"),
            F.lit(1).alias("s"),
            F.when(F.col("removed"), 0).otherwise(1).alias("a"),
        )
    )
    sums = stacked.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(name)
            for c, name in (
                ("c", "current_records"),
                ("s", "stored_records"),
                ("a", "active_records"),
            )
        ]
    )
    return sums.withColumn(
        "refused",
        (F.col("stored_records") > 0)
        & (F.col("current_records") * 2 < F.col("active_records")),
    )


def guard_against_shrinking(current: DataFrame, latest: DataFrame) -> None:
    """Raise when the snapshot is less than half of what is active in the history: a
    truncated feed would otherwise turn into a mass of false tombstones."""
    sizes = snapshot_sizes(current, latest).head()
    if sizes["refused"]:
        raise ShrunkSnapshot(
            f"refusing to ingest: snapshot has {sizes['current_records']} records, "
            f"less than half of {sizes['active_records']} active in the history"
        )
