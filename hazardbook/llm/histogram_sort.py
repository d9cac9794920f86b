"""Sharding by histogram sort.

Rows are put in the order of a whole-number key and cut into shards of nearly equal
bytes. The splitters are found without sorting: probes cut the range of keys into
cells, the exact bytes of every cell are counted across all partitions, and only the
cells that hold a splitter are probed again, more finely, until each splitter is known
within the tolerance. Then the rows are exchanged once.

Defined results: a null key comes before all others; a null text has no bytes; rows of
one key are told apart by the hash of the tie columns, so a hot key is cut as well;
rows equal in key and ties stay together; an empty table gives no rows. Columns of the
input named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Probes within an open cell, as a power of two. A round brings at most
# 2**PROBE_BITS cells a splitter to the driver.
PROBE_BITS = 10
LOWEST = -(2**63)


@dataclass
class Splitter:
    """Rows from (key, tie) on belong to the shards above. Both marks count up from the
    lowest 64-bit number."""

    target: float
    key: int
    tie: int = 0
    below: int = 0
    found: bool = False


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _refine(rows: DataFrame, over: str, bits: int, splitters: list[Splitter],
            tolerance: float) -> int:
    """Narrow the open splitters over the lowest ``bits`` bits of ``over``, "key" or
    "tie" within the splitter's key; gives the width in bits of the first cells."""
    shift, first = bits, max(0, bits - PROBE_BITS)
    while shift > 0 and (waiting := [s for s in splitters if not s.found]):
        last, shift = shift, max(0, shift - PROBE_BITS)

        def outer_of(s: Splitter, last: int = last) -> tuple[int | None, int]:
            mark = getattr(s, over) >> last
            return (_signed(s.key) if over == "tie" else None), _signed(mark)

        outer = F.shiftrightunsigned(over, last) if last < 64 else F.lit(0).cast("long")
        within = F.col("key") if over == "tie" else F.lit(None).cast("long")
        wanted = rows.where(outer.isin(sorted({outer_of(s)[1] for s in waiting})))
        if over == "tie":
            wanted = wanted.where(F.col("key").isin(sorted({_signed(s.key) for s in waiting})))
        counted = wanted.groupBy(
            within.alias("within"), outer.alias("outer"),
            F.shiftrightunsigned(over, shift).alias("cell"),
        ).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        cells: dict[tuple[int | None, int], list[tuple[int, int, int]]] = {}
        for row in counted.collect():
            cells.setdefault((row["within"], row["outer"]), []).append(
                (row["cell"] % 2**64, row["bytes"], row["rows"])
            )
        for s in waiting:
            mark = ((getattr(s, over) >> last) + 1) << last
            for cell, size, count in sorted(cells.get(outer_of(s), [])):
                if s.below >= s.target:
                    mark, s.found = cell << shift, True
                    break
                if s.below + size > s.target:
                    mark = cell << shift
                    near = size <= tolerance
                    if near or (shift == 0 and (count == 1 or over == "tie")):
                        s.found = True
                        if not near or s.below + size - s.target <= s.target - s.below:
                            s.below, mark = s.below + size, mark + (1 << shift)
                    break
                s.below += size
            else:
                s.found = True
            setattr(s, over, mark)
    return first


def place(rows: DataFrame, key: str, size: Column, ties: list[str], shards: int = 40,
          tolerance: float = 0.0) -> tuple[Column, Column, DataFrame]:
    """The shard and the cell of a row, as columns worked out from its own key, and the
    number of the first row of every (cell, shard).

    ``tolerance`` is the number of bytes a splitter may be off; 0 finds the exact ones:
    shard i begins at the first key below which there are i shards' bytes.
    """
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(LOWEST))
    tie_ = F.xxhash64(*[F.col(c) for c in ties])
    narrow = rows.select(
        id_.bitwiseXOR(F.lit(LOWEST)).alias("key"),
        tie_.bitwiseXOR(F.lit(LOWEST)).alias("tie"),
        id_.alias("id"), size.cast("long").alias("size"),
    )
    low, high, total = narrow.agg(F.min("id"), F.max("id"), F.sum("size")).first()
    low, high = (low or 0) + 2**63, (high or 0) + 2**63
    bits = max(1, (low ^ high).bit_length())
    splitters = [
        Splitter((total or 0) * i / shards, key=low >> bits << bits) for i in range(1, shards)
    ]
    wide = _refine(narrow, "key", bits, splitters, tolerance)
    _refine(narrow, "tie", 64, splitters, tolerance)
    shard = F.lit(0)
    for s in splitters:
        mark = F.lit(s.key - 2**63).cast("long") if s.key < 2**64 else None
        above = F.lit(False) if mark is None else id_ >= mark
        if s.tie and mark is not None:
            later = tie_ >= F.lit(s.tie - 2**63).cast("long") if s.tie < 2**64 else F.lit(False)
            above = (id_ > mark) | ((id_ == mark) & later)
        shard = shard + above.cast("int")
    cell = F.shiftrightunsigned(id_.bitwiseXOR(F.lit(LOWEST)), wide)
    counted = rows.groupBy(cell.alias("__cell"), shard.alias("__shard")).count()
    below = Window.partitionBy("__shard").orderBy("__cell")
    firsts = counted.select(
        "__cell", "__shard", (F.sum("count").over(below) - F.col("count")).alias("__first")
    )
    return shard, cell, firsts


def histogram_shards(rows: DataFrame, key: str, size: Column, ties: list[str],
                     shards: int = 40, tolerance: float = 0.0) -> DataFrame:
    """The rows with their ``shard`` (0 on) and their ``slot`` in it, gapless from 0 in
    the order of key and ties.

    Rows are numbered cell by cell, so the one exchange deals out up to
    ``2**PROBE_BITS + shards`` groups rather than one a shard. The first numbers of the
    groups, as many rows, are broadcast: their number does not grow with the data.
    """
    shard, cell, firsts = place(rows, key, size, ties, shards, tolerance)
    kept = rows.drop("shard", "slot")
    tie = F.xxhash64(*[F.col(c) for c in ties])
    dealt = rows.select(
        *kept.columns, shard.alias("__shard"), cell.alias("__cell"), tie.alias("__tie")
    )
    within = Window.partitionBy("__cell", "__shard").orderBy(
        F.col(key).asc_nulls_first(), "__tie"
    )
    numbered = dealt.withColumn("__row", F.row_number().over(within))
    return numbered.join(F.broadcast(firsts), ["__cell", "__shard"]).select(
        *kept.columns,
        F.col("__shard").alias("shard"),
        (F.col("__first") + F.col("__row") - 1).cast("long").alias("slot"),
    )
