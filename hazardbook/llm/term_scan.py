"""Ranked lexical search by an Aho-Corasick scan of the documents.

The terms of all items become one automaton, which is broadcast; it reads every text once
and counts the items' terms in it. No index of the documents is built. In the cleaned text
one space stands on either side of every term, and the automaton's patterns carry those
guards, so a match is a whole term. A term leads to the items that hold it, and a text's
score for all of them is summed in one pass over its counts.

Items are dealt into blocks by the bytes of their terms (``BLOCK_BYTES``), each with an
automaton of its own, so what is broadcast is bounded whatever the number of items. What a
scan finds in a text (its length and its counts of the block's terms) is written once,
because weights need the counts of all texts first. A task keeps the best of its rows for
every item, the best of groups of tasks follow, then the best of all: nothing but these is
exchanged.

A term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))), a text's m is
50 + (50 n N) div L, and its score sums w ((10**9 tf) div (1000 tf + 20 m)) over the item's
terms. Sums stay below 2**53, where doubles are exact.

Defined results: a text that is null or has no terms counts in nothing and is never found;
an item without terms finds nothing; item rows that share an id are items of their own,
each with its ranks; rows that share an id are documents of their own; of equal scores the
smaller id comes first, and rows without an id last; texts of any length are read whole; without
documents or items there are no rows. Other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardbook.session import stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 1 << 20
PIECE = 1 << 20  # bytes of text scanned together
CELLS = 1 << 21  # scores of (row, item) held together

# Term characters stay, A-Z in lower case; every other byte is a space.
_CLEAN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def cleaned(text: bytes) -> bytes:
    """The text's terms, with one space or more around each."""
    return b" " + text.translate(_CLEAN) + b" "


@dataclass
class Block:
    """Items by number (their ids and the numbers of their terms) and the terms."""

    items: list
    terms: list[bytes]
    of_term: list[list[int]]  # the items that hold a term

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", number)  # a character for a byte
        found.make_automaton()
        return found


def blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The items in blocks of about ``BLOCK_BYTES`` of terms; one block is on the driver at
    a time."""
    rows = stage(
        items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("text"))
        .withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)))
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    for number in range(count):
        held = dealt.where(F.col("block") == number).sort("item_id", "text").collect()
        if not held:
            continue
        terms: dict[bytes, int] = {}
        of_term: list[list[int]] = []
        for place, row in enumerate(held):
            for term in set(cleaned(bytes(row["text"] or b"")).split()):
                if term not in terms:
                    terms[term] = len(terms)
                    of_term.append([])
                of_term[terms[term]].append(place)
        yield Block([row["item_id"] for row in held], list(terms), of_term)


def _pieces(texts: Iterable[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Cleaned texts in order, as (position of the first, texts) of about ``PIECE`` bytes."""
    held: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        if held and size + len(text) > PIECE:
            yield first, held
            held, size, first = [], 0, i
        held.append(cleaned(text))
        size += len(text)
    if held:
        yield first, held


def scan(automaton: ahocorasick.Automaton, texts: list[bytes], n_terms: int):
    """Of cleaned texts: the number of terms of each; and the automaton's counts in order
    of the texts, as (text, term, count)."""
    line = b"".join(texts)
    starts = np.cumsum([0, *map(len, texts)])
    space = np.frombuffer(line, np.uint8) == 0x20
    opens = np.concatenate([[0], np.cumsum(space[:-1] & ~space[1:])])
    lengths = opens[starts[1:] - 1] - opens[starts[:-1]]
    hits = np.fromiter(automaton.iter(line.decode("latin-1")), [("end", np.int64), ("term", np.int64)])
    of = np.searchsorted(starts, hits["end"], side="right") - 1
    pairs, counts = np.unique(of * max(n_terms, 1) + hits["term"], return_counts=True)
    return lengths, pairs // max(n_terms, 1), pairs % max(n_terms, 1), counts


def _counted(docs: DataFrame, block) -> DataFrame:
    """Per row the number of its terms (``n``) and its counts (``tfs``) of the block's
    ``terms``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        automaton = held.automaton()
        for batch in batches:
            texts = (t.as_py() or b"" for t in batch.column("text"))
            for first, piece in _pieces(texts):
                lengths, of, terms, tfs = scan(automaton, piece, len(held.terms))
                ends = pa.array(np.searchsorted(of, np.arange(len(piece) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(piece)),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


class Best:
    """The best ``k`` rows of every item seen so far, equal scores by id."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(n_items)  # a row with less is beaten by k others
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.place = np.zeros(0, np.int64)  # the id; rows without one come last
        self.known = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, scores[row, item]])
        self.place = np.concatenate([self.place, ids[row]])
        self.known = np.concatenate([self.known, known[row]])
        order = np.lexsort((self.place, ~self.known, -self.score, self.item))
        of = self.item[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        last = order[rank == self.k - 1]
        self.least[self.item[last]] = self.score[last]
        kept = order[rank < self.k]
        self.item, self.score = self.item[kept], self.score[kept]
        self.place, self.known = self.place[kept], self.known[kept]


def _scored(counted: DataFrame, block, weights, documents: int, total: int, k: int) -> DataFrame:
    """The best rows of every item in each task: ``item`` (its number), ``doc_id``,
    ``score``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = block.value, np.array(weights.value, np.int64)
        n_items = len(held.items)
        width = np.array([len(x) for x in held.of_term], np.int64)
        begin = np.cumsum(width) - width
        items = np.concatenate([np.array(x, np.int64) for x in held.of_term])
        best = Best(n_items, k)
        rows = max(1, CELLS // n_items)
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                n = part.column("n").to_numpy(zero_copy_only=False)
                terms, tfs = part.column("terms"), part.column("tfs").flatten().to_numpy()
                of = np.repeat(np.arange(len(n)), terms.value_lengths().to_numpy(zero_copy_only=False))
                term = terms.flatten().to_numpy()
                m = 50 + (50 * n * documents) // max(total, 1)
                part_scores = weight[term] * ((10**9 * tfs) // (1000 * tfs + 20 * m[of]))
                # Each count goes to all items of its term.
                repeat = width[term]
                at = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
                cell = np.repeat(of * n_items, repeat) + items[np.repeat(begin[term], repeat) + at]
                scores = np.bincount(cell, np.repeat(part_scores, repeat), len(n) * n_items)
                ids = part.column("doc_id")
                known = ~ids.is_null().to_numpy(zero_copy_only=False)
                best.add(scores.reshape(len(n), n_items), ids.fill_null(0).to_numpy(zero_copy_only=False), known)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.item, pa.int64()),
                pa.array(best.place, pa.int64(), mask=~best.known),
                pa.array(best.score.astype(np.int64), pa.int64()),
            ],
            ["item", "doc_id", "score"],
        )

    return counted.mapInArrow(score, "item long, doc_id long, score long")


def _ranked(best: DataFrame, k: int) -> DataFrame:
    """Ranks within items, of groups of tasks first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    grouped = best.withColumn("group", F.spark_partition_id() % 64)
    some = Window.partitionBy("item", "group").orderBy(*order)
    few = grouped.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    whole = Window.partitionBy("item").orderBy(*order)
    return few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str,
           k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: ``item_id``, ``rank``, ``doc_id``,
    ``score``."""
    spark = docs.sparkSession
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = items.schema[item_id].dataType.simpleString()
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in blocks(items, item_id, item_text):
        if not block.terms:
            continue
        shared = spark.sparkContext.broadcast(block)
        counted = stage(_counted(whole, shared))
        size = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("total")).first()
        held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        df = {r["term"]: r["count"] for r in held}  # one row a term of the block
        documents, total = size["documents"], size["total"] or 0
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(block.terms))]
        weights = spark.sparkContext.broadcast(weight)
        best = _ranked(stage(_scored(counted, shared, weights, documents, total, k)), k)
        names = spark.createDataFrame(list(enumerate(block.items)), f"item long, item_id {kind}")
        found = found.union(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return found
