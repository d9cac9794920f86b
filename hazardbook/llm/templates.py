"""Benchmark decontamination by canonical templates.

Texts become templates: numbers, names and numbers with units are replaced by typed
placeholders, all other tokens are lower-cased. Windows of template tokens are joined by
hash between benchmark items and documents. Along one alignment of item and document a
value of the item must always become the same value of the document; two values may
become equal. A document holds an item when the windows of such alignments cover enough
of it, or when they run over ``RUN`` tokens without a gap, whatever share of the item
that is. Where a value becomes two, the windows that contradict the more frequent
reading are dropped; the others count only by themselves and must be as many as
``FIRM`` tokens in a row have. The copy is re-parameterised when some value differs.

Tokens are runs of ASCII letters, digits and all non-ASCII characters; a point or comma
between digits belongs to the number. A name is a capitalised token that is neither in
capitals throughout nor first in its sentence or line; neighbouring names are one. A
window with fewer than ``LITERAL`` literal tokens keeps its values, because its template
says little; so an item of a few tokens is found word for word only.

Defined results: null and empty texts match nothing, nor do items without tokens; items
shorter than a window are one window of their own length; rows that share an id are told
apart by their text, repeated rows are one; an empty side gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardbook.llm.common import U64, chunks, mix, texts_of, word_hashes
from hazardbook.session import stage

WINDOW = 8
COVER = 0.5
LITERAL = 4
RUN = 13
FIRM = 20
FILTER_BITS = 24

# Units that follow a number.
UNITS = (
    "m cm mm km kg g mg t l ml s ms min h hz khz mhz ghz kb mb gb tb v w kw mph kmh "
    "meter meters metre metres kilometer kilometers mile miles foot feet inch inches "
    "gram grams kilogram kilograms pound pounds ton tons liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees"
).split()

_CLASS = np.zeros(256, np.uint8)  # bits: 1 token, 2 digit, 4 capital, 8 small, 16 ends a sentence
_CLASS[ord("0") : ord("9") + 1] = 1 | 2
_CLASS[ord("A") : ord("Z") + 1] = 1 | 4
_CLASS[ord("a") : ord("z") + 1] = 1 | 8
_CLASS[0x80:] = 1 | 8
_CLASS[[ord(c) for c in ".!?:\n"]] = 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

NUMBER, UNIT, NAME = (U64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03))


class Template:
    """Canonical tokens of some texts, one after the other."""

    def __init__(self, texts: list[str]) -> None:
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        raw = np.frombuffer(b"\n".join([b"", *encoded, b""]), np.uint8)
        kind = _CLASS[raw]
        token = (kind & 1).astype(bool)
        inner = np.flatnonzero((raw == ord(".")) | (raw == ord(",")))
        if len(inner):
            inner = inner[(inner > 0) & (inner < len(raw) - 1)]
            inner = inner[(kind[inner - 1] & kind[inner + 1] & 2) > 0]
            token[inner] = True
        begin = np.flatnonzero(~token[:-1] & token[1:]) + 1
        end = np.flatnonzero(token[:-1] & ~token[1:]) + 1
        spaced = np.where(token, _LOWER[raw], np.uint8(32))
        # One text, in which a token is a word: its hashes are the literal values.
        value, _ = word_hashes([spaced.tobytes().decode("utf-8", "surrogatepass")]) if len(begin) else (np.zeros(0, U64), 0)
        totals = {bit: np.concatenate([[0], np.cumsum((kind & bit) > 0)]) for bit in (2, 4, 8, 16)}
        has = {bit: totals[bit][end] - totals[bit][begin] for bit in (2, 4, 8)}
        before = np.concatenate([[0], end[:-1]]) if len(begin) else begin
        opens = (totals[16][begin] - totals[16][before]) > 0
        number = (has[2] > 0) & (has[4] + has[8] == 0)
        after = np.concatenate([[False], number[:-1]]) if len(begin) else number
        unit = ((has[2] > 0) & ~number) | (after & np.isin(value, _unit_hashes()))
        name = (kind[begin] & 4 > 0) & (has[8] > 0) & (has[2] == 0) & ~opens
        more = name & np.concatenate([[False], name[:-1]]) if len(begin) else name
        first = np.flatnonzero(~more)
        self.value = np.add.reduceat(value, first) if len(first) else value
        code = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
        self.code = code[first]
        self.slot = (number | unit | name)[first]
        bounds = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])]) + 1
        self.cuts = np.searchsorted(begin[first], bounds)
        self.of = np.repeat(np.arange(len(texts)), np.diff(self.cuts))

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of each window's first token, its text, and its hash."""
        n = max(0, len(self.code) - width + 1)
        template, literal = np.zeros(n, U64), np.full(n, width, U64)
        slots = np.zeros(n, np.int64)
        for i in range(width):
            template = mix(template * U64(3) + self.code[i : i + n])
            literal = mix(literal * U64(5) + self.value[i : i + n])
            slots += self.slot[i : i + n]
        inside = np.flatnonzero(self.of[:n] == self.of[width - 1 : width - 1 + n])
        hashed = np.where(width - slots < LITERAL, literal, template)
        return inside, self.of[inside], hashed[inside]

    def slots(self, first: int, width: int) -> list[int]:
        here = slice(first, first + width)
        return self.value[here][self.slot[here]].view(np.int64).tolist()


_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        _units.append(word_hashes([" ".join(UNITS)])[0])
    return _units[0]


def item_windows(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """All windows of the items: ``width``, ``item_pos``, ``hash``, ``item_slots``, and
    the item's number of ``windows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            rows = []
            for first, texts in chunks(texts_of(batch)):
                for i, one in enumerate(texts):
                    template = Template([one])
                    own = min(width, len(template.code))
                    if own:
                        at, _, hashed = template.windows(own)
                        rows += [
                            (ids[first + i], own, len(at), int(p), h, template.slots(int(p), own))
                            for p, h in zip(at, hashed.view(np.int64).tolist(), strict=True)
                        ]
            names = ["item_id", "width", "windows", "item_pos", "hash", "item_slots"]
            kinds = [batch.column("item_id").type, *[pa.int64()] * 4, pa.list_(pa.int64())]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    narrow = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kind = narrow.schema["item_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"item_id {kind}, width long, windows long, item_pos long, hash long, item_slots array<long>"
    )


def _bitmap(windows: DataFrame) -> np.ndarray:
    """2**FILTER_BITS bits with those set that a window's hash names: as large for any
    benchmark. It only saves joining windows that no item has."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = windows.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits")
    )
    held = words.toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[held["word"].to_numpy(np.int64)] = held["bits"].to_numpy(np.int64)
    return bitmap.view(U64)


def _agreeing(hits: pa.Array) -> pa.Array:
    """The places of an alignment's windows whose values all have the most frequent
    counterpart, the smaller one of equally frequent ones; null for null."""
    found = []
    for windows in hits.to_pylist():
        if windows is None:
            found.append(None)
            continue
        seen = Counter(p for w in windows for p in zip(w["item_slots"], w["doc_slots"], strict=True))
        best: dict[int, int] = {}
        for (item, doc), _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
            best.setdefault(item, doc)
        found.append(sorted(
            w["place"] for w in windows
            if all(best[i] == d for i, d in zip(w["item_slots"], w["doc_slots"], strict=True))
        ))
    return pa.array(found, pa.list_(pa.int64()))


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str = "item_id",
                 item_text: str = "text", width: int = WINDOW, cover: float = COVER) -> DataFrame:
    """``doc_id``, ``text_hash``, ``item_id``, the ``windows`` of the item, how many are
    ``matched``, and whether the copy is ``reparameterised``: one row for every item that
    a document holds."""
    windows = stage(item_windows(items, item_id, item_text, width))
    bitmap = _bitmap(windows)
    widths = [row["width"] for row in windows.select("width").distinct().collect()]  # at most `width`

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("text_hash")
            for first, texts in chunks(texts_of(batch)):
                template = Template(texts)
                for own in widths:
                    at, of, hashed = template.windows(own)
                    place = hashed >> U64(64 - FILTER_BITS)
                    hit = np.flatnonzero((bitmap[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1))
                    rows = pa.array(of[hit] + first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(rows), keys.take(rows), pa.array([own] * len(hit), pa.int64()),
                            pa.array(at[hit] - template.cuts[of[hit]], pa.int64()),
                            pa.array(hashed[hit].view(np.int64)),
                            pa.array([template.slots(int(p), own) for p in at[hit]], pa.list_(pa.int64())),
                        ],
                        ["doc_id", "text_hash", "width", "doc_pos", "hash", "doc_slots"],
                    )

    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")
    )
    kind = narrow.schema["doc_id"].dataType.simpleString()
    hits = narrow.mapInArrow(
        run, f"doc_id {kind}, text_hash long, width long, doc_pos long, hash long, doc_slots array<long>"
    )
    # Groups below hold the windows of one item in one document at one alignment: no more
    # than the item has, however often documents or items repeat.
    shift = (F.col("doc_pos") - F.col("item_pos")).alias("shift")
    aligned = hits.join(windows, ["width", "hash"]).groupBy(
        "doc_id", "text_hash", "item_id", "windows", "width", shift
    ).agg(F.collect_set(F.struct(F.col("item_pos").alias("place"), "item_slots", "doc_slots")).alias("hits"))
    pairs = F.flatten(F.transform("hits", lambda h: F.arrays_zip(h["item_slots"], h["doc_slots"])))
    values = aligned.withColumn("values", F.array_distinct(pairs))
    clear = F.size(F.array_distinct("values.item_slots")) == F.size("values")
    sure = FIRM - F.col("width") + 1
    told = values.withColumn("clear", clear).select(
        "doc_id", "text_hash", "item_id", "windows", "width", "clear",
        F.exists("values", lambda v: v["item_slots"] != v["doc_slots"]).alias("differs"),
        F.when(F.col("clear"), F.array_sort("hits.place")).otherwise(
            F.arrow_udf(_agreeing, "array<long>")(F.when(~F.col("clear") & (F.size("hits") >= sure), F.col("hits")))
        ).alias("places"),
    )
    step = F.greatest(RUN - F.col("width") + 1, F.lit(1)).cast("int")
    ahead = F.transform("places", lambda p, i: F.try_element_at("places", i + step) - p == step - 1)
    long = F.when(F.col("clear"), F.coalesce(F.exists(ahead, lambda x: x), F.lit(False))).otherwise(True)
    placed = told.where(F.col("clear") | (F.size("places") >= sure)).select(
        "doc_id", "text_hash", "item_id", "windows", long.alias("long"), F.explode("places").alias("place"), "differs"
    )
    found = placed.groupBy("doc_id", "text_hash", "item_id", "windows", "place").agg(
        F.min("differs").alias("differs"), F.max("long").alias("long")
    ).groupBy("doc_id", "text_hash", "item_id", "windows").agg(
        F.count("*").alias("matched"), F.max("differs").alias("reparameterised"), F.max("long").alias("long")
    )
    return found.where(F.col("long") | (F.col("matched") >= cover * F.col("windows"))).drop("long")


def decontaminated(docs: DataFrame, items: DataFrame, doc_id: str, text: str, **how: object) -> DataFrame:
    """The rows that hold no item, with all their columns."""
    found = contaminated(docs, items, doc_id, text, **how)
    held = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash"))
    return docs.join(stage(held), same, "left_anti")
