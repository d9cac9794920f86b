"""Document fingerprints by a randomised edit embedding.

A walk reads a text from its first character. At step j it stands on a character, and a
random bit, shared by all walks and drawn for (j, character), says whether it moves on.
Walks over texts at a small edit distance meet again soon after every edit, so the
characters they stand on differ at few steps: edit distance becomes Hamming distance.

A fingerprint samples ``SLOTS`` steps of the walk and keeps a byte of what it reads
there. Each slot orders all steps at random and takes the first of those the walk has
made, so walks of nearly equal length sample the same steps, whatever their length.
Bands of slots find candidates, which are verified by the likeness: the share of equal
slots.

Defined results: null is as empty; an empty text has slots of zero, is like another empty
text (1) and unlike any other; equal texts have equal fingerprints. Rows of equal id
follow each other in the order of their texts' hashes, a null id comes first; the last
row is followed by the first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardbook.llm.common import U64, chunks, code_points, mix, texts_of
from hazardbook.session import stage

SLOTS = 64
READ = 3  # characters read at a sampled step
PERIOD = 8192
BANDS = 32

# (step, symbol) -> move on or stay; symbol 0 ends a text and holds the walk.
_MOVES = (mix(np.arange(PERIOD * 256, dtype=U64) + U64(0x632BE59BD9B4E019)) >> U64(63)).astype(np.uint8).reshape(PERIOD, 256)
_MOVES[:, 0] = 0


def _sampled_steps(limit: int) -> list[tuple[int, list[int]]]:
    """The steps below ``limit`` that are first in some slot's order among the steps up
    to them. After such a step t the next one is above t / u for a uniform u."""
    at: dict[int, list[int]] = {}
    for slot in range(SLOTS):
        step, drawn = 1, slot * 0x1000003
        while step <= limit:
            at.setdefault(step - 1, []).append(slot)
            drawn += 1
            uniform = (int(mix(np.array([drawn * 0x9E3779B97F4A7C15 % 2**64], U64))[0]) + 1) / 2**64
            step = int(step / uniform) + 1
    return sorted(at.items())


def embed(texts: list[str]) -> np.ndarray:
    """Fingerprints (texts x SLOTS bytes). All walks take their steps side by side."""
    found = np.zeros((len(texts), SLOTS), np.uint8)
    points, starts = code_points([t + "\0" * READ for t in texts])
    symbols = ((points * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
    symbols[symbols == 0] = 1
    ends = starts[1:]
    for i in range(1, READ + 1):
        symbols[ends - i] = 0
    rows = np.flatnonzero(np.diff(starts) > READ)
    at = starts[rows].copy()
    longest = int((ends - starts[:-1]).max(initial=0))
    sampled = iter(_sampled_steps(64 * longest + 1024))
    due, slots = next(sampled)
    step = 0
    while len(rows):
        if step == due:
            here = symbols[at]
            alive = here != 0
            read = np.zeros(len(at), np.uint64)
            for i in range(READ):
                read = read * U64(0x100000001B3) + symbols[at + i].astype(U64) + U64(1)
            read = (mix(read) >> U64(56)).astype(np.uint8)
            found[rows[alive][:, None], slots] = read[alive][:, None]
            due, slots = next(sampled, (-1, []))
        at += _MOVES[step % PERIOD].take(symbols.take(at))
        step += 1
        if step % 64 == 0:
            alive = symbols[at] != 0
            if not alive.all():
                rows, at = rows[alive], at[alive]
    return found


def likeness(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray) -> np.ndarray:
    same = (a == b).mean(axis=1)
    return np.where(empty_a | empty_b, (empty_a & empty_b).astype(float), same)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many characters of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (hexadecimal) of every row, where it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [p.tobytes().hex() for _, some in chunks(texts_of(batch), 1 << 23) for p in embed(some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"]
            )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _pairs(ids: list, texts: list[str]) -> list[tuple]:
    """A result for every text but the last, which only follows."""
    rows = []
    for first, some in chunks(texts[:-1], 1 << 22):
        run = texts[first : first + len(some) + 1]
        changed = [edited(a, b) for a, b in zip(run, run[1:], strict=False)]
        prints = embed([*run, *changed])
        own, after, new = prints[: len(some)], prints[1 : len(some) + 1], prints[len(run) :]
        empty = np.array([not t for t in run])
        none = np.array([not t for t in changed], bool)
        near = likeness(own, new, empty[:-1], none).tolist()
        next_ = likeness(own, after, empty[:-1], empty[1:]).tolist()
        for i, t in enumerate(some):
            sha = hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest()
            rows.append((ids[first + i], len(t), sha, own[i].tobytes().hex(), new[i].tobytes().hex(), near[i], next_[i]))
    return rows


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_KINDS = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def against_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The fingerprints of every text and of its edited text, and how like it is to that
    and to the next document's.

    Rows are exchanged once into ranges of ids; a range is read in order. Its first and
    last text come out as well, two a range, and the last ones are finished from those.
    """
    ordered = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("tie"),
    )
    kind = ordered.schema["doc_id"].dataType.simpleString()

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        first: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts, ties = (batch.column(c).to_pylist() for c in ("doc_id", "text", "tie"))
            first = first or (ids[0], ties[0], texts[0])
            last = (ids[-1], ties[-1], texts[-1])
            if held:
                ids, texts = [held[0], *ids], [held[2], *texts]
            held = last
            yield _batch(_pairs(ids, texts), [], batch.schema.field("doc_id").type)
        if held:
            yield _batch([], [(*first, 0), (*held, 1)], batch.schema.field("doc_id").type)

    dealt = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    told = stage(dealt.mapInArrow(within, f"doc_id {kind}, {_RESULT}, tie long, text string, role int"))
    edges = told.where("role IS NOT NULL").select("doc_id", "tie", "text", "role")
    order = Window.orderBy(F.col("doc_id").asc_nulls_first(), "tie", "role")  # two rows a range
    all_ = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("text").over(order), F.first("text").over(all_))
    linked = edges.withColumn("following", following).where("role = 1")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, after = (batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))
            rows = [r for i, t, f in zip(ids, texts, after, strict=True) for r in _pairs([i, i], [t, f])]
            yield _batch(rows, None, batch.schema.field("doc_id").type)

    last = linked.mapInArrow(finish, f"doc_id {kind}, {_RESULT}")
    return told.where("role IS NULL").select("doc_id", *_COLUMNS).union(last)


def _batch(rows: list[tuple], edges: list[tuple] | None, kind: pa.DataType) -> pa.RecordBatch:
    names, kinds = ["doc_id", *_COLUMNS], [kind, *_KINDS]
    columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in names]
    if edges is not None:
        names, kinds = [*names, "tie", "text", "role"], [*kinds, pa.int64(), pa.string(), pa.int32()]
        columns += [[None] * len(rows) for _ in range(3)]
        for id_, tie, text, role in edges:
            for column, value in zip(columns, (id_, *[None] * len(_COLUMNS), tie, text, role), strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def near_links(prints: DataFrame, least: float = 0.7, bands: int = BANDS) -> DataFrame:
    """Links (``a`` < ``b``, ``likeness``) between fingerprints that share a band and
    reach the likeness. ``prints`` has ``doc_id`` and ``fingerprint``.

    Equal fingerprints are one node, named by its smallest id, to which its other ids are
    linked. In a band each node is
    verified against the band's first node; those that fail are led by the first of the
    rest in the next round, until none is left, so a band of m nodes needs links, not
    pairs. Every node of a cluster is linked to its leader.
    """
    nodes = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("node")).where("node IS NOT NULL"))
    width = 2 * SLOTS // bands
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.concat(i.cast("string"), F.lit(":"), F.substring("fingerprint", i * width + 1, width)),
    )
    rest = nodes.select("node", "fingerprint", F.explode(keys).alias("band"))
    of = Window.partitionBy("band")
    found = prints.join(nodes, "fingerprint").where("doc_id != node").select(
        F.col("node").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("likeness")
    )
    while True:
        led = rest.withColumn("leader", F.min(F.struct("node", "fingerprint")).over(of)).where(
            F.col("node") != F.col("leader.node")
        )
        equal = F.aggregate(
            F.sequence(F.lit(0), F.lit(SLOTS - 1)), F.lit(0),
            lambda n, i: n + (F.substring("fingerprint", 2 * i + 1, 2) == F.substring("leader.fingerprint", 2 * i + 1, 2)).cast("int"),
        )
        told = stage(led.withColumn("likeness", equal / SLOTS))
        links = told.where(F.col("likeness") >= least).select(
            F.col("leader.node").alias("a"), F.col("node").alias("b"), "likeness"
        )
        found = found.union(links)
        rest = told.where(F.col("likeness") < least).select("node", "fingerprint", "band")
        if rest.isEmpty():
            return found.distinct()
