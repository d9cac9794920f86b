"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its distinct word shingles. Two sets whose Jaccard similarity
reaches the threshold differ in few elements, so their Hamming distance is bounded by
their sizes. Sizes are cut into bands; for the distance bound k of a band, the domain of
shingles is partitioned by hash into k / 2 groups of three parts (for small k into k / 3
groups of five). At most k differences leave a group with one difference at most (two),
hence all its parts but one (two) equal: every set signs all subsets of two (three) parts
of every group, and similar sets share a signature. A set signs for its own band and the
next larger one, because similar sets lie in the same or in neighbouring bands.
Candidates are verified on the sets.

In large bands a subset without elements does not sign, for it would gather unrelated
sets. A link is lost only if hashing leaves all elements of every such group in one part:
under 1e-4 for a pair at the very bound of the smallest of these bands, under 1e-8 from
200 shingles on, and less for any nearer pair; all else is exact.

Equal sets are one node, and signatures with the same nodes are one signature, which links
its nodes to two leaders first; the rest is
verified only between different components, so a group of copies never becomes all its
pairs. Of those pairs, the ones whose distance must be too large are left out by the join
itself: the bits in which the sets' sketches differ bound it from below, and with six
cells or more for each difference that is allowed, few pairs get past it that are not
links. No pair of a signature is left untested.

Defined results: texts that are null or without words have an empty set and are linked
with nothing; with fewer words than a shingle, the whole sequence is the one element;
rows that share an id each get a result; rows without an id get the component of their
set's other rows, else null, and do not carry links; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardbook.llm.common import U64, chunks, mix, texts_of, word_hashes
from hazardbook.llm.components import components
from hazardbook.session import stage


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in order, sorted within a text, and how many
    each text has."""
    words, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    n = np.maximum(len(words) - width + 1, 0)
    hashed = np.zeros(n, U64)
    for i in range(width):
        hashed = mix(hashed * U64(3) + words[i : i + n])
    inside = owner[:n] == owner[width - 1 : width - 1 + n]
    hashed, of = hashed[inside], owner[:n][inside]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        firsts = np.concatenate([[0], np.cumsum(counts)])
        extra = np.array(
            [mix(np.array([sum(int(w) * (2 * j + 3) for j, w in enumerate(words[firsts[d] : firsts[d + 1]])) % 2**64], U64) + U64(counts[d]))[0] for d in short],
            U64,
        )
        hashed, of = np.concatenate([hashed, extra]), np.concatenate([of, short])
    order = np.lexsort((hashed, of))
    hashed, of = hashed[order], of[order]
    first = np.ones(len(hashed), bool)
    first[1:] = (hashed[1:] != hashed[:-1]) | (of[1:] != of[:-1])
    return hashed[first], np.bincount(of[first], minlength=len(texts))


def set_key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets, and in practice only they, have in common."""
    a, b = mix(elements ^ U64(0x5BF03635)).sum(), mix(elements ^ U64(0x27D4EB2F165667C5)).sum()
    return int(a.view(np.int64)), int(b.view(np.int64))


class Bands:
    """Size bands for a threshold in percent, and the distance bound of each."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.upper = [percent_up(1, percent)]

    def of(self, size: int) -> int:
        while self.upper[-1] < size:
            self.upper.append(percent_up(self.upper[-1] + 1, self.percent))
        return int(np.searchsorted(self.upper, size))

    def bound(self, band: int) -> int:
        """The largest Hamming distance of similar sets of the band."""
        while len(self.upper) <= band:
            self.upper.append(percent_up(self.upper[-1] + 1, self.percent))
        return (100 - self.percent) * 2 * self.upper[band] // (100 + self.percent)


def percent_up(lower: int, percent: int) -> int:
    return lower * 100 // percent


@lru_cache
def bands_of(percent: int) -> Bands:
    return Bands(percent)


# Bits of a sketch for each difference that similar sets may have, at least.
SPREAD = 6


def sketch(elements: np.ndarray, percent: int) -> np.ndarray:
    """The parity of the elements in every cell of the domain, as 64-bit words.

    An element that two sets do not share flips one bit, so sketches differ in no more
    bits than the sets do in elements. The number of cells is a power of two that follows
    the size; halves of a sketch, one put over the other, are the sketch of half as many.
    """
    bands = bands_of(percent)
    wanted = SPREAD * bands.bound(bands.of(len(elements)))
    cells = 1 << max(6, wanted.bit_length())
    places = (elements & U64(cells - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=cells) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


# For few differences, groups of five parts of which two may differ; else three and one.
FEW = 24
_SUBSETS = {
    (parts, spoilt): np.array([[i in held for held in combinations(range(parts), parts - spoilt)] for i in range(parts)])
    for parts, spoilt in ((5, 2), (3, 1))
}


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """All PartEnum signatures of one set. Above ``FEW`` differences, subsets without an
    element do not sign: they would bring unrelated sets together, and similar sets share
    many subsets besides."""
    bands = bands_of(percent)
    own = bands.of(len(elements))
    found = []
    for band in (own, own + 1):
        tag = U64((band * 0x9E3779B97F4A7C15 + 1) % 2**64)
        weights = mix(elements + tag)
        k = bands.bound(band)
        if k == 0:
            found.append(mix(np.array([weights.sum()], U64) + tag))
            continue
        parts, spoilt = (5, 2) if k < FEW else (3, 1)
        groups = k // (spoilt + 1) + 1
        subsets = _SUBSETS[parts, spoilt]
        part = ((mix(weights) >> U64(11)) % U64(parts * groups)).astype(np.int64)
        sums = np.zeros(parts * groups, U64)
        np.add.at(sums, part, weights)
        held = sums.reshape(groups, parts) @ subsets.astype(U64)
        place = np.arange(held.size, dtype=U64).reshape(held.shape) * U64(0xC2B2AE3D27D4EB4F)
        signed = mix(held + place + tag)
        if k >= FEW:
            signed = signed[held != 0]
        found.append(signed.ravel())
    return np.concatenate(found)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, texts in chunks(texts_of(batch)):
        elements, counts = shingle_sets(texts, width)
        yield first, np.split(elements, np.cumsum(counts)[:-1])


def keyed_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row the size, the key and the sketch of its set."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch, width):
                keyed = [(len(s), *set_key(s)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(sets)),
                        *(pa.array(c, pa.int64()) for c in zip(*keyed, strict=True)),
                        _lists([sketch(s, percent) for s in sets]),
                    ],
                    ["doc_id", "n", "k1", "k2", "cells"],
                )

    return docs.mapInArrow(keys, "doc_id long, n long, k1 long, k2 long, cells array<long>")


def signed_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id`` and ``signatures`` of the first row of every set and task."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()  # no more than the task's rows
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, sets in _sets(batch, width):
                signers, signed = [], []
                for id_, elements in zip(ids[first:], sets, strict=False):
                    if len(elements) and id_ is not None and (key := set_key(elements)) not in seen:
                        seen.add(key)
                        signers.append(id_)
                        signed.append(signatures(elements, percent).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signers, pa.int64()), _lists(signed)], ["doc_id", "signatures"]
                )

    return docs.mapInArrow(sign, "doc_id long, signatures array<long>")


def listed_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id`` and its set as an array."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch, width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(sets)), _lists([s.view(np.int64) for s in sets])],
                    ["doc_id", "elements"],
                )

    return docs.mapInArrow(listed, "doc_id long, elements array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids that reach the threshold. Sets are listed for the ids in
    the pairs alone."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = stage(listed_sets(docs.join(ids, "doc_id", "left_semi"), width))
    left = sets.select(F.col("doc_id").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("eb"))
    shared = F.size(F.array_intersect("ea", "eb"))
    reached = 100 * shared >= percent * (F.size("ea") + F.size("eb") - shared)
    return pairs.join(left, "a").join(right, "b").where(reached).select("a", "b").distinct()


def _near_sizes(na: str, nb: str, percent: int) -> Column:
    return F.coalesce(100 * F.least(na, nb) >= percent * F.greatest(na, nb), F.lit(True))


def _folded(cells: Column, other: Column) -> Column:
    """A sketch with the cells of another that has as many or half as many."""
    half = F.size(other)
    over = F.zip_with(F.slice(cells, 1, half), F.slice(cells, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(cells) > half, over).otherwise(cells)


def _near_sketches(percent: int) -> Column:
    """Whether the sketches ``cells`` and ``cells_b`` allow the threshold; unknown ones do."""
    a, b = F.col("cells"), F.col("cells_b")
    apart = F.aggregate(
        F.zip_with(_folded(a, b), _folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0), lambda n, x: n + x,
    )
    near = (100 + percent) * apart <= (100 - percent) * (F.col("size") + F.col("size_b"))
    return F.coalesce(near, F.lit(True))


def _distinct_groups(members: DataFrame) -> DataFrame:
    """The members of one signature for every set of nodes that share some: near sets share
    many signatures, and one is enough to bring them together. Sets of nodes are told
    apart by 128 bits, which are summed before they are exchanged."""
    def mark(seed: int) -> Column:
        return F.bit_xor(F.xxhash64("node", "size", F.lit(seed))).alias(f"mark{seed}")

    groups = members.groupBy("signature").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), mark(1), mark(2), F.count("*").alias("held")
    ).where("low != high")
    chosen = groups.groupBy("mark1", "mark2", "held").agg(F.min("signature").alias("signature"))
    return members.join(chosen.select("signature"), "signature", "left_semi")


def _led(members: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Every member of a signature with the signature's first and last member, where
    they may be near."""
    of = Window.partitionBy("signature")
    who = F.struct("node", "size")
    ends = members.select("node", "size", F.min(who).over(of).alias("low"), F.max(who).over(of).alias("high"))
    led = ends.select("node", "size", F.explode(F.array("low", "high")).alias("leader"))
    near = (F.col("node") != F.col("leader.node")) & _near_sizes("size", "leader.size", percent)
    pairs = led.where(near).select(
        F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")
    ).distinct()
    left = cells.select(F.col("node").alias("a"), "size", "cells")
    right = cells.select(
        F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("cells").alias("cells_b")
    )
    return pairs.join(left, "a").join(right, "b").where(
        _near_sizes("size", "size_b", percent) & _near_sketches(percent)
    ).select("a", "b")


def _across(members: DataFrame, labels: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a signature, lie in different components, and may be near."""
    labelled = stage(
        members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    )
    groups = labelled.groupBy("signature").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    apart = groups.where("low != high").select("signature")
    mixed = stage(
        labelled.join(apart, "signature", "left_semi").join(cells.select("node", "cells"), "node")
    )
    other = mixed.select("signature", *[F.col(c).alias(f"{c}_b") for c in ("node", "size", "label", "cells")])
    return mixed.alias("m").join(
        other.alias("o"),
        (F.col("m.signature") == F.col("o.signature")) & (F.col("label") < F.col("label_b"))
        & _near_sizes("size", "size_b", percent) & _near_sketches(percent),
    ).select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def jaccard_components(docs: DataFrame, doc_id: str, text: str, width: int = 5,
                       percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by
    links, its own included) of every row."""
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = stage(keyed_sets(whole, width, percent))
    linkable = keyed.where("n > 0 AND doc_id IS NOT NULL")
    nodes = stage(
        linkable.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.first("n").alias("size"))
    )
    node_of = stage(
        linkable.join(nodes, ["k1", "k2"]).select("doc_id", "node", "size", "cells")
    )
    signed = signed_sets(whole, width, percent).select("doc_id", F.explode("signatures").alias("signature"))
    of = Window.partitionBy("signature")
    shared = signed.withColumns({"low": F.min("doc_id").over(of), "high": F.max("doc_id").over(of)})
    signing = stage(
        shared.where("low != high").join(node_of, "doc_id").select("signature", "node", "size").distinct()
    )
    members = stage(_distinct_groups(signing))
    # An id with several texts is a node with several sets: its sketches say nothing.
    single = F.min("cells") == F.max("cells")
    cells = stage(
        node_of.where("doc_id = node").groupBy("node").agg(
            F.when(single & (F.min("size") == F.max("size")), F.min("size")).alias("size"), F.when(single, F.min("cells")).alias("cells")
        )
    )
    tried = stage(_led(members, cells, percent))
    links = stage(_verified(tried, whole, width, percent))
    labels = components(links)
    rest = stage(_across(members, labels, cells, percent).join(tried, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        more = stage(_verified(rest, whole, width, percent))
        if not more.isEmpty():
            labels = components(links.union(more))
    of_set = nodes.join(labels, "node", "left").select(
        "k1", "k2", F.coalesce("label", "node").alias("component")
    )
    # A hot set is one row on the right, so its rows can be split on the left.
    return keyed.join(of_set, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
    )


def without_duplicates(docs: DataFrame, doc_id: str, text: str, width: int = 5,
                       percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id, with all
    their columns. Rows without an id stay; of repeated rows with one id and one text
    all but one go."""
    found = jaccard_components(docs, doc_id, text, width, percent)
    repeated = found.groupBy("doc_id").count().where("count > 1").select("doc_id")
    linked = found.where("doc_id > component_id").select("doc_id")
    apart = stage(linked.withColumn("go", F.lit(True)).union(
        repeated.where("doc_id IS NOT NULL").withColumn("go", F.lit(False))
    ).groupBy(F.col("doc_id").alias("__id")).agg(F.max("go").alias("__go")))
    id_ = F.col(doc_id).cast("long")
    kept = docs.join(apart.select("__id"), id_ == F.col("__id"), "left_anti")
    twice = apart.where("NOT __go").select("__id")
    if twice.isEmpty():
        return kept
    return kept.union(docs.join(twice, id_ == F.col("__id"), "left_semi").dropDuplicates([doc_id, text]))
