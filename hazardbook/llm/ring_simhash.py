"""SimHash near-duplicates, found by pigeonring filtering.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles.
The 64 bits are a ring of 16 segments of four. Two fingerprints at most two bits apart
have, by the pigeonring principle, a segment from which every chain of l consecutive
segments differs in at most 2 * l / 16 bits: none in the first seven segments, at most one
in the first fifteen. So a fingerprint signs, for each of the 16 starts, the 28 bits of the
seven segments; those that share a signature are candidates, candidates whose longer
chains go over budget are pruned, and what is left is held against the full distance.

Equal fingerprints are one node. A signature that more than ``CROWD`` nodes share, as in
a large group of near copies, is not paired: its nodes sign the 65 strings that are at most
one bit away from them. Two of them are at most two bits apart exactly if they share such a
string, and no string has more than 65 signers, so each is linked with the string's
smallest signer. No pair is lost, and no group becomes all its pairs.

Defined results: a text that is null or has no words has the fingerprint 0, linked like any
other; texts with fewer words than a shingle are one shingle; rows that share an id each
get a result; rows without an id carry links too, and their component is named after the
smallest id in it (null if it has none); texts of any length are hashed piece by piece; an
empty table gives no rows. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardbook.llm.components import components
from hazardbook.session import stage

WITHIN = 2
SEGMENTS = 16
SEED = 42
CROWD = 32

_BITS = 64 // SEGMENTS
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
PIECE = 1 << 18  # shingles whose hashes are held at once


def fingerprint(text: bytes, width: int) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    raw = np.frombuffer(text.lower(), np.uint8)  # bytes: A-Z alone
    space = _SPACES[raw]
    kept = np.concatenate([~space[:1], ~(space[1:] & space[:-1])]) if len(raw) else space
    line = np.where(space, np.uint8(0x20), raw)[kept].tobytes().strip(b" ")
    if not line:
        return 0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    begins = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(line)]])
    if len(begins) >= width:
        begins, ends = begins[: len(begins) - width + 1], ends[width - 1 :]
    else:
        begins, ends = begins[:1], ends[-1:]
    of = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for first in range(0, len(begins), PIECE):
        spans = zip(begins[first : first + PIECE].tolist(), ends[first : first + PIECE].tolist(), strict=True)
        hashes = np.array([of(line[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * set_bits > len(begins), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``doc_id`` and ``print`` (64 bits as a long) of every row."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "print"]
            )

    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return whole.mapInArrow(prints, "doc_id long, print long")


def budget(length: int) -> int:
    """Bits in which a chain of so many segments may differ."""
    return WITHIN * length // SEGMENTS


# Chains up to this length must be equal; they make the signature.
EQUAL = max(n for n in range(1, SEGMENTS) if budget(n) == 0)


def _turned(bits: Column, start: int) -> Column:
    """The ring read from a segment on."""
    by = start * _BITS
    if by == 0:
        return bits
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, 64 - by))


def signed(nodes: DataFrame) -> DataFrame:
    """``start``, ``chain`` and ``node`` for every start on the ring."""
    each = [
        F.struct(
            F.lit(i).alias("start"),
            F.shiftrightunsigned(_turned(F.col("node"), i), 64 - EQUAL * _BITS).alias("chain"),
        )
        for i in range(SEGMENTS)
    ]
    return nodes.select("node", F.inline(F.array(*each)))


def _in_budget(a: str, b: str) -> Column:
    """Whether every chain from ``start`` that is longer than the signature keeps its budget.
    Counts grow with the chain, so the last length of each budget decides."""
    apart = F.col(a).bitwiseXOR(F.col(b))
    ring = F.lit(None)
    for i in range(SEGMENTS):
        ring = F.when(F.col("start") == i, _turned(apart, i)).otherwise(ring)
    decisive = [n for n in range(EQUAL + 1, SEGMENTS) if budget(n) < budget(n + 1)]
    return reduce(
        lambda held, n: held & (F.bit_count(F.shiftrightunsigned(ring, 64 - n * _BITS)) <= budget(n)),
        decisive, F.lit(True),
    )


def _paired(members: DataFrame) -> DataFrame:
    """Links between the nodes of small signatures: budgets of the chains, then the
    full distance."""
    other = members.select("start", "chain", F.col("node").alias("other"))
    near = F.bit_count(F.col("node").bitwiseXOR(F.col("other"))) <= WITHIN
    candidates = members.join(other, ["start", "chain"]).where(
        (F.col("node") < F.col("other")) & _in_budget("node", "other")
    )
    return candidates.where(near).select(F.col("node").alias("a"), F.col("other").alias("b"))


def _around(nodes: DataFrame) -> DataFrame:
    """Links between crowded nodes: those that share a string at most one bit away."""
    flips = [F.col("node"), *[F.col("node").bitwiseXOR(F.lit(1).cast("long") if i == 0 else F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)]]
    shared = nodes.select("node", F.explode(F.array(*flips)).alias("between")).groupBy("between").agg(
        F.min("node").alias("a"), F.collect_list("node").alias("signers")
    )
    return shared.where(F.size("signers") > 1).select("a", F.explode("signers").alias("b")).where("a != b")


def links(nodes: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints (``node``) that hold together
    exactly the nodes that are joined by chains of distances up to ``WITHIN``."""
    chains = stage(signed(nodes))
    sizes = stage(
        chains.groupBy("start", "chain").agg(F.count("*").alias("held")).where("held > 1")
    )
    small = chains.join(sizes.where(F.col("held") <= CROWD), ["start", "chain"], "left_semi")
    crowded = chains.join(sizes.where(F.col("held") > CROWD), ["start", "chain"], "left_semi")
    return _paired(stage(small)).union(_around(crowded.select("node").distinct())).distinct()


def near_components(docs: DataFrame, doc_id: str, text: str, width: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (the smallest
    id reachable, its own included) of every row."""
    prints = stage(fingerprints(docs, doc_id, text, width))
    nodes = stage(prints.groupBy(F.col("print").alias("node")).agg(F.min("doc_id").alias("low")))
    labels = components(stage(links(nodes.select("node"))))
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = stage(labelled.groupBy("label").agg(F.min("low").alias("component_id")))
    of_print = stage(
        labelled.join(named, "label").select(F.col("node").alias("print"), "component_id")
    )
    return prints.join(of_print, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
