"""Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf, hashed at the scan. The leaves of a source, in order, are joined into
runs of 16, run by run and level by level, until one node remains: the source's subroot.
The subroots, in order of their sources, form a tree of the same kind up to the root.

Only every second level is kept (``KEPT``): a stored row is an aligned subtree's 256 nodes,
and the level between is hashed again when it is needed. To extract proofs, a subtree
regenerates its missing interior nodes from the stored descendants, hands every descendant
its siblings, and lets the nodes go. A stored level is a 256th of the one below.

Positions in the hot source are found without a task that holds it: rows are dealt by
ranges of (source, order), numbered inside their range, and shifted by the counts of the
ranges before. Nothing but the digests and the order is exchanged, never a text.

Defined results: a null field is hashed as ``-``; rows without a source are a source of
their own that comes first; rows without an order value come first in their source; rows
that share an order value are ordered by digest, so equal rows are interchangeable; empty
and very long texts are hashed like any other; a table without rows has no root and no
proofs. Other columns, whatever their names, take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardbook.session import stage

RUN = 16
KEPT = 2
BUNDLE = RUN**KEPT
DIGEST = 64  # hexadecimal digits

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(value: Column) -> Column:
    return F.sha2(value, 256)


def field(value: Column) -> Column:
    """``byte count:value`` of a field as text; ``-`` if null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(*values: Column) -> Column:
    return sha(F.concat(*[field(v) for v in values]))


def ascii_lower(value: Column) -> Column:
    return F.translate(value, UPPER, LOWER)


def _run_text(digests: Column) -> Column:
    return F.array_join(digests, "")


def _runs(digests: Column) -> Column:
    """A subtree's digests, cut into runs."""
    last = F.floor((F.size(digests) - 1) / RUN).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(digests, i * RUN + 1, RUN))


def _one_up(digests: Column) -> Column:
    """The regenerated level above a subtree's digests."""
    return F.transform(_runs(digests), lambda run: sha(_run_text(run)))


def _closing() -> Column:
    """The node that a stored subtree stands for: two levels up, or what is left of its
    tree if the tree ends here (``n`` counts the tree's nodes on the stored level)."""
    digests = F.col("members.digest")
    return (
        F.when(F.col("n") == 1, F.element_at(digests, 1))
        .when(F.col("n") <= RUN, F.element_at(_one_up(digests), 1))
        .otherwise(sha(_run_text(_one_up(digests))))
    )


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``position`` in its ``tree`` (from 0) and ``n``, the tree's size, for every leaf.

    Equal leaves are told apart by ``row``, so that many of them are still split."""
    keys = ["tree", *order, "digest", "row"]
    leaves = stage(leaves)
    ranged = stage(
        leaves.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"at": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
        .drop("row")
    )
    counts = ranged.groupBy("tree", "part").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(
        counts.withColumns({
            "shift": F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first"),
            "n": F.sum("held").over(whole),
        }).select("tree", "part", "shift", "n")
    )
    return ranged.join(shifts, ["tree", "part"]).withColumn("position", F.col("at") + F.col("shift"))


def _bundled(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Nodes of a level as stored subtrees: ``tree``, ``bundle``, ``n`` and ``members``."""
    member = F.struct("position", "digest", *carried)
    return stage(
        nodes.groupBy("tree", F.floor(F.col("position") / BUNDLE).alias("bundle")).agg(
            F.any_value("n").alias("n"), F.array_sort(F.collect_list(member)).alias("members")
        )
    )


def _grown(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """The stored levels of all trees, from the leaves up."""
    levels = [_bundled(nodes, carried)]
    while not (large := levels[-1].where(F.col("n") > BUNDLE)).isEmpty():
        above = large.select(
            "tree", F.col("bundle").alias("position"), _closing().alias("digest"),
            F.ceil(F.col("n") / BUNDLE).alias("n"),
        )
        levels.append(_bundled(above, []))
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """``tree`` and its last node."""
    ended = [
        level.where(F.col("n") <= BUNDLE).select("tree", _closing().alias("root")) for level in levels
    ]
    found = ended[0]
    for more in ended[1:]:
        found = found.union(more)
    return found


def _opened(bundles: DataFrame, carried: list[str]) -> DataFrame:
    """Every member of the stored subtrees with its ``path``: the siblings before and after
    it in its run, in its run's run, and then the subtree's own path (``above``)."""
    one_up = _one_up(F.col("members.digest"))
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("members") - 1) / RUN).cast("int")),
        lambda i: F.slice("members", i * RUN + 1, RUN),
    )
    runs = bundles.select(
        "tree", "subroot", "n", "above", _run_text(one_up).alias("upper"),
        F.posexplode(cut).alias("r", "run"),
    )
    members = runs.select(
        "tree", "subroot", "n", "above", "upper", "r", _run_text(F.col("run.digest")).alias("lower"),
        F.posexplode("run").alias("k", "member"),
    )

    def step(text: str, at: str) -> Column:
        return F.struct(
            F.substring(F.col(text), F.lit(1), F.col(at) * DIGEST).alias("before"),
            F.substring(F.col(text), (F.col(at) + 1) * DIGEST + 1, F.lit(RUN * DIGEST)).alias("after"),
        )

    none = F.array().cast("array<struct<before:string,after:string>>")
    own = (
        F.when(F.col("n") == 1, none)
        .when(F.col("n") <= RUN, F.array(step("lower", "k")))
        .otherwise(F.array(step("lower", "k"), step("upper", "r")))
    )
    return members.select(
        "tree", "subroot", "member.position", "member.digest",
        *[F.col(f"member.{c}") for c in carried], F.concat(own, "above").alias("path"),
    )


def _paths(levels: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """Paths of all leaves, given the path ``above`` every tree's root and its ``subroot``."""
    opened = None
    for depth in reversed(range(len(levels))):
        level = levels[depth]
        bundles = level.where(F.col("n") <= BUNDLE).join(tops, "tree")
        if opened is not None:
            parents = opened.select("tree", "subroot", F.col("position").alias("bundle"), F.col("path").alias("above"))
            inner = level.where(F.col("n") > BUNDLE).join(parents, ["tree", "bundle"])
            bundles = bundles.unionByName(inner.select(bundles.columns))
        opened = _opened(bundles, carried if depth == 0 else [])
    return opened


@dataclass
class Manifest:
    """Stored levels of the sources' trees and of the tree over them, and the root (None
    without rows)."""

    levels: list[DataFrame]
    upper: list[DataFrame]
    root: str | None
    carried: list[str]

    def proofs(self) -> DataFrame:
        """Every leaf (``digest``) with its carried columns, its ``subroot`` and its ``path``
        to the root: an array of (``before``, ``after``), the siblings' digests."""
        nothing = F.array().cast("array<struct<before:string,after:string>>")
        top = self.upper[0].sparkSession.createDataFrame([("",)], "tree string").select(
            "tree", F.lit(None).cast("string").alias("subroot"), nothing.alias("above")
        )
        tops = stage(
            _paths(self.upper, top, ["of"]).select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("above"))
        )
        return _paths(self.levels, tops, self.carried)


def manifest(leaves: DataFrame, source: str, order: str, digest: str, carried: list[str]) -> Manifest:
    """The manifest of a table of leaf digests; ``carried`` columns come back with the proofs."""
    source_key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))  # a null comes first
    nodes = leaves.select(
        source_key.alias("tree"), F.col(order).alias("place"), F.col(digest).alias("digest"),
        F.struct(*carried).alias("held"),
    )
    levels = _grown(_numbered(nodes, ["place"]), ["held"])
    subroots = _roots(levels).select(
        F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("digest")
    )
    upper = _grown(_numbered(subroots, ["of"]), ["of"])
    top = _roots(upper).first()
    return Manifest(levels, upper, top["root"] if top else None, ["held"])


def proof_digest(path: Column) -> Column:
    """The digest of all siblings on the way to the root, in order."""
    return sha(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda d, s: sha(F.concat(s["before"], d, s["after"])))


def verified_rows(docs: DataFrame, source: str, order: str, values: list[str], text: str,
                  tampered: Column) -> DataFrame:
    """Per row its ``leaf``, ``subroot``, ``root``, the digest of its proof, the root that
    follows when the text of the ``tampered`` rows is lower-cased, and whether that is
    still the manifest's."""
    changed = [ascii_lower(F.col(v)) if v == text else F.col(v) for v in values]
    leaves = docs.select(
        F.col(source).alias("source"), F.col(order).alias("doc_id"),
        leaf_digest(*[F.col(v) for v in values]).alias("leaf"),
        F.when(tampered, leaf_digest(*changed)).alias("changed"),
    )
    found = manifest(leaves, "source", "doc_id", "leaf", ["doc_id", "changed"])
    return found.proofs().select(
        "held.doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(found.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("held.changed", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
