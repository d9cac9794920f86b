"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 48-bit hash of its id. A source whose target is e times its words
takes all its documents floor(e) times and, once more, those whose hash lies below the
source's threshold. Thresholds come from histograms: words are summed by source and
hash bucket, and only the bucket in which the budget ends is divided further, twelve
bits a round. Nothing is sorted by document, and a larger budget takes a superset.

Targets: sources weigh 5, 2, 1, repeating in the order of their names by code point,
null last; shares of all words follow the weights, a target stops at ``cap`` times its
source's words, and the excess is shared out again by weight.

Defined results: a null or empty text has no words; a null source is a source of its
own; rows of one id are taken together, a null id being one id; an empty table gives no
rows. A source misses its target by at most half of its document at the threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardbook.llm.common import WORD, whole
from hazardbook.session import stage

WEIGHTS = (5, 2, 1)
CAP = 3
LEVELS, LEVEL_BITS = 4, 12


def hash48(doc_id: str) -> Column:
    """The first twelve hexadecimal digits of the id's MD5, as a number."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def source_key(source: str) -> Column:
    """A source as text that sorts by code point and puts null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``__source``, ``source_size`` and ``target`` of every source: one row a source.

    Sources in the order of cap per weight reach their caps one after the other; a
    source whose cap lies above its share of what is left keeps that share.
    """
    totals = sizes.groupBy("__source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("__source")) - 1) % len(weights)
    weight = reduce(
        lambda rest, i: F.when(place == i, weights[i]).otherwise(rest),
        range(len(weights) - 1),
        F.lit(weights[-1]),
    )
    weighed = totals.withColumn("__weight", weight).withColumn("__cap", F.col("source_size") * cap)
    ratio = F.col("__cap").cast("double") / F.col("__weight")
    before = Window.orderBy(ratio, "__source").rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    left = F.sum("source_size").over(all_) - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    heavy = F.sum("__weight").over(all_) - F.coalesce(F.sum("__weight").over(before), F.lit(0))
    level = weighed.withColumn("__level", left.cast("double") / heavy)
    free = F.when(F.col("__cap") > F.col("__level") * F.col("__weight"), F.col("__level"))
    # The first source that keeps its share sets the level of all that do.
    final = level.withColumn(
        "__final", F.min_by(free, F.when(free.isNotNull(), F.struct(ratio, "__source"))).over(all_)
    )
    share = F.coalesce(F.col("__final") * F.col("__weight"), F.col("__cap").cast("double"))
    return final.select(
        "__source", "source_size", F.least(F.col("__cap").cast("double"), share).alias("target")
    )


def thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """For every source the hash ``__mark`` at which its ``__budget`` ends, and whether
    the documents with that very hash are nearer in than out (``__take``)."""
    state = budgets.select(
        "__source", "__budget", F.lit(0).cast("long").alias("__prefix"), F.lit(0).cast("long").alias("__below")
    )
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        prefix = F.shiftright("__hash", shift + LEVEL_BITS)
        inside = sizes.withColumn("__prefix", prefix if level else F.lit(0).cast("long"))
        if level:
            inside = inside.join(state, ["__source", "__prefix"], "left_semi")
        # Buckets are summed before they are exchanged: a hot source sends one row a
        # bucket and task.
        bucket = F.shiftright("__hash", shift).alias("__bucket")
        buckets = inside.groupBy("__source", "__prefix", bucket).agg(F.sum("size").alias("__words"))
        order = Window.partitionBy("__source").orderBy("__bucket")
        summed = buckets.join(state, ["__source", "__prefix"]).withColumn(
            "__upto", F.col("__below") + F.sum("__words").over(order)
        )
        state = stage(
            summed.where("__upto >= __budget").groupBy("__source").agg(
                F.first("__budget").alias("__budget"),
                F.min("__bucket").alias("__prefix"),
                F.min_by(F.col("__upto") - F.col("__words"), "__bucket").alias("__below"),
                F.min("__upto").alias("__upto"),
            )
        )
        last, state = state, state.drop("__upto")
    take = F.col("__upto") + F.col("__below") < 2 * F.col("__budget")
    return last.select("__source", F.col("__prefix").alias("__mark"), take.alias("__take"))


def _marks(docs: DataFrame, doc_id: str, text: str, source: str, weights: tuple[int, ...],
           cap: int) -> tuple[DataFrame, DataFrame]:
    """Per source what it takes, and the documents' sizes and hashes."""
    sizes = stage(docs.select(
        F.col(doc_id).alias("doc_id"), source_key(source).alias("__source"),
        F.regexp_count(whole(text), F.lit(WORD)).cast("long").alias("size"),
        hash48(doc_id).alias("__hash"),
    ))
    targets = stage(source_targets(sizes, weights, cap))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = targets.withColumn("__rounds", rounds.cast("int")).withColumn(
        "__budget", F.col("target") - (F.col("__rounds") * F.col("source_size")).cast("double")
    )
    return planned.join(thresholds(sizes, planned), "__source"), sizes


def _copies(hash_: Column) -> Column:
    once_more = (hash_ < F.col("__mark")) | ((hash_ == F.col("__mark")) & F.col("__take"))
    return F.col("__rounds") + once_more.cast("int")


def mix_plan(docs: DataFrame, doc_id: str, text: str, source: str,
             weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``doc_id``, ``size`` in words, ``source_size``, ``target`` and ``copies``: how
    often the mix takes the document."""
    marks, sizes = _marks(docs, doc_id, text, source, weights, cap)
    return sizes.join(marks, "__source").select(
        "doc_id", "size", "source_size", "target", _copies(F.col("__hash")).alias("copies")
    )


def mixed(docs: DataFrame, doc_id: str, text: str, source: str,
          weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns.

    Only sources' marks, one row a source, meet the documents: whether a document is in
    follows from its source and the hash of its id.
    """
    marks, _ = _marks(docs, doc_id, text, source, weights, cap)
    held = marks.select(F.col("__source").alias("__s"), "__rounds", "__mark", "__take")
    joined = docs.join(held, source_key(source) == F.col("__s"))
    copies = F.explode(F.sequence(F.lit(1), _copies(hash48(doc_id))))
    return joined.where(_copies(hash48(doc_id)) > 0).select("*", copies.alias("__copy")).select(
        *[joined[c] for c in docs.columns]
    )
