"""A corpus, stage by stage: language, near duplicates, benchmark, mix, shards.

``run`` applies the stages to ``documents``; each result is written as Parquet and read
again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.llm import histogram_sort, language_spans, mixing, set_join, templates
from hazardbook.llm.common import held_out, whole
from hazardbook.session import stage

SHARDS = 40
# Share of a shard's bytes that a splitter may be off; at 0 the search goes on to the end.
TOLERANCE = 0.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language, or in which none covers half of the letters."""
    model = language_spans.learn(docs.where(~held_out()), "doc_id", "text", "lang")
    return language_spans.identified(docs, "text", model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every group whose five-word shingles agree by 0.8."""
    return set_join.without_duplicates(docs, "doc_id", "text", width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.decontaminated(docs, items, "doc_id", "text")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents until sources have their target weights."""
    return mixing.mixed(docs, "doc_id", "text", "source")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the documents into shards of nearly equal bytes."""
    size = F.octet_length(whole("text")) + 16
    return histogram_sort.histogram_shards(docs, "doc_id", size, ["text"], SHARDS, TOLERANCE)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

# Language labels come from a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs
