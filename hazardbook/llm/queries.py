"""The operators over the given tables, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.llm import (
    edit_embedding, histogram_sort, language_spans, merkle_manifest, mixing, oracles,
    personal_data, ring_simhash, rule_ensemble, set_join, templates, term_scan, transcripts,
    url_tree,
)
from hazardbook.llm.common import documents, held_out, whole
from hazardbook.session import stage

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
GOOD = 0.3

RULES = (
    url_tree.Rule("org", "/", True),
    url_tree.Rule("example.org", "/es/", False),
    url_tree.Rule("example.org", "/en/1", False),
    url_tree.Rule("com", "/fr/", True),
    url_tree.Rule("com", "/de/", False),
)


def op1_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.against_next(documents(spark, sf_dir), "doc_id", "text")


def op2_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    cut = stage(transcripts.pieces(turns, "conv_id", "turn", "role", "text"))
    return transcripts.parse(cut, transcripts.learn(cut))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.jaccard_components(
        documents(spark, sf_dir), "doc_id", "text", width=3, percent=90
    )


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(whole("text")) + 16).cast("long").alias("size"),
        F.crc32(whole("text")).alias("text_crc32"),
    )
    dealt = histogram_sort.histogram_shards(
        stage(sized), "doc_id", F.col("size"), ["text_crc32", "size"], SHARDS
    )
    return dealt.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def op5_url_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_tree.judge(pages, "url", ["page_id"], RULES)


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = rule_ensemble.scored(
        documents(spark, sf_dir), labels, "doc_id", "text", "quality", held_out()
    )
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, sf_dir), "doc_id", "text", "source")
    return plan.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_spans.learn(docs.where(~held_out()), "doc_id", "text", "lang")
    found = language_spans.identify(docs, "doc_id", "text", model)
    return found.withColumn("held_out", held_out())


def op9_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.contaminated(documents(spark, sf_dir), items, "doc_id", "text")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(documents(spark, sf_dir), "doc_id", "text")
    return found.withColumn("base_sha256", F.sha2("base", 256))


def op11_term_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return term_scan.ranked(documents(spark, sf_dir), "doc_id", "text", items, "item_id", "text")


def op12_ring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_simhash.near_components(documents(spark, sf_dir), "doc_id", "text")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verified_rows(
        documents(spark, sf_dir), "source", "doc_id",
        ["doc_id", "source", "lang", "n_chars", "text"], "text", held_out(),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_edit_embedding, op2_transcripts, op3_jaccard_join, op4_histogram_shards,
        op5_url_tree, op6_rule_ensemble, op7_mixing, op8_language_spans, op9_templates,
        op10_personal_data, op11_term_scan, op12_ring_simhash, op13_merkle_manifest, pipeline,
    )
}

ORACLES: dict[str, str] = {
    "op2_transcripts": oracles.OP2,
    "op3_jaccard_join": oracles.OP3,
    "op4_histogram_shards": oracles.OP4,
    "op7_mixing": oracles.OP7,
    "op11_term_scan": oracles.OP11,
    "op13_merkle_manifest": oracles.OP13,
}
