"""The seventeen views over the base tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.lazy import LazyMap
from hazardbook.operators.latest import latest_per_key, latest_snapshot
from hazardbook.operators.presence import Source, presence_matrix
from hazardbook.plans.assessments import (
    assessments,
    decision_candidates,
    decision_table,
    with_fragments,
)
from hazardbook.plans.provenance import datasets
from hazardbook.schemas import TABLES

Tables = Mapping[str, DataFrame]


def latest_view(tables: Tables, history: str) -> DataFrame:
    """Newest row per key of a history; for the weakness catalog, its newest release.

    Re-appended snapshots hold equal rows, so equal order values need no tie-break
    beyond the narrow columns that are there.
    """
    rules = TABLES[history]
    if history == "cwe_history":
        return latest_snapshot(tables[history], rules.order)
    return latest_per_key(tables[history], rules.key, rules.order)


def mention_sources(
    advisories: DataFrame,
    exploits: DataFrame,
    templates: DataFrame,
    exploited: DataFrame,
    mentions: DataFrame,
) -> list[Source]:
    """Datasets that name vulnerabilities of others. Withdrawn rows do not count."""
    in_exploits = exploits.select(F.explode("cve").alias("cve")).where("cve is not null")
    in_templates = (
        templates.where(~F.col("removed"))
        .select(F.explode("cve").alias("cve"))
        .where("cve is not null")
    )
    return [
        Source("ghsa", advisories.where("cve is not null").select("cve"), "ghsa_count"),
        Source("exploitdb", in_exploits, "exploitdb_count"),
        Source("nuclei", in_templates, "nuclei_count"),
        Source("kev", exploited.where(~F.col("removed")).select("cve")),
        Source(
            "cloudflare_waf",
            mentions.where(F.col("cve").isNotNull() & ~F.col("removed")).select("cve"),
            "cloudflare_waf_count",
        ),
    ]


def record_sources(scores: DataFrame, records: DataFrame, *mentioning: DataFrame) -> DataFrame:
    """Which datasets know a vulnerability; ``mentioning`` as in ``mention_sources``.

    ``records`` may be the history: any version of a record makes it present, so the
    widest table is not reduced to its newest rows for this.
    """
    own = [Source("epss", scores.select("cve"), "epss_days"), Source("cve", records.select("cve"))]
    return presence_matrix([*own, *mention_sources(*mentioning)], "cve")


def weakness_attack_patterns(patterns: DataFrame, techniques: DataFrame) -> DataFrame:
    """Weakness to attack pattern to enterprise technique. A pattern without techniques
    stays with NULLs; an unknown technique id shows as NULL, not as the raw id."""
    enterprise = techniques.where(F.col("matrix") == "enterprise").select(
        "attack_id",
        F.col("name").alias("attack_name"),
        F.col("object_type").alias("attack_object_type"),
        "kill_chain_phases",
    )
    links = (
        patterns.where(~F.col("revoked") & ~F.col("deprecated"))
        .select("capec_id", F.col("name").alias("capec_name"), "cwe", "attack")
        .withColumn("cwe", F.explode("cwe"))
        .withColumn("technique", F.explode_outer("attack"))
    )
    # Patterns without a technique are spread by their own id, not gathered under a null.
    wanted = F.coalesce("technique", F.concat(F.lit("no technique of "), "capec_id"))
    return links.join(enterprise, wanted == F.col("attack_id"), "left").select(
        "cwe",
        "capec_id",
        "capec_name",
        "attack_id",
        "attack_name",
        "attack_object_type",
        "kill_chain_phases",
    )


def build_views(spark: SparkSession, tables: Tables) -> LazyMap[DataFrame]:
    """All views by name; each is planned when it is first named."""
    builders: dict[str, Callable[[], DataFrame]] = {
        rules.view: lambda name=name: latest_view(tables, name)
        for name, rules in TABLES.items()
        if rules.view
    }
    sources = ("ghsa", "exploitdb", "nuclei", "kev", "cloudflare_waf")
    builders |= {
        "datasets": lambda: datasets(spark),
        "ssvc_decision": lambda: decision_table(spark),
        "cve_ssvc_history": lambda: assessments(
            with_fragments(tables["cve_history"]), repeated_records=True
        ),
        "cve_ssvc": lambda: assessments(
            latest_per_key(with_fragments(tables["cve_history"]), ["cve"], "date_updated"),
            repeated_records=False,
        ),
        "cve_ssvc_candidates": lambda: decision_candidates(views["cve_ssvc"]),
        "cve_sources": lambda: record_sources(
            tables["epss"],
            tables["cve_history"],
            *[views[name] for name in sources],
        ),
        "cwe_attack_patterns": lambda: weakness_attack_patterns(
            views["capec"], views["attack"]
        ),
    }
    views = LazyMap(builders)
    return views


def tables_and_views(spark: SparkSession, tables: Tables) -> LazyMap[DataFrame]:
    """Base tables and views under one roof."""
    named = {name: (lambda name=name: tables[name]) for name in tables}
    return LazyMap({**named, **build_views(spark, tables).builders()})


def register_views(
    spark: SparkSession, tables: Tables, transform: Callable[[str], str] = str
) -> None:
    """Make every table and view queryable by name with ``spark.sql``."""
    for name, frame in tables_and_views(spark, tables).items():
        frame.createOrReplaceTempView(transform(name))
