"""The published query patterns as functions over the views.

``v`` maps table and view names to DataFrames (``Lake.frames`` or ``build_views`` plus
the tables).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.operators.arrays import count_per_item, join_on_item, where_contains
from hazardbook.operators.latest import record_history
from hazardbook.operators.presence import presence_matrix
from hazardbook.plans.views import mention_sources

Views = Mapping[str, DataFrame]


def record(v: Views, cve: str) -> DataFrame:
    return v["cve"].where(F.col("cve") == cve)


def sources_of(v: Views, cve: str) -> DataFrame:
    return v["cve_sources"].where(F.col("cve") == cve)


def score_history(v: Views, cve: str) -> DataFrame:
    return v["epss"].where(F.col("cve") == cve).orderBy(F.col("date").desc())


def latest_scores(scores: DataFrame) -> DataFrame:
    """Newest score of every record. Only doubles and a date are kept per key, so this is a
    hash aggregation with partial results; the largest table is neither sorted nor
    exchanged whole."""
    return scores.groupBy("cve").agg(
        F.max_by("epss", "date").alias("epss"), F.max_by("percentile", "date").alias("percentile")
    )


def triage(v: Views) -> DataFrame:
    """One triage row per record; filter on ``cve`` to look at one.

    Whether a record has scores or is a record is not asked, so the presence matrix is
    made without these two datasets: scores are read once.
    """
    flags = ["has_ghsa", "has_exploitdb", "has_nuclei", "has_kev", "has_cloudflare_waf"]
    names = ("ghsa", "exploitdb", "nuclei", "kev", "cloudflare_waf")
    known = presence_matrix(mention_sources(*[v[name] for name in names]), "cve")
    return (
        v["cve"]
        .select("cve", "title", "cvss", "cvss_severity")
        .join(known.select("cve", *flags), "cve", "left")
        .join(latest_scores(v["epss"]), "cve", "left")
        .select(
            "cve", "title", "cvss", "cvss_severity", "epss", "percentile",
            *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in flags],
        )
    )


def candidates_of(v: Views, cve: str) -> DataFrame:
    return (
        v["cve_ssvc_candidates"]
        .where(F.col("cve") == cve)
        .orderBy(F.col("decision_rank"), F.col("mission_impact").asc_nulls_last())
    )


def partial_decisions(v: Views, **parameters: str) -> DataFrame:
    """Decisions for any subset of the parameters."""
    rows = v["ssvc_decision"]
    for name, value in parameters.items():
        rows = rows.where(F.col(name) == value)
    return rows


def advisories_of(v: Views, cve: str) -> DataFrame:
    return v["ghsa"].where(F.col("cve") == cve)


def affected_packages(v: Views, ecosystem: str | None = None) -> DataFrame:
    """One row per affected range; filter on ``cve`` or pass an ecosystem."""
    rows = v["ghsa"].select("ghsa", "cve", F.inline("affected"))
    return rows if ecosystem is None else rows.where(F.col("ecosystem") == ecosystem)


def exploits_of(v: Views, cve: str) -> DataFrame:
    return where_contains(v["exploitdb"], "cve", cve)


def templates_of(v: Views, cve: str) -> DataFrame:
    return where_contains(v["nuclei"], "cve", cve).where(~F.col("removed"))


def attack_patterns_of_records(v: Views) -> DataFrame:
    """Record to weakness to attack pattern to technique."""
    return join_on_item(
        v["cve"].select("cve", "title", F.col("cwe").alias("cwes")),
        v["cwe_attack_patterns"],
        "cwes",
        "cwe",
    ).select("cve", "title", "cwe", "capec_id", "capec_name", "attack_id", "attack_name")


def patterns_of_weakness(v: Views, cwe: str) -> DataFrame:
    return v["cwe_attack_patterns"].where(F.col("cwe") == cwe)


def technique_users(v: Views, technique: str, matrix: str = "enterprise") -> DataFrame:
    return v["attack_relationship"].where(
        (F.col("matrix") == matrix)
        & (F.col("relationship_type") == "uses")
        & (F.col("target_attack_id") == technique)
    )


def known_exploited(v: Views, cve: str) -> DataFrame:
    return v["kev"].where((F.col("cve") == cve) & ~F.col("removed"))


def firewall_mentions(v: Views, identifier: str) -> DataFrame:
    return v["cloudflare_waf"].where(
        (F.col("identifier") == identifier) & ~F.col("removed")
    )


def weakness_names(v: Views) -> DataFrame:
    """Records with the names of their weaknesses; records without any stay once."""
    return join_on_item(
        v["cve"].select("cve", "title", F.col("cwe").alias("cwes")),
        v["cwe"].select("cwe_id", F.col("name").alias("cwe_name")),
        "cwes",
        "cwe_id",
        how="left",
        row_key=["cve"],
    ).select("cve", "title", "cwe_id", "cwe_name")


def weakness_parents(v: Views) -> DataFrame:
    return (
        v["cwe"]
        .select("cwe_id", F.inline("relations"))
        .where(F.col("nature") == "ChildOf")
        .select("cwe_id", F.col("target_id").alias("parent_id"))
    )


def summary(v: Views) -> DataFrame:
    """Cross-dataset summary per record.

    Each branch is counted per vulnerability before it is joined. The branches are keyed
    by their own id, so the counts equal distinct counts over the joined rows, without
    multiplying the branches with each other.
    """
    exploited = (
        v["kev"]
        .where(~F.col("removed"))
        .select("cve", F.col("date_added").alias("kev_date_added"))
    )
    advisories = (
        v["ghsa"].where("cve is not null").groupBy("cve").agg(F.count("*").alias("ghsa_count"))
    )

    def distinct_items(frame: DataFrame, count: str) -> DataFrame:
        once = frame.select(F.array_distinct("cve").alias("cve"))
        return count_per_item(once, "cve", "cve", count)

    counts = ["ghsa_count", "exploitdb_count", "nuclei_template_count"]
    joined = (
        v["cve"]
        .select("cve", "title", "cvss", "cvss_severity")
        .join(latest_scores(v["epss"]), "cve", "left")
        .join(exploited, "cve", "left")
        .join(advisories, "cve", "left")
        .join(distinct_items(v["exploitdb"], "exploitdb_count"), "cve", "left")
        .join(
            distinct_items(v["nuclei"].where(~F.col("removed")), "nuclei_template_count"),
            "cve",
            "left",
        )
    )
    return joined.na.fill(0, counts)


def record_versions(v: Views, cve: str) -> DataFrame:
    return record_history(v["cve_history"], "cve", cve, "date_updated")


def raw_field(v: Views, view: str, path: str) -> DataFrame:
    """Drill into the stored raw JSON of a view."""
    key = v[view].columns[0]
    return v[view].select(key, F.get_json_object("raw", path).alias("value"))


def score_files(spark: SparkSession, root: str, year: int) -> DataFrame:
    """Plain Parquet access to the score files of one year."""
    return spark.read.option("recursiveFileLookup", "true").parquet(
        f"{root}/epss/year={year}"
    )
