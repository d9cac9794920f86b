"""Schemas, keys and ordering of the base tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Base tables as DDL text, which readers take as it is.
SCHEMAS: dict[str, str] = {
    "epss": "cve string, epss double, percentile double, date date, model_version string",
    "cve_history": (
        "cve string, state string, assigner string, title string, description string,"
        " cvss double, cvss_version string, cvss_severity string, cvss_vector string,"
        " cwe array<string>, date_published timestamp_ntz, date_reserved timestamp_ntz,"
        " date_updated timestamp_ntz, raw string"
    ),
    "ghsa_history": (
        "ghsa string, cve string, summary string, severity string, cvss double,"
        " cvss_version string, cvss_vector string, cwe array<string>,"
        " affected array<struct<ecosystem:string,package:string,introduced:string,"
        "fixed:string,last_affected:string>>,"
        " published timestamp_ntz, modified timestamp_ntz, withdrawn timestamp_ntz,"
        " raw string"
    ),
    "exploitdb_history": (
        "edb_id int, cve array<string>, description string, type string,"
        " platform string, author string, port int, verified boolean, tags string,"
        " aliases string, codes string, file string, code_url string,"
        " source_url string, application_url string, screenshot_url string,"
        " date_published date, date_added date, date_updated date"
    ),
    "nuclei_history": (
        "template_id string, name string, severity string, description string,"
        " author array<string>, tags array<string>, reference array<string>,"
        " cve array<string>, cwe array<string>, cvss_score double, cvss_metrics string,"
        " epss_score double, epss_percentile double, cpe string, vendor string,"
        " product string, verified boolean, type string, file string,"
        " template_url string, digest string, fetched_date date, removed boolean"
    ),
    "cwe_history": (
        "cwe_id string, entry_type string, name string, abstraction string,"
        " status string, description string, likelihood_of_exploit string,"
        " relations array<struct<nature:string,target_id:string>>, cwe_version string,"
        " release_date date"
    ),
    "kev_history": (
        "cve string, vendor_project string, product string, vulnerability_name string,"
        " short_description string, required_action string,"
        " known_ransomware_campaign_use string, notes string, cwe array<string>,"
        " date_added date, due_date date, fetched_date date, removed boolean"
    ),
    "cloudflare_waf_history": (
        "identifier string, identifier_type string, cve string, source_title string,"
        " source_url string, source_date date, matched_text string, fetched_date date,"
        " removed boolean"
    ),
    "attack_history": (
        "matrix string, attack_id string, object_id string, object_type string,"
        " name string, description string, url string,"
        " kill_chain_phases array<struct<kill_chain_name:string,phase_name:string>>,"
        " revoked boolean, deprecated boolean, modified timestamp_ntz, raw string"
    ),
    "attack_relationship_history": (
        "matrix string, relationship_id string, relationship_type string,"
        " source_ref string, source_attack_id string, source_name string,"
        " source_type string, target_ref string, target_attack_id string,"
        " target_name string, target_type string, description string,"
        " revoked boolean, deprecated boolean, modified timestamp_ntz, raw string"
    ),
    "capec_history": (
        "capec_id string, object_id string, name string, description string,"
        " url string, cwe array<string>, attack array<string>, revoked boolean,"
        " deprecated boolean, modified timestamp_ntz, raw string"
    ),
}


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows, as a relation the optimizer knows to be empty."""
    fields = StructType.fromDDL(ddl).fields
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(1).select(*nulls).limit(0)


def columns_of(table: str) -> list[str]:
    return StructType.fromDDL(SCHEMAS[table]).names


@dataclass(frozen=True)
class TableRules:
    """How one base table is laid out, ordered and checked."""

    name: str
    folder: str  # below the root; batches of the table live here
    key: tuple[str, ...]
    order: str  # newest row per key has the greatest value
    sort: tuple[str, ...]  # sort order inside the files
    view: str | None = None
    update_name: str | None = None  # "<name>-YYYY-MM-DD.parquet" of dated batches
    dated_updates_follow: bool = True  # newest row must keep up with the batch date
    min_age_days: int | None = 0  # floor of the staleness limit, None = never stale


TABLES: dict[str, TableRules] = {
    rules.name: rules
    for rules in (
        TableRules(
            "epss", "epss", ("cve", "date"), "date", ("cve", "date"), None, "epss"
        ),
        TableRules(
            "cve_history",
            "cve",
            ("cve",),
            "date_updated",
            ("cve", "date_updated"),
            "cve",
            "cve-updates",
        ),
        TableRules(
            "ghsa_history",
            "ghsa",
            ("ghsa",),
            "modified",
            ("ghsa", "modified"),
            "ghsa",
            "ghsa-updates",
        ),
        TableRules(
            "exploitdb_history",
            "exploitdb",
            ("edb_id",),
            "date_updated",
            ("edb_id",),
            "exploitdb",
            "exploitdb-updates",
            min_age_days=21,  # upstream publishes in bursts weeks apart
        ),
        TableRules(
            "nuclei_history",
            "nuclei",
            ("template_id",),
            "fetched_date",
            ("template_id",),
            "nuclei",
            "nuclei-updates",
        ),
        TableRules(
            "cwe_history",
            "cwe",
            ("cwe_id",),
            "release_date",
            ("entry_type", "cwe_id"),
            "cwe",
            None,
            dated_updates_follow=False,
            min_age_days=None,
        ),
        TableRules(
            "kev_history",
            "kev",
            ("cve",),
            "fetched_date",
            ("cve",),
            "kev",
            "kev-updates",
        ),
        TableRules(
            "cloudflare_waf_history",
            "cloudflare_waf",
            ("identifier", "source_url"),
            "fetched_date",
            ("identifier", "source_url"),
            "cloudflare_waf",
            "cloudflare-waf-updates",
            min_age_days=None,
        ),
        TableRules(
            "attack_history",
            "attack/updates",
            ("matrix", "attack_id"),
            "modified",
            ("matrix", "attack_id", "modified"),
            "attack",
            "attack",
            dated_updates_follow=False,
            min_age_days=None,
        ),
        TableRules(
            "attack_relationship_history",
            "attack/relationships",
            ("matrix", "relationship_id"),
            "modified",
            ("matrix", "relationship_id", "modified"),
            "attack_relationship",
            "attack-relationships",
            dated_updates_follow=False,
            min_age_days=None,
        ),
        TableRules(
            "capec_history",
            "capec",
            ("capec_id",),
            "modified",
            ("capec_id", "modified"),
            "capec",
            "capec",
            dated_updates_follow=False,
            min_age_days=None,
        ),
    )
}
