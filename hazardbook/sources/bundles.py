"""STIX bundles: attack techniques, their relationships, attack patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.functions.jsontext import canonical_json
from hazardbook.functions.nested import (
    complete_phases,
    external_id,
    external_ids,
    external_url,
    flag,
)
from hazardbook.functions.times import iso_timestamp
from hazardbook.operators.references import resolve_ends
from hazardbook.sources.files import read_documents

# Object types that are published.
OBJECT_TYPES = (
    "attack-pattern", "course-of-action", "intrusion-set", "malware", "tool",
    "x-mitre-data-source", "x-mitre-data-component", "x-mitre-tactic",
)
# How the two catalogs are named in external references.
ATTACK_SOURCE = "mitre-attack"
CAPEC_SOURCE = "capec"
WEAKNESS_SOURCES = ("cwe",)
TECHNIQUE_SOURCES = ("mitre-attack", "ATTACK")

_OBJECT = (
    "type string, id string, name string, description string, modified string,"
    " revoked boolean, x_mitre_deprecated boolean,"
    " external_references array<struct<source_name:string,external_id:string,url:string>>,"
    " kill_chain_phases array<struct<kill_chain_name:string,phase_name:string>>,"
    " relationship_type string, source_ref string, target_ref string"
)


def matrix_of(path: Column) -> Column:
    """``enterprise`` for ``.../enterprise-attack.json`` and so on."""
    return F.regexp_extract(path, "([a-z]+)-attack[.]json$", 1)


def read_bundles(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    return read_documents(spark, root, name_glob)


def bundle_objects(documents: DataFrame, *scope: str) -> DataFrame:
    """One row per object with its ``position`` in the bundle, parsed as ``o``."""
    # Parsed inside of the generator: a filter on a field would be pushed below a parser in
    # a projection, and every field it names would parse the object again.
    listed = F.from_json("value", "objects array<string>")["objects"]
    parsed = F.transform(
        listed, lambda s: F.struct(s.alias("source"), F.from_json(s, _OBJECT).alias("o"))
    )
    return documents.select(*scope, F.posexplode(parsed).alias("position", "object")).select(
        *scope, "position", "object.source", "object.o"
    )


def _common(source: str) -> list[Column]:
    o = F.col("o")
    return [
        o["id"].alias("object_id"),
        o["name"].alias("name"),
        o["description"].alias("description"),
        external_url(o["external_references"], source).alias("url"),
    ]


def _state() -> list[Column]:
    o = F.col("o")
    return [
        flag(o["revoked"]).alias("revoked"),
        flag(o["x_mitre_deprecated"]).alias("deprecated"),
        iso_timestamp(o["modified"]).alias("modified"),
        canonical_json(F.col("source")).alias("raw"),
    ]


def attack_rows(objects: DataFrame) -> DataFrame:
    """Rows of ``attack_history``: published types that carry an ATT&CK id."""
    o = F.col("o")
    attack_id = external_id(o["external_references"], ATTACK_SOURCE)
    published = objects.where(o["type"].isin(*OBJECT_TYPES) & attack_id.isNotNull())
    object_id, name, description, url = _common(ATTACK_SOURCE)
    return published.select(
        "matrix",
        attack_id.alias("attack_id"),
        object_id,
        o["type"].alias("object_type"),
        name,
        description,
        url,
        complete_phases(o["kill_chain_phases"]).alias("kill_chain_phases"),
        *_state(),
    )


def relationship_rows(objects: DataFrame, *scope: str) -> DataFrame:
    """Rows of ``attack_relationship_history`` with both ends resolved inside the same
    bundle. The index covers all object types, also unpublished ones."""
    o = F.col("o")
    scope = scope or ("matrix",)
    nodes = objects.where(F.coalesce(o["type"], F.lit("")) != "relationship").select(
        *scope,
        o["id"].alias("id"),
        external_id(o["external_references"], ATTACK_SOURCE).alias("attack_id"),
        o["name"].alias("name"),
        o["type"].alias("type"),
        "position",
    )
    edges = objects.where(o["type"] == "relationship").select(
        *scope,
        o["id"].alias("relationship_id"),
        o["relationship_type"].alias("relationship_type"),
        o["source_ref"].alias("source_ref"),
        o["target_ref"].alias("target_ref"),
        o["description"].alias("description"),
        *_state(),
    )
    resolved = resolve_ends(
        edges,
        nodes,
        scope,
        "id",
        ("attack_id", "name", "type"),
        (("source_ref", "source"), ("target_ref", "target")),
        "position",
    )
    return resolved.select(
        *scope,
        "relationship_id",
        "relationship_type",
        "source_ref",
        "source_attack_id",
        "source_name",
        "source_type",
        "target_ref",
        "target_attack_id",
        "target_name",
        "target_type",
        "description",
        "revoked",
        "deprecated",
        "modified",
        "raw",
    )


def pattern_rows(objects: DataFrame) -> DataFrame:
    """Rows of ``capec_history``: attack patterns that carry a CAPEC id."""
    o = F.col("o")
    references = o["external_references"]
    capec_id = external_id(references, CAPEC_SOURCE)
    published = objects.where((o["type"] == "attack-pattern") & capec_id.isNotNull())
    return published.select(
        capec_id.alias("capec_id"),
        *_common(CAPEC_SOURCE),
        external_ids(references, WEAKNESS_SOURCES, "CWE-").alias("cwe"),
        external_ids(references, TECHNIQUE_SOURCES, "T").alias("attack"),
        *_state(),
    )
