"""Known-exploited catalog: one JSON document with a ``vulnerabilities`` array."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.functions.jsontext import with_json_strings
from hazardbook.functions.strings import (
    CVE_PATTERN,
    empty_strings,
    trimmed_items,
    upper_items,
)
from hazardbook.functions.times import iso_date
from hazardbook.sources.files import read_documents


def read_exploited(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, "*.json")


def exploited_rows(documents: DataFrame) -> DataFrame:
    """Typed rows plus ``position`` in the feed and ``valid``, from ``value``.

    A document without the array is a broken feed and fails the job.
    """
    listed = F.from_json("value", "vulnerabilities array<string>")["vulnerabilities"]
    entries = documents.select(
        *[c for c in documents.columns if c != "value"],
        F.posexplode(
            F.coalesce(
                listed,
                F.raise_error(F.lit("feed has no vulnerabilities array")).cast(
                    "array<string>"
                ),
            )
        ).alias("position", "entry"),
    )
    listed_cwes = F.try_variant_get("v", "$.cwes", "array<variant>")
    texts = F.transform(
        F.filter(listed_cwes, lambda c: F.schema_of_variant(c) == "STRING"),
        lambda c: c.cast("string"),
    )
    named = {
        "cve": "cveID",
        "vendor_project": "vendorProject",
        "product": "product",
        "vulnerability_name": "vulnerabilityName",
        "short_description": "shortDescription",
        "required_action": "requiredAction",
        "known_ransomware_campaign_use": "knownRansomwareCampaignUse",
        "notes": "notes",
        "date_added": "dateAdded",
        "due_date": "dueDate",
    }
    rows = with_json_strings(
        entries.withColumn("v", F.try_parse_json("entry")),
        "v",
        {c: f"$.{field}" for c, field in named.items()},
    )
    return rows.select(
        *[c for c in documents.columns if c != "value"],
        *[c for c in named if c not in ("date_added", "due_date")],
        F.coalesce(upper_items(trimmed_items(texts)), empty_strings()).alias("cwe"),
        iso_date(F.col("date_added")).alias("date_added"),
        iso_date(F.col("due_date")).alias("due_date"),
        "position",
        F.coalesce(F.col("cve").rlike(f"^{CVE_PATTERN}$"), F.lit(False)).alias("valid"),
    )
