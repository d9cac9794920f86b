"""Detection templates: YAML documents."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hazardbook.functions.jsontext import (
    json_is_object,
    json_items,
    json_number,
    json_string,
    json_true,
)
from hazardbook.functions.strings import (
    content_digest,
    only_cve_ids,
    trimmed_items,
    upper_items,
    url_from,
)
from hazardbook.sources.files import read_documents

try:
    import yaml
except ImportError:  # only this feed needs it
    yaml = None

# Fixed value: public page of a template.
PAGE_URL = "https://github.com/projectdiscovery/nuclei-templates/blob/main/{}"

# Protocol keys in order of precedence and the type each stands for.
PROTOCOLS = (
    ("http", "http"), ("requests", "http"), ("network", "network"), ("tcp", "network"),
    ("dns", "dns"), ("file", "file"), ("headless", "headless"), ("ssl", "ssl"),
    ("websocket", "websocket"), ("whois", "whois"), ("code", "code"),
    ("javascript", "javascript"), ("workflows", "workflows"),
)

# Directories that hold no templates.
SKIPPED_DIRECTORIES = (".github/", "helpers/", "profiles/")


def template_path(path: Column) -> Column:
    """Path below the top directory of the landed archive."""
    return F.regexp_extract(path, "^[^/]*/(.*)$", 1)


def is_template(relative: Column) -> Column:
    skipped = F.lit(False)
    for directory in SKIPPED_DIRECTORIES:
        skipped = skipped | relative.startswith(directory)
    return (relative != "") & ~skipped & relative.rlike("[.]ya?ml$")


def read_templates(spark: SparkSession, root: str) -> DataFrame:
    documents = read_documents(spark, root, "*.{yaml,yml}")
    relative = template_path(F.col("path"))
    return documents.where(is_template(relative)).select(relative.alias("file"), "value")


def _plain(value):
    """A YAML value as JSON; lists become text entries, other types an object."""
    if isinstance(value, list):
        return [str(item) for item in value]
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, float) and value != value:
        return "NaN"
    if value is None or isinstance(value, str | bool | int | float):
        return value
    return {"other": str(value)}


def _summary(text: str | None) -> str | None:
    """Id, info block and top-level keys of one YAML document as JSON."""
    if text is None:
        return None
    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    try:
        document = yaml.load(text, Loader=loader)
    except (yaml.YAMLError, ValueError):
        return None
    if not isinstance(document, dict):
        return None
    return json.dumps(
        {
            "id": _plain(document.get("id")),
            "info": _plain(document.get("info")),
            "keys": [str(key) for key in document],
        }
    )


@F.pandas_udf(StringType())
def _yaml_summary(text: pd.Series) -> pd.Series:
    return text.map(_summary)


def template_type(keys: Column) -> Column:
    return F.coalesce(
        *[F.when(F.array_contains(keys, key), kind) for key, kind in PROTOCOLS]
    )


def template_rows(documents: DataFrame) -> DataFrame:
    """Typed template rows plus ``valid``, from ``file`` and ``value`` text columns.

    Python does one thing, YAML to a small JSON text in Arrow batches; every rule on
    the content is a column expression.
    """
    if yaml is None:
        raise RuntimeError("reading templates needs a YAML parser")
    parsed = documents.select(
        "file",
        content_digest(F.col("value")).alias("digest"),
        F.try_parse_json(_yaml_summary("value")).alias("t"),
    )
    t = F.col("t")

    def items(path: str) -> Column:
        return trimmed_items(json_items(t, path))

    info, classification, metadata = "$.info", "$.info.classification", "$.info.metadata"
    return parsed.select(
        json_string(t, "$.id").alias("template_id"),
        json_string(t, f"{info}.name").alias("name"),
        json_string(t, f"{info}.severity").alias("severity"),
        json_string(t, f"{info}.description").alias("description"),
        items(f"{info}.author").alias("author"),
        items(f"{info}.tags").alias("tags"),
        items(f"{info}.reference").alias("reference"),
        only_cve_ids(items(f'{classification}["cve-id"]')).alias("cve"),
        upper_items(items(f'{classification}["cwe-id"]')).alias("cwe"),
        json_number(t, f'{classification}["cvss-score"]').alias("cvss_score"),
        json_string(t, f'{classification}["cvss-metrics"]').alias("cvss_metrics"),
        json_number(t, f'{classification}["epss-score"]').alias("epss_score"),
        json_number(t, f'{classification}["epss-percentile"]').alias("epss_percentile"),
        json_string(t, f"{classification}.cpe").alias("cpe"),
        json_string(t, f"{metadata}.vendor").alias("vendor"),
        json_string(t, f"{metadata}.product").alias("product"),
        json_true(t, f"{metadata}.verified").alias("verified"),
        template_type(F.try_variant_get(t, "$.keys", "array<string>")).alias("type"),
        "file",
        url_from(PAGE_URL, F.col("file")).alias("template_url"),
        "digest",
        (json_string(t, "$.id").isNotNull() & json_is_object(t, info)).alias("valid"),
    )
