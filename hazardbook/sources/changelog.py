"""Firewall change-log pages: identifiers mentioned in MDX text and HTML tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.functions.identifiers import (
    excerpt_around,
    extract_identifiers,
    identifier_family,
)
from hazardbook.functions.markup import (
    frontmatter_block,
    frontmatter_entries,
    frontmatter_value,
    html_cells,
    html_rows,
    page_body,
    plain_text,
)
from hazardbook.functions.times import first_iso_date
from hazardbook.operators.latest import first_per_key
from hazardbook.sources.files import read_documents

# Where pages are published, by their path in the documentation sources.
SITE = "https://developers.cloudflare.com"
CHANGELOG_FOLDER = "src/content/changelog/waf/"
SCHEDULED_PAGE = "src/content/changelog/waf/scheduled-waf-release.mdx"
ARCHIVE_FOLDER = "src/content/docs/waf/change-log/"
HISTORICAL_PAGES = "src/content/docs/waf/change-log/historical-"
SOURCE_VIEW = "https://github.com/cloudflare/cloudflare-docs/blob/production/"


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, "*.mdx")


def page_name(path: Column) -> Column:
    return F.regexp_replace(F.substring_index(path, "/", -1), "[.]mdx$", "")


def public_url(path: Column) -> Column:
    name = page_name(path)
    return (
        F.when(path == SCHEDULED_PAGE, f"{SITE}/waf/change-log/scheduled-changes/")
        .when(
            path.startswith(CHANGELOG_FOLDER),
            F.concat(F.lit(f"{SITE}/changelog/"), name, F.lit("/")),
        )
        .when(
            path.startswith(ARCHIVE_FOLDER),
            F.concat(F.lit(f"{SITE}/waf/change-log/"), name, F.lit("/")),
        )
        .otherwise(F.concat(F.lit(SOURCE_VIEW), path))
    )


def mention_rows(pages: DataFrame) -> DataFrame:
    """One row per identifier and page, the first mention wins; from ``path``, ``value``.

    Table pages give one text per table row (fourth cell, dated by the fifth); other
    pages are one text dated by their frontmatter.
    """
    path, page = F.col("path"), F.col("value")
    entries = frontmatter_entries(frontmatter_block(page))
    is_table = path.startswith(HISTORICAL_PAGES)
    row_cells = F.filter(
        F.transform(html_rows(page_body(page)), html_cells), lambda c: F.size(c) >= 5
    )
    table_texts = F.transform(
        row_cells, lambda c: F.struct(c[3].alias("text"), c[4].alias("dated"))
    )
    page_text = F.array(
        F.struct(
            page_body(page).alias("text"), frontmatter_value(entries, "date").alias("dated")
        )
    )
    texts = pages.select(
        "path",
        public_url(path).alias("source_url"),
        F.coalesce(frontmatter_value(entries, "title"), page_name(path)).alias("title"),
        is_table.alias("is_table"),
        F.posexplode(F.when(is_table, table_texts).otherwise(page_text)).alias(
            "text_position", "part"
        ),
    )
    plain = texts.select(
        "path",
        "source_url",
        "title",
        "is_table",
        "text_position",
        plain_text(F.col("part.text")).alias("text"),
        F.when(F.col("is_table"), plain_text(F.col("part.dated")))
        .otherwise(F.col("part.dated"))
        .alias("dated"),
    )
    mentions = plain.withColumn("upper_text", F.upper("text")).select(
        "*",
        F.posexplode(extract_identifiers(F.col("text"))).alias("position", "identifier"),
    )
    rows = mentions.select(
        "identifier",
        identifier_family(F.col("identifier")).alias("identifier_type"),
        F.when(F.col("identifier").startswith("CVE-"), F.col("identifier")).alias("cve"),
        F.when(F.col("is_table"), F.col("text"))
        .otherwise(F.col("title"))
        .alias("source_title"),
        "source_url",
        first_iso_date(F.col("dated")).alias("source_date"),
        excerpt_around(
            F.col("text"), F.col("identifier"), F.col("upper_text")
        ).alias("matched_text"),
        F.split("path", "/").alias("__path"),
        "text_position",
        "position",
    )
    order = ("__path", "text_position", "position")
    return first_per_key(rows, ("identifier", "source_url"), order).drop(*order)
