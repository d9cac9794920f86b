"""Weakness catalog: one XML document per release."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.functions.markup import markup_kept, text_of_markup, unmarked
from hazardbook.functions.nested import weakness_relations
from hazardbook.functions.times import iso_date
from hazardbook.sources.files import read_documents

# List element, entry element, published entry type, description child,
# relation list and relation element.
ENTRY_KINDS = (
    ("Weaknesses", "Weakness", "weakness", "Description", "Related_Weaknesses", "Related_Weakness"),
    ("Categories", "Category", "category", "Summary", "Relationships", "Has_Member"),
    ("Views", "View", "view", "Objective", "Members", "Has_Member"),
)


def _entry_list(listing: str, tag: str, kind: str, text: str, group: str, member: str) -> str:
    return (
        f"{listing} struct<{tag}:array<struct<`_ID`:string,`_Name`:string,"
        f"`_Abstraction`:string,`_Status`:string,{text}:string,Likelihood_Of_Exploit:string,"
        f"{group}:struct<{member}:array<struct<`_Nature`:string,`_CWE_ID`:string>>>>>>"
    )


_CATALOG = "_Version string, _Date string, " + ", ".join(_entry_list(*k) for k in ENTRY_KINDS)


def read_catalogs(spark: SparkSession, root: str) -> DataFrame:
    return read_documents(spark, root, "*.xml")


def weakness_rows(documents: DataFrame) -> DataFrame:
    """Typed rows of ``cwe_history`` from the text of catalogs (``value``), in one pass of
    Spark's XML parser: comments are skipped, CDATA is text, and an entry counts where the
    catalog lists it, whether it is closed by itself or not. A catalog that is no XML or
    has no version or date is an error.
    """
    parsed = documents.select(F.from_xml(markup_kept(F.col("value")), _CATALOG).alias("c"))

    def required(attribute: str) -> Column:
        value = F.col(f"c._{attribute}")
        return F.when(value != "", unmarked(value)).otherwise(
            F.raise_error(F.lit(f"catalog has no {attribute} attribute"))
        )

    release = parsed.withColumns(
        {"cwe_version": required("Version"), "release_date": iso_date(required("Date"))}
    )

    def of_kind(listing: str, tag: str, kind: str, text: str, group: str, member: str) -> DataFrame:
        nothing = F.lit(None).cast("string")
        entries = release.select(
            "cwe_version", "release_date", F.explode(F.col(f"c.{listing}.{tag}")).alias("e")
        )

        def attribute(name: str) -> Column:
            value = unmarked(F.col(f"e._{name}"))
            return F.when(value != "", value)

        related = F.col(f"e.{group}.{member}")
        nature = (lambda r: r["_Nature"]) if kind == "weakness" else (lambda r: F.lit("HasMember"))
        return entries.select(
            F.concat(F.lit("CWE-"), attribute("ID")).alias("cwe_id"),
            F.lit(kind).alias("entry_type"),
            attribute("Name").alias("name"),
            (attribute("Abstraction") if kind == "weakness" else nothing).alias("abstraction"),
            attribute("Status").alias("status"),
            text_of_markup(F.col(f"e.{text}")).alias("description"),
            (
                text_of_markup(F.col("e.Likelihood_Of_Exploit")) if kind == "weakness" else nothing
            ).alias("likelihood_of_exploit"),
            weakness_relations(
                F.transform(related, nature), F.transform(related, lambda r: r["_CWE_ID"])
            ).alias("relations"),
            "cwe_version",
            "release_date",
        )

    return reduce(DataFrame.unionByName, [of_kind(*kind) for kind in ENTRY_KINDS])
