"""Stakeholder-specific assessments: extraction, decision table, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.functions.times import iso_timestamp
from hazardbook.operators.decision import matching_rows

# Whose assessments count, and the table version.
PROVIDER_TITLE = "CISA ADP Vulnrichment"
PROVIDER_SHORT_NAME = "CISA-ADP"
ROLE = "CISA Coordinator"
VERSION = "2.0.3"

# The decision table. Exploitation, automatable, technical impact, mission
# impact and the decision.
DECISIONS = (
    ("none", "no", "partial", "low", "track"),
    ("none", "no", "partial", "medium", "track"),
    ("none", "no", "partial", "high", "track"),
    ("none", "no", "total", "low", "track"),
    ("none", "no", "total", "medium", "track"),
    ("none", "no", "total", "high", "track*"),
    ("none", "yes", "partial", "low", "track"),
    ("none", "yes", "partial", "medium", "track"),
    ("none", "yes", "partial", "high", "attend"),
    ("none", "yes", "total", "low", "track"),
    ("none", "yes", "total", "medium", "track"),
    ("none", "yes", "total", "high", "attend"),
    ("public poc", "no", "partial", "low", "track"),
    ("public poc", "no", "partial", "medium", "track"),
    ("public poc", "no", "partial", "high", "track*"),
    ("public poc", "no", "total", "low", "track"),
    ("public poc", "no", "total", "medium", "track*"),
    ("public poc", "no", "total", "high", "attend"),
    ("public poc", "yes", "partial", "low", "track"),
    ("public poc", "yes", "partial", "medium", "track"),
    ("public poc", "yes", "partial", "high", "attend"),
    ("public poc", "yes", "total", "low", "track"),
    ("public poc", "yes", "total", "medium", "track*"),
    ("public poc", "yes", "total", "high", "attend"),
    ("active", "no", "partial", "low", "track"),
    ("active", "no", "partial", "medium", "track"),
    ("active", "no", "partial", "high", "attend"),
    ("active", "no", "total", "low", "track"),
    ("active", "no", "total", "medium", "attend"),
    ("active", "no", "total", "high", "act"),
    ("active", "yes", "partial", "low", "attend"),
    ("active", "yes", "partial", "medium", "attend"),
    ("active", "yes", "partial", "high", "act"),
    ("active", "yes", "total", "low", "attend"),
    ("active", "yes", "total", "medium", "act"),
    ("active", "yes", "total", "high", "act"),
)
# Decisions from the least to the most urgent.
RANKED_DECISIONS = ("track", "track*", "attend", "act")

PARAMETERS = ("exploitation", "automatable", "technical_impact", "mission_impact")
TABLE_SCHEMA = (
    "ssvc_version string, ssvc_role string, exploitation string, automatable string,"
    " technical_impact string, mission_impact string, decision string,"
    " decision_label string, decision_rank int"
)


def decision_rows() -> list[dict[str, object]]:
    return [
        {
            "ssvc_version": VERSION,
            "ssvc_role": ROLE,
            "exploitation": exploitation,
            "automatable": automatable,
            "technical_impact": technical,
            "mission_impact": mission,
            "decision": decision,
            "decision_label": decision.capitalize(),
            "decision_rank": RANKED_DECISIONS.index(decision) + 1,
        }
        for exploitation, automatable, technical, mission, decision in DECISIONS
    ]


def decision_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [tuple(row.values()) for row in decision_rows()], TABLE_SCHEMA
    )


_ADDED = (
    "array<struct<title:string,providerMetadata:struct<shortName:string>,"
    "metrics:array<string>>>"
)
_METRIC = (
    "other struct<type:string,content:struct<version:string,role:string,"
    "timestamp:string,decision:string,options:array<struct<"
    "`Exploitation`:string,`Automatable`:string,`Technical Impact`:string,"
    "`Mission and Well-Being Impact`:string>>>>"
)


def with_fragments(records: DataFrame) -> DataFrame:
    """``cve``, ``date_updated`` and the metric ``fragments`` of the provider, cut out of the
    ``raw`` text of records. Whatever is exchanged later is a fragment, never a record."""
    added = F.from_json("raw", f"containers struct<adp:{_ADDED}>")["containers"]["adp"]
    from_provider = F.filter(
        added,
        lambda a: F.coalesce(a["title"] == PROVIDER_TITLE, F.lit(False))
        | F.coalesce(a["providerMetadata"]["shortName"] == PROVIDER_SHORT_NAME, F.lit(False)),
    )
    fragments = F.flatten(
        F.transform(
            F.filter(from_provider, lambda a: a["metrics"].isNotNull()),
            lambda a: F.transform(
                a["metrics"],
                lambda m: F.struct(
                    F.coalesce(a["title"], a["providerMetadata"]["shortName"]).alias(
                        "ssvc_provider"
                    ),
                    m.alias("ssvc_raw"),
                ),
            ),
        )
    )
    return records.select("cve", "date_updated", F.array_distinct(fragments).alias("fragments"))


def assessments(cut: DataFrame, *, repeated_records: bool) -> DataFrame:
    """Assessments inside the fragments of records (``with_fragments``).

    One row per record and distinct metric fragment. Everything happens inside the row
    without a shuffle. Only where one (cve, date_updated) may be stored more than once,
    as in a history, ``repeated_records`` merges equal rows across records.
    """
    metrics = cut.select("cve", "date_updated", F.inline("fragments")).withColumn(
        "m", F.from_json("ssvc_raw", _METRIC)
    )
    content = F.col("m.other.content")
    wanted = metrics.where(
        (F.lower(F.col("m.other.type")) == "ssvc") & (content["role"] == ROLE)
    )

    def recorded(option: str) -> Column:
        values = F.transform(content["options"], lambda o: F.lower(o[option]))
        return F.array_max(values)

    rows = wanted.select(
        "cve",
        "date_updated",
        content["version"].alias("ssvc_version"),
        content["role"].alias("ssvc_role"),
        iso_timestamp(content["timestamp"]).alias("ssvc_timestamp"),
        "ssvc_provider",
        recorded("Exploitation").alias("exploitation"),
        recorded("Automatable").alias("automatable"),
        recorded("Technical Impact").alias("technical_impact"),
        recorded("Mission and Well-Being Impact").alias("mission_impact"),
        F.lower(content["decision"]).alias("recorded_decision"),
        "ssvc_raw",
    )
    return rows.distinct() if repeated_records else rows


def decision_candidates(assessed: DataFrame) -> DataFrame:
    """Every decision an assessment allows; missing parameters take all values."""
    matched = matching_rows(
        assessed, decision_rows(), ("ssvc_version", "ssvc_role", *PARAMETERS), "d"
    )
    d = F.col("d")
    return matched.select(
        "cve",
        "date_updated",
        F.coalesce("ssvc_version", d["ssvc_version"]).alias("ssvc_version"),
        F.coalesce("ssvc_role", d["ssvc_role"]).alias("ssvc_role"),
        "ssvc_timestamp",
        "ssvc_provider",
        *[d[p].alias(p) for p in PARAMETERS],
        *[F.col(p).alias(f"recorded_{p}") for p in PARAMETERS],
        "recorded_decision",
        d["decision"].alias("computed_decision"),
        (F.col("recorded_decision") == d["decision"]).alias("decision_matches"),
        d["decision_label"].alias("decision_label"),
        d["decision_rank"].alias("decision_rank"),
        "ssvc_raw",
    )
