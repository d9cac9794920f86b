"""Views and published query patterns over the derived base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardbook.bindings.registry import register
from hazardbook.bindings.world import base_tables, frames, over_world
from hazardbook.operators.latest import as_of
from hazardbook.plans import published
from hazardbook.plans.provenance import COLUMNS, DATASETS
from hazardbook.plans.views import register_views

_TEXT_DATES = {"date", "fetched_date", "date_updated_day", "release_date", "source_date"}


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text and arrays joined, so that every engine prints them alike."""
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        value = F.array_join(c, ",") if kind == "array" else F.col(c).cast("string")
        df = df.withColumn(c, value)
    return df


@register(
    "view_latest_record",
    over_world("""
select cve, state, title, cvss, cvss_severity, array_to_string(cwe, ',') as cwe,
       date_updated from cve"""),
)
def view_latest_record(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["cve"]
    return _texts(
        v.select("cve", "state", "title", "cvss", "cvss_severity", "cwe", "date_updated"),
        "cwe",
    )


@register(
    "view_latest_advisory",
    over_world("select ghsa, cve, summary, severity, cvss, modified from ghsa"),
)
def view_latest_advisory(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["ghsa"]
    return v.select("ghsa", "cve", "summary", "severity", "cvss", "modified")


@register(
    "view_latest_exploit",
    over_world("""
select edb_id, array_to_string(cve, ',') as cve, description, type, verified, code_url,
       date_updated::varchar as date_updated from exploitdb"""),
)
def view_latest_exploit(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["exploitdb"].select(
        "edb_id", "cve", "description", "type", "verified", "code_url", "date_updated"
    )
    return _texts(v, "cve", "date_updated")


@register(
    "view_latest_template",
    over_world("""
select template_id, name, severity, array_to_string(cve, ',') as cve, digest,
       fetched_date::varchar as fetched_date, removed from nuclei"""),
)
def view_latest_template(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["nuclei"].select(
        "template_id", "name", "severity", "cve", "digest", "fetched_date", "removed"
    )
    return _texts(v, "cve", "fetched_date")


@register(
    "view_latest_known_exploited",
    over_world("""
select cve, vendor_project, vulnerability_name, fetched_date::varchar as fetched_date,
       removed from kev"""),
)
def view_latest_known_exploited(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["kev"].select(
        "cve", "vendor_project", "vulnerability_name", "fetched_date", "removed"
    )
    return _texts(v, "fetched_date")


@register(
    "view_latest_mention",
    over_world("""
select identifier, source_url, cve, source_title, fetched_date::varchar as fetched_date,
       removed from cloudflare_waf"""),
)
def view_latest_mention(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["cloudflare_waf"].select(
        "identifier", "source_url", "cve", "source_title", "fetched_date", "removed"
    )
    return _texts(v, "fetched_date")


@register(
    "view_latest_technique",
    over_world("select matrix, attack_id, object_type, name, modified from attack"),
)
def view_latest_technique(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["attack"]
    return v.select("matrix", "attack_id", "object_type", "name", "modified")


@register(
    "view_latest_relationship",
    over_world("""
select matrix, relationship_id, relationship_type, description, modified
from attack_relationship"""),
)
def view_latest_relationship(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["attack_relationship"]
    return v.select(
        "matrix", "relationship_id", "relationship_type", "description", "modified"
    )


@register(
    "view_latest_pattern",
    over_world("""
select capec_id, name, array_to_string(cwe, ',') as cwe, revoked, deprecated, modified
from capec"""),
)
def view_latest_pattern(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["capec"].select(
        "capec_id", "name", "cwe", "revoked", "deprecated", "modified"
    )
    return _texts(v, "cwe")


@register(
    "view_weakness_snapshot",
    over_world("""
select cwe_id, name, status, cwe_version, release_date::varchar as release_date
from cwe"""),
)
def view_weakness_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["cwe"].select(
        "cwe_id", "name", "status", "cwe_version", "release_date"
    )
    return _texts(v, "release_date")


@register("view_record_sources", over_world("select * from cve_sources"))
def view_record_sources(spark: SparkSession, sf: str) -> DataFrame:
    return frames(spark, sf)["cve_sources"]


_ASSESSMENT_COLUMNS = (
    "cve", "date_updated", "ssvc_version", "ssvc_role", "ssvc_timestamp",
    "ssvc_provider", "exploitation", "automatable", "technical_impact",
    "mission_impact", "recorded_decision",
)
_ASSESSMENT_SQL = """
select cve, date_updated, '2.0.3' as ssvc_version, 'CISA Coordinator' as ssvc_role,
       assessed_at as ssvc_timestamp, 'CISA ADP Vulnrichment' as ssvc_provider,
       exploitation, automatable, technical_impact, mission_impact, recorded_decision
from {} where metric_type = 'ssvc'"""


@register("view_assessments", over_world(_ASSESSMENT_SQL.format("cve")))
def view_assessments(spark: SparkSession, sf: str) -> DataFrame:
    return frames(spark, sf)["cve_ssvc"].select(*_ASSESSMENT_COLUMNS)


@register("view_assessment_history", over_world(_ASSESSMENT_SQL.format("cve_history")))
def view_assessment_history(spark: SparkSession, sf: str) -> DataFrame:
    return frames(spark, sf)["cve_ssvc_history"].select(*_ASSESSMENT_COLUMNS)


_CANDIDATE_COLUMNS = (
    "cve", "exploitation", "automatable", "technical_impact", "mission_impact",
    "recorded_mission_impact", "recorded_decision", "computed_decision",
    "decision_matches", "decision_rank",
)


@register("view_decision_candidates", over_world("select * from cve_ssvc_candidates"))
def view_decision_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return frames(spark, sf)["cve_ssvc_candidates"].select(*_CANDIDATE_COLUMNS)


@register(
    "view_decision_table_usage",
    over_world("""
select exploitation, automatable, technical_impact, mission_impact, computed_decision,
       decision_rank, count(*) as assessments
from cve_ssvc_candidates group by all"""),
)
def view_decision_table_usage(spark: SparkSession, sf: str) -> DataFrame:
    """How often each row of the decision table applies."""
    v = frames(spark, sf)
    parameters = ["exploitation", "automatable", "technical_impact", "mission_impact"]
    counts = (
        v["cve_ssvc_candidates"]
        .groupBy(*parameters)
        .agg(F.count("*").alias("assessments"))
    )
    decided = v["ssvc_decision"].select(
        *parameters, F.col("decision").alias("computed_decision"), "decision_rank"
    )
    return decided.join(counts, parameters)


@register(
    "view_weakness_attack_patterns",
    over_world("""
select cwe, capec_id, capec_name, attack_id, attack_name, attack_object_type,
       'kill-chain/' || phase_name as phases from cwe_attack_patterns"""),
)
def view_weakness_attack_patterns(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)["cwe_attack_patterns"]
    phases = F.transform(
        "kill_chain_phases",
        lambda p: F.concat_ws("/", p["kill_chain_name"], p["phase_name"]),
    )
    return v.withColumn("phases", F.array_join(phases, ",")).drop("kill_chain_phases")


@register(
    "record_state_as_of",
    over_world("""
select cve, title, date_updated from (
  select *, row_number() over (partition by cve order by date_updated desc) rn
  from cve_history where date_updated <= timestamp '1998-12-31') where rn = 1"""),
)
def record_state_as_of(spark: SparkSession, sf: str) -> DataFrame:
    moment = F.lit("1998-12-31").cast("timestamp_ntz")
    history = base_tables(spark, sf)["cve_history"]
    return as_of(history, ["cve"], "date_updated", moment).select(
        "cve", "title", "date_updated"
    )


_ONE = "CVE-2024-0000007"


@register(
    "find_record",
    over_world(f"select cve, title, cvss, cvss_severity from cve where cve = '{_ONE}'"),
)
def find_record(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)
    return published.record(v, _ONE).select("cve", "title", "cvss", "cvss_severity")


@register("find_sources", over_world(f"select * from cve_sources where cve = '{_ONE}'"))
def find_sources(spark: SparkSession, sf: str) -> DataFrame:
    return published.sources_of(frames(spark, sf), _ONE)


_MOST_OPEN_SQL = """
select cve from cve_ssvc_candidates group by cve order by count(*) desc, cve limit 1"""


@register(
    "find_score_history",
    over_world(f"""
select cve, epss, percentile, date::varchar as date, model_version from epss
where cve = '{_ONE}'"""),
)
def find_score_history(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(published.score_history(frames(spark, sf), _ONE), "date")


def _in_order(ordered: DataFrame) -> DataFrame:
    """Rows with their place in the order they are given in."""
    placed = ordered.withColumn("at", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("at"))).drop("at")


@register(
    "score_history_in_order",
    over_world(f"""
select row_number() over (order by date desc) as place, cve, epss, date::varchar as date from epss
where cve = '{_ONE}'"""),
)
def score_history_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """The newest score first; the place makes the order part of the result."""
    ordered = published.score_history(frames(spark, sf), _ONE)
    return _texts(_in_order(ordered), "date").select("place", "cve", "epss", "date")


@register(
    "candidates_in_order",
    over_world(f"""
select row_number() over (order by decision_rank, mission_impact) as place, cve, decision_rank, mission_impact
from cve_ssvc_candidates where cve = ({_MOST_OPEN_SQL})"""),
)
def candidates_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates of the record with the most of them, the least urgent decision first."""
    v = frames(spark, sf)
    counts = v["cve_ssvc_candidates"].groupBy("cve").count()
    most = counts.orderBy(F.desc("count"), "cve").head()["cve"]
    ordered = published.candidates_of(v, most).select("cve", "decision_rank", "mission_impact")
    return _in_order(ordered)


@register(
    "triage_rows",
    over_world("""
select c.cve, c.title, c.cvss, c.cvss_severity, e.epss, e.percentile, s.has_ghsa,
       s.has_exploitdb, s.has_nuclei, s.has_kev, s.has_cloudflare_waf
from cve c left join cve_sources s using (cve) left join latest_scores e using (cve)"""),
)
def triage_rows(spark: SparkSession, sf: str) -> DataFrame:
    return published.triage(frames(spark, sf))


@register(
    "find_candidates",
    over_world("select * from cve_ssvc_candidates where cve = 'CVE-2024-0000002'"),
)
def find_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.candidates_of(frames(spark, sf), "CVE-2024-0000002")
    return rows.select(*_CANDIDATE_COLUMNS)


@register(
    "partial_decision_lookup",
    over_world("""
select c.cve, d.mission_impact, d.decision
from cve c join ssvc_decision d on c.exploitation = d.exploitation
where d.exploitation = 'active' and d.automatable = 'yes'
  and d.technical_impact = 'total' and c.metric_type = 'ssvc'"""),
)
def partial_decision_lookup(spark: SparkSession, sf: str) -> DataFrame:
    v = frames(spark, sf)
    decisions = published.partial_decisions(
        v, exploitation="active", automatable="yes", technical_impact="total"
    ).select("exploitation", "mission_impact", "decision")
    return (
        v["cve_ssvc"]
        .select("cve", "exploitation")
        .join(decisions, "exploitation")
        .drop("exploitation")
    )


@register(
    "advisories_of_record",
    over_world("""
select ghsa, summary, severity, cvss from ghsa where cve = 'CVE-2024-0000107'"""),
)
def advisories_of_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.advisories_of(frames(spark, sf), "CVE-2024-0000107")
    return rows.select("ghsa", "summary", "severity", "cvss")


_AFFECTED_SQL = """
select ghsa, cve, a.ecosystem, a.package, a.introduced, a.fixed, a.last_affected
from (select ghsa, cve, unnest(affected) as a from ghsa) {}"""


@register("affected_packages", over_world(_AFFECTED_SQL.format("")))
def affected_packages(spark: SparkSession, sf: str) -> DataFrame:
    return published.affected_packages(frames(spark, sf))


@register(
    "affected_in_ecosystem",
    over_world(_AFFECTED_SQL.format("where a.ecosystem = 'R'")),
)
def affected_in_ecosystem(spark: SparkSession, sf: str) -> DataFrame:
    return published.affected_packages(frames(spark, sf), "R")


@register(
    "exploits_of_record",
    over_world(f"""
select edb_id, description, type, code_url from exploitdb
where list_contains(cve, '{_ONE}')"""),
)
def exploits_of_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.exploits_of(frames(spark, sf), _ONE)
    return rows.select("edb_id", "description", "type", "code_url")


@register(
    "templates_of_record",
    over_world(f"""
select template_id, name, severity, type, template_url from nuclei
where list_contains(cve, '{_ONE}') and not removed"""),
)
def templates_of_record(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.templates_of(frames(spark, sf), _ONE)
    return rows.select("template_id", "name", "severity", "type", "template_url")


@register(
    "record_attack_patterns",
    over_world("""
select c.cve, c.title, p.cwe, p.capec_id, p.capec_name, p.attack_id, p.attack_name
from cve c join cwe_attack_patterns p on list_contains(c.cwe, p.cwe)"""),
)
def record_attack_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return published.attack_patterns_of_records(frames(spark, sf))


@register(
    "patterns_of_weakness",
    over_world("""
select cwe, capec_id, capec_name, attack_id, attack_name from cwe_attack_patterns
where cwe = 'CWE-42'"""),
)
def patterns_of_weakness(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.patterns_of_weakness(frames(spark, sf), "CWE-42")
    return rows.select("cwe", "capec_id", "capec_name", "attack_id", "attack_name")


@register(
    "technique_users",
    over_world("""
select source_name, relationship_type, target_attack_id, target_name
from attack_relationship where matrix = 'enterprise' and relationship_type = 'uses'
  and target_attack_id = 'T42'"""),
)
def technique_users(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.technique_users(frames(spark, sf), "T42")
    return rows.select(
        "source_name", "relationship_type", "target_attack_id", "target_name"
    )


@register(
    "live_known_exploited",
    over_world("""
select cve, vulnerability_name, date_added::varchar as date_added,
       due_date::varchar as due_date, known_ransomware_campaign_use
from kev where cve = 'CVE-2024-0000002' and not removed"""),
)
def live_known_exploited(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.known_exploited(frames(spark, sf), "CVE-2024-0000002").select(
        "cve", "vulnerability_name", "date_added", "due_date",
        "known_ransomware_campaign_use",
    )
    return _texts(rows, "date_added", "due_date")


@register(
    "live_firewall_mentions",
    over_world(f"""
select identifier, source_title, source_url, source_date::varchar as source_date
from cloudflare_waf where identifier = '{_ONE}' and not removed"""),
)
def live_firewall_mentions(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.firewall_mentions(frames(spark, sf), _ONE).select(
        "identifier", "source_title", "source_url", "source_date"
    )
    return _texts(rows, "source_date")


@register(
    "record_weakness_names",
    over_world("""
select c.cve, c.title, w.cwe_id, w.name as cwe_name
from cve c left join cwe w on list_contains(c.cwe, w.cwe_id)"""),
)
def record_weakness_names(spark: SparkSession, sf: str) -> DataFrame:
    return published.weakness_names(frames(spark, sf))


@register(
    "record_summary",
    over_world("""
select c.cve, c.title, c.cvss, c.cvss_severity, e.epss, e.percentile,
       k.date_added::varchar as kev_date_added, coalesce(g.n, 0) as ghsa_count,
       coalesce(x.n, 0) as exploitdb_count, coalesce(t.n, 0) as nuclei_template_count
from cve c left join latest_scores e using (cve)
left join kev k on c.cve = k.cve and not k.removed
left join (select cve, count(distinct ghsa) n from ghsa group by 1) g on c.cve = g.cve
left join (select cve, count(distinct edb_id) n
           from (select edb_id, unnest(cve) cve from exploitdb) group by 1) x
  on c.cve = x.cve
left join (select cve, count(distinct template_id) n
           from (select template_id, unnest(cve) cve from nuclei where not removed)
           group by 1) t on c.cve = t.cve"""),
)
def record_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(published.summary(frames(spark, sf)), "kev_date_added")


@register(
    "record_versions",
    over_world(f"""
select cve, state, title, cvss, cvss_severity, date_updated from cve_history
where cve = '{_ONE}'"""),
)
def record_versions(spark: SparkSession, sf: str) -> DataFrame:
    rows = published.record_versions(frames(spark, sf), _ONE)
    return rows.select("cve", "state", "title", "cvss", "cvss_severity", "date_updated")


@register(
    "weakness_parents", over_world("select cwe_id, parent_id from cwe")
)
def weakness_parents(spark: SparkSession, sf: str) -> DataFrame:
    return published.weakness_parents(frames(spark, sf))


@register(
    "raw_json_field",
    over_world("select ghsa, raw_order_key::varchar as value from ghsa"),
)
def raw_json_field(spark: SparkSession, sf: str) -> DataFrame:
    return published.raw_field(frames(spark, sf), "ghsa", "$.order.key")


@register(
    "sql_over_views",
    over_world("""
select c.cvss_severity, count(*) as records, sum(case when s.has_kev then 1 else 0 end)
       ::bigint as exploited
from cve c join cve_sources s using (cve) group by 1"""),
)
def sql_over_views(spark: SparkSession, sf: str) -> DataFrame:
    """Plain SQL over the registered views."""
    register_views(spark, base_tables(spark, sf), "lake_{}".format)
    return spark.sql("""
        SELECT c.cvss_severity, count(*) AS records, count_if(s.has_kev) AS exploited
        FROM lake_cve c JOIN lake_cve_sources s USING (cve) GROUP BY c.cvss_severity
    """)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_DATASETS_SQL = ",\n".join(f"({', '.join(map(_quoted, row))})" for row in DATASETS)


@register(
    "provenance_columns",
    over_world(f"""
select d.*, n as stored_rows from (values {_DATASETS_SQL}) d({", ".join(COLUMNS)}) join (
  select 'epss' as name, count(*) as n from epss
  union all select 'cve', count(*) from cve_history
  union all select 'kev', count(*) from kev_history
  union all select 'capec', count(*) from capec_history) using (name)"""),
)
def provenance_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of the provenance view next to the rows that are stored."""
    v = frames(spark, sf)
    sized = None
    for name in ("epss", "cve_history", "kev_history", "capec_history"):
        rows = v[name].select(F.lit(name.removesuffix("_history")).alias("name"))
        sized = rows if sized is None else sized.unionByName(rows)
    counts = sized.groupBy("name").agg(F.count("*").alias("stored_rows"))
    return v["datasets"].join(counts, "name")


@register(
    "provenance_of_rows",
    over_world("""
select name, n as stored_rows from (
  select 'epss' as name, count(*) as n from epss
  union all select 'cve', count(*) from cve_history
  union all select 'ghsa', count(*) from ghsa_history
  union all select 'exploitdb', count(*) from exploitdb_history
  union all select 'nuclei', count(*) from nuclei_history
  union all select 'cwe', count(*) from cwe_history
  union all select 'kev', count(*) from kev_history
  union all select 'cloudflare_waf', count(*) from cloudflare_waf_history
  union all select 'attack', count(*) from attack_history
  union all select 'capec', count(*) from capec_history)"""),
)
def provenance_of_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Stored rows of every dataset in the provenance view."""
    tables = base_tables(spark, sf)
    names = [name for name in tables if name != "attack_relationship_history"]
    sized = None
    for name in names:
        rows = tables[name].select(F.lit(name.removesuffix("_history")).alias("name"))
        sized = rows if sized is None else sized.unionByName(rows)
    counts = sized.groupBy("name").agg(F.count("*").alias("stored_rows"))
    return frames(spark, sf)["datasets"].select("name").join(counts, "name")
