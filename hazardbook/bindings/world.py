"""The eleven base tables derived from the given tables, in Spark and in SQL.

Orders become record versions, line items advisories, techniques, relationships and
attack patterns, events scores, templates and firewall mentions, parts weaknesses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardbook.bindings.registry import table
from hazardbook.lazy import LazyMap
from hazardbook.plans.views import tables_and_views


def _cve(number: str) -> str:
    return f"concat('CVE-2024-', lpad(cast({number} as string), 7, '0'))"


def _micros(number: str) -> str:
    return f"make_dt_interval(0, 0, 0, cast({number} as decimal(18, 6)) / 1000000)"


_ASSESSMENT = """
concat('{"containers":{"adp":[{"title":"CISA ADP Vulnrichment","metrics":[{"other":',
  '{"type":"', if(o_orderpriority = '5-LOW', 'kev', 'ssvc'), '","content":{"version":"2.0.3",',
  '"role":"CISA Coordinator","timestamp":"', date_format(o_orderdate, 'yyyy-MM-dd'),
  'T10:00:00Z","options":[{"Exploitation":"',
  case o_orderstatus when 'F' then 'active' when 'O' then 'none' else 'public poc' end,
  '"},{"Automatable":"', if(o_totalprice > 250000, 'yes', 'no'), '"}',
  if(o_orderpriority = '1-URGENT', ',{"Technical Impact":"Total"}', ''),
  if(o_orderpriority = '3-MEDIUM', ',{"Mission and Well-Being Impact":"Low"}', ''),
  ']', if(o_totalprice > 400000, ',"decision":"Attend"', ''), '}}}]}]}}')
"""


_NOTHING = "cast(null as string)"
_LINE_TIME_SPARK = f"l_shipdate + {_micros('l_orderkey * 10 + l_linenumber')}"
_MATRIX_SPARK = (
    "case l_returnflag when 'A' then 'enterprise' when 'N' then 'mobile' else 'ics' end"
)

def _daily_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "user_id", "event_type", "cast(ts as date) as day", "value", "event_id"
    )


def _scores(events: DataFrame) -> DataFrame:
    return (
        _daily_events(events).groupBy("user_id", "day")
        .agg({"value": "max", "event_id": "count"})
        .selectExpr(
            f"{_cve('user_id')} as cve",
            "`max(value)` as epss",
            "cast(`count(event_id)` as double) as percentile",
            "day as date",
            "'v1' as model_version",
        )
    )


def _records(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        f"{_cve('o_custkey')} as cve",
        "if(o_orderstatus = 'F', 'REJECTED', 'PUBLISHED') as state",
        "o_orderpriority as assigner",
        "concat('order ', o_orderkey) as title",
        "cast(null as string) as description",
        "o_totalprice as cvss",
        "'3.1' as cvss_version",
        "o_orderstatus as cvss_severity",
        "cast(null as string) as cvss_vector",
        "array(concat('CWE-', o_custkey), concat('CWE-', o_orderkey div 10),"
        " concat('CWE-', o_custkey)) as cwe",
        "o_orderdate as date_published",
        "o_orderdate as date_reserved",
        f"o_orderdate + {_micros('o_orderkey')} as date_updated",
        f"{_ASSESSMENT} as raw",
    )


def _advisories(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        "concat('GHSA-', l_partkey) as ghsa",
        f"if(l_returnflag = 'N', null, {_cve('l_orderkey div 10')}) as cve",
        "concat('line ', l_orderkey, '/', l_linenumber) as summary",
        "l_returnflag as severity",
        "l_extendedprice as cvss",
        "'3.1' as cvss_version",
        "cast(null as string) as cvss_vector",
        "array(concat('CWE-', l_partkey)) as cwe",
        "array(struct(l_returnflag as ecosystem, concat('pkg', l_suppkey) as package,"
        " cast(cast(l_quantity as int) as string) as introduced,"
        " if(l_linestatus = 'F', '99', null) as fixed,"
        " cast(null as string) as last_affected),"
        " struct('all' as ecosystem, concat('pkg', l_suppkey) as package,"
        " cast(null as string) as introduced, cast(null as string) as fixed,"
        " cast(null as string) as last_affected)) as affected",
        "l_shipdate as published",
        f"{_LINE_TIME_SPARK} as modified",
        "cast(null as timestamp_ntz) as withdrawn",
        "concat('{\"order\":{\"key\":', l_orderkey, '}}') as raw",
    )


def _order_days(orders: DataFrame) -> DataFrame:
    daily_orders = orders.groupBy("o_custkey", "o_orderdate").agg(
        {"o_orderkey": "max", "o_orderstatus": "max"}
    )
    return daily_orders.selectExpr(
        "o_custkey",
        "cast(o_orderdate as date) as day",
        "`max(o_orderkey)` as okey",
        "`max(o_orderstatus)` as status",
    )


def _exploits(orders: DataFrame) -> DataFrame:
    return _order_days(orders).selectExpr(
        "cast(o_custkey as int) as edb_id",
        f"if(status = 'P', cast(array() as array<string>), array({_cve('o_custkey')},"
        f" {_cve('okey div 10')}, {_cve('o_custkey')})) as cve",
        "concat('exploit ', okey) as description",
        "status as type",
        *[f"{_NOTHING} as {c}" for c in ("platform", "author")],
        "cast(null as int) as port",
        "status = 'F' as verified",
        *[f"{_NOTHING} as {c}" for c in ("tags", "aliases", "codes", "file")],
        "concat('https://www.exploit-db.com/exploits/', o_custkey) as code_url",
        *[
            f"{_NOTHING} as {c}"
            for c in ("source_url", "application_url", "screenshot_url")
        ],
        "day as date_published",
        "day as date_added",
        "day as date_updated",
    )


def _exploited(orders: DataFrame) -> DataFrame:
    return _order_days(orders).selectExpr(
        f"{_cve('o_custkey')} as cve",
        "status as vendor_project",
        "concat('product ', okey) as product",
        "concat('vulnerability ', okey) as vulnerability_name",
        *[
            f"{_NOTHING} as {c}"
            for c in ("short_description", "required_action")
        ],
        "if(status = 'O', 'Known', 'Unknown') as known_ransomware_campaign_use",
        f"{_NOTHING} as notes",
        "array(concat('CWE-', o_custkey)) as cwe",
        "day as date_added",
        "date_add(day, 21) as due_date",
        "day as fetched_date",
        "status = 'F' as removed",
    )


def _event_days(events: DataFrame) -> DataFrame:
    return (
        _daily_events(events).groupBy("user_id", "event_type", "day")
        .agg({"value": "max", "event_id": "max"})
        .selectExpr(
            "user_id", "event_type", "day", "`max(value)` as top", "`max(event_id)` as eid"
        )
    )


def _templates(events: DataFrame) -> DataFrame:
    return _event_days(events).selectExpr(
        "concat(event_type, '-', user_id) as template_id",
        "concat('template ', eid) as name",
        "event_type as severity",
        f"{_NOTHING} as description",
        "cast(array() as array<string>) as author",
        "array(event_type) as tags",
        "cast(array() as array<string>) as reference",
        f"array({_cve('user_id')}, {_cve('user_id + 1')}) as cve",
        "array(concat('CWE-', user_id)) as cwe",
        "top as cvss_score",
        f"{_NOTHING} as cvss_metrics",
        "cast(null as double) as epss_score",
        "cast(null as double) as epss_percentile",
        *[f"{_NOTHING} as {c}" for c in ("cpe", "vendor", "product")],
        "top > 50 as verified",
        "'http' as type",
        "concat(event_type, '/', user_id, '.yaml') as file",
        "concat('https://example.org/', event_type) as template_url",
        "sha2(cast(eid as string), 256) as digest",
        "day as fetched_date",
        "event_type = 'error' and top > 100 as removed",
    )


def _mentions(events: DataFrame) -> DataFrame:
    return _event_days(events).selectExpr(
        f"if(event_type = 'signup', concat('GHSA-', user_id), {_cve('user_id')})"
        " as identifier",
        "if(event_type = 'signup', 'GHSA', 'CVE') as identifier_type",
        f"if(event_type = 'signup', null, {_cve('user_id')}) as cve",
        "concat('entry ', eid) as source_title",
        "concat('https://example.org/', event_type) as source_url",
        "day as source_date",
        "event_type as matched_text",
        "day as fetched_date",
        "event_type = 'click' and top > 100 as removed",
    )


def _weaknesses(parts: DataFrame) -> DataFrame:
    return parts.selectExpr(
        "concat('CWE-', p_partkey) as cwe_id",
        "'weakness' as entry_type",
        "p_name as name",
        "p_brand as abstraction",
        "p_type as status",
        f"{_NOTHING} as description",
        f"{_NOTHING} as likelihood_of_exploit",
        "array(struct('ChildOf' as nature, concat('CWE-', p_size) as target_id),"
        " struct('PeerOf' as nature, concat('CWE-', p_partkey + 1) as target_id))"
        " as relations",
        "concat('4.', length(p_type)) as cwe_version",
        "date_add(date'2024-01-01', length(p_type)) as release_date",
    )


def _techniques(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        f"{_MATRIX_SPARK} as matrix",
        "concat('T', l_partkey) as attack_id",
        "concat('attack-pattern--', l_partkey) as object_id",
        "l_linestatus as object_type",
        "concat('technique ', l_orderkey, '/', l_linenumber) as name",
        f"{_NOTHING} as description",
        f"{_NOTHING} as url",
        "array(struct('kill-chain' as kill_chain_name, l_linestatus as phase_name))"
        " as kill_chain_phases",
        "false as revoked",
        "false as deprecated",
        f"{_LINE_TIME_SPARK} as modified",
        "concat('{\"line\":', l_linenumber, '}') as raw",
    )


def _relationships(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        f"{_MATRIX_SPARK} as matrix",
        "concat('relationship--', l_suppkey, '-', l_partkey) as relationship_id",
        "if(l_linestatus = 'F', 'uses', 'mitigates') as relationship_type",
        "concat('group--', l_suppkey) as source_ref",
        "concat('G', l_suppkey) as source_attack_id",
        "concat('group ', l_suppkey) as source_name",
        "'intrusion-set' as source_type",
        "concat('attack-pattern--', l_partkey) as target_ref",
        "concat('T', l_partkey) as target_attack_id",
        "concat('technique ', l_partkey) as target_name",
        "'attack-pattern' as target_type",
        "concat('line ', l_orderkey, '/', l_linenumber) as description",
        "false as revoked",
        "false as deprecated",
        f"{_LINE_TIME_SPARK} as modified",
        "'{}' as raw",
    )


def _patterns(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        "concat('CAPEC-', l_suppkey, '-', cast(l_quantity as bigint) div 10) as capec_id",
        "concat('attack-pattern--', l_suppkey) as object_id",
        "concat('pattern ', l_orderkey, '/', l_linenumber) as name",
        f"{_NOTHING} as description",
        f"{_NOTHING} as url",
        "array(concat('CWE-', l_partkey), concat('CWE-', l_suppkey)) as cwe",
        "if(l_linestatus = 'O', cast(array() as array<string>),"
        " array(concat('T', l_partkey), concat('T', l_orderkey))) as attack",
        "l_quantity > 48 as revoked",
        "l_discount > 0.09 as deprecated",
        f"{_LINE_TIME_SPARK} as modified",
        "'{}' as raw",
    )


_BUILDERS = {
    "epss": (_scores, "events"),
    "cve_history": (_records, "orders"),
    "ghsa_history": (_advisories, "lineitem"),
    "exploitdb_history": (_exploits, "orders"),
    "nuclei_history": (_templates, "events"),
    "kev_history": (_exploited, "orders"),
    "cloudflare_waf_history": (_mentions, "events"),
    "cwe_history": (_weaknesses, "part"),
    "attack_history": (_techniques, "lineitem"),
    "attack_relationship_history": (_relationships, "lineitem"),
    "capec_history": (_patterns, "lineitem"),
}


def base_tables(spark: SparkSession, sf_dir: str) -> LazyMap[DataFrame]:
    def builder(name: str):
        derive, given = _BUILDERS[name]
        return lambda: derive(table(spark, sf_dir, given))

    return LazyMap({name: builder(name) for name in _BUILDERS})


def frames(spark: SparkSession, sf_dir: str) -> LazyMap[DataFrame]:
    """Base tables and views by name."""
    return tables_and_views(spark, base_tables(spark, sf_dir))


# ---------------------------------------------------------------- the same in SQL


def _sql_cve(number: str) -> str:
    return f"'CVE-2024-' || lpad(({number})::varchar, 7, '0')"


_LINE_TIME = "l_shipdate + to_microseconds(l_orderkey * 10 + l_linenumber)"
_MATRIX = (
    "case l_returnflag when 'A' then 'enterprise' when 'N' then 'mobile' else 'ics' end"
)

SQL_TABLES = {
    "epss": f"""
select {_sql_cve("user_id")} as cve, max(value) as epss,
       count(event_id)::double as percentile, ts::date as date, 'v1' as model_version
from events group by user_id, ts::date""",
    "cve_history": f"""
select {_sql_cve("o_custkey")} as cve,
       case when o_orderstatus = 'F' then 'REJECTED' else 'PUBLISHED' end as state,
       o_orderpriority as assigner, 'order ' || o_orderkey as title,
       o_totalprice as cvss, '3.1' as cvss_version, o_orderstatus as cvss_severity,
       ['CWE-' || o_custkey, 'CWE-' || (o_orderkey // 10), 'CWE-' || o_custkey] as cwe,
       o_orderdate as date_published,
       o_orderdate + to_microseconds(o_orderkey) as date_updated,
       case when o_orderpriority = '5-LOW' then 'kev' else 'ssvc' end as metric_type,
       o_orderdate::date + interval 10 hour as assessed_at,
       case o_orderstatus when 'F' then 'active' when 'O' then 'none'
            else 'public poc' end as exploitation,
       case when o_totalprice > 250000 then 'yes' else 'no' end as automatable,
       case when o_orderpriority = '1-URGENT' then 'total' end as technical_impact,
       case when o_orderpriority = '3-MEDIUM' then 'low' end as mission_impact,
       case when o_totalprice > 400000 then 'attend' end as recorded_decision
from orders""",
    "ghsa_history": f"""
select 'GHSA-' || l_partkey as ghsa,
       case when l_returnflag = 'N' then null
            else {_sql_cve("l_orderkey // 10")} end as cve,
       'line ' || l_orderkey || '/' || l_linenumber as summary,
       l_returnflag as severity, l_extendedprice as cvss,
       [{{'ecosystem': l_returnflag, 'package': 'pkg' || l_suppkey,
          'introduced': (l_quantity::int)::varchar,
          'fixed': case when l_linestatus = 'F' then '99' end,
          'last_affected': null::varchar}},
        {{'ecosystem': 'all', 'package': 'pkg' || l_suppkey,
          'introduced': null::varchar, 'fixed': null::varchar,
          'last_affected': null::varchar}}] as affected,
       {_LINE_TIME} as modified, l_orderkey as raw_order_key
from lineitem""",
    "order_days": """
select o_custkey, o_orderdate::date as day, max(o_orderkey) as okey,
       max(o_orderstatus) as status
from orders group by 1, 2""",
    "exploitdb_history": f"""
select o_custkey::int as edb_id,
       case when status = 'P' then []::varchar[]
            else [{_sql_cve("o_custkey")}, {_sql_cve("okey // 10")},
                  {_sql_cve("o_custkey")}] end as cve,
       'exploit ' || okey as description, status as type, status = 'F' as verified,
       'https://www.exploit-db.com/exploits/' || o_custkey as code_url,
       day as date_updated
from order_days""",
    "kev_history": f"""
select {_sql_cve("o_custkey")} as cve, status as vendor_project,
       'vulnerability ' || okey as vulnerability_name,
       case when status = 'O' then 'Known' else 'Unknown' end
           as known_ransomware_campaign_use,
       day as date_added, day + 21 as due_date, day as fetched_date,
       status = 'F' as removed
from order_days""",
    "event_days": """
select user_id, event_type, ts::date as day, max(value) as top, max(event_id) as eid
from events group by 1, 2, 3""",
    "nuclei_history": f"""
select event_type || '-' || user_id as template_id, 'template ' || eid as name,
       event_type as severity, [{_sql_cve("user_id")}, {_sql_cve("user_id + 1")}] as cve,
       'http' as type, 'https://example.org/' || event_type as template_url,
       sha256(eid::varchar) as digest, day as fetched_date,
       event_type = 'error' and top > 100 as removed
from event_days""",
    "cloudflare_waf_history": f"""
select case when event_type = 'signup' then 'GHSA-' || user_id
            else {_sql_cve("user_id")} end as identifier,
       case when event_type = 'signup' then null
            else {_sql_cve("user_id")} end as cve,
       'entry ' || eid as source_title,
       'https://example.org/' || event_type as source_url, day as source_date,
       day as fetched_date, event_type = 'click' and top > 100 as removed
from event_days""",
    "cwe_history": """
select 'CWE-' || p_partkey as cwe_id, 'weakness' as entry_type, p_name as name,
       p_type as status, 'CWE-' || p_size as parent_id,
       '4.' || length(p_type) as cwe_version,
       date '2024-01-01' + length(p_type)::int as release_date
from part""",
    "attack_history": f"""
select {_MATRIX} as matrix, 'T' || l_partkey as attack_id, l_linestatus as object_type,
       'technique ' || l_orderkey || '/' || l_linenumber as name,
       l_linestatus as phase_name, {_LINE_TIME} as modified
from lineitem""",
    "attack_relationship_history": f"""
select {_MATRIX} as matrix,
       'relationship--' || l_suppkey || '-' || l_partkey as relationship_id,
       case when l_linestatus = 'F' then 'uses' else 'mitigates' end as relationship_type,
       'group ' || l_suppkey as source_name, 'T' || l_partkey as target_attack_id,
       'technique ' || l_partkey as target_name,
       'line ' || l_orderkey || '/' || l_linenumber as description,
       {_LINE_TIME} as modified
from lineitem""",
    "capec_history": f"""
select 'CAPEC-' || l_suppkey || '-' || (l_quantity::bigint // 10) as capec_id,
       'pattern ' || l_orderkey || '/' || l_linenumber as name,
       ['CWE-' || l_partkey, 'CWE-' || l_suppkey] as cwe,
       case when l_linestatus = 'O' then []::varchar[]
            else ['T' || l_partkey, 'T' || l_orderkey] end as attack,
       l_quantity > 48 as revoked, l_discount > 0.09 as deprecated,
       {_LINE_TIME} as modified
from lineitem""",
}


def _latest(history: str, keys: str, order: str) -> str:
    return f"""
select * exclude (rn) from (
  select *, row_number() over (partition by {keys} order by {order} desc) as rn
  from {history}) where rn = 1"""


SQL_VIEWS = {
    "cve": _latest("cve_history", "cve", "date_updated"),
    "ghsa": _latest("ghsa_history", "ghsa", "modified"),
    "exploitdb": _latest("exploitdb_history", "edb_id", "date_updated"),
    "nuclei": _latest("nuclei_history", "template_id", "fetched_date"),
    "kev": _latest("kev_history", "cve", "fetched_date"),
    "cloudflare_waf": _latest(
        "cloudflare_waf_history", "identifier, source_url", "fetched_date"
    ),
    "attack": _latest("attack_history", "matrix, attack_id", "modified"),
    "attack_relationship": _latest(
        "attack_relationship_history", "matrix, relationship_id", "modified"
    ),
    "capec": _latest("capec_history", "capec_id", "modified"),
    "cwe": """
select * from cwe_history
where release_date = (select max(release_date) from cwe_history)""",
    "latest_scores": """
select cve, arg_max(epss, date) as epss, arg_max(percentile, date) as percentile
from epss group by cve""",
    "cve_sources": """
select k.cve, e.cve is not null as has_epss, c.cve is not null as has_cve,
       g.cve is not null as has_ghsa, x.cve is not null as has_exploitdb,
       n.cve is not null as has_nuclei, v.cve is not null as has_kev,
       w.cve is not null as has_cloudflare_waf,
       coalesce(e.n, 0) as epss_days, coalesce(g.n, 0) as ghsa_count,
       coalesce(x.n, 0) as exploitdb_count, coalesce(n.n, 0) as nuclei_count,
       coalesce(w.n, 0) as cloudflare_waf_count
from (select cve from epss union select cve from cve
      union select cve from ghsa where cve is not null
      union select unnest(cve) from exploitdb
      union select unnest(cve) from nuclei where not removed
      union select cve from kev where not removed
      union select cve from cloudflare_waf where cve is not null and not removed) k
left join (select cve, count(*) n from epss group by 1) e on k.cve = e.cve
left join cve c on k.cve = c.cve
left join (select cve, count(*) n from ghsa group by 1) g on k.cve = g.cve
left join (select cve, count(*) n from (select unnest(cve) cve from exploitdb)
           group by 1) x on k.cve = x.cve
left join (select cve, count(*) n from (select unnest(cve) cve from nuclei
           where not removed) group by 1) n on k.cve = n.cve
left join (select cve from kev where not removed) v on k.cve = v.cve
left join (select cve, count(*) n from cloudflare_waf where not removed
           group by 1) w on k.cve = w.cve""",
    "ssvc_decision": """
select * from (values
  ('none', 'no', 'partial', 'low', 'track'),
  ('none', 'no', 'partial', 'medium', 'track'),
  ('none', 'no', 'partial', 'high', 'track'),
  ('none', 'no', 'total', 'low', 'track'),
  ('none', 'no', 'total', 'medium', 'track'),
  ('none', 'no', 'total', 'high', 'track*'),
  ('none', 'yes', 'partial', 'low', 'track'),
  ('none', 'yes', 'partial', 'medium', 'track'),
  ('none', 'yes', 'partial', 'high', 'attend'),
  ('none', 'yes', 'total', 'low', 'track'),
  ('none', 'yes', 'total', 'medium', 'track'),
  ('none', 'yes', 'total', 'high', 'attend'),
  ('public poc', 'no', 'partial', 'low', 'track'),
  ('public poc', 'no', 'partial', 'medium', 'track'),
  ('public poc', 'no', 'partial', 'high', 'track*'),
  ('public poc', 'no', 'total', 'low', 'track'),
  ('public poc', 'no', 'total', 'medium', 'track*'),
  ('public poc', 'no', 'total', 'high', 'attend'),
  ('public poc', 'yes', 'partial', 'low', 'track'),
  ('public poc', 'yes', 'partial', 'medium', 'track'),
  ('public poc', 'yes', 'partial', 'high', 'attend'),
  ('public poc', 'yes', 'total', 'low', 'track'),
  ('public poc', 'yes', 'total', 'medium', 'track*'),
  ('public poc', 'yes', 'total', 'high', 'attend'),
  ('active', 'no', 'partial', 'low', 'track'),
  ('active', 'no', 'partial', 'medium', 'track'),
  ('active', 'no', 'partial', 'high', 'attend'),
  ('active', 'no', 'total', 'low', 'track'),
  ('active', 'no', 'total', 'medium', 'attend'),
  ('active', 'no', 'total', 'high', 'act'),
  ('active', 'yes', 'partial', 'low', 'attend'),
  ('active', 'yes', 'partial', 'medium', 'attend'),
  ('active', 'yes', 'partial', 'high', 'act'),
  ('active', 'yes', 'total', 'low', 'attend'),
  ('active', 'yes', 'total', 'medium', 'act'),
  ('active', 'yes', 'total', 'high', 'act')
) t(exploitation, automatable, technical_impact, mission_impact, decision)""",
    "cve_ssvc_candidates": """
select s.cve, d.exploitation, d.automatable, d.technical_impact, d.mission_impact,
       s.mission_impact as recorded_mission_impact, s.recorded_decision,
       d.decision as computed_decision,
       s.recorded_decision = d.decision as decision_matches,
       list_position(['track', 'track*', 'attend', 'act'], d.decision)
           as decision_rank
from cve s join ssvc_decision d
  on s.exploitation = d.exploitation and s.automatable = d.automatable
 and (s.technical_impact is null or s.technical_impact = d.technical_impact)
 and (s.mission_impact is null or s.mission_impact = d.mission_impact)
where s.metric_type = 'ssvc'""",
    "cwe_attack_patterns": """
select p.cwe, p.capec_id, p.name as capec_name, a.attack_id, a.name as attack_name,
       a.object_type as attack_object_type, a.phase_name
from (select capec_id, name, unnest(cwe) as cwe,
             case when len(attack) = 0 then [null] else attack end as techniques
      from capec where not revoked and not deprecated) p
cross join unnest(p.techniques) u(technique)
left join attack a on a.matrix = 'enterprise' and a.attack_id = u.technique""",
}


def over_world(select: str) -> str:
    """``select`` with the derived tables and views it can name in front of it."""
    ctes = ",\n".join(
        f"{name} as ({body})" for name, body in {**SQL_TABLES, **SQL_VIEWS}.items()
    )
    return f"with {ctes}\n{select}"
