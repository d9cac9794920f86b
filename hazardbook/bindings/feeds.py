"""Feed parsers run over feed text that is written from the given tables.

Each query turns every row of a table into the text of a feed (JSON, YAML, XML, CSV
lines, MDX) and parses it back; the SQL states the expected columns directly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.bindings.registry import register, spread, table
from hazardbook.functions.times import year_in_file_name
from hazardbook.operators.latest import first_per_key
from hazardbook.operators.quality import quality_counts, screen
from hazardbook.session import shared_folder
from hazardbook.sources import (
    advisories,
    bundles,
    changelog,
    exploited,
    exploits,
    records,
    scores,
    templates,
    weaknesses,
)


def _parsed(rows: DataFrame) -> DataFrame:
    return screen(rows, F.col("valid")).drop("valid")


def _text(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        value = F.array_join(c, ",") if kind == "array" else F.col(c).cast("string")
        df = df.withColumn(c, value)
    return df


def score_lines(events: DataFrame) -> DataFrame:
    """Score files of three generations, one per day, as ``folder``, ``file``, ``position``
    and ``value``; error events are a beta feed. Every file has a blank line, and the
    value of some scores is no number."""
    rows = events.selectExpr(
        "cast(ts as date) as day",
        "if(event_type = 'error', 'beta_scores', '2024') as folder",
        "concat('epss_scores-', cast(ts as date), '.csv.gz') as file",
        "user_id",
        "if(event_id % 50 = 7, 'oops', cast(value as string)) as score",
        "event_id",
    )
    old = "day < date'2024-01-11'"
    files = rows.select("day", "folder", "file").distinct()
    comments = files.where(f"not ({old})").selectExpr(
        "folder", "file", "-3L as position",
        "if(day < date'2024-01-21', concat('#model_version:v2,score_date:', day,"
        " 'T00:00:00+0000'), concat('#model_version:v3,score_date:', date_add(day, 1),"
        " 'T12:00:34Z')) as value",
    )
    titles = files.selectExpr(
        "folder", "file", "-2L as position", f"if({old}, 'cve,epss', 'cve,epss,percentile') as value"
    )
    blanks = files.selectExpr("folder", "file", "-1L as position", "'' as value")
    lines = rows.selectExpr(
        "folder", "file", "event_id as position",
        "concat('CVE-2024-', lpad(user_id, 6, '0'), ',', score,"
        f" if({old}, '', concat(',', cast(event_id as double)))) as value",
    )
    return lines.unionByName(comments).unionByName(titles).unionByName(blanks)


def land_scores(spark: SparkSession, lines: DataFrame) -> str:
    """The lines as compressed files of a landing folder, one for each ``file``."""
    folder = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    (
        lines.repartition("folder", "file")
        .sortWithinPartitions("folder", "file", "position")
        .select("folder", "file", "value")
        .write.partitionBy("folder", "file").option("compression", "gzip").text(folder)
    )
    return folder


def landed_scores(spark: SparkSession, sf: str) -> str:
    return land_scores(spark, score_lines(table(spark, sf, "events")))


@register(
    "feed_score_files",
    """
select 'CVE-2024-' || lpad(user_id::varchar, 6, '0') as cve, value as epss,
       case when ts::date >= date '2024-01-11' then event_id::double end as percentile,
       (case when ts::date < date '2024-01-21' then ts::date else ts::date + 1 end)
           ::varchar as date,
       case when ts::date < date '2024-01-11' then 'v1'
            when ts::date < date '2024-01-21' then 'v2' else 'v3' end as model_version
from events where event_type <> 'error' and event_id % 50 <> 7""",
)
def feed_score_files(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files read by the source; blank lines and bad values are left out."""
    rows = scores.read_scores(spark, landed_scores(spark, sf))
    return _text(_parsed(rows).drop("path"), "date")


@register(
    "feed_score_quality",
    """
select ts::date::varchar as file_date, count(*) filter (event_id % 50 <> 7) as records,
       count(*) filter (event_id % 50 = 7) as bad
from events where event_type <> 'error' group by 1""",
)
def feed_score_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of every landed file that are scores, and lines that are not; titles,
    comments and blank lines are neither."""
    rows = scores.read_scores(spark, landed_scores(spark, sf))
    dated = rows.withColumn("file_date", scores.file_date(F.col("path")))
    return _text(quality_counts(dated, F.col("valid"), "file_date"), "file_date")


@register(
    "feed_score_file_names",
    """
select ts::date::varchar as file_date, 2024 as file_year, count(*) as lines
from events where event_type <> 'error' group by 1""",
)
def feed_score_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Mirror discovery: dated files outside of beta folders, by date and year."""
    path = F.col("path")
    lines = score_lines(spread(table(spark, sf, "events"))).withColumn(
        "path", F.concat_ws("/", F.lit("mirror"), "folder", "file")
    )
    lines = lines.where(scores.is_score_file(path) & F.col("value").startswith("CVE-"))
    return _text(
        lines.groupBy(
            scores.file_date(path).alias("file_date"),
            year_in_file_name(path, "epss_scores-", "[.]csv[.]gz").alias("file_year"),
        ).agg(F.count("*").alias("lines")),
        "file_date",
    )


def record_documents(orders: DataFrame, file_year: str = "year(o_orderdate)") -> DataFrame:
    """One record per order; records of cheap orders are cut off in the middle."""
    document = """to_json(named_struct(
      'cveMetadata', named_struct(
        'cveId', concat('CVE-', year(o_orderdate), '-', lpad(o_orderkey, 7, '0')),
        'state', if(o_orderstatus = 'F', 'REJECTED', 'PUBLISHED'),
        'assignerShortName', o_orderpriority,
        'datePublished', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss"),
        'dateReserved', if(o_orderpriority = '5-LOW', 'soon',
                           date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        'dateUpdated', case o_orderstatus
            when 'O' then date_format(o_orderdate, "yyyy-MM-dd'T'10:30:00.250'Z'")
            when 'P' then date_format(o_orderdate, "yyyy-MM-dd'T'01:00:00'+09:00'") end),
      'containers', named_struct(
        'cna', named_struct(
          'title', if(o_orderstatus = 'P', null, concat('order ', o_orderkey)),
          'descriptions', array(
            named_struct('lang', 'fr', 'value', concat('commande ', o_orderkey)),
            named_struct('lang', if(o_orderpriority = '2-HIGH', 'de', 'en-US'),
                         'value', concat('sold to ', o_custkey))),
          'rejectedReasons', array(named_struct('lang', 'en', 'value', 'withdrawn')),
          'metrics', if(o_totalprice > 300000, array(
              named_struct('cvssV2_0', named_struct('version', '2.0',
                           'baseScore', o_totalprice, 'vectorString', 'AV:N'))), array()),
          'problemTypes', array(named_struct('descriptions', array(
              named_struct('cweId', concat('CWE-', substr(o_orderpriority, 1, 1))),
              named_struct('cweId', cast(null as string)))))),
        'adp', array(named_struct(
          'title', 'enrichment',
          'metrics', array(
            named_struct('cvssV3_1', named_struct('version', cast(null as string),
                         'baseScore', o_custkey, 'baseSeverity', 'LOW'),
                         'cvssV4_0', cast(null as struct<version:string,baseScore:double>)),
            named_struct('cvssV3_1', cast(null as struct<version:string,baseScore:bigint,baseSeverity:string>),
                         'cvssV4_0', if(o_orderpriority = '1-URGENT',
                            named_struct('version', '4.0', 'baseScore', o_totalprice),
                            null))),
          'problemTypes', array(named_struct('descriptions', array(
              named_struct('cweId', concat('CWE-', length(o_orderpriority))),
              named_struct('cweId', concat('CWE-', substr(o_orderpriority, 1, 1)))))))))))"""
    return orders.selectExpr(
        "o_totalprice",
        "o_orderdate",
        f"concat('cves/CVE-', {file_year}, '-', lpad(o_orderkey, 7, '0'), '.json') as path",
        f"if(o_totalprice < 10000, substr({document}, 1, 60), {document}) as value",
    )


@register(
    "feed_records",
    """
select 'CVE-' || year(o_orderdate) || '-' || lpad(o_orderkey::varchar, 7, '0') as cve,
       case when o_orderstatus = 'F' then 'REJECTED' else 'PUBLISHED' end as state,
       o_orderpriority as assigner,
       case when o_orderstatus <> 'P' then 'order ' || o_orderkey end as title,
       case when o_orderstatus = 'F' then 'withdrawn'
            when o_orderpriority = '2-HIGH' then 'commande ' || o_orderkey
            else 'sold to ' || o_custkey end as description,
       case when o_totalprice > 300000 or o_orderpriority = '1-URGENT' then o_totalprice
            else o_custkey::double end as cvss,
       case when o_totalprice > 300000 then '2.0'
            when o_orderpriority = '1-URGENT' then '4.0' else '3.1' end as cvss_version,
       case when o_totalprice <= 300000 and o_orderpriority <> '1-URGENT'
            then 'LOW' end as cvss_severity,
       case when o_totalprice > 300000 then 'AV:N' end as cvss_vector,
       case when o_orderpriority = '5-LOW' then 'CWE-5'
            else 'CWE-' || o_orderpriority[1] || ',CWE-' || length(o_orderpriority)
            end as cwe,
       o_orderdate as date_published,
       case when o_orderpriority <> '5-LOW' then o_orderdate end as date_reserved,
       case o_orderstatus when 'O' then o_orderdate + interval 37800250 milliseconds
            when 'P' then o_orderdate - interval 8 hours
            else o_orderdate end as date_updated
from orders where o_totalprice >= 10000""",
)
def feed_records(spark: SparkSession, sf: str) -> DataFrame:
    documents = record_documents(spread(table(spark, sf, "orders")))
    return _text(_parsed(records.record_rows(documents)).drop("raw", "file_year"), "cwe")


@register(
    "feed_record_quality",
    """
select count(*) filter (o_totalprice >= 10000) as records,
       count(*) filter (o_totalprice < 10000) as bad from orders""",
)
def feed_record_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed records are counted, not fatal."""
    rows = records.record_rows(record_documents(spread(table(spark, sf, "orders"))))
    return rows.agg(
        F.count_if("valid").alias("records"), F.count_if(~F.col("valid")).alias("bad")
    )


def advisory_documents(lines: DataFrame) -> DataFrame:
    events = """
      if(l_returnflag = 'A', array(
          named_struct('introduced', '0', 'fixed', null, 'last_affected', null),
          named_struct('introduced', null, 'fixed', string(l_partkey), 'last_affected', null),
          named_struct('introduced', string(l_suppkey), 'fixed', null, 'last_affected', null),
          named_struct('introduced', null, 'fixed', null,
                       'last_affected', string(l_linenumber))),
        array(named_struct('introduced', null, 'fixed', '9', 'last_affected', null)))"""
    return lines.selectExpr(
        f"""to_json(named_struct(
          'id', concat(if(l_linenumber = 7, 'OSV-', 'GHSA-'), l_orderkey, '-', l_linenumber),
          'summary', concat('part ', l_partkey),
          'published', date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
          'modified', if(l_linestatus = 'F', null,
                         date_format(l_shipdate, "yyyy-MM-dd'T'05:00:00'Z'")),
          'aliases', if(l_returnflag = 'R', array('PYSEC-2024-1'),
                        array('X-1', concat('CVE-2024-', l_partkey), 'CVE-0-0')),
          'severity', array(
             named_struct('type', 'CVSS_V3', 'score', if(l_linestatus = 'F',
               concat('CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:', l_returnflag),
               'CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H'))),
          'affected', array(named_struct(
             'package', named_struct('ecosystem', l_returnflag, 'name', string(l_suppkey)),
             'ranges', array(named_struct('type', 'ECOSYSTEM', 'events', {events})))),
          'database_specific', named_struct('severity', l_linestatus,
             'cwe_ids', if(l_tax > 0.04, array(concat('CWE-', l_suppkey)), null)))) as value"""
    )


@register(
    "feed_advisories",
    """
select 'GHSA-' || l_orderkey || '-' || l_linenumber as ghsa,
       case when l_returnflag <> 'R' then 'CVE-2024-' || l_partkey end as cve,
       'part ' || l_partkey as summary, l_linestatus as severity,
       case when l_linestatus <> 'F' then 10.0
            when l_returnflag = 'N' then 9.1 end as cvss,
       case when l_linestatus <> 'F' or l_returnflag = 'N' then '3.1' end as cvss_version,
       case when l_linestatus = 'F'
            then 'CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:' || l_returnflag
            else 'CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H' end as cvss_vector,
       case when l_tax > 0.04 then 'CWE-' || l_suppkey else '' end as cwe,
       case when l_returnflag = 'A'
            then 'A/' || l_suppkey || '/0/' || l_partkey || '/-;A/' || l_suppkey || '/'
                 || l_suppkey || '/-/' || l_linenumber
            else l_returnflag || '/' || l_suppkey || '/-/-/-' end as affected,
       l_shipdate as published,
       case when l_linestatus = 'F' then l_shipdate
            else l_shipdate + interval 5 hours end as modified
from lineitem where l_linenumber <> 7""",
)
def feed_advisories(spark: SparkSession, sf: str) -> DataFrame:
    rows = _parsed(
        advisories.advisory_rows(advisory_documents(spread(table(spark, sf, "lineitem"))))
    )
    dash = F.lit("-")
    ranges = F.transform(
        "affected",
        lambda a: F.concat_ws(
            "/",
            a["ecosystem"],
            a["package"],
            *[F.coalesce(a[f], dash) for f in ("introduced", "fixed", "last_affected")],
        ),
    )
    return _text(rows.withColumn("affected", F.array_join(ranges, ";")), "cwe").drop(
        "raw", "withdrawn"
    )


@register(
    "feed_exploit_index",
    """
select o_orderkey::int as edb_id,
       case o_orderstatus when 'F' then 'CVE-1999-' || o_custkey || ',CVE-2001-1,CVE-1999-'
            || o_custkey else '' end as cve,
       'exploit by ' || o_custkey as description,
       case when o_orderpriority <> '5-LOW' then o_orderpriority end as type,
       case when o_orderstatus = 'O' then o_custkey::int end as port,
       o_orderstatus = 'F' as verified,
       case o_orderstatus when 'F' then 'CVE-1999-' || o_custkey
            || ';OSVDB-7;CVE-2001-1;CVE-1999-' || o_custkey end as codes,
       'https://www.exploit-db.com/exploits/' || o_orderkey as code_url,
       case when o_orderstatus <> 'P' then o_orderdate::date::varchar end
           as date_published,
       o_orderdate::date::varchar as date_updated
from orders where o_totalprice >= 20000""",
)
def feed_exploit_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = _parsed(exploits.exploit_rows(exploit_index(spread(table(spark, sf, "orders"))))).select(
        "edb_id", "cve", "description", "type", "port", "verified", "codes", "code_url",
        "date_published", "date_updated",
    )
    return _text(rows, "cve", "date_published", "date_updated")


def exploit_index(orders: DataFrame) -> DataFrame:
    written = {
        "id": "if(o_totalprice < 20000, concat('x', o_orderkey), concat(' ', o_orderkey))",
        "description": "concat('exploit by ', o_custkey)",
        "type": "if(o_orderpriority = '5-LOW', '', o_orderpriority)",
        "port": "if(o_orderstatus = 'O', concat(' ', o_custkey, ' '), 'none')",
        "verified": "if(o_orderstatus = 'F', '1', '0')",
        "codes": "if(o_orderstatus = 'F', concat(' CVE-1999-', o_custkey,"
        " ';OSVDB-7;CVE-2001-1;CVE-1999-', o_custkey), '  ')",
        "date_published": "if(o_orderstatus = 'P', string(year(o_orderdate)),"
        " date_format(o_orderdate, 'yyyy-MM-dd'))",
        "date_updated": "date_format(o_orderdate, ' yyyy-MM-dd ')",
    }
    return orders.selectExpr(
        *[f"{written.get(c, 'cast(null as string)')} as {c}" for c in exploits.COLUMNS]
    )


@register(
    "exploit_year_assignment",
    """
select coalesce(year(case when o_orderstatus <> 'P' then o_orderdate end),
                (select min(year(o_orderdate)) from orders where o_orderstatus <> 'P'),
                1970) as year, count(*) as rows
from orders group by 1""",
)
def exploit_year_assignment(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr(
        "if(o_orderstatus = 'P', null, cast(o_orderdate as date)) as date_published",
        "cast(null as date) as date_added",
    )
    return rows.groupBy(exploits.exploit_year(rows).alias("year")).agg(
        F.count("*").alias("rows")
    )


_TEMPLATE_SPARK = """concat(
  'id: part-', p_partkey, '\\ninfo:\\n  name: ',
  if(p_size > 40, string(p_size), concat('\\"', p_name, '\\"')),
  '\\n  severity: ', lower(p_type), '\\n  author: a b, ', p_brand, ' ,,c\\n  tags:\\n  - ',
  p_type, '\\n  - ', p_size, '\\n  classification:\\n    cve-id: ',
  if(p_size > 25, concat('cve-2024-', p_partkey, ', nope'),
     concat('[CVE-2023-', p_partkey, ', cve-1-2]')),
  '\\n    cwe-id: cwe-', p_size, '\\n    cvss-score: ',
  if(p_type = 'PROMO', 'true', concat('\\"', p_size, '.5\\"')),
  '\\n    epss-score: ', p_retailprice,
  '\\n  metadata:\\n    verified: ', if(p_type = 'LARGE', 'true', '\\"true\\"'),
  '\\n    vendor: ', p_brand, '\\n',
  case p_type when 'SMALL' then 'tcp' when 'LARGE' then 'requests'
       when 'PROMO' then 'dns: []\\nhttp' when 'ECONOMY' then 'ssl' else 'other' end,
  ': []\\n')"""
_TEMPLATE_SQL = """concat(
  'id: part-', p_partkey, chr(10), 'info:', chr(10), '  name: ',
  case when p_size > 40 then p_size::varchar else '"' || p_name || '"' end,
  chr(10), '  severity: ', lower(p_type), chr(10), '  author: a b, ', p_brand, ' ,,c',
  chr(10), '  tags:', chr(10), '  - ', p_type, chr(10), '  - ', p_size, chr(10),
  '  classification:', chr(10), '    cve-id: ',
  case when p_size > 25 then 'cve-2024-' || p_partkey || ', nope'
       else '[CVE-2023-' || p_partkey || ', cve-1-2]' end,
  chr(10), '    cwe-id: cwe-', p_size, chr(10), '    cvss-score: ',
  case when p_type = 'PROMO' then 'true' else '"' || p_size || '.5"' end,
  chr(10), '    epss-score: ', p_retailprice::varchar, chr(10), '  metadata:', chr(10),
  '    verified: ', case when p_type = 'LARGE' then 'true' else '"true"' end, chr(10),
  '    vendor: ', p_brand, chr(10),
  case p_type when 'SMALL' then 'tcp' when 'LARGE' then 'requests'
       when 'PROMO' then 'dns: []' || chr(10) || 'http' when 'ECONOMY' then 'ssl'
       else 'other' end, ': []', chr(10))"""


@register(
    "feed_templates",
    f"""
select 'part-' || p_partkey as template_id,
       case when p_size <= 40 then p_name end as name, lower(p_type) as severity,
       'a b,' || p_brand || ',c' as author, p_type || ',' || p_size as tags,
       case when p_size > 25 then 'CVE-2024-' || p_partkey
            else 'CVE-2023-' || p_partkey end as cve,
       'CWE-' || p_size as cwe,
       case when p_type <> 'PROMO' then p_size + 0.5::double end as cvss_score,
       p_retailprice as epss_score, p_brand as vendor, p_type = 'LARGE' as verified,
       case p_type when 'SMALL' then 'network' when 'LARGE' then 'http'
            when 'PROMO' then 'http' when 'ECONOMY' then 'ssl' end as type,
       'http/' || p_partkey || '.yaml' as file,
       'https://github.com/projectdiscovery/nuclei-templates/blob/main/http/'
           || p_partkey || '.yaml' as template_url,
       sha256({_TEMPLATE_SQL}) as digest
from part where p_type <> 'STANDARD'""",
)
def feed_templates(spark: SparkSession, sf: str) -> DataFrame:
    """YAML templates; signature lines do not count for the digest, and the STANDARD
    parts are documents that are no templates."""
    documents = spread(table(spark, sf, "part")).selectExpr(
        "concat('http/', p_partkey, '.yaml') as file",
        f"if(p_type = 'STANDARD', '- just\\n- a list\\n', concat({_TEMPLATE_SPARK},"
        " '# digest: 4a0a', p_partkey, '\\n')) as value",
    )
    rows = _parsed(templates.template_rows(documents)).select(
        "template_id", "name", "severity", "author", "tags", "cve", "cwe", "cvss_score",
        "epss_score", "vendor", "verified", "type", "file", "template_url", "digest",
    )
    return _text(rows, "author", "tags", "cve", "cwe")


@register(
    "feed_known_exploited",
    """
select o_orderkey as order_key, 'CVE-2024-' || o_custkey as cve,
       o_orderpriority as vendor_project,
       case when o_orderstatus = 'O' then 'note ' || o_custkey end as notes,
       'CWE-' || o_custkey as cwe, o_orderdate::date::varchar as date_added,
       case when o_orderpriority <> '5-LOW' then o_orderdate::date::varchar end as due_date
from orders
union all
select o_orderkey, 'CVE-2023-' || o_orderkey, 'second', null, '', null, null
from orders where o_orderstatus <> 'F'""",
)
def feed_known_exploited(spark: SparkSession, sf: str) -> DataFrame:
    """One catalog per order with three entries: one names a CVE again for some orders,
    where the first entry wins, and one is malformed."""
    documents = spread(table(spark, sf, "orders")).selectExpr(
        "o_orderkey as order_key",
        """concat('{"vulnerabilities":[', to_json(named_struct(
          'cveID', concat('CVE-2024-', o_custkey), 'vendorProject', o_orderpriority,
          'notes', if(o_orderstatus = 'O', concat('note ', o_custkey), ''),
          'cwes', array(concat(' cwe-', o_custkey), '  '),
          'dateAdded', date_format(o_orderdate, 'yyyy-MM-dd'),
          'dueDate', date_format(o_orderdate, case when o_orderpriority = '5-LOW' then 'yyyy-MM'
                       when o_orderstatus = 'P' then 'yyyyMMdd' else 'yyyy-MM-dd' end))),
        ',{"cveID":"', if(o_orderstatus = 'F', concat('CVE-2024-', o_custkey),
                          concat('CVE-2023-', o_orderkey)),
        '","vendorProject":"second","notes":5},{"cveID":"BAD-', o_custkey, '"},"text"]}')
        as value""",
    )
    rows = _parsed(exploited.exploited_rows(documents))
    first = first_per_key(rows, ["order_key", "cve"], ["position"])
    return _text(
        first.select(
            "order_key", "cve", "vendor_project", "notes", "cwe", "date_added", "due_date"
        ),
        "cwe",
        "date_added",
        "due_date",
    )


@register(
    "feed_weaknesses",
    """
select 'CWE-' || p_partkey as cwe_id,
       case p_type when 'SMALL' then 'category' when 'PROMO' then 'view'
            else 'weakness' end as entry_type,
       p_name || ' & more' as name,
       case when p_type not in ('SMALL', 'PROMO') then p_brand end as abstraction,
       p_type as status, 'All <b> of ' || p_name || ' ' || p_brand as description,
       case when p_type not in ('SMALL', 'PROMO') then 'High' end
           as likelihood_of_exploit,
       case when p_type in ('SMALL', 'PROMO') then 'HasMember' else 'ChildOf' end
           || '>CWE-' || p_size || ';'
           || case when p_type in ('SMALL', 'PROMO') then 'HasMember' else 'PeerOf' end
           || '>CWE-' || (p_size + 1) as relations,
       '4.20' as cwe_version, '2024-01-02' as release_date
from part""",
)
def feed_weaknesses(spark: SparkSession, sf: str) -> DataFrame:
    tag = "case p_type when 'SMALL' then 'Category' when 'PROMO' then 'View' else 'Weakness' end"
    listing = "case p_type when 'SMALL' then 'Categories' when 'PROMO' then 'Views' else 'Weaknesses' end"
    text = "case p_type when 'SMALL' then 'Summary' when 'PROMO' then 'Objective' else 'Description' end"
    group = "case p_type when 'SMALL' then 'Relationships' when 'PROMO' then 'Members' else 'Related_Weaknesses' end"
    member = "if(p_type in ('SMALL', 'PROMO'), 'Has_Member', 'Related_Weakness')"
    documents = spread(table(spark, sf, "part")).selectExpr(
        f"""concat('<?xml version="1.0"?>\\n<Weakness_Catalog xmlns="http://cwe.mitre.org/cwe-7"',
          ' xmlns:xhtml="http://www.w3.org/1999/xhtml" Version="4.20" Date="2024-01-02"><', {listing}, '><',
          {tag}, ' ID="', p_partkey, '" Name="', p_name, ' &amp; more" Abstraction="', p_brand,
          '" Status="', p_type, '"><', {text}, '>All &lt;b&gt;\\n  of <xhtml:i>', p_name,
          '</xhtml:i> ', p_brand, '\\n</', {text}, '><', {group}, '><',
          {member}, ' Nature="ChildOf" CWE_ID="', p_size, '" View_ID="1"/><',
          {member}, ' Nature="ChildOf" CWE_ID="', p_size, '" View_ID="2"/><',
          {member}, ' Nature="PeerOf" CWE_ID="', p_size + 1, '"/></', {group},
          '><Likelihood_Of_Exploit>High</Likelihood_Of_Exploit></', {tag},
          '></', {listing}, '></Weakness_Catalog>') as value"""
    )
    rows = weaknesses.weakness_rows(documents)
    relations = F.transform(
        "relations", lambda r: F.concat_ws(">", r["nature"], r["target_id"])
    )
    return _text(
        rows.withColumn("relations", F.array_join(relations, ";")), "release_date"
    )


@register(
    "feed_weakness_markup",
    """
select 'CWE-' || p_partkey as cwe_id, 'weakness' as entry_type,
       p_name || ' <&> it' as name, null as description, '' as relations, p_type as cwe_version
from part
union all
select 'CWE-' || (p_partkey + 1000000), 'weakness', p_name,
       'a <b> ' || p_name || ' < <Weakness ID="9"/> & so' || case when p_size > 25 then ' on' else '' end,
       'ChildOf>CWE-' || p_size, p_type
from part
union all
select 'CWE-' || (p_partkey + 2000000), 'category', null, null, '', p_type from part""",
)
def feed_weakness_markup(spark: SparkSession, sf: str) -> DataFrame:
    """Entries closed by themselves, entries in comments (none counts), entries outside of
    their list, CDATA, character references and markup inside of texts."""
    documents = table(spark, sf, "part").selectExpr(
        """concat('<?xml version="1.0"?><!-- <Weakness ID="7"/> --><Weakness_Catalog Version="', p_type,
          '" Date="2024-01-02"><Weakness ID="8" Name="stray"/><Weaknesses><Weakness ID="', p_partkey,
          '" Name="', p_name, ' &lt;&amp;&gt; it"/><!-- <Weakness ID="', p_partkey, '9" Name="no">',
          '<Description>no</Description></Weakness> --><Weakness Name="', p_name, '" ID="',
          p_partkey + 1000000, '"><Description>a &#60;b&gt; <i title="1 > 0">', p_name,
          '</i> &#x3C; <![CDATA[<Weakness ID="9"/> &]]> so', if(p_size > 25, '<br/> on', ''),
          '</Description><Related_Weaknesses><Related_Weakness CWE_ID="', p_size,
          '" Nature="ChildOf"/></Related_Weaknesses></Weakness></Weaknesses><Categories><Category ID="',
          p_partkey + 2000000, '"/></Categories><Views/></Weakness_Catalog>') as value"""
    )
    rows = weaknesses.weakness_rows(documents)
    relations = F.transform("relations", lambda r: F.concat_ws(">", r["nature"], r["target_id"]))
    return rows.withColumn("relations", F.array_join(relations, ";")).select(
        "cwe_id", "entry_type", "name", "description", "relations", "cwe_version"
    )


@register(
    "feed_attack_relationships",
    """
select o_orderkey as matrix, 'r1--' || o_custkey as relationship_id,
       'uses' as relationship_type, 'G' || o_custkey as source_attack_id,
       'group ' || o_custkey as source_name, 'intrusion-set' as source_type,
       'ap--' || o_orderkey as target_ref, null as target_attack_id,
       'renamed ' || o_orderkey as target_name, 'x-note' as target_type,
       o_orderstatus = 'F' as revoked
from orders
union all
select o_orderkey, 'r2--' || o_custkey, 'mitigates', 'G' || o_custkey,
       'group ' || o_custkey, 'intrusion-set', 'gone--' || o_orderkey, null, null, null,
       false
from orders""",
)
def feed_attack_relationships(spark: SparkSession, sf: str) -> DataFrame:
    """One bundle per order: a group, an object that is listed twice (the last one
    counts), an edge between them, and an edge to an object that is not there."""
    documents = spread(table(spark, sf, "orders")).selectExpr(
        "o_orderkey as matrix",
        """concat('{"objects":[{"type":"relationship","id":"r1--', o_custkey,
          '","relationship_type":"uses","source_ref":"g--', o_custkey,
          '","target_ref":"ap--', o_orderkey, '"',
          if(o_orderstatus = 'F', ',"revoked":true', ''), '},',
          '{"type":"attack-pattern","id":"ap--', o_orderkey, '","name":"first",',
          '"external_references":[{"source_name":"mitre-attack","external_id":"T1"}]},',
          '{"type":"intrusion-set","id":"g--', o_custkey, '","name":"group ', o_custkey,
          '","external_references":[{"source_name":"mitre-attack","external_id":"G',
          o_custkey, '"}]},{"type":"x-note","id":"ap--', o_orderkey,
          '","name":"renamed ', o_orderkey, '"},{"type":"relationship","id":"r2--',
          o_custkey, '","relationship_type":"mitigates","source_ref":"g--', o_custkey,
          '","target_ref":"gone--', o_orderkey, '"}]}') as value""",
    )
    objects = bundles.bundle_objects(documents, "matrix")
    return bundles.relationship_rows(objects).select(
        "matrix", "relationship_id", "relationship_type", "source_attack_id",
        "source_name", "source_type", "target_ref", "target_attack_id", "target_name",
        "target_type", "revoked",
    )


@register(
    "feed_attack_objects",
    """
select s_suppkey as matrix, 'T' || s_suppkey as attack_id, 'ap--' || s_suppkey as object_id,
       'attack-pattern' as object_type, s_name as name, 'https://a/' || s_suppkey as url,
       'kc/' || s_nationkey as phases, s_acctbal > 5000 as revoked,
       false as deprecated, timestamp '2024-02-01 03:04:05' as modified,
       json_object('external_id', 'T' || s_suppkey, 'name', s_name)::varchar as raw_part
from supplier where s_acctbal >= 0 and s_suppkey <> 0
union all
select s_suppkey, 'G' || s_suppkey, 'g--' || s_suppkey, 'intrusion-set',
       'group of ' || s_name, null, '', false, true, null,
       json_object('external_id', 'G' || s_suppkey, 'name', 'group of ' || s_name)::varchar
from supplier""",
)
def feed_attack_objects(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread(table(spark, sf, "supplier")).selectExpr(
        "s_suppkey as matrix",
        """concat('{"objects":[', to_json(named_struct(
          'type', 'attack-pattern', 'id', concat('ap--', s_suppkey), 'name', s_name,
          'modified', '2024-02-01T05:04:05.000+02:00', 'revoked', s_acctbal > 5000,
          'kill_chain_phases', array(
            named_struct('kill_chain_name', 'kc', 'phase_name', string(s_nationkey)),
            named_struct('kill_chain_name', 'kc', 'phase_name', '')),
          'external_references', array(
            named_struct('source_name', 'mitre-attack',
                         'external_id', if(s_acctbal < 0, '', concat('T', s_suppkey)),
                         'url', ''),
            named_struct('source_name', 'mitre-attack', 'external_id', 'T0',
                         'url', concat('https://a/', s_suppkey))))), ',',
        to_json(named_struct('type', 'x-unknown', 'id', 'u')), ',"text",',
        to_json(named_struct(
          'type', 'intrusion-set', 'id', concat('g--', s_suppkey),
          'name', concat('group of ', s_name), 'x_mitre_deprecated', true,
          'external_references', array(named_struct('source_name', 'mitre-attack',
                         'external_id', concat('G', s_suppkey))))), ']}') as value""",
    )
    rows = bundles.attack_rows(bundles.bundle_objects(documents, "matrix"))
    phases = F.transform(
        "kill_chain_phases",
        lambda p: F.concat_ws("/", p["kill_chain_name"], p["phase_name"]),
    )
    kept = rows.where("attack_id != 'T0'")
    return kept.select(
        "matrix", "attack_id", "object_id", "object_type", "name", "url",
        F.array_join(phases, ",").alias("phases"), "revoked", "deprecated", "modified",
        F.to_json(F.struct(F.col("attack_id").alias("external_id"),
                           F.get_json_object("raw", "$.name").alias("name")))
        .alias("raw_part"),
    )


@register(
    "feed_attack_patterns",
    """
select 'CAPEC-' || c_custkey as capec_id, c_name as name,
       case when c_nationkey = c_custkey then 'CWE-' || c_custkey
            else 'CWE-' || c_nationkey || ',CWE-' || c_custkey end as cwe,
       case when c_mktsegment = 'BUILDING' then ''
            when c_nationkey = c_custkey then 'T' || c_custkey
            else 'T' || c_nationkey || ',T' || c_custkey end as attack,
       false as revoked, c_acctbal < 0 as deprecated
from customer""",
)
def feed_attack_patterns(spark: SparkSession, sf: str) -> DataFrame:
    reference = "named_struct('source_name', {}, 'external_id', {})"
    references = ", ".join(
        reference.format(source, ext)
        for source, ext in (
            ("'capec'", "concat('CAPEC-', c_custkey)"),
            ("'cwe'", "concat('CWE-', c_nationkey)"),
            ("'cwe'", "concat('CWE-', c_custkey)"),
            ("'cwe'", "concat('CWE-', c_nationkey)"),
            ("'cwe'", "concat('WEAK-', c_nationkey)"),
            ("'ATTACK'", "concat(if(c_mktsegment = 'BUILDING', 'X', 'T'), c_nationkey)"),
            ("'mitre-attack'", "concat(if(c_mktsegment = 'BUILDING', 'X', 'T'), c_custkey)"),
        )
    )
    documents = spread(table(spark, sf, "customer")).selectExpr(
        f"""to_json(named_struct('objects', array(named_struct(
          'type', 'attack-pattern', 'id', concat('ap--', c_custkey), 'name', c_name,
          'x_mitre_deprecated', c_acctbal < 0,
          'external_references', array({references})))))  as value"""
    )
    rows = bundles.pattern_rows(bundles.bundle_objects(documents))
    return _text(
        rows.select("capec_id", "name", "cwe", "attack", "revoked", "deprecated"),
        "cwe",
        "attack",
    )


_PLAIN_SQL = r"""trim(regexp_replace(replace(replace(replace(replace(regexp_replace(
  {}, '<[^>]+>', ' ', 'g'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
  '[\x09-\x0d\x1c-\x20\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"""


@register(
    "feed_changelog_pages",
    f"""
with page as (
  select page_id, {_PLAIN_SQL.format("html")} as body from pages),
plain as (
  select page_id, body || ' seen in cve-2024-' || (10000 + page_id) || ' and GHSA-ab12-cd34-ef56;'
         || ' CVE-2024-' || (10000 + page_id) as text from page),
mention as (
  select *, unnest(['CVE-2024-' || (10000 + page_id), 'GHSA-AB12-CD34-EF56']) as identifier
  from plain),
found as (
  select *, instr(upper(replace(text, 'ß', 'SS')), identifier) as pos from mention)
select identifier, split_part(identifier, '-', 1) as identifier_type,
       case when identifier like 'CVE%' then identifier end as cve,
       'Page ' || page_id || ' of "all' as source_title,
       'https://developers.cloudflare.com/changelog/' || page_id || '/' as source_url,
       '2024-03-01' as source_date,
       trim(substr(text, greatest(1, pos - 60)::bigint,
                   (least(length(text), pos - 1 + length(identifier) + 60)
                    - greatest(1, pos - 60) + 1)::bigint)) as matched_text
from found""",
)
def feed_changelog_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Free-text change-log pages around the whole text of every web page."""
    pages = spread(table(spark, sf, "pages")).selectExpr(
        "concat('src/content/changelog/waf/', page_id, '.mdx') as path",
        """concat('---\\ntitle: "Page ', page_id, ' of "all""\\n  date: 1999-01-01\\n',
          'date: on 2024-03-01\\n---\\n', html, ' seen in cve-2024-', 10000 + page_id,
          ' and GHSA-ab12-cd34-ef56; CVE-2024-', 10000 + page_id) as value""",
    )
    return _text(changelog.mention_rows(pages), "source_date")


@register(
    "feed_changelog_tables",
    """
select identifier, split_part(identifier, '-', 1) as identifier_type, source_title,
       source_url, source_date
from (select 'https://developers.cloudflare.com/waf/change-log/historical-'
             || o_orderkey || '/' as source_url,
             'Order ' || o_orderkey || ' - GO-2024-' || o_custkey || ', RUSTSEC-2024-'
             || o_orderkey as source_title,
             o_orderdate::date::varchar as source_date,
             unnest(['GO-2024-' || o_custkey, 'RUSTSEC-2024-' || o_orderkey]) as identifier
      from orders)""",
)
def feed_changelog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Historical pages: one HTML table per order; short rows and rows without an
    identifier are left out, and the first mention on a page wins."""
    row = "concat('<TR><td>s</td><td><RuleID id=\"1\" /></td><td>1</td><td>', {}, '</td><td> <b>', {}, '</b></td></tr>')"
    wanted = row.format(
        "'Order ', o_orderkey, ' - go-2024-', o_custkey, ', RUSTSEC-2024-', o_orderkey",
        "date_format(o_orderdate, 'yyyy-MM-dd')",
    )
    again = row.format("'again RUSTSEC-2024-', o_orderkey", "'2030-01-01'")
    without = row.format("'no identifier'", "'2030-01-01'")
    pages = spread(table(spark, sf, "orders")).selectExpr(
        "concat('src/content/docs/waf/change-log/historical-', o_orderkey, '.mdx') as path",
        f"""concat('---\\ntitle: H\\n---\\n<table>', {without},
          '<tr><td>CVE-2024-11111</td></tr>\\n', {wanted}, {again}, '</table>') as value""",
    )
    rows = changelog.mention_rows(pages).select(
        "identifier",
        "identifier_type",
        F.regexp_replace("source_title", "go-2024", "GO-2024").alias("source_title"),
        "source_url",
        "source_date",
    )
    return _text(rows, "source_date")


_PATHS = """
select url as path from pages
union all select 'cves/2024/CVE-2024-' || (1000 + page_id) || '.json' from pages
union all select 'cves/delta-' || page_id || '.json' from pages
union all select 'db/advisories/github-reviewed/2024/' || page_id || '.json' from pages
union all select 'db/advisories/unreviewed/2024/' || page_id || '.json' from pages
union all select 'top/http/' || page_id || '.yaml' from pages
union all select 'top/helpers/' || page_id || '.yml' from pages"""


@register(
    "feed_path_filters",
    f"""
select regexp_matches(path, 'CVE-[0-9]{{4}}-[0-9]{{4,}}[.]json$') as is_record,
       case when path like '%/CVE-2024-%' then 2024 end as record_year,
       path like '%/github-reviewed/%' as is_reviewed,
       path like 'top/http/%' as is_template, count(*) as files
from ({_PATHS}) group by all""",
)
def feed_path_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Which landed files belong to which feed, by path alone."""
    pages = table(spark, sf, "pages")
    shapes = (
        "url",
        "concat('cves/2024/CVE-2024-', 1000 + page_id, '.json')",
        "concat('cves/delta-', page_id, '.json')",
        "concat('db/advisories/github-reviewed/2024/', page_id, '.json')",
        "concat('db/advisories/unreviewed/2024/', page_id, '.json')",
        "concat('top/http/', page_id, '.yaml')",
        "concat('top/helpers/', page_id, '.yml')",
    )
    paths = pages.selectExpr(f"explode(array({', '.join(shapes)})) as path")
    path = F.col("path")
    year = records.record_year(path)
    return paths.groupBy(
        year.isNotNull().alias("is_record"),
        year.alias("record_year"),
        advisories.is_reviewed(path).alias("is_reviewed"),
        templates.is_template(templates.template_path(path)).alias("is_template"),
    ).agg(F.count("*").alias("files"))


@register(
    "parquet_glob_scan",
    """
select l_returnflag, count(*) as rows, max(l_shipdate) as newest from lineitem
where l_shipdate >= timestamp '1998-01-01' group by 1""",
)
def parquet_glob_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Plain Parquet by glob: the filter and three columns reach the scan."""
    rows = spark.read.parquet(f"{sf}/line*.parquet")
    recent = rows.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return recent.groupBy("l_returnflag").agg(
        F.count("*").alias("rows"), F.max("l_shipdate").alias("newest")
    )
