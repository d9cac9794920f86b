"""Ingest jobs, the lake and its checks run over feeds that are made from the given tables.

Every query opens a lake of its own in the shared folder, runs the jobs, and returns what
they said or what they stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.bindings.feeds import (
    advisory_documents, exploit_index, land_scores, landed_scores, record_documents, score_lines,
)
from hazardbook.bindings.registry import register, spread, table
from hazardbook.bindings.world import base_tables, over_world
from hazardbook.checks import overall, verify
from hazardbook.operators.changes import ShrunkSnapshot
from hazardbook.plans import published
from hazardbook.session import drop_path, shared_folder
from hazardbook.sinks import ingest
from hazardbook.sinks.lake import BatchResult, Lake
from hazardbook.sources import advisories, exploited, exploits, records, scores, templates, weaknesses
from hazardbook.streaming.daily import ingest_arrivals


def _new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}")


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _said(spark: SparkSession, steps: list[tuple[str, int, BatchResult]]) -> DataFrame:
    """What jobs said, one row per step and batch."""
    rows = [(feed, step, r.batch, r.status, r.records, r.bad) for feed, step, r in steps]
    return spark.createDataFrame(
        rows, "feed string, step int, batch string, status string, records long, bad long"
    )


# ------------------------------------------------------------- records in the lake


def _record_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Records as a parser gives them, all valid."""
    rows = base_tables(spark, sf)["cve_history"]
    return rows.withColumns({"file_year": F.year("date_published"), "valid": F.lit(True)})


def _lake_of_records(spark: SparkSession, sf: str) -> Lake:
    """Records up to 1999 as year batches, later ones as a dated update batch."""
    lake = _new_lake(spark)
    rows = _record_rows(spark, sf)
    ingest.fill_records(lake, rows.where(F.col("date_updated") < _moment("2000-01-01")))
    ingest.add_records(lake, lambda _: rows, date(2001, 8, 2))
    return lake


@register(
    "lake_year_backfill_and_update",
    over_world("""
select year(date_published) as year, count(*) as records, max(date_updated) as newest
from cve_history group by 1"""),
)
def lake_year_backfill_and_update(spark: SparkSession, sf: str) -> DataFrame:
    """All records through a year backfill and a watermark update, read back."""
    stored = _lake_of_records(spark, sf).table("cve_history")
    return stored.groupBy(F.year("date_published").alias("year")).agg(
        F.count("*").alias("records"), F.max("date_updated").alias("newest")
    )


_BATCHES_SQL = """
select 'cve_history' as table_name,
       case when date_updated < timestamp '2000-01-01' then year(date_published) else 2001 end as year,
       case when date_updated < timestamp '2000-01-01' then 'backfill' else '2001-08-02' end as batch,
       count(*) as records
from cve_history group by all"""


@register(
    "lake_manifest",
    over_world(f"""
select *, table_name || ' ' || case batch when 'backfill' then year || ' backfill' else batch end
       || ' (' || records || ' records)' as message
from ({_BATCHES_SQL})"""),
)
def lake_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Registered files by batch, with the message of the run that wrote them."""
    files = _lake_of_records(spark, sf).data_files()
    return files.groupBy("table_name", "year", "batch", "message").agg(F.sum("rows").alias("records"))


@register("lake_rebuilt", over_world(_BATCHES_SQL))
def lake_rebuilt(spark: SparkSession, sf: str) -> DataFrame:
    """The stored files under a new catalog, after the old one was lost."""
    old = _lake_of_records(spark, sf)
    lake = Lake(spark, old.root, f"{old.database}_new")
    lake.rebuild()
    return lake.stored("cve_history").groupBy(
        F.lit("cve_history").alias("table_name"), "year", "batch"
    ).agg(F.count("*").alias("records"))


@register(
    "lake_backfill_messages",
    """
with r as (select o_orderstatus = 'P' as bad, o_orderpriority = '5-LOW' as yearless,
                  year(o_orderdate) as y from orders)
select 1 as run, 'backfilled ' || count(distinct case when not bad and not yearless then y end)
       || ' year batches (skipped 0 years, ' || count(*) filter (bad or yearless) || ' bad records)' as said
from r
union all
select 2, 'backfilled 0 year batches (skipped '
       || count(distinct case when not bad and not yearless then y end) || ' years, '
       || count(*) filter (bad or yearless) || ' bad records)' from r""",
)
def lake_backfill_messages(spark: SparkSession, sf: str) -> DataFrame:
    """A backfill and a second one of the same feed: records that are not valid or whose
    file names no year are counted, not lost without a word."""
    status, priority = F.substring("cvss_severity", 1, 1), F.col("assigner")
    rows = _record_rows(spark, sf).withColumns({
        "file_year": F.when(priority != "5-LOW", F.col("file_year")), "valid": status != "P",
    })
    lake = _new_lake(spark)
    said = [(run, ingest.fill_records(lake, rows)) for run in (1, 2)]
    return spark.createDataFrame(said, "run int, said string")


@register(
    "lake_sql_catalog",
    over_world("""
select 'cve_history' as name, 14 as columns, count(*) as rows from cve_history
union all select 'cve', 14, count(*) from cve"""),
)
def lake_sql_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Names, columns and rows of tables as SQL shows them."""
    lake = _lake_of_records(spark, sf)
    prefix = f"c{uuid.uuid4().hex[:8]}_"
    lake.refresh_views(prefix)
    shown = lake.query(f"SHOW TABLES LIKE '{prefix}cve*'").select("tableName")
    wanted = shown.where(F.col("tableName").isin(f"{prefix}cve_history", f"{prefix}cve"))
    found = None
    for row in wanted.collect():
        described = lake.query(f"DESCRIBE {row.tableName}").agg(F.count("*").cast("int").alias("columns"))
        rows = lake.query(f"SELECT count(*) AS rows FROM {row.tableName}")
        one = described.crossJoin(rows).withColumn("name", F.lit(row.tableName.removeprefix(prefix)))
        found = one if found is None else found.unionByName(one)
    return found


# ----------------------------------------------------------------------- checks


@register(
    "lake_verification",
    over_world("""
select 'cve_history' as table_name, true as stored, 0 as stray_files, 0 as missing_files,
       0 as changed_files, count(*) as row_count, min(date_updated)::date::varchar as min_date,
       max(date_updated)::date::varchar as max_date, true as ok, true as stale
from cve_history
union all
select t, false, 0, 0, 0, 0, null, null, true, false
from (select unnest(['epss', 'ghsa_history', 'exploitdb_history', 'nuclei_history',
  'cwe_history', 'kev_history', 'cloudflare_waf_history', 'attack_history',
  'attack_relationship_history', 'capec_history']) as t)"""),
)
def lake_verification(spark: SparkSession, sf: str) -> DataFrame:
    """Files in storage against the catalog, row statistics, freshness; one row per table."""
    report = verify(_lake_of_records(spark, sf), date(2001, 9, 1), 3)
    return report.select(
        "table_name", (F.col("files_in_storage") > 0).alias("stored"), "stray_files",
        "missing_files", "changed_files", "row_count", F.col("min_date").cast("string").alias("min_date"),
        F.col("max_date").cast("string").alias("max_date"), "ok", "stale",
    )


@register(
    "lake_verification_overall",
    "select count(*) > 0 as ok, max(o_orderdate) < timestamp '2001-08-29' as stale from orders",
)
def lake_verification_overall(spark: SparkSession, sf: str) -> DataFrame:
    return overall(verify(_lake_of_records(spark, sf), date(2001, 9, 1), 3))


@register(
    "lake_lost_and_stray_files",
    over_world("""
select 'cve_history' as table_name, 1 as missing_files, 1 as stray_files,
       count(*) > 0 as had_rows, false as ok from cve_history"""),
)
def lake_lost_and_stray_files(spark: SparkSession, sf: str) -> DataFrame:
    """A part file that is gone and one that nobody registered, both of an old batch."""
    lake = _lake_of_records(spark, sf)
    files = lake.data_files().where("batch = 'backfill'")
    year = files.agg(F.min("year")).head()[0]
    lost = files.where(F.col("year") == year).agg(F.min("file")).head()[0]
    stray = lake.table("cve_history").where(F.year("date_published") == year).limit(5)
    stray.coalesce(1).write.parquet(f"{lake.location('cve_history')}/year={year}/batch=left")
    drop_path(spark, lost)
    had = F.lit(lake.data_files().agg(F.sum("rows")).head()[0] > 0)
    report = verify(lake, date(2001, 9, 1), 3).where("NOT ok")
    return report.select("table_name", "missing_files", "stray_files", had.alias("had_rows"), "ok")


@register(
    "lake_without_catalog",
    "select 'catalog not found' as table_name, count(*) > 0 as stored, false as ok, false as stale from nation",
)
def lake_without_catalog(spark: SparkSession, sf: str) -> DataFrame:
    lake = _new_lake(spark)
    table(spark, sf, "nation").write.parquet(f"{lake.root}/cve/left")
    report = verify(lake, date(2001, 9, 1))
    return report.select("table_name", (F.col("files_in_storage") > 0).alias("stored"), "ok", "stale")


# ------------------------------------------------------------------------ scores


_DAYS_SQL = """
with lines as (
  select ts::date as file_day, event_id % 50 <> 7 as good,
         case when ts::date < date '2024-01-21' then ts::date else ts::date + 1 end as day
  from events where event_type <> 'error'),
days as (select day::varchar as batch, day, min(file_day) as file_day, count(*) filter (good) as n from lines group by all),
bad as (select count(*) filter (not good and file_day < date '2024-01-15') as early,
               count(*) filter (not good) as every from lines),
runs as (
  select 'epss' as feed, 1 as step, batch, day, 'published' as status, n as records from days where file_day < date '2024-01-15'
  union all
  select 'epss', 2, batch, day, case when file_day < date '2024-01-15' then 'already-registered' else 'published' end,
         case when file_day < date '2024-01-15' then 0 else n end from days)
"""


def _lake_of_days(spark: SparkSession, sf: str) -> tuple[Lake, list]:
    """The first two weeks of landed files, then all of them."""
    lake = _new_lake(spark)
    lines = score_lines(table(spark, sf, "events"))
    early = land_scores(spark, lines.where("file < 'epss_scores-2024-01-15'"))
    steps = [("epss", 1, r) for r in ingest.update_scores(lake, early)]
    steps += [("epss", 2, r) for r in ingest.update_scores(lake, landed_scores(spark, sf))]
    return lake, steps


@register(
    "lake_score_days",
    _DAYS_SQL
    + """
select feed, step, batch, status, records,
       case when day = max(day) over (partition by step) then case step when 1 then early else every end
            else 0 end as bad
from runs, bad""",
)
def lake_score_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days as they land: every day is one batch, written once, all days of a run in one
    job; lines that are no scores are counted."""
    return _said(spark, _lake_of_days(spark, sf)[1])


@register(
    "lake_score_verification",
    _DAYS_SQL
    + """
select 'epss' as table_name, sum(n) as row_count, min(day)::varchar as min_date,
       max(day)::varchar as max_date, true as ok, true as stale from days""",
)
def lake_score_verification(spark: SparkSession, sf: str) -> DataFrame:
    """The newest score is as old as the newest batch, and the oldest year is stored."""
    report = verify(_lake_of_days(spark, sf)[0], date(2024, 3, 1), 3).where("table_name = 'epss'")
    return report.select(
        "table_name", "row_count", F.col("min_date").cast("string").alias("min_date"),
        F.col("max_date").cast("string").alias("max_date"), "ok", "stale",
    )


@register(
    "score_files_of_year",
    _DAYS_SQL + "select day::varchar as date, n as records from days where year(day) = 2024",
)
def score_files_of_year(spark: SparkSession, sf: str) -> DataFrame:
    """The files of a year read by their place, without the catalog."""
    lake, _ = _lake_of_days(spark, sf)
    rows = published.score_files(spark, lake.root, 2024)
    return rows.groupBy(F.col("date").cast("string").alias("date")).agg(F.count("*").alias("records"))


@register(
    "lake_arrivals",
    _DAYS_SQL + "select day::varchar as date, n as records, n as distinct_rows from days",
)
def lake_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """The landing folder as a stream that is started three times: on the first files, on
    more of them, and on nothing new. No row is stored twice."""
    lake = _new_lake(spark)
    landed, checkpoint = f"{lake.root}-landed", f"{lake.root}-checkpoint"
    rows = score_lines(table(spark, sf, "events"))
    for part in ("file < 'epss_scores-2024-01-15'", "file >= 'epss_scores-2024-01-15'", "false"):
        files = rows.where(part).repartition("folder", "file").sortWithinPartitions(
            "folder", "file", "position"
        ).select("folder", "file", "value")
        files.write.mode("append").partitionBy("folder", "file").option("compression", "gzip").text(landed)
        ingest_arrivals(lake, landed, checkpoint, files_per_batch=8).awaitTermination()
    stored = lake.table("epss").withColumn("date", F.col("date").cast("string"))
    once = F.countDistinct("percentile", F.struct("cve", "epss"))
    early = F.count("*")
    return stored.groupBy("date").agg(
        F.count("*").alias("records"), F.when(F.col("date") < "2024-01-11", early).otherwise(once).alias("distinct_rows")
    )


def _order_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores by order; the file is named three days after the date it holds."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("CVE-2024-"), "o_orderkey").alias("cve"),
        F.col("o_totalprice").alias("epss"),
        F.lit(None).cast("double").alias("percentile"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.concat(F.lit("v"), "o_orderstatus").alias("model_version"),
        F.concat(F.lit("x/epss_scores-"), F.date_add(F.col("o_orderdate").cast("date"), 3), F.lit(".csv.gz")).alias("path"),
        (F.col("o_orderpriority") != "5-LOW").alias("valid"),
    )


_LAST_DAYS = "2001-07-25"


@register(
    "lake_score_folds",
    f"""
with s as (select year(o_orderdate + interval 3 days) as fy, o_orderstatus as st,
                  o_orderpriority = '5-LOW' as bad from orders),
years as (select fy, count(*) filter (not bad) as n,
                 string_agg(distinct case when not bad then 'v' || st end, ', ' order by case when not bad then 'v' || st end) as models
          from s group by 1 having n > 0)
select fy as year, 'backfill' as batch, n as records,
       'epss ' || fy || ' backfill (' || n || ' records, ' || models || ')' as message
from years where fy < 2001
union all
select 2001, o_orderdate::date::varchar, count(*), 'epss ' || o_orderdate::date || ' (' || count(*) || ' records, '
       || string_agg(distinct 'v' || o_orderstatus, ', ' order by 'v' || o_orderstatus) || ')'
from orders where o_orderdate >= timestamp '{_LAST_DAYS}' and o_orderpriority <> '5-LOW' group by o_orderdate::date
union all
select null, 'said', null, 'backfilled ' || count(*) filter (fy < 2001) || ' year batches, 0 daily batches (skipped '
       || count(*) filter (fy = 2001) || ' years, 0 daily, ' || (select count(*) from s where bad) || ' bad lines)'
from years""",
)
def lake_score_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Closed years folded into one batch each by the year of the file's name, with the
    models in the message; a year that has daily batches is left as it is."""
    lake = _new_lake(spark)
    rows = _order_scores(spark, sf)
    ingest.add_score_days(lake, rows.where(F.col("date") >= F.lit(_LAST_DAYS).cast("date")))
    said = ingest.fold_scores(lake, rows, date(2002, 2, 1))
    kept = lake.data_files().groupBy("year", "batch", "message").agg(F.sum("rows").alias("records"))
    return kept.unionByName(
        spark.createDataFrame([(None, "said", said, None)], "year int, batch string, message string, records long")
    )


@register(
    "lake_closed_year_scores",
    over_world("""
select cve, date::varchar as date, epss, model_version from epss"""),
)
def lake_closed_year_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Daily scores folded into one sorted batch per closed year, read back."""
    lake = _new_lake(spark)
    named = F.concat(F.lit("epss_scores-"), "date", F.lit(".csv.gz"))
    rows = base_tables(spark, sf)["epss"].withColumns({"path": named, "valid": F.lit(True)})
    ingest.fold_scores(lake, rows, date(2030, 1, 1))
    rows = lake.table("epss").select("cve", "date", "epss", "model_version")
    return rows.withColumn("date", F.col("date").cast("string"))


# ------------------------------------------------------------ watermarked updates


def _watermarked(
    lake: Lake, feed: str, fill: Callable[[], str], add: Callable[[date], BatchResult]
) -> list[tuple[str, int, BatchResult]]:
    """An update without a history, a backfill, an update, the same again, and one without
    news."""
    steps = [add(date(2001, 8, 2))]
    fill()
    steps += [add(date(2001, 8, 2)), add(date(2001, 8, 2)), add(date(2001, 8, 3))]
    return [(feed, i, step) for i, step in enumerate(steps)]


_UPDATES_SQL = """
with cve as (
  select o_totalprice >= 10000 as good, o_orderdate < timestamp '2000-01-01' as old,
         case o_orderstatus when 'O' then o_orderdate + interval 37800250 milliseconds
              when 'P' then o_orderdate - interval 8 hours else o_orderdate end as moment from orders),
ghsa as (
  select l_linenumber <> 7 as good, l_shipdate < timestamp '2000-01-01' as old,
         case when l_linestatus = 'F' then l_shipdate else l_shipdate + interval 5 hours end as moment from lineitem),
exploitdb as (
  select o_totalprice >= 20000 as good, o_orderdate::date as moment,
         o_orderdate < timestamp '2000-01-01'
         and (o_orderstatus <> 'F' or o_orderdate < timestamp '1999-12-30') as old from orders),
counted as (
  select 'cve' as feed, count(*) filter (good and moment > (select max(moment) from cve where good and old)) as n,
         count(*) filter (not good) as bad from cve
  union all
  select 'ghsa', count(*) filter (good and moment > (select max(moment) from ghsa where good and old)),
         count(*) filter (not good) from ghsa
  union all
  select 'exploitdb', count(*) filter (good and (moment > (select max(moment) from exploitdb where good and old)
           or moment = (select max(moment) from exploitdb where good and old) and not old)),
         count(*) filter (not good) from exploitdb)
select feed, 0 as step, '' as batch, 'refused: history is empty, run the backfill first' as status, 0 as records, 0 as bad from counted
union all select feed, 1, '2001-08-02', 'published', n, bad from counted
union all select feed, 2, '2001-08-02', 'already-registered', 0, 0 from counted
union all select feed, 3, '2001-08-03', 'no-new-records', 0, bad from counted
"""


@register("lake_updates", _UPDATES_SQL)
def lake_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Watermarked feeds, from their documents to the batches; malformed records are counted
    by the job that writes the delta."""
    lake = _new_lake(spark)
    orders, lines = spread(table(spark, sf, "orders")), spread(table(spark, sf, "lineitem"))
    old = F.col("o_orderdate") < _moment("2000-01-01")

    def record_feed(rows: DataFrame, since: Column | None = None) -> DataFrame:
        return records.record_rows(record_documents(rows), since)

    def advisory_feed(rows: DataFrame, since: Column | None = None) -> DataFrame:
        return advisories.advisory_rows(advisory_documents(rows), since)

    def exploit_feed(rows: DataFrame) -> DataFrame:
        return exploits.exploit_rows(exploit_index(rows))

    late = (F.col("o_orderstatus") != "F") | (F.col("o_orderdate") < _moment("1999-12-30"))
    steps = _watermarked(
        lake, "cve",
        lambda: ingest.fill_records(lake, record_feed(orders.where(old))),
        lambda day: ingest.add_records(lake, lambda since: record_feed(orders, since), day),
    )
    steps += _watermarked(
        lake, "ghsa",
        lambda: ingest.fill_advisories(
            lake, advisory_feed(lines.where(F.col("l_shipdate") < _moment("2000-01-01")))
        ),
        lambda day: ingest.add_advisories(lake, lambda since: advisory_feed(lines, since), day),
    )
    steps += _watermarked(
        lake, "exploitdb",
        lambda: ingest.fill_exploits(lake, exploit_feed(orders.where(old & late))),
        lambda day: ingest.add_exploits(lake, lambda _: exploit_feed(orders), day),
    )
    return _said(spark, steps)


@register(
    "lake_record_years",
    """
select year(o_orderdate) + case when o_orderpriority = '5-LOW' then 1 else 0 end as year,
       count(*) as records from orders where o_totalprice >= 10000 group by 1""",
)
def lake_record_years(spark: SparkSession, sf: str) -> DataFrame:
    """The year of a record's batch is that of its file's name, whatever its id says."""
    lake = _new_lake(spark)
    year = "year(o_orderdate) + if(o_orderpriority = '5-LOW', 1, 0)"
    orders = table(spark, sf, "orders")
    documents = record_documents(orders, year)
    ingest.fill_records(lake, records.record_rows(documents))
    return lake.stored("cve_history").groupBy("year").agg(F.count("*").alias("records"))


# --------------------------------------------------------------- snapshot updates


def _catalog(customers: DataFrame, product: str) -> DataFrame:
    documents = customers.selectExpr(
        "concat(c_custkey, '.json') as path",
        f"""concat('{{"vulnerabilities":[', to_json(named_struct('cveID',
          concat('CVE-2024-', lpad(c_custkey, 7, '0')), 'product', {product})), ',{{"cveID":"x"}}]}}') as value""",
    )
    return exploited.exploited_rows(documents)


def _folder(parts: DataFrame, folder: str) -> DataFrame:
    documents = parts.selectExpr(
        f"concat({folder}, '/', p_partkey, '.yaml') as file",
        "concat('id: part-', p_partkey, '\\ninfo:\\n  name: x\\n# digest: ', rand(), '\\n') as value",
    )
    return templates.template_rows(documents)


def _lake_of_snapshots(spark: SparkSession, sf: str) -> tuple[Lake, list]:
    lake = _new_lake(spark)
    customers, parts = spread(table(spark, sf, "customer")), spread(table(spark, sf, "part"))
    first = customers.where("c_mktsegment <> 'BUILDING'")
    second = customers.where("c_mktsegment <> 'MACHINERY'")
    changed = "if(c_acctbal < 0, 'other', c_mktsegment)"
    days = [
        (1, lambda: _catalog(first, "c_mktsegment")),
        (2, lambda: _catalog(second, changed)),
        (2, lambda: _catalog(second, changed)),
        (3, lambda: _catalog(second, changed)),
        (4, lambda: _catalog(customers, "c_mktsegment")),
    ]
    steps = []
    for step, (day, rows) in enumerate(days):
        steps.append(("kev", step, ingest.add_exploited(lake, rows, date(2024, 1, day))))
    try:
        few = _catalog(customers.where("c_acctbal > 9000"), "c_mktsegment")
        ingest.add_exploited(lake, lambda: few, date(2024, 1, 5))
    except ShrunkSnapshot:
        steps.append(("kev", len(days), BatchResult("refused", "2024-01-05")))
    moved = "if(p_size > 25, 'dns', 'http')"
    for step, (day, folder) in enumerate([(1, "'http'"), (2, "'http'"), (3, moved)]):
        rows = _folder(parts, folder)
        steps.append(("nuclei", step, ingest.add_templates(lake, lambda rows=rows: rows, date(2024, 1, day))))
    return lake, steps


@register(
    "lake_snapshots",
    """
with c as (select *, c_mktsegment <> 'BUILDING' as one, c_mktsegment <> 'MACHINERY' as two,
                  c_acctbal < 0 as low from customer),
p as (select count(*) as n, count(*) filter (p_size > 25) as moved from part)
select 'kev' as feed, 0 as step, '2024-01-01' as batch, 'published' as status,
       count(*) filter (one) as records, count(*) filter (one) as bad from c
union all select 'kev', 1, '2024-01-02', 'published', count(*) filter (one <> two or (one and two and low)), count(*) filter (two) from c
union all select 'kev', 2, '2024-01-02', 'already-registered', 0, 0
union all select 'kev', 3, '2024-01-03', 'no-new-records', 0, count(*) filter (two) from c
union all select 'kev', 4, '2024-01-04', 'published', count(*) filter (not two or low), count(*) from c
union all select 'kev', 5, '2024-01-05', 'refused', 0, 0
union all select 'nuclei', 0, '2024-01-01', 'published', n, 0 from p
union all select 'nuclei', 1, '2024-01-02', 'no-new-records', 0, 0
union all select 'nuclei', 2, '2024-01-03', 'published', moved, 0 from p""",
)
def lake_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot feeds day by day: changes, tombstones and revivals are stored, a feed that
    lost more than half is refused, another signature of a template is no change."""
    return _said(spark, _lake_of_snapshots(spark, sf)[1])


@register(
    "lake_snapshot_versions",
    """
with c as (select 'CVE-2024-' || lpad(c_custkey::varchar, 7, '0') as cve, c_mktsegment as m,
                  c_acctbal < 0 as low from customer)
select cve, '2024-01-01' as fetched_date, m as product, false as removed from c where m <> 'BUILDING'
union all
select cve, '2024-01-02', case when m = 'MACHINERY' then m when low then 'other' else m end, m = 'MACHINERY'
from c where m in ('BUILDING', 'MACHINERY') or low
union all
select cve, '2024-01-04', m, false from c where m = 'MACHINERY' or low""",
)
def lake_snapshot_versions(spark: SparkSession, sf: str) -> DataFrame:
    """What the snapshot runs stored, tombstones with the last known values."""
    stored = _lake_of_snapshots(spark, sf)[0].table("kev_history")
    return stored.select("cve", F.col("fetched_date").cast("string").alias("fetched_date"), "product", "removed")


def _releases(parts: DataFrame) -> DataFrame:
    documents = parts.groupBy("p_type").agg(
        F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('<Weakness ID="'), "p_partkey", F.lit('"/>')))), "").alias("listed")
    ).selectExpr(
        """concat('<Weakness_Catalog Version="', p_type, '" Date="2024-01-02"><Weaknesses>', listed,
           '</Weaknesses></Weakness_Catalog>') as value"""
    )
    return weaknesses.weakness_rows(documents)


@register(
    "lake_releases",
    """
with v as (select p_type as batch, count(*) as n from part group by 1)
select 'cwe' as feed, 0 as step, batch, 'published' as status, n as records, 0 as bad from v
where batch in ('SMALL', 'PROMO')
union all
select 'cwe', 1, batch, case when batch in ('SMALL', 'PROMO') then 'already-registered' else 'published' end,
       case when batch in ('SMALL', 'PROMO') then 0 else n end, 0 from v""",
)
def lake_releases(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog releases: a version is stored whole and once."""
    lake, parts = _new_lake(spark), table(spark, sf, "part")
    some = parts.where("p_type IN ('SMALL', 'PROMO')")
    steps = [("cwe", 0, r) for r in ingest.add_releases(lake, _releases(some))]
    steps += [("cwe", 1, r) for r in ingest.add_releases(lake, _releases(parts))]
    return _said(spark, steps)


@register(
    "lake_technique_runs",
    """
with s as (select count(*) as n from supplier)
select 'attack' as feed, day as step, '2024-01-0' || day as batch, 'published' as status, 2 * n as records, 0 as bad
from s, (select unnest([1, 2]) as day)
union all
select 'attack', day, '2024-01-0' || day, 'published', n, 0 from s, (select unnest([1, 2]) as day)
union all
select 'attack', 3, '2024-01-02', 'already-registered', 0, 0 from s
union all
select 'capec', 1, '2024-01-01', 'published', n, 0 from s
union all
select 'capec', 2, '2024-01-01', 'already-registered', 0, 0 from s""",
)
def lake_technique_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Whole snapshots by run date: techniques with their relationships, and patterns."""
    lake = _new_lake(spark)
    bundles_ = table(spark, sf, "supplier").selectExpr(
        "s_suppkey as matrix",
        """concat('{"objects":[{"type":"attack-pattern","id":"ap--', s_suppkey, '","external_references":[',
          '{"source_name":"mitre-attack","external_id":"T', s_suppkey, '"}]},{"type":"intrusion-set","id":"g--',
          s_suppkey, '","external_references":[{"source_name":"mitre-attack","external_id":"G', s_suppkey,
          '"}]},{"type":"relationship","id":"r--', s_suppkey, '","relationship_type":"uses","source_ref":"g--',
          s_suppkey, '","target_ref":"ap--', s_suppkey, '"}]}') as value""",
    )
    patterns = bundles_.select(F.replace("value", F.lit("mitre-attack"), F.lit("capec")).alias("value"))
    steps = []
    for step, day in ((1, 1), (2, 2), (3, 2)):
        steps += [("attack", step, r) for r in ingest.add_techniques(lake, lambda: bundles_, date(2024, 1, day))]
    only = patterns.select(F.replace("value", F.lit('"intrusion-set"'), F.lit('"x-note"')).alias("value"))
    for step in (1, 2):
        steps.append(("capec", step, ingest.add_patterns(lake, lambda: only, date(2024, 1, 1))))
    return _said(spark, steps)
