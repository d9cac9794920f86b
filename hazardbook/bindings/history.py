"""Change capture, sinks, the lake and its checks over the given tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.bindings.registry import register, table
from hazardbook.bindings.world import base_tables, over_world
from hazardbook.operators.changes import (
    classify_snapshot,
    high_watermark,
    newer_or_unseen,
    newer_than,
    snapshot_changes,
    snapshot_sizes,
)
from hazardbook.operators.latest import latest_per_key
from hazardbook.plans.views import latest_view
from hazardbook.session import shared_folder
from hazardbook.sinks.files import file_ranges, write_sorted
from hazardbook.sinks.ingest import model_versions_by_year
from hazardbook.sinks.lake import table_of_path
from hazardbook.sources.records import id_year


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


@register(
    "watermark_delta",
    """
select o_orderkey, o_custkey, o_orderdate from orders
where o_orderdate > (select max(o_orderdate) from orders
                     where o_orderdate < timestamp '2000-01-01')""",
)
def watermark_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The history ends before 2000; only orders after its newest one are new."""
    orders = table(spark, sf, "orders")
    history = orders.where(F.col("o_orderdate") < _moment("2000-01-01"))
    watermark = high_watermark(history, "o_orderdate")
    return newer_than(orders, "o_orderdate", watermark).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@register(
    "same_day_delta",
    """
with h as (select * from orders where o_orderdate < timestamp '2000-01-01'
             and (o_orderstatus <> 'F' or o_orderdate < timestamp '1999-12-31'))
select o_orderkey, o_orderdate::date::varchar as day from orders
where o_orderdate > (select max(o_orderdate) from h)
   or (o_orderdate = (select max(o_orderdate) from h)
       and o_orderkey not in (select o_orderkey from h
                              where o_orderdate = (select max(o_orderdate) from h)))""",
)
def same_day_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with status F of the last stored day arrived late and are taken too."""
    feed = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "cast(o_orderdate as date) as day"
    )
    history = feed.where(
        "day < date'2000-01-01' and (o_orderstatus <> 'F' or day < date'1999-12-31')"
    )
    watermark = high_watermark(history, "day")
    fresh = newer_or_unseen(feed, history, "o_orderkey", "day", watermark)
    return fresh.select("o_orderkey", F.col("day").cast("string").alias("day"))


def _order_snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored state: newest order per customer before 1998, tombstones for status P.
    Current snapshot: newest order per customer since 1997."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate"
    )
    before = orders.where(F.col("o_orderdate") < _moment("1998-01-01"))
    since = orders.where(F.col("o_orderdate") >= _moment("1997-01-01"))
    newest = ["o_custkey"], "o_orderdate", ["o_orderkey"]
    stored = latest_per_key(before, *newest).selectExpr(
        "o_custkey", "o_orderkey", "o_orderpriority",
        "date'1998-01-01' as fetched_date", "o_orderstatus = 'P' as removed",
    )
    current = latest_per_key(since, *newest).select(
        "o_custkey", "o_orderkey", "o_orderpriority"
    )
    return current, stored


_SNAPSHOTS_SQL = """
with p as (select * from (select *, row_number() over (partition by o_custkey
             order by o_orderdate desc, o_orderkey desc) rn from orders
             where o_orderdate < timestamp '1998-01-01') where rn = 1),
c as (select * from (select *, row_number() over (partition by o_custkey
        order by o_orderdate desc, o_orderkey desc) rn from orders
        where o_orderdate >= timestamp '1997-01-01') where rn = 1),
d as (select coalesce(c.o_custkey, p.o_custkey) as o_custkey,
             case when p.o_custkey is null then 'added'
                  when c.o_custkey is null then
                       case when p.o_orderstatus <> 'P' then 'removed' end
                  when p.o_orderstatus = 'P' then 'revived'
                  when {differs} then 'changed' end as change,
             coalesce(c.o_orderkey, p.o_orderkey) as o_orderkey,
             coalesce(c.o_orderpriority, p.o_orderpriority) as o_orderpriority
      from c full join p on c.o_custkey = p.o_custkey)
"""
_BY_KEY = _SNAPSHOTS_SQL.format(differs="c.o_orderkey <> p.o_orderkey")
_BY_PRIORITY = _SNAPSHOTS_SQL.format(differs="c.o_orderpriority <> p.o_orderpriority")


@register(
    "snapshot_diff_by_digest",
    _BY_KEY
    + """
select o_custkey, o_orderkey, o_orderpriority, '2001-09-01' as fetched_date,
       change = 'removed' as removed from d where change is not null""",
)
def snapshot_diff_by_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to append when the order (as a content digest) decides on a change."""
    current, stored = _order_snapshots(spark, sf)
    rows = snapshot_changes(
        current, stored, ["o_custkey"], ["o_orderkey"], date(2001, 9, 1)
    )
    return rows.withColumn("fetched_date", F.col("fetched_date").cast("string"))


@register(
    "snapshot_diff_classes",
    _BY_PRIORITY
    + """
select coalesce(change, 'unchanged') as change, count(*) as records from d group by 1""",
)
def snapshot_diff_classes(spark: SparkSession, sf: str) -> DataFrame:
    """How many records are added, changed, revived, removed, or as they were."""
    current, stored = _order_snapshots(spark, sf)
    classes = classify_snapshot(current, stored, ["o_custkey"], ["o_orderpriority"])
    return classes.groupBy(F.coalesce("change", F.lit("unchanged")).alias("change")).agg(
        F.count("*").alias("records")
    )


@register(
    "snapshot_diff_composite_key",
    """
with p as (select user_id, event_type, max(value) as top, max(event_id) as eid
           from events where ts < timestamp '2024-01-20' group by 1, 2),
c as (select user_id, event_type, max(value) as top, max(event_id) as eid
      from events where ts >= timestamp '2024-01-05' group by 1, 2)
select coalesce(c.user_id, p.user_id) as user_id,
       coalesce(c.event_type, p.event_type) as event_type,
       case when c.user_id is null then p.top else c.top end as top,
       case when c.user_id is null then p.eid else c.eid end as eid,
       '2024-02-01' as fetched_date, c.user_id is null as removed
from c full join p on c.user_id = p.user_id and c.event_type = p.event_type
where p.user_id is null or c.user_id is null or c.top <> p.top or c.eid <> p.eid""",
)
def snapshot_diff_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    def state(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id", "event_type").agg(
            F.max("value").alias("top"), F.max("event_id").alias("eid")
        )

    events = table(spark, sf, "events")
    stored = state(events.where(F.col("ts") < _moment("2024-01-20"))).selectExpr(
        "*", "date'2024-01-20' as fetched_date", "false as removed"
    )
    current = state(events.where(F.col("ts") >= _moment("2024-01-05")))
    rows = snapshot_changes(
        current, stored, ["user_id", "event_type"], ["top", "eid"], date(2024, 2, 1)
    )
    return rows.withColumn("fetched_date", F.col("fetched_date").cast("string"))


@register(
    "shrink_guard",
    """
with s as (select count(distinct o_custkey) as n from orders
           where o_orderdate >= timestamp '2001-07-01'),
p as (select o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) as st
      from orders group by 1)
select s.n as current_records, count(*) as stored_records,
       count(*) filter (st <> 'P') as active_records,
       s.n * 2 < count(*) filter (st <> 'P') as refused
from p, s group by s.n""",
)
def shrink_guard(spark: SparkSession, sf: str) -> DataFrame:
    """A feed of the last month only is compared with all stored customers."""
    orders = table(spark, sf, "orders")
    current = (
        orders.where(F.col("o_orderdate") >= _moment("2001-07-01"))
        .select("o_custkey")
        .distinct()
    )
    stored = latest_per_key(
        orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]
    ).selectExpr("o_custkey", "o_orderstatus = 'P' as removed")
    return snapshot_sizes(current, stored)


@register(
    "versioned_snapshot",
    """
select p_type as version, count(*) as records from part
where p_type not in (select p_type from part where p_size = 1 group by 1
                     having count(*) >= 14)
group by 1""",
)
def versioned_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Whole snapshots of the versions that are not stored yet."""
    parts = table(spark, sf, "part")
    stored = (
        parts.where("p_size = 1").groupBy("p_type").count().where("count >= 14")
    ).select("p_type")
    fresh = parts.join(stored, "p_type", "left_anti")
    return fresh.groupBy(F.col("p_type").alias("version")).agg(
        F.count("*").alias("records")
    )


# ------------------------------------------------------------------ sinks and the lake


@register(
    "sorted_batch",
    """
select l_returnflag, count(*) as rows, sum(l_quantity)::bigint as quantity
from lineitem group by 1""",
)
def sorted_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Line items written as one sorted batch of zstd files and read back."""
    path = f"{shared_folder(spark)}/sorted-{uuid.uuid4().hex}"
    write_sorted(table(spark, sf, "lineitem"), path, ["l_orderkey", "l_linenumber"])
    return (
        spark.read.parquet(path)
        .groupBy("l_returnflag")
        .agg(
            F.count("*").alias("rows"),
            F.sum("l_quantity").cast("long").alias("quantity"),
        )
    )


@register(
    "sorted_batch_files",
    """
select count(*) as rows, 0 as unsorted_rows, 0 as overlapping_files,
       min(l_orderkey) as first_order, max(l_orderkey) as last_order
from lineitem""",
)
def sorted_batch_files(spark: SparkSession, sf: str) -> DataFrame:
    """Order inside and between the files of a sorted batch, from the stored files."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    path = f"{shared_folder(spark)}/sorted-{uuid.uuid4().hex}"
    write_sorted(table(spark, sf, "lineitem"), path, keys)
    return file_ranges(spark.read.parquet(path), keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("unsorted_rows").alias("unsorted_rows"),
        F.count_if("overlaps").alias("overlapping_files"),
        F.min("low.l_orderkey").alias("first_order"),
        F.max("high.l_orderkey").alias("last_order"),
    )


@register(
    "score_models_per_year",
    over_world("""
select year(date) as year, string_agg(distinct model_version, ', ') as models
from epss group by 1"""),
)
def score_models_per_year(spark: SparkSession, sf: str) -> DataFrame:
    return model_versions_by_year(base_tables(spark, sf)["epss"])


@register(
    "record_rows_per_id_year",
    over_world("""
select substr(cve, 5, 4)::int as year, count(*) as records from cve_history group by 1"""),
)
def record_rows_per_id_year(spark: SparkSession, sf: str) -> DataFrame:
    records = base_tables(spark, sf)["cve_history"]
    return records.groupBy(id_year(F.col("cve")).alias("year")).agg(
        F.count("*").alias("records")
    )


@register(
    "path_routing",
    """
select case when e.path like 'epss/%' then 'epss' when e.path like 'cve/%' then 'cve_history'
            when e.path like 'attack/relationships/%' then 'attack_relationship_history'
            when e.path like 'attack/updates/%' then 'attack_history' end as table_name,
       count(*) as paths
from (select unnest(['epss/year=' || user_id, 'cve/updates/' || user_id,
        'attack/relationships/' || user_id, 'attack/updates/' || user_id,
        'other/' || user_id]) as path from events) e group by 1""",
)
def path_routing(spark: SparkSession, sf: str) -> DataFrame:
    """Stored paths to tables by folder; unknown folders are counted under NULL."""
    paths = table(spark, sf, "events").selectExpr(
        "explode(array(concat('epss/year=', user_id), concat('cve/updates/', user_id),"
        " concat('attack/relationships/', user_id), concat('attack/updates/', user_id),"
        " concat('other/', user_id))) as path"
    )
    return paths.groupBy(table_of_path(F.col("path")).alias("table_name")).agg(
        F.count("*").alias("paths")
    )


@register(
    "active_records",
    over_world("""
select count(*) as stored, count(*) filter (not removed) as active from kev"""),
)
def active_records(spark: SparkSession, sf: str) -> DataFrame:
    latest = latest_view(base_tables(spark, sf), "kev_history")
    return latest.agg(
        F.count("*").alias("stored"), F.count_if(~F.col("removed")).alias("active")
    )
