"""Generic operators on the given tables: joins, arrays, aggregates, windows, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.bindings.registry import register, spread, table
from hazardbook.functions.cvss import is_valid_v3, v3_base_score, vector_version
from hazardbook.functions.identifiers import (
    excerpt_around,
    extract_identifiers,
    identifier_family,
)
from hazardbook.functions.jsontext import canonical_json, json_path, json_string, number_text
from hazardbook.functions.markup import (
    frontmatter_block,
    frontmatter_entries,
    frontmatter_value,
    plain_text,
)
from hazardbook.functions.nested import affected_ranges
from hazardbook.functions.strings import (
    blank_to_null,
    comma_items,
    content_digest,
    find_cve_ids,
    only_cve_ids,
    parse_int,
    url_from,
)
from hazardbook.functions.times import (
    first_iso_date,
    first_year,
    iso_date,
    iso_timestamp,
)
from hazardbook.operators.arrays import (
    count_per_item,
    join_on_item,
    unnest,
    where_contains,
)
from hazardbook.operators.latest import (
    as_of,
    first_per_key,
    latest_per_key,
    latest_snapshot,
)
from hazardbook.operators.presence import Source, key_union, presence_matrix
from hazardbook.operators.quality import (
    path_differences,
    quality_counts,
    table_statistics,
)
from hazardbook.operators.references import resolve_ends
from hazardbook.sources.changelog import public_url


def _tokens(parts: DataFrame) -> DataFrame:
    return parts.select("p_partkey", F.split("p_name", " ").alias("tokens"))


# ------------------------------------------------------------------ one row per key


@register(
    "latest_event_per_user",
    """
select user_id, event_id, ts, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
  from events) where rn = 1""",
)
def latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return latest_per_key(events, ["user_id"], "ts", ["event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value"
    )


@register(
    "latest_event_per_user_and_type",
    """
select user_id, event_type, event_id, ts from (
  select *, row_number() over (partition by user_id, event_type
                               order by ts desc, event_id desc) rn
  from events) where rn = 1""",
)
def latest_event_per_user_and_type(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    keys = ["user_id", "event_type"]
    return latest_per_key(events, keys, "ts", ["event_id"]).select(*keys, "event_id", "ts")


@register(
    "customers_with_latest_order",
    """
select c_custkey, c_name, o.o_orderkey, o.o_totalprice from customer
left join (select * from (select *, row_number() over (
             partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn
           from orders) where rn = 1) o on c_custkey = o.o_custkey""",
)
def customers_with_latest_order(spark: SparkSession, sf: str) -> DataFrame:
    newest = latest_per_key(
        table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]
    ).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return customers.join(newest, "c_custkey", "left")


@register(
    "newest_order_snapshot",
    """
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderdate = (select max(o_orderdate) from orders)""",
)
def newest_order_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return latest_snapshot(table(spark, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@register(
    "orders_as_of",
    """
select o_custkey, o_orderkey, o_orderdate from (
  select *, row_number() over (partition by o_custkey
                               order by o_orderdate desc, o_orderkey desc) rn
  from orders where o_orderdate <= timestamp '1998-12-31') where rn = 1""",
)
def orders_as_of(spark: SparkSession, sf: str) -> DataFrame:
    moment = F.lit("1998-12-31").cast("timestamp_ntz")
    orders = table(spark, sf, "orders")
    return as_of(orders, ["o_custkey"], "o_orderdate", moment, ["o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate"
    )


@register(
    "first_document_per_text",
    """
select doc_id, source from (
  select *, row_number() over (partition by text order by doc_id) rn from documents)
where rn = 1""",
)
def first_document_per_text(spark: SparkSession, sf: str) -> DataFrame:
    """First-wins deduplication on whole texts; the digest keeps the shuffle narrow."""
    documents = table(spark, sf, "documents").select(
        "doc_id", "source", F.sha2("text", 256).alias("digest")
    )
    return first_per_key(documents, ["digest"], ["doc_id"]).drop("digest")


@register(
    "first_document_per_source",
    """
select source, min(doc_id) as doc_id from documents group by source""",
)
def first_document_per_source(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("source", "doc_id")
    return first_per_key(documents, ["source"], ["doc_id"])


# ---------------------------------------------------------------------------- joins


@register(
    "presence_of_keys",
    """
select k.id, c.n is not null as has_customer, o.n is not null as has_order,
       e.n is not null as has_event, s.n is not null as has_supplier,
       coalesce(o.n, 0) as order_count, coalesce(e.n, 0) as event_count
from (select c_custkey as id from customer union select o_custkey from orders
      union select user_id from events union select s_suppkey from supplier) k
left join (select c_custkey as id, count(*) n from customer group by 1) c using (id)
left join (select o_custkey as id, count(*) n from orders group by 1) o using (id)
left join (select user_id as id, count(*) n from events group by 1) e using (id)
left join (select s_suppkey as id, count(*) n from supplier group by 1) s using (id)""",
)
def presence_of_keys(spark: SparkSession, sf: str) -> DataFrame:
    def keys(name: str, column: str) -> DataFrame:
        return table(spark, sf, name).select(F.col(column).alias("id"))

    return presence_matrix(
        [
            Source("customer", keys("customer", "c_custkey")),
            Source("order", keys("orders", "o_custkey"), "order_count"),
            Source("event", keys("events", "user_id"), "event_count"),
            Source("supplier", keys("supplier", "s_suppkey")),
        ],
        "id",
    )


@register(
    "key_union",
    """
select c_custkey as id from customer union select o_custkey from orders
union select user_id from events""",
)
def union_of_keys(spark: SparkSession, sf: str) -> DataFrame:
    return key_union(
        [
            table(spark, sf, name).select(F.col(column).alias("id"))
            for name, column in (
                ("customer", "c_custkey"),
                ("orders", "o_custkey"),
                ("events", "user_id"),
            )
        ],
        "id",
    )


@register(
    "array_join_inner",
    """
with t as (select p_partkey, string_split(p_name || ' ' || p_name, ' ') as tokens from part),
b as (select p_brand, split_part(min(p_name), ' ', 1) as word from part group by 1)
select p_partkey, p_brand from t join b on list_contains(t.tokens, b.word)""",
)
def array_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    """Parts joined to brands by a word of their name; repeats in the array match once."""
    parts = table(spark, sf, "part")
    tokens = parts.select(
        "p_partkey", F.split(F.concat_ws(" ", "p_name", "p_name"), " ").alias("tokens")
    )
    brands = parts.groupBy("p_brand").agg(
        F.split_part(F.min("p_name"), F.lit(" "), F.lit(1)).alias("word")
    )
    return join_on_item(tokens, brands, "tokens", "word").select("p_partkey", "p_brand")


@register(
    "array_join_left",
    """
with t as (select p_partkey, string_split(p_name, ' ') as tokens from part),
w as (select split_part(p_name, ' ', 1) as word, min(p_partkey) as first_part
      from part where p_size > 48 and p_retailprice > 1000 group by 1)
select p_partkey, word, first_part from t left join w on list_contains(t.tokens, w.word)""",
)
def array_join_left(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    words = (
        parts.where("p_size > 48 and p_retailprice > 1000")
        .groupBy(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
        .agg(F.min("p_partkey").alias("first_part"))
    )
    return join_on_item(
        _tokens(parts), words, "tokens", "word", how="left", row_key=["p_partkey"]
    ).drop("tokens")


@register(
    "unnest_outer_join",
    """
select p.p_partkey, u.token, d.parts
from (select p_partkey, case when p_size > 25 then []::varchar[]
             else string_split(p_name, ' ') end as tokens from part) p
left join unnest(p.tokens) as u(token) on true
left join (select split_part(p_name, ' ', 2) as token, count(*) as parts
           from part group by 1) d on d.token = u.token""",
)
def unnest_outer_join(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with an empty array stay, with a NULL entry that joins to nothing."""
    parts = table(spark, sf, "part")
    tokens = parts.select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.array().cast("array<string>"))
        .otherwise(F.split("p_name", " "))
        .alias("tokens"),
    )
    counted = parts.groupBy(
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("token")
    ).agg(F.count("*").alias("parts"))
    return (
        unnest(tokens, "tokens", "token", keep_empty=True)
        .drop("tokens")
        .join(counted, "token", "left")
    )


@register(
    "unnest_count",
    """
select token, count(*) as uses
from (select unnest(string_split(text, ' ')) as token from documents) group by 1""",
)
def unnest_count(spark: SparkSession, sf: str) -> DataFrame:
    """Uses of every word of every whole text."""
    words = spread(table(spark, sf, "documents")).select(F.split("text", " ").alias("words"))
    return count_per_item(words, "words", "token", "uses")


@register(
    "array_filter",
    """
select p_partkey, p_name from part where list_contains(string_split(p_name, ' '), 'ring')""",
)
def array_filter(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").withColumn("tokens", F.split("p_name", " "))
    return where_contains(parts, "tokens", "ring").select("p_partkey", "p_name")


@register(
    "resolved_references",
    """
with o as (select 0 as kind, 's' || s_suppkey as id, s_name as name from supplier
           union all select 0, 'p' || p_partkey, p_name from part)
select l.l_orderkey, l.l_linenumber, s.name as source_name, p.name as target_name
from lineitem l
left join o s on s.id = 's' || l.l_suppkey
left join o p on p.id = 'p' || (l.l_partkey * 2)""",
)
def resolved_references(spark: SparkSession, sf: str) -> DataFrame:
    """Both ends of every line item looked up in one object table; half of the target
    references lead nowhere."""
    objects = (
        table(spark, sf, "supplier")
        .selectExpr("concat('s', s_suppkey) as id", "s_name as name")
        .unionByName(
            table(spark, sf, "part").selectExpr("concat('p', p_partkey) as id", "p_name as name")
        )
        .withColumn("position", F.lit(0))
    )
    edges = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "concat('s', l_suppkey) as source_ref",
        "concat('p', l_partkey * 2) as target_ref",
    )
    resolved = resolve_ends(
        edges,
        objects,
        (),
        "id",
        ("name",),
        (("source_ref", "source"), ("target_ref", "target")),
        "position",
    )
    return resolved.drop("source_ref", "target_ref")


@register(
    "left_join_with_condition",
    """
select n_nationkey, n_name, count(s_suppkey) as rich_suppliers
from nation left join supplier on n_nationkey = s_nationkey and s_acctbal > 5000
group by 1, 2""",
)
def left_join_with_condition(spark: SparkSession, sf: str) -> DataFrame:
    """The extra condition filters the right side before the join."""
    rich = (
        table(spark, sf, "supplier")
        .where("s_acctbal > 5000")
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.count("*").alias("rich_suppliers"))
    )
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return nations.join(rich, "n_nationkey", "left").na.fill(0, ["rich_suppliers"])


# ----------------------------------------------------------------------- aggregates


@register(
    "summary_with_distinct_counts",
    """
select c_custkey, c_mktsegment, count(distinct o_orderkey) as orders,
       count(distinct event_id) as events
from customer left join orders on o_custkey = c_custkey
left join events on user_id = c_custkey group by 1, 2""",
)
def summary_with_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Each branch is counted before the join, so branches do not multiply."""

    def per_key(name: str, key: str, unique: str, count: str) -> DataFrame:
        return (
            table(spark, sf, name)
            .groupBy(F.col(key).alias("c_custkey"))
            .agg(F.countDistinct(unique).alias(count))
        )

    return (
        table(spark, sf, "customer")
        .select("c_custkey", "c_mktsegment")
        .join(per_key("orders", "o_custkey", "o_orderkey", "orders"), "c_custkey", "left")
        .join(per_key("events", "user_id", "event_id", "events"), "c_custkey", "left")
        .na.fill(0, ["orders", "events"])
    )


@register(
    "conditional_pivot",
    """
select user_id, max(case when event_type = 'view' then value end) as view,
       max(case when event_type = 'click' then value end) as click,
       max(case when event_type = 'purchase' then value end) as purchase
from events group by 1""",
)
def conditional_pivot(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(
            *[
                F.max(F.when(kind == name, F.col("value"))).alias(name)
                for name in ("view", "click", "purchase")
            ]
        )
    )


@register(
    "table_statistics",
    """
select 'events' as name, count(*) as row_count, min(ts) as min_value, max(ts) as max_value
from events
union all select 'orders', count(*), min(o_orderdate), max(o_orderdate) from orders
union all select 'lineitem', count(*), min(l_shipdate), max(l_shipdate) from lineitem""",
)
def statistics_of_tables(spark: SparkSession, sf: str) -> DataFrame:
    result = None
    for name, column in (
        ("events", "ts"),
        ("orders", "o_orderdate"),
        ("lineitem", "l_shipdate"),
    ):
        rows = table_statistics(table(spark, sf, name), column).select(
            F.lit(name).alias("name"), "*"
        )
        result = rows if result is None else result.unionByName(rows)
    return result


@register(
    "distinct_dates",
    """
select count(distinct o_orderdate) as days, count(*) as orders from orders""",
)
def distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(
        F.countDistinct("o_orderdate").alias("days"), F.count("*").alias("orders")
    )


@register(
    "values_per_year",
    """
select year(o_orderdate) as year, string_agg(distinct o_orderstatus, ', '
       order by o_orderstatus) as statuses from orders group by 1""",
)
def values_per_year(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct small values of each year, sorted and joined."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("year"))
        .agg(
            F.array_join(F.sort_array(F.collect_set("o_orderstatus")), ", ").alias(
                "statuses"
            )
        )
    )


@register("distinct_values", "select distinct p_brand, p_type from part")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@register(
    "record_quality_by_language",
    """
select lang, count(*) filter (n_chars >= 500) as records,
       count(*) filter (n_chars < 500) as bad from documents group by 1""",
)
def record_quality_by_language(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return quality_counts(documents, F.col("n_chars") >= 500, "lang")


# ----------------------------------------------------------------- sorting, top rows


@register(
    "top_event",
    """
select event_id, user_id, value from events order by value desc, event_id limit 10""",
)
def top_event(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return events.orderBy(F.col("value").desc(), "event_id").limit(10)


@register(
    "sort_with_missing_values",
    """
select c_custkey, c_name from customer
order by case when c_acctbal >= 0 then c_acctbal end asc nulls first, c_custkey limit 100""",
)
def sort_with_missing_values(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred where a missing value sorts as the smallest."""
    keyed = table(spark, sf, "customer").withColumn(
        "balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    )
    top = keyed.orderBy(F.col("balance").asc_nulls_first(), "c_custkey").limit(100)
    return top.select("c_custkey", "c_name")


# --------------------------------------------------------------------- set operations


@register(
    "path_set_check",
    """
with s as (select 'orders/' || o_custkey as path from orders),
r as (select 'orders/' || c_custkey as path from customer where c_acctbal > 0)
select coalesce(s.path, r.path) as path,
       case when r.path is null then 'stray' else 'missing' end as problem
from (select distinct path from s) s full join (select distinct path from r) r
  on s.path = r.path
where s.path is null or r.path is null""",
)
def path_set_check(spark: SparkSession, sf: str) -> DataFrame:
    stored = table(spark, sf, "orders").selectExpr("concat('orders/', o_custkey) as path")
    registered = (
        table(spark, sf, "customer")
        .where("c_acctbal > 0")
        .selectExpr("concat('orders/', c_custkey) as path")
    )
    return path_differences(stored, registered, "path")


# -------------------------------------------------------------------- filters, lookups


@register(
    "point_lookup", "select c_custkey, c_name, c_acctbal from customer where c_custkey = 42"
)
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "customer")
        .where("c_custkey = 42")
        .select("c_custkey", "c_name", "c_acctbal")
    )


@register(
    "compound_filter",
    """
select event_id, user_id, value from events
where event_type = 'purchase' and value > 200 and not (user_id < 100)""",
)
def compound_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").where(
        (F.col("event_type") == "purchase")
        & (F.col("value") > 200)
        & ~(F.col("user_id") < 100)
    )
    return rows.select("event_id", "user_id", "value")


# ------------------------------------------------------------------- column functions


@register(
    "json_field",
    """
select event_id, json_extract_string(props, '$.k') as k,
       (json_extract_string(props, '$.k'))::int as number from events""",
)
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    k = json_path(F.col("props"), "$.k")
    return table(spark, sf, "events").select(
        "event_id", k.alias("k"), parse_int(k).alias("number")
    )


@register(
    "canonical_json_text",
    """
select event_id, '{"a":' || (json_extract_string(props, '$.k')) || ',"b":"' || event_type
       || '"}' as canonical, event_type as text_field, null::varchar as number_field
from events""",
)
def canonical_json_text(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted keys; only JSON strings count as text."""
    written = F.concat(
        F.lit('{ "b" : "'), "event_type", F.lit('" , "a" : '),
        F.get_json_object("props", "$.k"), F.lit("}"),
    )
    rows = table(spark, sf, "events").select("event_id", written.alias("written"))
    v = F.try_parse_json("written")
    return rows.select(
        "event_id",
        canonical_json(F.col("written")).alias("canonical"),
        json_string(v, "$.b").alias("text_field"),
        json_string(v, "$.a").alias("number_field"),
    )


@register(
    "timestamp_normalisation",
    """
select o_orderkey,
       case o_orderstatus when 'O' then o_orderdate + interval 3 hours
            when 'F' then o_orderdate - interval 330 minutes end as at,
       case when o_orderstatus <> 'P' then o_orderdate::date::varchar end as day,
       case when o_orderstatus <> 'P' then o_orderdate::date::varchar end as first_day,
       coalesce(case when o_orderstatus <> 'P' then year(o_orderdate) end, 1970) as year
from orders""",
)
def timestamp_normalisation(spark: SparkSession, sf: str) -> DataFrame:
    """ISO texts with and without an offset, and texts that are none."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case o_orderstatus when 'O' then date_format(o_orderdate, \"yyyy-MM-dd'T03:00:00Z'\")"
        " when 'F' then date_format(o_orderdate, \"yyyy-MM-dd'T00:00:00.000+05:30'\")"
        " else string(year(o_orderdate)) end as text",
        "if(o_orderstatus = 'P', date_format(o_orderdate, 'yyyy-M'),"
        " date_format(o_orderdate, 'yyyy-MM-dd')) as day_text",
    )
    day = iso_date(F.col("day_text"))
    return rows.select(
        "o_orderkey",
        iso_timestamp(F.col("text")).alias("at"),
        day.cast("string").alias("day"),
        first_iso_date(F.concat(F.lit("since "), "day_text", F.lit("!")))
        .cast("string")
        .alias("first_day"),
        first_year(day, default=F.lit(1970)).alias("year"),
    )


# Forms of one moment, the offset in minutes to subtract, and the seconds they keep.
_FORMS = (
    ("date_format(t, \"yyyyMMdd'T'HHmmss'Z'\")", 0, "second"),
    ("date_format(t, \"yyyy-MM-dd'T'HH\")", 0, "hour"),
    ("date_format(t, \"yyyy-MM-dd HHmm\")", 0, "minute"),
    ("date_format(t, \"yyyy-MM-dd'T'HH:mm:ss,5+02\")", 120, "half"),
    ("date_format(t, \"yyyy-MM-dd_HH:mm:ss.1234567-0130\")", -90, "fraction"),
    ("concat(iso_year, '-W', iso_week, '-', iso_day, date_format(t, \"'T'HH:mm:ss-00:30:15\"))", -30.25, "second"),
    ("concat(iso_year, 'W', iso_week, iso_day)", 0, "day"),
    ("concat(iso_year, '-W', iso_week)", 0, "week"),
    ("date_format(t, \"yyyyMMdd'Z'\")", 0, "day"),
    ("date_format(t, 'yyyy-DDD')", 0, None),
    ("concat(year(t), '-W54')", 0, None),
    ("date_format(t, \"yyyy-MM-dd'T'24:00:00\")", 0, None),
    ("date_format(t, \"yyyy-MM-dd'T'HH:mmss\")", 0, None),
    ("date_format(t, 'yyyy-MM')", 0, None),
    ("date_format(t, \"yyyy-MM-dd'T'HH:mm:ss+0\")", 0, None),
)
_KEPT = {
    "second": "t", "hour": "date_trunc('hour', t)", "minute": "date_trunc('minute', t)",
    "half": "t + interval 500 milliseconds", "fraction": "t + interval 123456 microseconds",
    "day": "date_trunc('day', t)", "week": "date_trunc('week', t)",
}


def _form_sql(form: int) -> str:
    _, minutes, kept = _FORMS[form]
    at = "null" if kept is None else f"{_KEPT[kept]} - to_seconds({int(minutes * 60)})"
    day = "t::date" if form == 6 else "date_trunc('week', t)::date" if form == 7 else "null"
    return f"select o_orderkey, {form} as form, ({at})::timestamp as at, ({day})::date::varchar as day from r"


@register(
    "iso_time_forms",
    "with r as (select o_orderkey, o_orderdate + to_seconds(o_orderkey * 7919 + o_custkey) as t from orders)\n"
    + "\nunion all\n".join(_form_sql(i) for i in range(len(_FORMS))),
)
def iso_time_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Compact, reduced and week forms, comma fractions and offsets of moments, and
    texts that look like them but are none."""
    moments = spread(table(spark, sf, "orders")).selectExpr(
        "o_orderkey",
        "o_orderdate + make_dt_interval(0, 0, 0, cast(o_orderkey * 7919 + o_custkey as decimal(18, 6))) as t",
    ).selectExpr(
        "*", "extract(YEAROFWEEK from t) as iso_year", "lpad(weekofyear(t), 2, '0') as iso_week",
        "weekday(t) + 1 as iso_day",
    )
    forms = ", ".join(f"{i}, {text}" for i, (text, _, _) in enumerate(_FORMS))
    texts = moments.selectExpr("o_orderkey", f"stack({len(_FORMS)}, {forms}) as (form, text)")
    return texts.select(
        "o_orderkey", "form", iso_timestamp(F.col("text")).alias("at"),
        iso_date(F.col("text")).cast("string").alias("day"),
    )


@register(
    "number_texts",
    """
select p_partkey, form, case form when 0 then p_retailprice when 1 then p_retailprice when 2 then p_size * 1000.0
       when 3 then p_size / 10.0 when 4 then p_size * 100.0 end::double as number
from part, (select unnest(range(9)) as form)""",
)
def number_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers as the feeds write them, and texts that only Java takes for numbers."""
    texts = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "stack(9, 0, string(p_retailprice), 1, concat(' +', p_retailprice, '\\n'), 2, concat(p_size, '_000'),"
        " 3, concat(p_size, 'e-1'), 4, concat(p_size, '.E+2'), 5, concat(p_retailprice, 'd'),"
        " 6, concat(p_retailprice, 'f'), 7, concat('0x', p_size), 8, concat(p_size, '__0')) as (form, text)",
    )
    return texts.select("p_partkey", "form", number_text(F.col("text")).alias("number"))


@register(
    "cvss_four_vectors",
    """
select c_custkey, form, case when form < 3 then '4.0' end as version
from customer, (select unnest(range(9)) as form)""",
)
def cvss_four_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Well-formed CVSS 4.0 vectors, and ones with a metric that is missing, repeated,
    unknown or out of range, or with an empty part."""
    vectors = spread(table(spark, sf, "customer")).selectExpr(
        "c_custkey",
        "concat('/AV:', substr('NALP', 1 + c_custkey % 4, 1), '/AC:L/AT:N/PR:', substr('NLH', 1 + c_custkey % 3, 1),"
        " '/UI:A/VC:H/VI:L/VA:N/SC:N/SI:N') as most",
    ).selectExpr(
        "c_custkey",
        "stack(9, 0, concat('CVSS:4.0', most, '/SA:L'), 1, concat('CVSS:4.0/SA:L', most, '/E:A/MSI:S'),"
        " 2, concat('CVSS:4.0', most, '/SA:L/U:Amber'), 3, concat('CVSS:4.0', most),"
        " 4, concat('CVSS:4.0', most, '/SA:L/SA:L'), 5, concat('CVSS:4.0', most, '/SA:L/ZZ:N'),"
        " 6, concat('CVSS:4.0', most, '/SA:S'), 7, concat('CVSS:4.0', most, '/SA:L/'),"
        " 8, concat('CVSS:4.0', most, '/SA:L/U:Blue')) as (form, vector)",
    )
    return vectors.select("c_custkey", "form", vector_version(F.col("vector")).alias("version"))


@register(
    "text_clean_up",
    """
select p_partkey, case when p_size > 25 then p_brand end as brand,
       case when p_size > 10 then p_size end as number,
       array_to_string(string_split(p_name, ' '), ',') as items,
       case when p_size > 25 then 'CVE-2024-' || p_partkey else '' end as cve_items,
       'CVE-2020-' || p_partkey || ',CVE-2020-' || p_partkey as found,
       'https://example.org/' || p_partkey as url,
       sha256('a' || chr(10) || p_name) as digest
from part""",
)
def text_clean_up(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "if(p_size > 25, p_brand, '') as brand",
        "if(p_size > 10, concat(' ', p_size, ' '), concat(p_size, '.0')) as number",
        "concat(' ', replace(p_name, ' ', ' , '), ',,') as items",
        "array(concat(if(p_size > 25, 'cve-2024-', 'cve-24-'), p_partkey), 'x') as ids",
        "concat('CVE-2020-', p_partkey, ';EDB-1;CVE-2020-', p_partkey, 'x') as codes",
        "concat('a\\n# digest: ', p_brand, '\\n', p_name) as body",
    )
    return rows.select(
        "p_partkey",
        blank_to_null(F.col("brand")).alias("brand"),
        parse_int(F.col("number")).alias("number"),
        F.array_join(comma_items(F.col("items")), ",").alias("items"),
        F.array_join(only_cve_ids(F.col("ids")), ",").alias("cve_items"),
        F.array_join(find_cve_ids(F.col("codes")), ",").alias("found"),
        url_from("https://example.org/{}", F.col("p_partkey")).alias("url"),
        content_digest(F.col("body")).alias("digest"),
    )


_IDS_SQL = """
with t as (select doc_id, upper(md5(doc_id::varchar)[1:4]) as tail,
                  text || ' go-2024-' || doc_id || ', CVE-2024-' || (10000 + doc_id)
                  || ' (GHSA-abcd-12ef-' || md5(doc_id::varchar)[1:4]
                  || ') Cve-2024-' || (10000 + doc_id) || ' xCVE-2024-99999' as body
           from documents),
i as (select doc_id, body, unnest(['GO-2024-' || doc_id, 'CVE-2024-' || (10000 + doc_id),
                                   'GHSA-ABCD-12EF-' || tail]) as identifier from t),
f as (select *, instr(upper(replace(body, 'ß', 'SS')), identifier) as pos from i)
select doc_id, identifier, split_part(identifier, '-', 1) as family,
       trim(substr(body, greatest(1, pos - 60)::bigint,
            (least(length(body), pos - 1 + length(identifier) + 60)
             - greatest(1, pos - 60) + 1)::bigint)) as excerpt
from f"""


@register("identifiers_in_text", _IDS_SQL)
def identifiers_in_text(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of several families in whole texts, with the text around them."""
    rows = spread(table(spark, sf, "documents")).selectExpr(
        "doc_id",
        "concat(text, ' go-2024-', doc_id, ', CVE-2024-', 10000 + doc_id,"
        " ' (GHSA-abcd-12ef-', left(md5(string(doc_id)), 4), ') Cve-2024-',"
        " 10000 + doc_id, ' xCVE-2024-99999') as body",
    )
    rows = rows.withColumn("upper_body", F.upper("body"))
    found = rows.withColumn("identifier", F.explode(extract_identifiers(F.col("body"))))
    identifier = F.col("identifier")
    return found.select(
        "doc_id",
        "identifier",
        identifier_family(identifier).alias("family"),
        excerpt_around(F.col("body"), identifier, F.col("upper_body")).alias("excerpt"),
    )


_PLAIN_SQL = r"""
select page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(
  html, '<[^>]+>', ' ', 'g'), '&quot;', '"'), '&copy;', '©'), '&middot;', '·'),
  '&amp;', '&'),
  '[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+',
  ' ', 'g')) as text
from pages"""


@register("markup_to_text", _PLAIN_SQL)
def markup_to_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(table(spark, sf, "pages"))
    return pages.select("page_id", plain_text(F.col("html")).alias("text"))


@register(
    "frontmatter_fields",
    """
select c_custkey, c_name as title, '1998-01-02' as day,
       case c_mktsegment
         when 'BUILDING' then 'https://developers.cloudflare.com/waf/change-log/scheduled-changes/'
         when 'FURNITURE' then 'https://developers.cloudflare.com/changelog/' || c_custkey || '/'
         when 'MACHINERY' then 'https://developers.cloudflare.com/waf/change-log/' || c_custkey || '/'
         else 'https://github.com/cloudflare/cloudflare-docs/blob/production/other/'
              || c_custkey || '.mdx' end as url
from customer""",
)
def frontmatter_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Page attributes, the last of repeated ones, and the public address of a page."""
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "concat('---\\ntitle: first\\n  title: indented\\ntitle: \"', c_name,"
        " '\"\\ndate: 1998-01-02\\nempty:\\n---\\nbody: no') as page",
        "case c_mktsegment"
        " when 'BUILDING' then 'src/content/changelog/waf/scheduled-waf-release.mdx'"
        " when 'FURNITURE' then concat('src/content/changelog/waf/', c_custkey, '.mdx')"
        " when 'MACHINERY' then concat('src/content/docs/waf/change-log/', c_custkey, '.mdx')"
        " else concat('other/', c_custkey, '.mdx') end as path",
    ).withColumn("entries", frontmatter_entries(frontmatter_block(F.col("page"))))
    entries = F.col("entries")
    return rows.select(
        "c_custkey",
        frontmatter_value(entries, "title").alias("title"),
        frontmatter_value(entries, "date").alias("day"),
        public_url(F.col("path")).alias("url"),
    )


_VECTOR_PARTS = {
    "AV": ("c_nationkey < 6", "N", "c_nationkey < 12", "A", "c_nationkey < 18", "L", "P"),
    "AC": ("c_acctbal > 3000", "L", "H"),
    "PR": ("c_mktsegment = 'BUILDING'", "N", "c_mktsegment = 'MACHINERY'", "L", "H"),
    "UI": ("c_acctbal > 5000", "N", "R"),
    "S": ("c_nationkey > 12", "C", "U"),
    "C": ("c_acctbal > 8000", "H", "c_acctbal > 4000", "L", "N"),
    "I": ("c_mktsegment = 'FURNITURE'", "H", "c_acctbal < 2000", "L", "N"),
    "A": ("c_acctbal < 0", "H", "c_nationkey > 20", "L", "N"),
}


def _case(parts: tuple[str, ...]) -> str:
    pairs = zip(parts[:-1:2], parts[1:-1:2], strict=True)
    whens = " ".join(f"when {test} then '{value}'" for test, value in pairs)
    return f"case {whens} else '{parts[-1]}' end"


def _weights(metric: str, table_text: str) -> str:
    whens = " ".join(
        f"when '{pair.split('=')[0]}' then {pair.split('=')[1]}::double"
        for pair in table_text.split()
    )
    return f"case {metric} {whens} end"


_SCORE_SQL = f"""
with m as (select c_custkey, case when c_acctbal < 1000 then '3.0' else '3.1' end as version,
  {", ".join(f"{_case(parts)} as m_{name}" for name, parts in _VECTOR_PARTS.items())}
  from customer),
w as (select *,
  1 - (1 - {_weights("m_C", "H=0.56 L=0.22 N=0")}) * (1 - {_weights("m_I", "H=0.56 L=0.22 N=0")})
    * (1 - {_weights("m_A", "H=0.56 L=0.22 N=0")}) as loss,
  8.22 * {_weights("m_AV", "N=0.85 A=0.62 L=0.55 P=0.2")}
    * {_weights("m_AC", "L=0.77 H=0.44")} * {_weights("m_UI", "N=0.85 R=0.62")}
    * case when m_S = 'C' then {_weights("m_PR", "N=0.85 L=0.68 H=0.5")}
           else {_weights("m_PR", "N=0.85 L=0.62 H=0.27")} end as exploitability
  from m),
s as (select *, case when m_S = 'C' then 7.52 * (loss - 0.029) - 3.25 * pow(loss - 0.02, 15)
                     else 6.42 * loss end as impact from w)
select c_custkey, case when impact <= 0 then 0
         else ceil(round(least(10, (case when m_S = 'C' then 1.08 else 1 end)
                               * (impact + exploitability)), 5) * 10 - 1e-9) / 10 end
         ::double as score,
       version, true as valid
from s
union all
select s_suppkey + 1000000000, null, null, false from supplier"""


@register("cvss_base_score", _SCORE_SQL)
def cvss_base_score(spark: SparkSession, sf: str) -> DataFrame:
    letters = ", ".join(
        f"'/{name}:', {_case(parts)}" for name, parts in _VECTOR_PARTS.items()
    )
    good = spread(table(spark, sf, "customer")).selectExpr(
        "c_custkey",
        f"concat('CVSS:', if(c_acctbal < 1000, '3.0', '3.1'), {letters}) as vector",
    )
    broken = table(spark, sf, "supplier").selectExpr(
        "s_suppkey + 1000000000 as c_custkey",
        "concat('CVSS:3.1/AV:N/AC:L/AV:', if(s_acctbal > 0, 'N', 'X')) as vector",
    )
    vector = F.col("vector")
    return good.unionByName(broken).select(
        "c_custkey",
        v3_base_score(vector).alias("score"),
        vector_version(vector).alias("version"),
        is_valid_v3(vector).alias("valid"),
    )


_EVENT_KINDS = (
    "l_returnflag",
    "case when l_tax < 0.03 then 'A' when l_tax < 0.06 then 'R' else 'N' end",
    "case when l_discount < 0.04 then 'N' when l_discount < 0.08 then 'A' else 'R' end",
    "case when l_linestatus = 'F' then 'R' else 'N' end",
    "case when l_quantity > 25 then 'A' else 'R' end",
    "'R'",
)
_RANGES_SQL = f"""
with b as (select row_number() over () as id, l_orderkey,
                  [{", ".join(_EVENT_KINDS)}] as kinds from lineitem),
e as (select id, l_orderkey, unnest(kinds) as kind,
             unnest(range(1, {len(_EVENT_KINDS) + 1})) as i from b),
n as (select *, sum(case when kind = 'A' then 1 else 0 end)
                over (partition by id order by i) as seg from e),
g as (select id, seg, max(case when kind = 'A' then i end) as introduced,
             max(case when kind = 'R' then i end) as fixed,
             max(case when kind = 'N' then i end) as last_affected
      from n where seg > 0 group by 1, 2),
r as (select id, string_agg('pkg/v' || introduced || '/' || coalesce('v' || fixed, '-')
             || '/' || coalesce('v' || last_affected, '-'), ';' order by seg) as ranges
      from g group by 1)
select b.l_orderkey, coalesce(r.ranges, 'pkg/-/-/-') as ranges
from b left join r using (id)"""


@register("affected_version_ranges", _RANGES_SQL)
def affected_version_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Introduced / fixed / last affected events of every line item folded to ranges."""
    events = ", ".join(
        f"named_struct('introduced', if({kind} = 'A', 'v{i}', null),"
        f" 'fixed', if({kind} = 'R', 'v{i}', null),"
        f" 'last_affected', if({kind} = 'N', 'v{i}', null))"
        for i, kind in enumerate(_EVENT_KINDS, start=1)
    )
    packages = spread(table(spark, sf, "lineitem")).selectExpr(
        "l_orderkey",
        "array(named_struct('package', named_struct('ecosystem', 'pkg', 'name', ''),"
        f" 'ranges', array(named_struct('events', array({events}))))) as affected",
    )
    dash = F.lit("-")
    texts = F.transform(
        affected_ranges(F.col("affected")),
        lambda a: F.concat_ws(
            "/",
            a["ecosystem"],
            *[F.coalesce(a[c], dash) for c in ("introduced", "fixed", "last_affected")],
        ),
    )
    return packages.select("l_orderkey", F.array_join(texts, ";").alias("ranges"))
