"""Work and memory that must not grow faster than the rows."""

from __future__ import annotations

from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import functions as F

from hazardbook.bindings import jobs, registry
from hazardbook.functions import cvss
from hazardbook.functions.nested import affected_ranges
from hazardbook.functions.times import iso_date, iso_timestamp
from hazardbook.sinks import files, ingest
from hazardbook.sinks.lake import BatchResult
from hazardbook.sources import advisories, bundles, exploited, records


def plan_of(rows) -> str:
    out = StringIO()
    with redirect_stdout(out):
        rows.explain("extended")
    return out.getvalue().split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_a_time_text_is_matched_a_few_times_only(spark):
    texts = spark.createDataFrame([("2024-W01-1T03:04+01",), ("20240102",)], "text string")
    rows = texts.select(iso_timestamp(F.col("text")).alias("at"), iso_date(F.col("text")).alias("day"))
    plan = plan_of(rows).lower()
    assert plan.count("regexp") + plan.count("rlike") <= 10
    assert [(str(r["at"]), str(r["day"])) for r in rows.collect()] == [
        ("2024-01-01 02:04:00", "None"), ("2024-01-02 00:00:00", "2024-01-02"),
    ]


def test_a_larger_table_is_spread_over_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(registry, "ROWS_A_TASK", 10)
    rows = spark.range(1000, numPartitions=2).selectExpr("id", "id % 3 as kind")
    spread = registry.spread(rows)
    assert spread.rdd.getNumPartitions() == 100
    assert spread.agg(F.count("*"), F.sum("id")).head()[:] == (1000, 499500)


def test_snapshot_feeds_are_parsed_by_all_cores(spark, tmp_path, monkeypatch):
    spark.range(5).selectExpr(
        "id as c_custkey", "'BUILDING' as c_mktsegment", "1.0D as c_acctbal"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(5).selectExpr("id as p_partkey", "1 as p_size").write.parquet(f"{tmp_path}/part.parquet")
    spread = []
    monkeypatch.setattr(jobs, "spread", lambda scan: spread.append(scan.columns[0]) or scan)
    for job in ("add_exploited", "add_templates"):
        monkeypatch.setattr(ingest, job, lambda *_: BatchResult("published"))
    jobs._lake_of_snapshots(spark, str(tmp_path))
    assert spread == ["c_custkey", "p_partkey"]


def test_files_are_checked_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_A_CHUNK", 3)
    for keys in ([1, 2, 3, 2, 5, 4, 6], [6, 7, 8, 9]):  # out of order at a chunk's end and inside
        rows = spark.createDataFrame([(k,) for k in keys], "k int").coalesce(1)
        rows.write.mode("append").parquet(str(tmp_path / "stored"))
    found = files.file_ranges(spark.read.parquet(str(tmp_path / "stored")), ["k"]).sort("low")
    assert [(r["rows"], r["low"]["k"], r["high"]["k"], r["unsorted_rows"], r["overlaps"]) for r in found.collect()] == [
        (7, 1, 6, 2, False), (4, 6, 9, 0, False),
    ]


def test_range_starts_are_worked_out_once(spark):
    event = "struct<introduced:string,fixed:string,last_affected:string>"
    rows = spark.createDataFrame([([(("p", "n"), [([("0", None, None), (None, "2", None), ("3", None, None)],)])],)],
        f"a array<struct<package:struct<ecosystem:string,name:string>,ranges:array<struct<events:array<{event}>>>>>",
    )
    ranges = rows.select(affected_ranges(F.col("a")).alias("r"))
    assert [tuple(x) for x in ranges.head()["r"]] == [("p", "n", "0", "2", None), ("p", "n", "3", None, None)]
    assert plan_of(ranges).count("filter(") <= 3


def test_an_advisory_is_scored_in_steps(spark):
    base = "CVSS:3.{}/AV:{}/AC:H/PR:{}/UI:R/S:{}/C:{}/I:L/A:N"
    vectors = [base.format(*x) for x in ("0NLUH", "1PHCN", "1ANCL", "0LNUN")] + ["CVSS:3.1/AV:N", "", None]
    rows = spark.createDataFrame([(v,) for v in vectors], "v string").withColumn("ok", cvss.is_valid_v3(F.col("v")))
    scored = cvss.with_v3_base_score(rows, "v", "ok", "score").withColumn("same", cvss.v3_base_score(F.col("v")))
    assert scored.columns == ["v", "ok", "score", "same"]
    found = scored.collect()
    assert all(r["score"] == r["same"] for r in found) and sum(r["score"] is not None for r in found) == 4
    document = """{"id":"GHSA-1","published":"2024-01-02T00:00:00Z","severity":[{"type":"CVSS_V3","score":"%s"}]}"""
    parsed = advisories.advisory_rows(spark.createDataFrame([(document % vectors[0],)], "value string"))
    assert parsed.head()["cvss"] == found[0]["same"]
    assert plan_of(parsed).count("instr(") <= 8


def test_fields_of_an_entry_are_read_once(spark):
    text = """{"vulnerabilities":[{"cveID":"CVE-2024-1","notes":"","product":5,"dateAdded":"20240102",
        "dueDate":"2024-01-03","cwes":[" cwe-1 ",7,null]},{"cveID":"CVE-2024-2","cwes":"cwe-2"},"text"]}"""
    rows = exploited.exploited_rows(spark.createDataFrame([(text,)], "value string"))
    fields = ("cve", "notes", "product", "cwe", "date_added", "due_date", "valid")
    assert [tuple(str(r[f]) for f in fields) for r in rows.collect()] == [
        ("CVE-2024-1", "None", "None", "['CWE-1']", "2024-01-02", "2024-01-03", "True"),
        ("CVE-2024-2", "None", "None", "[]", "None", "None", "True"),
        ("None", "None", "None", "[]", "None", "None", "False"),
    ]
    plan = plan_of(rows)
    assert plan.count("variant_get(") <= 11 and plan.count("from_json(") == 1


def test_a_bundle_object_is_parsed_once_for_each_side(spark):
    text = """{"objects":[{"type":"relationship","id":"r","source_ref":"a","target_ref":"b"},"text",
        {"type":"x","id":"a","name":"A"},{"type":"x","id":"a","name":"B"},{"type":"tool","id":"b","name":"C"}]}"""
    documents = spark.createDataFrame([("m", text), ("n", "{}")], "matrix string, value string")
    rows = bundles.relationship_rows(bundles.bundle_objects(documents, "matrix"))
    assert [(r["matrix"], r["source_name"], r["target_name"]) for r in rows.collect()] == [("m", "B", "C")]
    assert plan_of(rows).count("from_json(") <= 6  # three sides: the list and its objects


def test_rows_before_the_newest_stored_one_are_parsed_no_further_than_their_date(spark):
    texts = spark.createDataFrame([("a", "{}")], "path string, value string")
    for rows, order in ((advisories.advisory_rows(texts), "modified"), (records.record_rows(texts), "date_updated")):
        late = F.col(order) >= F.lit("2024-01-01").cast("timestamp_ntz")
        plan = plan_of(rows.where(~F.col("valid") | late))
        below = plan[plan.index("Filter"):].splitlines()
        assert "CollectMetrics" in below[1]  # the rest is worked out above the filter
        assert plan.count("from_json(") == 1


def test_documents_that_a_light_read_settles_are_not_parsed(spark):
    day, new, tab = '"published":"2024-01-02T00:00:00Z"', '"modified":"2024-06-01T00:00:00Z"', '"summary":"a\tb"'
    parts = [f'"id":"GHSA-1",{day}', f'"id":"GHSA-2",{day},{new}', f'"id":"GHSA-3",{tab},{day},{new}',
             f'"id":"GHSA-4",{tab},{day}', '"id":"GHSA-5","modified":"soon","published":"20240801"',
             '"id":"GHSA-6"', f'"id":"OSV-7",{day}', f'"id":8,{new}', f'{day},{new}',
             f'"id":"GHSA-9",{new},"severity":5,"affected":[1]', f'"id":{{"a":1}},{day}']
    texts = [f"{{{p}}}" for p in parts]
    texts += [texts[0][:20], texts[1][:-1], f"[{texts[1]}]", f"{texts[0]} tail", "[]", "", "null", None]
    names = {'"id"': '"cveId"', '"published"': '"datePublished"', '"modified"': '"dateUpdated"'}

    def record(text):
        for name, other in names.items():
            text = text.replace(name, other)
        return f'{{"containers":{{"cna":{{"title":"a"}},"adp":[null,1]}},"cveMetadata":{text}}}'

    since = F.lit("2024-06-01").cast("timestamp_ntz")
    for parser, order, values in (
        (advisories.advisory_rows, "modified", texts),
        (records.record_rows, "date_updated", [t and record(t) for t in texts]),
    ):
        documents = spark.createDataFrame([("CVE-2024-0001.json", v) for v in values], "path string, value string")
        whole, left = parser(documents), parser(documents, since)
        valid = F.coalesce("valid", F.lit(False))
        late = [rows.where(valid & (F.col(order) >= since)) for rows in (whole, left)]
        assert late[0].count() >= 3 and late[0].exceptAll(late[1]).isEmpty() and late[1].exceptAll(late[0]).isEmpty()
        assert whole.where(~valid).count() == left.where(~valid).count() >= 8
        assert left.where(valid & F.col("raw").contains(values[0])).count() < whole.where(valid & F.col("raw").contains(values[0])).count()
        lines = plan_of(left).splitlines()
        parsed = [i for i, line in enumerate(lines) if "from_json(" in line]
        filters = [i for i, line in enumerate(lines) if "Filter" in line]
        assert len(parsed) == 2 and parsed[0] < filters[-1] < parsed[1]  # the whole parse is above


def test_the_metric_is_built_for_the_first_hit_only(spark):
    score = "struct<version:string,baseScore:string,baseSeverity:string,vectorString:string>"
    metric = ",".join(f"{key}:{score}" for key in cvss.METRIC_KEYS)
    none, v2, v3, v4 = (None,) * 4, ("", "5.5", "LOW", "AV:N"), ("3.1", "9", None, None), ("4.0", "x", None, None)
    rows = spark.createDataFrame(
        [([(None,), None, ([(v4, None, None, v2), none, None, (None, v3, None, None)],)],), ([(v2,)][:0],), (None,)],
        f"c array<struct<metrics:array<struct<{metric}>>>>",
    ).select(cvss.best_record_metric(F.col("c")).alias("m"))
    assert [r["m"] and tuple(r["m"]) for r in rows.collect()] == [(9.0, "3.1", None, None), None, None]
    assert plan_of(rows).count("flatten(") == 0
