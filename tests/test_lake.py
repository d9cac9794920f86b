"""Feeds to lake to views, end to end on small files."""

from __future__ import annotations

import os
from datetime import date

import feedfiles as ff
import pytest

from pyspark.sql import functions as F

from hazardbook.checks import overall, verify
from hazardbook.operators.changes import ShrunkSnapshot
from hazardbook.schemas import SCHEMAS, columns_of, empty_table
from hazardbook.session import drop_path, shared_folder
from hazardbook.sinks import ingest
from hazardbook.sinks.files import file_ranges, write_sorted
from hazardbook.sinks.lake import Lake
from hazardbook.sources import scores
from hazardbook.streaming.daily import ingest_arrivals


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def test_scores_backfill_update_and_verify(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    ff.score_file(landed, "2024-05-01", [("CVE-1-2", 0.2), ("CVE-1-1", 0.1)], percentile=False)
    ff.score_file(landed, "2024-05-02", [("CVE-1-1", 0.3, 0.9)], model="v2")
    ff.score_file(landed, "2025-01-01", [("CVE-1-1", 0.4, 0.8)], model="v3")
    ff.score_file(landed, "2026-01-01", [("CVE-1-1", 0.5, 0.7)], model="v4")
    ff.score_file(landed, "2024-05-09", [("CVE-9-9", 0.5, 0.7)], folder="beta_scores")
    message = ingest.backfill_scores(lake, str(landed), date(2026, 1, 5))
    assert message == "backfilled 2 year batches, 1 daily batches (skipped 0 years, 0 daily, 0 bad lines)"
    assert rows(lake.batches("epss"), "year", "batch") == [
        (2024, "backfill"),
        (2025, "backfill"),
        (2026, "2026-01-01"),
    ]
    assert rows(lake.table("epss"), "cve", "epss", "percentile", "model_version") == sorted(
        [
            ("CVE-1-1", 0.1, None, "v1"),
            ("CVE-1-2", 0.2, None, "v1"),
            ("CVE-1-1", 0.3, 0.9, "v2"),
            ("CVE-1-1", 0.4, 0.8, "v3"),
            ("CVE-1-1", 0.5, 0.7, "v4"),
        ],
        key=repr,
    )
    again = ingest.backfill_scores(lake, str(landed), date(2026, 1, 5))
    assert again == "backfilled 0 year batches, 0 daily batches (skipped 2 years, 1 daily, 0 bad lines)"
    assert lake.table("epss").count() == 5
    models = ingest.model_versions_by_year(lake.table("epss"))
    assert rows(models, "year", "models")[0] == (2024, "v1, v2")
    messages = {r.batch: r.message for r in lake.data_files().where("year = 2024").collect()}
    assert messages == {"backfill": "epss 2024 backfill (3 records, v1, v2)"}
    report = verify(lake, date(2026, 1, 2), 3)
    assert overall(report).head() == (True, False)
    late = overall(verify(lake, date(2026, 2, 2), 3)).head()
    assert late == (True, True)
    stray = lake.table("epss").where("false")
    stray = lake.table("epss").limit(1)
    stray.write.parquet(f"{lake.root}/epss/year=2026/batch=2026-01-09")
    report = verify(lake, date(2026, 1, 2)).where("table_name = 'epss'").head()
    assert (report.ok, report.stray_files, report.missing_files) == (False, 1, 0)
    drop_path(spark, f"{lake.root}/epss/year=2026/batch=2026-01-09")
    assert overall(verify(lake, date(2026, 1, 2))).head().ok is True


def test_lost_and_changed_files_are_found(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    for day in ("2024-05-01", "2024-05-02", "2026-05-03"):
        ff.score_file(landed, day, [("CVE-1-1", 0.1, 0.2), ("CVE-1-2", 0.1, 0.2)], model="v2")
    ingest.backfill_scores(lake, str(landed), date(2026, 6, 1))
    files = {r.batch: r.file for r in lake.data_files().collect()}
    assert sum(r.rows for r in lake.data_files().collect()) == 6
    drop_path(spark, files["backfill"])
    report = verify(lake, date(2026, 5, 4)).where("table_name = 'epss'").head()
    assert (report.ok, report.missing_files, report.changed_files) == (False, 1, 0)


def test_score_lines_that_are_no_scores(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    lines = ["#model_version:v2,score_date:2024-05-02T00:00:00Z", "cve,epss,percentile", "CVE-1-1,0.1,0.2", "", "   ",
             "CVE-1-2,oops,0.3", "CVE-1-3,0.4", ",0.1,0.2", "CVE-1-4,0.1,0.2,0.3", "CVE-1-5,0.1,x", "CVE-1-6,0.6,"]
    ff.score_lines(landed, "2024-05-01", lines)
    ff.score_lines(landed, "2024-05-03", ["cve,epss", "CVE-2-1,0.1", "CVE-2-2,0.1,0.5,1"])
    ff.score_lines(landed, "2024-13-03", ["cve,epss", "CVE-3-1,0.1"])
    found = scores.read_scores(spark, str(landed)).drop("path")
    assert rows(found.where("valid"), "cve", "epss", "percentile", "date", "model_version") == [
        ("CVE-1-1", 0.1, 0.2, date(2024, 5, 2), "v2"),
        ("CVE-1-3", 0.4, None, date(2024, 5, 2), "v2"),
        ("CVE-1-6", 0.6, None, date(2024, 5, 2), "v2"),
        ("CVE-2-1", 0.1, None, date(2024, 5, 3), "v1"),
    ]
    assert found.where("NOT valid").count() == 6
    results = ingest.update_scores(lake, str(landed))
    assert [(r.batch, r.status, r.records, r.bad) for r in results] == [
        ("2024-05-02", "published", 3, 0), ("2024-05-03", "published", 1, 6)]


def test_files_out_of_order_are_found(spark, tmp_path):
    plain, ordered = str(tmp_path / "plain"), str(tmp_path / "sorted")
    numbers = spark.range(2000).selectExpr("pmod(xxhash64(id), 997) AS a", "id AS b")
    numbers.repartition(4).write.parquet(plain)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_sorted(numbers.repartition(4), ordered, ["a", "b"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    bad, good = (file_ranges(spark.read.parquet(p), ["a", "b"]) for p in (plain, ordered))
    assert bad.agg(F.sum("unsorted_rows")).head()[0] > 0 and bad.where("overlaps").count() > 0
    assert good.agg(F.sum("rows"), F.sum("unsorted_rows")).head() == (2000, 0)
    assert good.count() > 1 and good.where("overlaps").isEmpty()


def test_batches_of_the_lake_are_sorted(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    for day in range(1, 6):
        lines = [(f"CVE-1-{(i * 7919 + day) % 500:04d}", 0.5, 0.5) for i in range(500)]
        ff.score_file(landed, f"2024-05-0{day}", lines, model="v2")
        ff.score_file(landed, f"2026-05-0{day}", lines, model="v2")
    ingest.backfill_scores(lake, str(landed), date(2026, 6, 1))
    for batch in ("backfill", "2026-05-03"):
        stored = lake.stored("epss").where(F.col("batch") == batch)
        files = file_ranges(stored, ["cve", "date"])
        assert files.agg(F.sum("unsorted_rows")).head()[0] == 0
        assert files.where("overlaps").isEmpty()


def test_closed_year_with_daily_batches_is_not_folded(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    ff.score_file(landed, "2024-05-01", [("CVE-1-1", 0.1, 0.2)], model="v2")
    ingest.update_scores(lake, str(landed))
    ff.score_file(landed, "2024-05-02", [("CVE-1-1", 0.1, 0.2)], model="v2")
    ingest.backfill_scores(lake, str(landed), date(2026, 1, 5))
    assert rows(lake.batches("epss"), "batch") == [("2024-05-01",)]


def test_arrivals_are_ingested_once(spark, tmp_path, lake):
    landed, checkpoint = tmp_path / "landed", str(tmp_path / "cp")
    ff.score_file(landed, "2026-05-01", [("CVE-1-1", 0.1, 0.2)], model="v2")
    ingest_arrivals(lake, str(landed), checkpoint).awaitTermination()
    ff.score_file(landed, "2026-05-02", [("CVE-1-1", 0.2, 0.2)], model="v2")
    ingest_arrivals(lake, str(landed), checkpoint).awaitTermination()
    ingest_arrivals(lake, str(landed), checkpoint).awaitTermination()
    assert rows(lake.table("epss"), "cve", "epss") == [("CVE-1-1", 0.1), ("CVE-1-1", 0.2)]


def test_records_strict_watermark(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    assert ingest.update_records(lake, str(landed), date(2026, 1, 1)).status.startswith("refused")
    ff.record(landed, "CVE-2023-0001", "2026-01-01T00:00:00Z")
    ff.record(landed, "CVE-2024-0002", "2026-01-02T00:00:00Z")
    ff.record(landed, "CVE-2024-0003", "", broken=True)
    ff.put(landed, "cves/delta.json", "{}")
    assert ingest.backfill_records(lake, str(landed)) == "backfilled 2 year batches (skipped 0 years, 1 bad records)"
    assert ingest.update_records(lake, str(landed), date(2026, 1, 2)).status == "no-new-records"
    ff.record(landed, "CVE-2023-0001", "2026-01-03T09:00:00+09:00", title="new")
    ff.record(landed, "CVE-2024-0009", "2026-01-02T00:00:00Z")  # equal: left out
    result = ingest.update_records(lake, str(landed), date(2026, 1, 3))
    assert (result.status, result.records, result.bad) == ("published", 1, 1)
    assert ingest.update_records(lake, str(landed), date(2026, 1, 3)).status == "already-registered"
    assert rows(lake.frames()["cve"], "cve", "title") == [
        ("CVE-2023-0001", "new"),
        ("CVE-2024-0002", "t"),
    ]
    assert overall(verify(lake, date(2026, 1, 4), 3)).head() == (True, False)
    lake.refresh_views("t_")
    assert lake.query("select count(*) n from t_cve_history").head().n == 3
    names = {r.tableName for r in lake.query("show tables").collect()}
    assert {f"t_{name}" for name in lake.frames()} <= names
    described = [r.col_name for r in lake.query("describe t_cve").collect()]
    assert described == columns_of("cve_history")
    messages = {(r.year, r.batch): r.message for r in lake.data_files().collect()}
    assert messages == {
        (2023, "backfill"): "cve_history 2023 backfill (1 records)",
        (2024, "backfill"): "cve_history 2024 backfill (1 records)",
        (2026, "2026-01-03"): "cve_history 2026-01-03 (1 records)",
    }
    plan = lake.stored("cve_history").where("year = 2023")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_advisories(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    vector = "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H"
    ff.advisory(landed, "GHSA-1", "2026-01-01T00:00:00Z", aliases=["CVE-2024-1"],
                severity=[{"type": "CVSS_V3", "score": vector}])
    ff.advisory(landed, "GHSA-9", "2026-01-01T00:00:00Z", folder="unreviewed")
    ff.advisory(landed, "OSV-1", "2026-01-01T00:00:00Z")
    assert ingest.backfill_advisories(lake, str(landed)) == "backfilled 1 year batches (skipped 0 years, 1 bad records)"
    ff.advisory(landed, "GHSA-2", "2026-02-01T00:00:00Z",
                severity=[{"type": "CVSS_V3", "score": 123}])
    ff.advisory(landed, "GHSA-3", "2026-02-02T00:00:00Z",
                severity=[{"type": "CVSS_V3", "score": "CVSS:3.1/broken"}])
    assert ingest.update_advisories(lake, str(landed), date(2026, 2, 2)).records == 2
    assert lake.frames()["ghsa"].orderBy("ghsa").select("cvss", "cvss_version", "cvss_vector").collect() == [
        (10.0, "3.1", vector),
        (None, None, None),
        (None, None, "CVSS:3.1/broken"),
    ]


def test_exploits_same_day(spark, tmp_path, lake):
    landed = tmp_path / "landed"
    first = [
        {"id": "1", "date_published": "2024-01-01", "date_updated": "2024-05-01", "codes": "CVE-2024-1;OSVDB-2"},
        {"id": "2", "date_updated": "2024-05-02", "description": 'multi\nline "q"'},
        {"id": "x"},
    ]
    ff.exploit_index(landed, first)
    assert ingest.backfill_exploits(lake, str(landed)) == "backfilled 1 year batches (skipped 0 years, 1 bad records)"
    assert lake.table("exploitdb_history").where("edb_id = 2").head().description == 'multi\nline "q"'
    more = first + [
        {"id": "3", "date_updated": "2024-05-02"},  # same day, new
        {"id": "1", "date_updated": "2024-05-03"},  # later
        {"id": "4", "date_updated": ""},  # no day
    ]
    ff.exploit_index(landed, more)
    assert ingest.update_exploits(lake, str(landed), date(2024, 5, 3)).records == 2
    assert rows(lake.table("exploitdb_history"), "edb_id") == [(1,), (1,), (2,), (3,)]
    assert overall(verify(lake, date(2024, 5, 20), 3)).head() == (True, False)  # 21-day floor
    assert overall(verify(lake, date(2024, 5, 30), 3)).head() == (True, True)


def test_templates_digest_and_path(spark, tmp_path, lake):
    landed = tmp_path / "a"
    ff.template(landed, "http/one.yaml", "one")
    ff.template(landed, "http/two.yaml", "two")
    ff.template(landed, "http/zz.yaml", "two", name="later path loses")
    ff.template(landed, "helpers/three.yaml", "three")
    ff.put(landed, "top/http/no.yaml", "just: text\n")
    result = ingest.update_templates(lake, str(landed), date(2026, 1, 1))
    assert (result.records, result.bad) == (2, 1)
    signed = tmp_path / "b"
    ff.template(signed, "http/one.yaml", "one", signature="other")
    ff.template(signed, "dns/two.yaml", "two")
    result = ingest.update_templates(lake, str(signed), date(2026, 1, 2))
    assert result.records == 1  # re-signed only: no row; moved: one row
    gone = tmp_path / "c"
    ff.template(gone, "http/one.yaml", "one")
    ingest.update_templates(lake, str(gone), date(2026, 1, 3))
    latest = lake.frames()["nuclei"]
    assert rows(latest, "template_id", "file", "removed") == [
        ("one", "http/one.yaml", False),
        ("two", "dns/two.yaml", True),
    ]


def test_exploited_changes_tombstone_revival_and_guard(spark, tmp_path, lake):
    def entry(n, **fields):
        return {"cveID": f"CVE-2024-000{n}", "dateAdded": "2024-01-01", **fields}

    first = [entry(1), entry(2), entry(3), entry(1, product="second loses"), {"cveID": "x"}]
    ff.exploited(tmp_path / "1", first)
    result = ingest.update_exploited(lake, str(tmp_path / "1"), date(2026, 1, 1))
    assert (result.records, result.bad) == (3, 1)
    ff.exploited(tmp_path / "2", [entry(1, product="p"), entry(2), entry(4)])
    assert ingest.update_exploited(lake, str(tmp_path / "2"), date(2026, 1, 2)).records == 3
    state = rows(lake.frames()["kev"], "cve", "product", "date_added", "removed")
    day = date(2024, 1, 1)
    assert state == [
        ("CVE-2024-0001", "p", day, False),
        ("CVE-2024-0002", None, day, False),
        ("CVE-2024-0003", None, day, True),
        ("CVE-2024-0004", None, day, False),
    ]
    ff.exploited(tmp_path / "3", [entry(1), entry(2), entry(3)])
    assert ingest.update_exploited(lake, str(tmp_path / "3"), date(2026, 1, 3)).records == 3
    ff.exploited(tmp_path / "4", [entry(1)])
    with pytest.raises(ShrunkSnapshot):
        ingest.update_exploited(lake, str(tmp_path / "4"), date(2026, 1, 4))
    assert lake.batches("kev_history").count() == 3
    ff.put(tmp_path / "5", "catalog.json", '{"vulnerabilities": 5}')
    with pytest.raises(Exception, match="no vulnerabilities array"):
        ingest.update_exploited(lake, str(tmp_path / "5"), date(2026, 1, 5))


def test_mentions(spark, tmp_path, lake):
    ff.change_page(tmp_path / "1", "a", "<b>Fix</b> for CVE-2024-12345 &amp; cve-2024-12345", title="A")
    result = ingest.update_mentions(lake, str(tmp_path / "1"), date(2026, 1, 1))
    assert result.records == 1
    row = lake.table("cloudflare_waf_history").head()
    assert row.source_title == "A"
    assert row.source_date == date(2026, 1, 2)
    assert row.matched_text == "Fix for CVE-2024-12345 & cve-2024-12345"
    assert ingest.update_mentions(lake, str(tmp_path / "1"), date(2026, 1, 2)).status == "no-new-records"
    ff.change_page(tmp_path / "2", "a", "nothing")
    with pytest.raises(RuntimeError, match="no identifiers"):
        ingest.update_mentions(lake, str(tmp_path / "2"), date(2026, 1, 3))


def test_weakness_snapshots(spark, tmp_path, lake):
    ff.weaknesses(tmp_path / "w", "4.9", "2022-10-13", {1: "old", 2: "both"})
    ff.weaknesses(tmp_path / "w", "4.20", "2026-01-01", {2: "both", 3: "new"})
    results = ingest.update_weaknesses(lake, str(tmp_path / "w"))
    assert [r.status for r in results] == ["published", "published"]
    assert rows(lake.frames()["cwe"], "cwe_id", "cwe_version") == [("CWE-2", "4.20"), ("CWE-3", "4.20")]
    again = ingest.update_weaknesses(lake, str(tmp_path / "w"))
    assert {r.status for r in again} == {"already-registered"}


def _ref(source, ext, **more):
    return {"source_name": source, "external_id": ext, **more}


def test_techniques_patterns_and_bridge(spark, tmp_path, lake):
    objects = [
        {"type": "attack-pattern", "id": "ap-1", "name": "Exploit", "modified": "2026-01-01T00:00:00Z",
         "external_references": [_ref("mitre-attack", "T1")],
         "kill_chain_phases": [{"kill_chain_name": "k", "phase_name": "p"}]},
        {"type": "campaign", "id": "c-1", "name": "Camp", "external_references": [_ref("mitre-attack", "C1")]},
        {"type": "relationship", "id": "r-1", "relationship_type": "uses", "source_ref": "c-1", "target_ref": "ap-1"},
        {"type": "relationship", "id": "r-2", "relationship_type": "uses", "source_ref": "gone", "target_ref": "ap-1"},
    ]
    ff.bundle(tmp_path / "s", "enterprise-attack.json", objects)
    ff.bundle(tmp_path / "s", "mobile-attack.json", objects[:1])
    ff.bundle(tmp_path / "s", "stix-capec.json", [
        {"type": "attack-pattern", "id": "cp-1", "name": "Inject",
         "external_references": [_ref("capec", "CAPEC-1"), _ref("cwe", "CWE-89"), _ref("ATTACK", "T1")]},
        {"type": "attack-pattern", "id": "cp-2", "name": "Other", "x_mitre_deprecated": True,
         "external_references": [_ref("capec", "CAPEC-2"), _ref("cwe", "CWE-89")]},
        {"type": "attack-pattern", "id": "cp-3", "name": "Plain",
         "external_references": [_ref("capec", "CAPEC-3"), _ref("cwe", "CWE-89")]},
    ])
    results = ingest.update_techniques(lake, str(tmp_path / "s"), date(2026, 1, 1))
    assert [r.records for r in results] == [2, 2]
    assert ingest.update_patterns(lake, str(tmp_path / "s"), date(2026, 1, 1)).records == 3
    v = lake.frames()
    edges = v["attack_relationship"].orderBy("relationship_id").select(
        "source_ref", "source_attack_id", "source_name", "source_type", "target_name").collect()
    assert edges == [("c-1", "C1", "Camp", "campaign", "Exploit"), ("gone", None, None, None, "Exploit")]
    bridge = v["cwe_attack_patterns"].orderBy("capec_id").select("cwe", "capec_id", "attack_id", "attack_name").collect()
    assert bridge == [("CWE-89", "CAPEC-1", "T1", "Exploit"), ("CWE-89", "CAPEC-3", None, None)]


def test_rebuild(spark, tmp_path, lake):
    staged_before = set(os.listdir(shared_folder(spark)))
    assert lake.rebuild() == "refused: no parquet files in storage"
    assert verify(lake, date(2026, 1, 1)).head().ok is False
    ff.weaknesses(tmp_path / "w", "4.9", "2022-10-13", {1: "old"})
    ingest.update_weaknesses(lake, str(tmp_path / "w"))
    ff.exploited(tmp_path / "k", [{"cveID": "CVE-2024-0001"}])
    ingest.update_exploited(lake, str(tmp_path / "k"), date(2026, 1, 1))
    assert set(os.listdir(shared_folder(spark))) == staged_before  # nothing is left over
    before = rows(lake.data_files(), "table_name", "year", "batch", "file", "rows")
    spark.range(1).coalesce(1).write.parquet(f"{lake.root}/unknown/x.parquet")
    lost = Lake(spark, lake.root, f"{lake.database}_new")
    assert lost.batches("cwe_history").isEmpty()
    assert lost.rebuild() == "rebuilt catalog with 2 batches (ignored 1 unknown files)"
    assert rows(lost.data_files(), "table_name", "year", "batch", "file", "rows") == before
    assert lost.table("cwe_history").count() == 1
    drop_path(spark, f"{lake.root}/_data_files")
    again = Lake(spark, lake.root, f"{lake.database}_again")
    again.rebuild()
    assert rows(again.data_files(), "table_name", "year", "batch", "file", "rows") == before


def test_catalog_with_hidden_entries(spark, tmp_path, lake):
    ff.put(tmp_path / "w", "cwec_1.xml", """<?xml version="1.0"?><!-- <Weakness ID="98"/> -->
<Weakness_Catalog xmlns="http://cwe.mitre.org/cwe-7" Version="1" Date="2024-01-02"><Weaknesses>
<Weakness ID="1" Name="by itself"/><!-- <Weakness ID="99" Name="no"><Description>x</Description></Weakness> -->
<Weakness ID="2" Name="a &lt;b&gt; &amp;amp;"><Description> one <i>two</i> &lt;br&gt; &#60; <![CDATA[<Weakness ID="97"/>]]></Description>
<Related_Weaknesses><Related_Weakness Nature="ChildOf" CWE_ID="1" View_ID="1"/><Related_Weakness Nature="ChildOf" CWE_ID="1" View_ID="2"/></Related_Weaknesses>
</Weakness></Weaknesses><Views/></Weakness_Catalog>""")
    ingest.update_weaknesses(lake, str(tmp_path / "w"))
    found = lake.table("cwe_history").orderBy("cwe_id").select("cwe_id", "name", "description", "relations").collect()
    assert found == [
        ("CWE-1", "by itself", None, []),
        ("CWE-2", "a <b> &amp;", 'one two <br> < <Weakness ID="97"/>', [("ChildOf", "CWE-1")]),
    ]
    ff.put(tmp_path / "x", "cwec_2.xml", '<Weakness_Catalog Date="2024-01-02"><Weaknesses><Weakness ID="1"/></Weaknesses></Weakness_Catalog>')
    with pytest.raises(Exception, match="catalog has no Version"):
        ingest.update_weaknesses(lake, str(tmp_path / "x"))


def test_rows_without_a_year_or_date_are_counted(spark, lake):
    columns = "cve string, epss double, percentile double, date date, model_version string, path string, valid boolean"
    day = date(2024, 5, 1)
    given = [("CVE-1-1", 0.1, 0.2, day, "v1", "x", True), ("CVE-1-2", 0.1, 0.2, None, "v1", "x", False)]
    results = ingest.add_score_days(lake, spark.createDataFrame(given, columns))
    assert [(r.batch, r.records, r.bad) for r in results] == [("2024-05-01", 1, 1)]
    kept = spark.range(3).selectExpr("concat('CVE-', id) AS cve", "if(id = 0, null, 2000 + id) AS file_year", "true AS valid")
    typed = empty_table(spark, SCHEMAS["cve_history"]).unionByName(kept, allowMissingColumns=True)
    filled = typed.withColumns({"file_year": F.col("file_year").cast("int")})
    assert ingest.fill_records(lake, filled) == "backfilled 2 year batches (skipped 0 years, 1 bad records)"
    assert rows(lake.stored("cve_history"), "cve", "year", "batch") == [("CVE-1", 2001, "backfill"), ("CVE-2", 2002, "backfill")]


def test_a_failed_run_leaves_readers_on_the_old_state(spark, tmp_path, lake):
    ff.exploited(tmp_path / "1", [{"cveID": "CVE-2024-0001"}])
    ingest.update_exploited(lake, str(tmp_path / "1"), date(2026, 1, 1))
    left = f"{lake.location('kev_history')}/year=2026/batch=2026-01-02"
    lake.table("kev_history").write.parquet(left)  # a run that ended before its batch was added
    assert lake.table("kev_history").count() == 1
    ff.exploited(tmp_path / "2", [{"cveID": "CVE-2024-0001", "product": "p"}])
    assert ingest.update_exploited(lake, str(tmp_path / "2"), date(2026, 1, 2)).records == 1
    assert rows(lake.table("kev_history"), "cve", "product") == [("CVE-2024-0001", "p"), ("CVE-2024-0001", None)]
    assert overall(verify(lake, date(2026, 1, 2))).head().ok is True
