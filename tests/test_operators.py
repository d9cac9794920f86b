"""Operators on small tables, under skew, and the shape of their plans."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from hazardbook.operators import arrays, changes, latest, presence, quality, references
from hazardbook.plans import assessments, provenance, published
from hazardbook.plans.views import build_views
from hazardbook.schemas import SCHEMAS, columns_of, empty_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows belong to one key."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7919 % 60_013).alias("t"),
        F.col("id").alias("v"),
    )
    return rows.repartition(8)


def test_latest_limits_hot_keys_before_the_shuffle(spark, hot):
    newest = latest.latest_per_key(hot, ["k"], "t")
    plan = plan_of(newest)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    top = hot.where("k = 0").agg(F.max("t")).head()[0]
    assert newest.where("k = 0").head().t == top
    assert newest.count() == hot.select("k").distinct().count()


def test_latest_null_order_is_oldest_and_first_wins(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c")], "k int, t int, v string")
    assert sorted(r.v for r in latest.latest_per_key(rows, ["k"], "t").collect()) == ["b", "c"]
    feed = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "k int, pos int, v string")
    assert [r.v for r in latest.first_per_key(feed, ["k"], ["pos"]).collect()] == ["x"]


def test_presence_takes_one_shuffle_and_handles_null_keys(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "cve string")
    b = spark.createDataFrame([("x",), ("y",)], "cve string")
    matrix = presence.presence_matrix([presence.Source("a", a, "a_n"), presence.Source("b", b)], "cve")
    assert plan_of(matrix).count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in matrix.collect()} == {
        ("x", True, True, 2),
        ("y", False, True, 0),
        (None, False, False, 0),
    }


def test_array_joins_against_membership(spark):
    left = spark.createDataFrame(
        [(1, ["a", "a", "b"]), (2, ["z"]), (3, []), (4, None), (5, ["a", "z"])], "k int, arr array<string>"
    )
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "item string, n int")
    for how in ("inner", "left"):
        ours = arrays.join_on_item(left, right, "arr", "item", how, row_key=["k"])
        naive = left.join(right, F.array_contains("arr", F.col("item")), how)
        pairs = [Counter((r.k, r.item, r.n) for r in df.collect()) for df in (ours, naive)]
        assert pairs[0] == pairs[1]
        assert "NestedLoop" not in plan_of(ours)
    with pytest.raises(ValueError, match="key of a left row"):
        arrays.join_on_item(left, right, "arr", "item", "left")


def test_hot_array_item_joins_without_loss(spark, hot):
    left = hot.select(F.col("v").alias("row"), F.array(F.col("k"), F.lit(0)).alias("arr"))
    right = spark.createDataFrame([(0, "hot"), (1, "cold")], "item long, name string")
    joined = arrays.join_on_item(left, right, "arr", "item")
    assert joined.where("name = 'hot'").count() == 60_000
    assert joined.where("name = 'cold'").count() == 1


def test_same_day_delta(spark):
    schema = "id int, d date"
    day = [date(2024, 1, n) for n in range(1, 5)]
    history = spark.createDataFrame([(1, day[0]), (2, day[1])], schema)
    feed = spark.createDataFrame(
        [(1, day[1]), (2, day[1]), (3, day[1]), (4, day[2]), (5, day[0]), (6, None)], schema
    )
    fresh = changes.newer_or_unseen(feed, history, "id", "d", changes.high_watermark(history, "d"))
    assert sorted(r.id for r in fresh.collect()) == [1, 3, 4]
    assert changes.high_watermark(history.where("false"), "d") is None


def test_snapshot_changes(spark):
    stored = spark.createDataFrame(
        [("same", ["a"], False), ("diff", ["a", "b"], False), ("gone", None, False),
         ("back", ["a"], True), ("dead", ["a"], True), ("null", None, False)],
        "k string, v array<string>, removed boolean",
    ).withColumn("fetched_date", F.lit(date(2024, 1, 1)))
    current = spark.createDataFrame(
        [("same", ["a"]), ("diff", ["b", "a"]), ("back", ["a"]), ("new", []), ("null", None)],
        "k string, v array<string>",
    )
    rows = changes.snapshot_changes(current, stored, ["k"], ["v"], date(2024, 2, 1))
    assert rows.columns == stored.columns
    assert {(r.k, r.removed) for r in rows.collect()} == {
        ("diff", False), ("gone", True), ("back", False), ("new", False),
    }
    changes.guard_against_shrinking(current, stored)
    with pytest.raises(changes.ShrunkSnapshot):
        changes.guard_against_shrinking(current.limit(1), stored)
    changes.guard_against_shrinking(current.limit(0), stored.where("false"))


def test_path_differences(spark):
    stored = spark.createDataFrame([("a",), ("b",)], "p string")
    registered = spark.createDataFrame([("b",), ("c",)], "p string")
    found = quality.path_differences(stored, registered, "p").collect()
    assert {tuple(r) for r in found} == {("a", "stray"), ("c", "missing")}


def test_decision_table_is_complete(spark):
    rows = assessments.decision_rows()
    assert len(rows) == 36 == len({tuple(r[p] for p in assessments.PARAMETERS) for r in rows})
    by = {tuple(r[p] for p in assessments.PARAMETERS): r for r in rows}
    assert by["active", "no", "total", "high"]["decision_label"] == "Act"
    assert by["public poc", "yes", "total", "medium"]["decision_label"] == "Track*"
    assert by["none", "no", "total", "high"]["decision_rank"] == 2
    assert provenance.datasets(spark).count() == 10


def _empty(spark, **given):
    tables = {name: empty_table(spark, ddl) for name, ddl in SCHEMAS.items()}
    return {**tables, **given}


def _record(spark, raw):
    columns = columns_of("cve_history")
    row = {"cve": "CVE-1", "raw": raw}
    return spark.createDataFrame([tuple(row.get(c) for c in columns)], SCHEMAS["cve_history"])


def test_assessment_rules(spark):
    good = (
        '{"other":{"type":"SSVC","content":{"role":"CISA Coordinator","version":"2.0.3",'
        '"options":[{"Exploitation":"Active"},{"Automatable":"No"},{"Technical Impact":"total"}],'
        '"decision":"Act"}}}'
    )
    other_role = good.replace("CISA Coordinator", "Supplier")
    raw = (
        '{"containers":{"adp":['
        f'{{"providerMetadata":{{"shortName":"CISA-ADP"}},"metrics":[{good},{good},{other_role}]}},'
        f'{{"title":"Somebody","metrics":[{good}]}},{{"title":"CISA ADP Vulnrichment"}}]}}}}'
    )
    v = build_views(spark, _empty(spark, cve_history=_record(spark, raw)))
    row = v["cve_ssvc"].collect()
    assert len(row) == 1
    assert (row[0].exploitation, row[0].mission_impact, row[0].ssvc_provider) == ("active", None, "CISA-ADP")
    assert row[0].ssvc_raw == good
    candidates = v["cve_ssvc_candidates"].orderBy("decision_rank").collect()
    assert [(c.mission_impact, c.computed_decision, c.decision_matches) for c in candidates] == [
        ("low", "track", False),
        ("medium", "attend", False),
        ("high", "act", True),
    ]
    assert v["cve_ssvc_history"].count() == 1
    unknown = raw.replace("Active", "poc")
    v = build_views(spark, _empty(spark, cve_history=_record(spark, unknown)))
    assert v["cve_ssvc_candidates"].count() == 0
    assert build_views(spark, _empty(spark, cve_history=_record(spark, "{}")))["cve_ssvc"].count() == 0


def test_empty_lake_views_and_queries(spark):
    tables = _empty(spark)
    views = build_views(spark, tables)
    v = {**tables, **{name: views[name] for name in views}}
    assert len(views) == 17
    for query in (published.triage, published.summary, published.weakness_names,
                  published.attack_patterns_of_records, published.affected_packages):
        assert query(v).count() == 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "cve")
    _record(spark, "{}").write.parquet(path)
    history = spark.read.schema(SCHEMAS["cve_history"]).parquet(path)
    view = build_views(spark, _empty(spark, cve_history=history))["cve"]
    plan = plan_of(view.where("cve = 'CVE-1'").select("cve", "title"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(cve,CVE-1)" in scan
    assert "raw:string" not in scan


@pytest.fixture
def eager_splitting(spark):
    """Skew handling at the size of a test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def test_hot_reference_is_split(spark, hot, eager_splitting):
    edges = hot.select(F.col("v").alias("edge"), F.col("k").alias("ref"))
    objects = hot.select(F.col("k").alias("id"), F.col("v").alias("name"), F.col("t").alias("pos"))
    resolved = references.resolve_ends(edges, objects, (), "id", ("name",), (("ref", "target"),), "pos")
    rows = resolved.collect()
    assert len(rows) == 60_000 and all(r.target_name is not None for r in rows)
    assert len({r.target_name for r in rows if r.ref == 0}) == 1
    assert "skew=true" in plan_of(resolved)


def test_hot_array_item_is_split(spark, hot, eager_splitting):
    left = hot.select(F.col("v").alias("row"), F.array(F.col("k")).alias("arr"))
    names = latest.latest_per_key(hot, ["k"], "t").select(F.col("k").alias("item"), F.col("v").alias("name"))
    joined = arrays.join_on_item(left, names, "arr", "item")
    assert joined.agg(F.count("*")).head()[0] == 60_000
    joined.write.format("noop").mode("overwrite").save()
    rows = joined.collect()
    assert len(rows) == 60_000
    assert "skew=true" in plan_of(joined)


def test_latest_scores_are_a_hash_aggregation(spark, hot):
    scores = hot.selectExpr("concat('CVE-', k) AS cve", "v / 7 AS epss", "v / 9 AS percentile", "date_add(date'2020-01-01', cast(t as int)) AS date")
    newest = published.latest_scores(scores)
    plan = plan_of(newest)
    assert "HashAggregate" in plan
    assert not any(word in plan for word in ("Sort ", "SortAggregate", "Window", "ObjectHashAggregate"))
    by_window = latest.latest_per_key(scores, ["cve"], "date").select("cve", "epss", "percentile")
    assert sorted(newest.collect()) == sorted(by_window.collect())


def test_left_array_join_reads_its_left_side_once(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "if(id % 4 = 0, null, array(id, id, id + 1, 1000)) AS items").write.parquet(str(tmp_path / "l"))
    left = spark.read.parquet(str(tmp_path / "l"))
    right = spark.range(0, 50, 2).selectExpr("id AS item", "id * 10 AS found")
    joined = arrays.join_on_item(left, right, "items", "item", how="left", row_key=["k"])
    assert plan_of(joined).count("FileScan parquet") == 1
    expected = []
    for k in range(100):
        items = [] if k % 4 == 0 else [i for i in (k, k + 1) if i % 2 == 0 and i < 50]
        expected += [(k, i, i * 10) for i in items] or [(k, None, None)]
    assert sorted(map(repr, expected)) == sorted(repr((r.k, r.item, r.found)) for r in joined.collect())


def test_raw_text_is_in_no_exchange(spark, tmp_path):
    table = empty_table(spark, SCHEMAS["cve_history"])
    table.write.parquet(str(tmp_path / "h"))
    tables = {name: empty_table(spark, ddl) for name, ddl in SCHEMAS.items()}
    tables["cve_history"] = spark.read.schema(SCHEMAS["cve_history"]).parquet(str(tmp_path / "h"))
    plan = plan_of(build_views(spark, tables)["cve_ssvc"])
    whole = re.compile(r"(?<!ssvc_)raw#")
    above, below = plan[: plan.index("Exchange")], plan[plan.index("Exchange") :]
    assert whole.search(below) and not whole.search(above)
    exchanged = below[: below.index("FileScan")].splitlines()
    assert sum(bool(whole.search(line)) for line in exchanged) <= 1  # where fragments are cut out
    assert not any(whole.search(line) for line in exchanged if "Exchange" in line or "Sort" in line)


def test_triage_reads_scores_once(spark, tmp_path):
    tables = {name: empty_table(spark, ddl) for name, ddl in SCHEMAS.items()}
    for name in ("epss", "cve_history"):
        tables[name].write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(SCHEMAS[name]).parquet(str(tmp_path / name))
    v = {**tables, **build_views(spark, tables)}
    assert plan_of(published.triage(v)).count("FileScan parquet") == 2
