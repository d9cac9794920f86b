"""Ingest jobs: landed feed -> rows to append -> published batch.

All jobs are idempotent. A job over a landed folder reads and parses it and hands the rows
to the job over rows, which can be called with rows from anywhere. A watermarked feed is
parsed, counted and written by one job; the full dump is never stored. A snapshot feed is
staged once, because the guard and the comparison both read it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hazardbook.operators.changes import (
    guard_against_shrinking,
    high_watermark,
    newer_or_unseen,
    newer_than,
    snapshot_changes,
)
from hazardbook.operators.latest import first_per_key
from hazardbook.operators.quality import screen
from hazardbook.plans.views import latest_view
from hazardbook.session import stage, staged_job
from hazardbook.sinks.lake import YEAR_BATCH, BatchResult, Lake
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

# Compared columns of the snapshot feeds; every other column may differ unnoticed.
TEMPLATE_COLUMNS = ("digest", "file")
EXPLOITED_COLUMNS = (
    "vendor_project", "product", "vulnerability_name", "short_description",
    "required_action", "known_ransomware_campaign_use", "notes", "cwe", "date_added",
    "due_date",
)
MENTION_COLUMNS = (
    "identifier_type", "cve", "source_title", "source_date", "matched_text",
)


def _screened(rows: DataFrame) -> tuple[DataFrame, int]:
    """Valid rows, staged, and the number of malformed ones."""
    seen = Observation()
    kept = stage(screen(rows, F.col("valid"), seen).drop("valid"))
    return kept, seen.get["bad"]


def _backfilled(years: list[BatchResult], found: DataFrame, bad: int) -> str:
    """What a backfill did; ``found`` has a ``year`` for all rows it was given."""
    skipped = found.where("year is not null").select("year").distinct().count() - len(years)
    return f"backfilled {len(years)} year batches (skipped {skipped} years, {bad} bad records)"


# ------------------------------------------------------------------------- scores


@staged_job
def update_scores(lake: Lake, landed: str) -> list[BatchResult]:
    """Append every landed day that is not stored yet, one batch per day."""
    return add_score_days(lake, scores.read_scores(lake.spark, landed))


@staged_job
def add_score_days(lake: Lake, rows: DataFrame) -> list[BatchResult]:
    """One batch per day that is not stored yet, all of them written in one job. Lines that
    are not valid, such as those without a date, are counted in the last result."""
    staged, bad = _screened(rows)
    dated = staged.withColumns({"year": F.year("date"), "batch": F.col("date").cast("string")})
    return _add_scores(lake, dated, bad)


def _add_scores(lake: Lake, rows: DataFrame, bad: int) -> list[BatchResult]:
    """Rows with their ``year`` and ``batch``; batches that are there stay as they are."""
    known = F.broadcast(lake.batches("epss"))  # one row a batch
    models = F.array_join(F.sort_array(F.collect_set("model_version")), ", ")
    fresh = rows.join(known, ["year", "batch"], "left_anti")
    added = lake.publish("epss", fresh, note=models)
    published = {r.batch for r in added}
    results = [
        BatchResult("already-registered", r.batch)
        for r in rows.select("batch").distinct().sort("batch").collect()  # one row a batch
        if r.batch not in published and r.batch != YEAR_BATCH
    ] + added
    if not results:
        return [BatchResult("not-published-yet", bad=bad)]
    last = results[-1]
    return [*results[:-1], BatchResult(last.status, last.batch, last.records, bad)]


@staged_job
def backfill_scores(lake: Lake, landed: str, today: date) -> str:
    return fold_scores(lake, scores.read_scores(lake.spark, landed), today)


@staged_job
def fold_scores(lake: Lake, rows: DataFrame, today: date) -> str:
    """Fold each closed year of files into one batch and keep the running year daily, all
    in one job. The year is that of the file's name.

    A closed year that already holds daily batches is skipped, not folded.
    """
    kept, bad = _screened(rows)
    file_year = F.coalesce(F.year(scores.file_date(F.col("path"))), F.year("date"))
    closed = file_year < today.year
    batched = kept.withColumns({
        "batch": F.when(closed, YEAR_BATCH).otherwise(F.col("date").cast("string")),
        "year": F.when(closed, file_year).otherwise(F.year("date")),
    })
    daily = lake.years_with_dated_batches("epss").withColumn("batch", F.lit(YEAR_BATCH))
    open_years = batched.join(F.broadcast(daily), ["year", "batch"], "left_anti")
    results = _add_scores(lake, open_years, bad)
    years = batched.where(F.col("batch") == YEAR_BATCH).select("year").distinct().count()
    published = [r.batch for r in results if r.status == "published"]
    folded = [b for b in published if b.endswith(YEAR_BATCH)]
    known = [r for r in results if r.status == "already-registered"]
    return (
        f"backfilled {len(folded)} year batches, {len(published) - len(folded)} daily batches"
        f" (skipped {years - len(folded)} years, {len(known)} daily, {bad} bad lines)"
    )


def model_versions_by_year(rows: DataFrame) -> DataFrame:
    """Score models seen in each year, sorted and joined."""
    return rows.groupBy(F.year("date").alias("year")).agg(
        F.array_join(F.sort_array(F.collect_set("model_version")), ", ").alias("models")
    )


# ------------------------------------------------------------- watermarked feeds


def _add_delta(
    lake: Lake,
    table: str,
    parsed: Callable[[Column], DataFrame],
    order: str,
    day: date,
    fresh: Callable[[DataFrame, object], DataFrame],
) -> BatchResult:
    """Append what is ``fresh`` after the newest stored row. One job parses the feed, counts
    its malformed records and writes the delta. Valid rows from before that row are left out
    first, so that a parser need not work out columns that are not written; ``parsed`` is
    given the row's ``order`` and may leave them out itself."""
    label = day.isoformat()
    if lake.has_batch(table, label):
        return BatchResult("already-registered", label)
    watermark = high_watermark(lake.table(table), order)
    if watermark is None:
        return BatchResult("refused: history is empty, run the backfill first")
    seen = Observation()
    feed = parsed(F.lit(watermark))
    valid = F.coalesce("valid", F.lit(False))
    rows = screen(feed.where(~valid | (F.col(order) >= F.lit(watermark))), valid, seen)
    done = lake.append(table, fresh(rows, watermark), day, once=True)
    return BatchResult(done.status, label, done.records, seen.get["bad"])


def _fill_years(lake: Lake, table: str, parsed: DataFrame, year: Callable[[DataFrame], Column]) -> str:
    """All records, one batch per year; records without a year are counted as bad."""
    rows, bad = _screened(parsed)
    placed = rows.withColumn("year", year(rows))
    added, without = lake.backfill_years(table, placed)
    return _backfilled(added, placed, bad + without)


@staged_job
def update_records(lake: Lake, landed: str, baseline: date) -> BatchResult:
    """Records changed after the newest stored one."""
    return add_records(
        lake, lambda since: records.record_rows(records.read_records(lake.spark, landed), since), baseline
    )


def add_records(lake: Lake, parsed: Callable[[Column], DataFrame], baseline: date) -> BatchResult:
    return _add_delta(
        lake, "cve_history", parsed, "date_updated", baseline,
        lambda rows, newest: newer_than(rows, "date_updated", newest),
    )


@staged_job
def backfill_records(lake: Lake, landed: str) -> str:
    """All records, one batch per year in the name of the record's file."""
    return fill_records(lake, records.record_rows(records.read_records(lake.spark, landed)))


@staged_job
def fill_records(lake: Lake, parsed: DataFrame) -> str:
    return _fill_years(lake, "cve_history", parsed, lambda _: F.col("file_year"))


@staged_job
def update_advisories(lake: Lake, landed: str, run_date: date) -> BatchResult:
    return add_advisories(
        lake, lambda since: advisories.advisory_rows(advisories.read_advisories(lake.spark, landed), since), run_date
    )


def add_advisories(lake: Lake, parsed: Callable[[Column], DataFrame], run_date: date) -> BatchResult:
    return _add_delta(
        lake, "ghsa_history", parsed, "modified", run_date,
        lambda rows, newest: newer_than(rows, "modified", newest),
    )


@staged_job
def backfill_advisories(lake: Lake, landed: str) -> str:
    return fill_advisories(
        lake, advisories.advisory_rows(advisories.read_advisories(lake.spark, landed))
    )


@staged_job
def fill_advisories(lake: Lake, parsed: DataFrame) -> str:
    return _fill_years(lake, "ghsa_history", parsed, lambda _: advisories.advisory_year())


@staged_job
def update_exploits(lake: Lake, landed: str, run_date: date) -> BatchResult:
    """Index rows of the newest stored day that were not stored then, and later ones."""
    return add_exploits(
        lake, lambda _: exploits.exploit_rows(exploits.read_exploit_index(lake.spark, landed)), run_date
    )


def add_exploits(lake: Lake, parsed: Callable[[Column], DataFrame], run_date: date) -> BatchResult:
    history = lake.table("exploitdb_history")
    return _add_delta(
        lake, "exploitdb_history", parsed, "date_updated", run_date,
        lambda rows, newest: newer_or_unseen(rows, history, "edb_id", "date_updated", newest),
    )


@staged_job
def backfill_exploits(lake: Lake, landed: str) -> str:
    return fill_exploits(
        lake, exploits.exploit_rows(exploits.read_exploit_index(lake.spark, landed))
    )


@staged_job
def fill_exploits(lake: Lake, parsed: DataFrame) -> str:
    return _fill_years(lake, "exploitdb_history", parsed, exploits.exploit_year)


# ----------------------------------------------------------------- snapshot feeds


def _add_snapshot(
    lake: Lake,
    table: str,
    current: DataFrame,
    keys: tuple[str, ...],
    compare: tuple[str, ...],
    run_date: date,
    bad: int,
) -> BatchResult:
    latest = latest_view(lake.tables(), table)
    guard_against_shrinking(current, latest)
    changes = snapshot_changes(current, latest, keys, compare, run_date)
    done = lake.append(table, changes, run_date, once=True)
    return BatchResult(done.status, done.batch, done.records, bad)


@staged_job
def update_templates(lake: Lake, landed: str, run_date: date) -> BatchResult:
    return add_templates(
        lake, lambda: templates.template_rows(templates.read_templates(lake.spark, landed)), run_date
    )


@staged_job
def add_templates(lake: Lake, parsed: Callable[[], DataFrame], run_date: date) -> BatchResult:
    """Templates whose content or path changed, came back, or are gone."""
    if lake.has_batch("nuclei_history", run_date.isoformat()):
        return BatchResult("already-registered", run_date.isoformat())
    rows, bad = _screened(parsed())
    current = first_per_key(rows, ["template_id"], ["file"])
    return _add_snapshot(
        lake, "nuclei_history", current, ("template_id",), TEMPLATE_COLUMNS, run_date, bad
    )


@staged_job
def update_exploited(lake: Lake, landed: str, run_date: date) -> BatchResult:
    return add_exploited(
        lake, lambda: exploited.exploited_rows(exploited.read_exploited(lake.spark, landed)), run_date
    )


@staged_job
def add_exploited(lake: Lake, parsed: Callable[[], DataFrame], run_date: date) -> BatchResult:
    """Catalog entries with any changed field, that came back, or are gone."""
    if lake.has_batch("kev_history", run_date.isoformat()):
        return BatchResult("already-registered", run_date.isoformat())
    rows, bad = _screened(parsed())
    current = first_per_key(rows, ["cve"], ["path", "position"]).drop("path", "position")
    return _add_snapshot(
        lake, "kev_history", current, ("cve",), EXPLOITED_COLUMNS, run_date, bad
    )


@staged_job
def update_mentions(lake: Lake, landed: str, run_date: date) -> BatchResult:
    return add_mentions(
        lake, lambda: changelog.mention_rows(changelog.read_pages(lake.spark, landed)), run_date
    )


@staged_job
def add_mentions(lake: Lake, parsed: Callable[[], DataFrame], run_date: date) -> BatchResult:
    if lake.has_batch("cloudflare_waf_history", run_date.isoformat()):
        return BatchResult("already-registered", run_date.isoformat())
    current = stage(parsed())
    if current.isEmpty():
        raise RuntimeError("refusing to ingest: no identifiers in the change log")
    return _add_snapshot(
        lake, "cloudflare_waf_history", current, ("identifier", "source_url"),
        MENTION_COLUMNS, run_date, 0,
    )


# ------------------------------------------------------------ versioned snapshots


@staged_job
def update_weaknesses(lake: Lake, landed: str) -> list[BatchResult]:
    """Append the whole catalog of every release that is not stored yet."""
    return add_releases(lake, weaknesses.weakness_rows(weaknesses.read_catalogs(lake.spark, landed)))


@staged_job
def add_releases(lake: Lake, rows: DataFrame) -> list[BatchResult]:
    """One batch per release, named after its version, all written in one job."""
    table = "cwe_history"
    staged = stage(rows.withColumns({"year": F.year("release_date"), "batch": F.col("cwe_version")}))
    known = lake.batches(table).select("batch")
    added = lake.publish(table, staged.join(F.broadcast(known), "batch", "left_anti"))
    published = {r.batch for r in added}
    releases = staged.select("batch").distinct().sort("batch").collect()  # one row a release
    return added + [
        BatchResult("already-registered", r.batch) for r in releases if r.batch not in published
    ]


@staged_job
def update_techniques(lake: Lake, landed: str, run_date: date) -> list[BatchResult]:
    documents = bundles.read_bundles(lake.spark, landed, "*-attack.json")
    return add_techniques(
        lake, lambda: documents.withColumn("matrix", bundles.matrix_of(F.col("path"))), run_date
    )


@staged_job
def add_techniques(
    lake: Lake, documents: Callable[[], DataFrame], run_date: date
) -> list[BatchResult]:
    """Append the whole snapshot of all matrices, objects and relationships."""
    if lake.has_batch("attack_history", run_date.isoformat()):
        return [BatchResult("already-registered", run_date.isoformat())]
    objects = stage(
        bundles.bundle_objects(documents(), "matrix").repartition("matrix", "position")
    )
    # The object batch answers "is this run done", so it is published last.
    edges = lake.append(
        "attack_relationship_history", bundles.relationship_rows(objects), run_date, once=True
    )
    done = lake.append("attack_history", bundles.attack_rows(objects), run_date, once=True)
    return [done, *([edges] if edges.records else [])]


@staged_job
def update_patterns(lake: Lake, landed: str, run_date: date) -> BatchResult:
    documents = bundles.read_bundles(lake.spark, landed, "*capec*.json")
    return add_patterns(lake, lambda: documents, run_date)


def add_patterns(lake: Lake, documents: Callable[[], DataFrame], run_date: date) -> BatchResult:
    if lake.has_batch("capec_history", run_date.isoformat()):
        return BatchResult("already-registered", run_date.isoformat())
    objects = bundles.bundle_objects(documents()).repartition("position")
    return lake.append("capec_history", bundles.pattern_rows(objects), run_date, once=True)
