"""Base tables as catalog tables, partitioned by year and batch.

A batch is a partition: the rows of one run. Spark writes all batches of a run in one job
and adds their partitions to the catalog when the files are in place, so readers see a
batch whole or not at all, and a batch that is written again after a failure replaces what
the failed run left. ``data_files`` records the files of every batch with their rows and
the batch's message; the checks compare it with what is stored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.lazy import LazyMap
from hazardbook.plans.views import register_views, tables_and_views
from hazardbook.schemas import SCHEMAS, TABLES, columns_of, empty_table
from hazardbook.sinks.files import gathered, ranged
from hazardbook.sources.files import relative_path

YEAR_BATCH = "backfill"  # the batch of a whole year; others are named after their date
DATA_FILES = "data_files"
_FILES_SCHEMA = (
    "table_name string, year int, batch string, file string, rows long, message string"
)
_FOLDERS = sorted(
    ((rules.folder + "/", name) for name, rules in TABLES.items()), reverse=True
)


@dataclass(frozen=True)
class BatchResult:
    """What one ingest run did."""

    status: str
    batch: str = ""
    records: int = 0
    bad: int = 0

    def __str__(self) -> str:
        detail = f" ({self.records} records, {self.bad} bad)" if self.records else ""
        return f"{self.status} {self.batch}{detail}".strip()


def table_of_path(path: Column) -> Column:
    """Base table a stored path belongs to, by its folder; NULL for unknown paths."""
    return F.coalesce(
        *[F.when(path.startswith(folder), table) for folder, table in _FOLDERS]
    )


# An overwrite replaces the partitions it writes and leaves the others. A plan that turns
# out to give no rows is still run to its end, for the counts that are observed in it.
_WRITING = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.optimizer.excludedRules": (
        "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    ),
}


@contextmanager
def _set_for_writing(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Lake:
    def __init__(self, spark: SparkSession, root: str, database: str | None = None) -> None:
        """Tables below ``root``, in a database that is named after it unless given."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database or "lake_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]
        self._named: set[str] = set()

    # ------------------------------------------------------------- catalog

    def exists(self) -> bool:
        return self.spark.catalog.databaseExists(self.database)

    def location(self, table: str) -> str:
        folder = TABLES[table].folder if table in TABLES else f"_{table}"
        return f"{self.root}/{folder}"

    def _name(self, table: str) -> str:
        """The table's name in the catalog, where it is declared when first named."""
        name = f"{self.database}.{table}"
        if not self._named:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/_{self.database}'"
            )
        if table not in self._named:
            schema, layout = _FILES_SCHEMA, ""
            if table != DATA_FILES:
                schema = f"{SCHEMAS[table]}, year int, batch string"
                layout = "PARTITIONED BY (year, batch)"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet"
                f" OPTIONS (compression 'zstd') {layout} LOCATION '{self.location(table)}'"
            )
            self._named.add(table)
        return name

    def batches(self, table: str) -> DataFrame:
        """``year`` and ``batch`` of every batch of a table that readers see."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self._name(table)}")
        year = F.regexp_extract("partition", "^year=([^/]*)", 1).try_cast("int")
        batch = F.url_decode(F.regexp_extract("partition", "/batch=(.*)$", 1))
        return listed.select(year.alias("year"), batch.alias("batch"))

    def has_batch(self, table: str, batch: str) -> bool:
        return not self.batches(table).where(F.col("batch") == batch).isEmpty()

    def data_files(self) -> DataFrame:
        """Registered files: table, batch, URL, rows, and the message of the batch."""
        return self.spark.table(self._name(DATA_FILES))

    def refresh(self) -> None:
        """Forget listings of files that were read before; the next read lists them anew."""
        for name in SCHEMAS:
            self.spark.catalog.refreshTable(self._name(name))

    # ------------------------------------------------------------- reading

    def stored(self, name: str) -> DataFrame:
        """All rows of a base table with their ``year`` and ``batch``; filters on these
        two leave other partitions unread."""
        return self.spark.table(self._name(name))

    def table(self, name: str) -> DataFrame:
        """All rows of a base table, in its declared schema."""
        return self.stored(name).select(*columns_of(name))

    def tables(self) -> LazyMap[DataFrame]:
        """Base tables by name."""
        return LazyMap({name: (lambda name=name: self.table(name)) for name in SCHEMAS})

    def frames(self) -> LazyMap[DataFrame]:
        """Base tables and views by name."""
        return tables_and_views(self.spark, self.tables())

    def refresh_views(self, prefix: str = "") -> None:
        """(Re)register every table and view for SQL."""
        register_views(self.spark, self.tables(), lambda name: prefix + name)

    def query(self, sql: str) -> DataFrame:
        return self.spark.sql(sql)

    # ------------------------------------------------------------- writing

    def publish(
        self, table: str, rows: DataFrame, *, once: bool = False, note: Column | None = None
    ) -> list[BatchResult]:
        """Write the rows, which carry ``year`` and ``batch``, and say what each batch holds.

        All batches are written in one job. With ``once`` the rows are read once, for rows
        that come straight out of a parser; else their files do not overlap. ``note`` is
        an aggregate over a batch for its message. No rows make no batch.
        """
        target, keys = self._name(table), TABLES[table].sort
        known = self.batches(table)
        arranged = (gathered if once else ranged)(
            rows.select(*columns_of(table), "year", "batch"), ["year", "batch", *keys]
        )
        with _set_for_writing(rows.sparkSession):
            arranged.write.mode("overwrite").insertInto(target)
        added = [tuple(r) for r in self.batches(table).exceptAll(known).collect()]
        return self._record(table, added, note) if added else []

    def _record(
        self, table: str, added: Sequence[tuple[int, str]], note: Column | None
    ) -> list[BatchResult]:
        """Register the files of new batches; only their footers are read."""
        new = self.stored(table).where(
            F.col("year").isin(sorted({y for y, _ in added})) & F.col("batch").isin(sorted({b for _, b in added}))
        )
        files = new.groupBy("year", "batch", F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("rows")
        )
        batches = new.groupBy("year", "batch").agg(
            F.count("*").alias("records"), (F.lit(None) if note is None else note).cast("string").alias("note")
        ).collect()  # one row a batch of this run
        noted = [r for r in batches if (r.year, r.batch) in added]
        label = {
            (r.year, r.batch): str(r.year) + " backfill" if r.batch == YEAR_BATCH else r.batch for r in noted
        }
        said = [
            (r.year, r.batch, f"{table} {label[r.year, r.batch]} ({r.records} records{', ' + r.note if r.note else ''})")
            for r in noted
        ]
        messages = self.spark.createDataFrame(said, "year int, batch string, message string")
        (
            files.join(F.broadcast(messages), ["year", "batch"])
            .select(F.lit(table).alias("table_name"), "year", "batch", "file", "rows", "message")
            .coalesce(1).write.mode("append").insertInto(self._name(DATA_FILES))
        )
        return [
            BatchResult("published", label[r.year, r.batch], r.records)
            for r in sorted(noted, key=lambda r: (r.year, r.batch))
        ]

    def append(self, table: str, rows: DataFrame, day: date, *, once: bool = False) -> BatchResult:
        """The rows as the batch of a day, unless there is one already."""
        label = day.isoformat()
        if self.has_batch(table, label):
            return BatchResult("already-registered", label)
        dated = rows.withColumns({"year": F.lit(day.year), "batch": F.lit(label)})
        done = self.publish(table, dated, once=once)
        return done[0] if done else BatchResult("no-new-records", label)

    def years(self, table: str) -> DataFrame:
        """``year`` of every whole-year batch."""
        return self.batches(table).where(F.col("batch") == YEAR_BATCH).select("year")

    def years_with_dated_batches(self, table: str) -> DataFrame:
        """``year`` of dated batches; folding such a year into one batch would store its rows
        twice."""
        return self.batches(table).where(F.col("batch") != YEAR_BATCH).select("year").distinct()

    def backfill_years(
        self, table: str, rows: DataFrame, skip: DataFrame | None = None
    ) -> tuple[list[BatchResult], int]:
        """One batch for every ``year`` of the rows, all written in one job, and the number
        of rows without a year, which can not be stored.

        Years that have their batch, and those to ``skip``, are left out before anything
        is shuffled. The rows are read more than once, so pass a staged table.
        """
        done = self.years(table) if skip is None else self.years(table).union(skip).distinct()
        fresh = rows.join(F.broadcast(done), "year", "left_anti").where("year is not null")
        added = self.publish(table, fresh.withColumn("batch", F.lit(YEAR_BATCH)))
        return added, rows.where("year is null").count()

    # ------------------------------------------------------------- storage

    def stored_files(self) -> DataFrame:
        """Files in the tables' folders, registered or not: ``table_name``, ``file`` and its
        ``rows``. The folders are listed anew, and only footers are read."""
        try:
            found = (
                self.spark.read.schema("nothing int")  # no column is read
                .option("recursiveFileLookup", "true")
                .parquet(self.root)
            )
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return empty_table(self.spark, "table_name string, file string, rows long")
        files = found.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
        return files.select(
            table_of_path(relative_path(F.col("file"), self.root)).alias("table_name"), "file", "rows"
        ).where("table_name IS NOT NULL")

    def stored_paths(self) -> DataFrame:
        """Path below the root of every stored Parquet file. Only names are listed."""
        try:
            listing = (
                self.spark.read.format("binaryFile")
                .option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", "true")
                .load(self.root)
                .select("path")
            )
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return empty_table(self.spark, "path string")
        return listing.select(relative_path(F.col("path"), self.root).alias("path"))

    def rebuild(self) -> str:
        """Catalog partitions and the list of files from what is stored, after the catalog
        was lost. Files outside of the tables' folders are counted."""
        routed = self.stored_paths().where(~F.col("path").startswith("_")).select(
            table_of_path(F.col("path")).alias("table")
        )
        files = {r["table"]: r["count"] for r in routed.groupBy("table").count().collect()}
        unknown = files.pop(None, 0)
        if not files:
            return "refused: no parquet files in storage"
        batches = 0
        kept = self.data_files().select("file").distinct()
        for table in sorted(files):
            self.spark.sql(f"MSCK REPAIR TABLE {self._name(table)}")
            self.spark.catalog.refreshTable(self._name(table))
            batches += self.batches(table).count()
            rows = self.stored(table).groupBy(
                "year", "batch", F.col("_metadata.file_path").alias("file")
            ).agg(F.count("*").alias("rows"))
            (
                rows.join(kept, "file", "left_anti")
                .select(F.lit(table).alias("table_name"), "year", "batch", "file", "rows", F.lit("rebuilt").alias("message"))
                .coalesce(1).write.mode("append").insertInto(self._name(DATA_FILES))
            )
        suffix = f" (ignored {unknown} unknown files)" if unknown else ""
        return f"rebuilt catalog with {batches} batches{suffix}"
