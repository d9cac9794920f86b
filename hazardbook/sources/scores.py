"""Daily exploit-prediction score files (three generations of CSV)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardbook.functions.times import date_in_file_name

# A landed file may be a folder of that name with the file in it, as Spark writes it.
_FILE = r"[.]csv[.]gz(/part-[^/]*)?"
_NAME = rf"epss_scores-[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}{_FILE}$"

# Cells of a line; ``line`` is the whole line if it does not have these three cells.
CELLS = "cve string, epss double, percentile double, line string"
CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "line",
    "recursiveFileLookup": "true",
}


def is_score_file(path: Column) -> Column:
    """Dated score files outside of ``beta_scores`` directories."""
    return path.rlike("(^|/|=)" + _NAME) & ~path.rlike("(^|/|=)beta_scores/")


def file_date(path: Column) -> Column:
    return date_in_file_name(path, "epss_scores-", _FILE)


def with_path(scan: DataFrame) -> DataFrame:
    """The cells of score files only, with the URL of their file as ``path``; files of
    other names are not opened."""
    rows = scan.select("cve", "epss", "percentile", "line", F.col("_metadata.file_path").alias("path"))
    return rows.where(is_score_file(F.col("path")))


def read_score_cells(spark: SparkSession, root: str) -> DataFrame:
    return with_path(spark.read.schema(CELLS).options(**CSV_OPTIONS).csv(root))


def _headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the comment line above every row. A compressed file is one task's, from its
    first line on, so the comment is carried down within its file."""
    path, header = None, None
    for batch in batches:
        lines, paths = batch.column("line"), batch.column("path")
        comment = pc.fill_null(pc.starts_with(lines, "#"), False).to_numpy(zero_copy_only=False)
        codes = paths.dictionary_encode().indices.to_numpy()
        begins = np.union1d(np.flatnonzero(comment), np.flatnonzero(np.diff(codes, prepend=-1)))
        ends = [*begins[1:].tolist(), batch.num_rows]
        headers, lengths = [], []
        for begin, end in zip(begins.tolist(), ends, strict=True):
            here = paths[begin].as_py()
            if here != path:
                path, header = here, None
            if comment[begin]:
                header = lines[begin].as_py()
            headers.append(header)
            lengths.append(end - begin)
        of = pa.array(np.repeat(np.arange(len(headers)), lengths))
        columns = [*batch.columns, pa.array(headers, pa.string()).take(of)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "header"])


def score_rows(cells: DataFrame) -> DataFrame:
    """Score rows and their ``path`` and ``valid``, from the cells of any number of files,
    each read once.

    The optional first line ``#model_version:..,score_date:..`` gives the model and the
    date, else they are ``v1`` and the date in the file name. The earliest generation
    has no percentile column, which then is NULL. Blank lines do not count; a line with
    a missing id, a value that is no number, or too many cells is not valid.
    """
    headed = cells.mapInArrow(_headed, f"{CELLS}, path string, header string")
    line, header = F.col("line"), F.col("header")
    titles = line.startswith("#") | (F.col("cve") == "cve")
    scores = headed.where(~F.coalesce(line.isNotNull() & titles, F.lit(False)))
    model = F.when(
        header.rlike("[#,]model_version:"), F.regexp_extract(header, "[#,]model_version:([^,]*)", 1)
    )
    named_date = F.regexp_extract(header, "[#,]score_date:([^,]{0,10})", 1).try_cast("date")
    two_cells = F.col("percentile").isNull() & (F.size(F.split(line, ",")) == 2)
    day = F.when(header.rlike("[#,]score_date:"), named_date).otherwise(file_date(F.col("path")))
    rows = scores.select(
        "cve",
        "epss",
        "percentile",
        day.alias("date"),
        F.coalesce(model, F.lit("v1")).alias("model_version"),
        "path",
        (line.isNull() | two_cells).alias("whole"),
    )
    valid = (F.col("cve") != "") & F.col("epss").isNotNull() & F.col("date").isNotNull() & F.col("whole")
    return rows.withColumn("valid", F.coalesce(valid, F.lit(False))).drop("whole")


def read_scores(spark: SparkSession, root: str) -> DataFrame:
    return score_rows(read_score_cells(spark, root))
