"""Reading landed files as text, with their path below the landing folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def relative_path(file_path: Column, root: str) -> Column:
    """Path below ``root`` of a file URL."""
    base = root.split(":", 1)[-1].rstrip("/") + "/"
    plain = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.substring(plain, F.instr(plain, base) + len(base), F.length(plain))


def read_documents(spark: SparkSession, root: str, name_glob: str) -> DataFrame:
    """One row per file: ``path`` below the root and the whole text as ``value``.
    Filters on the path drop files before they are read."""
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .text(root, wholetext=True)
    )
    return files.select(
        relative_path(F.col("_metadata.file_path"), root).alias("path"), "value"
    )
