"""Daily score files picked up as they arrive, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from hazardbook.sinks.ingest import add_score_days
from hazardbook.sinks.lake import Lake
from hazardbook.sources.scores import CELLS, CSV_OPTIONS, score_rows, with_path


def score_stream(lake: Lake, landed: str, files_per_batch: int = 200) -> DataFrame:
    """Score rows of newly landed files. A file arrives whole in one micro-batch, so its
    header and its rows are always together."""
    cells = (
        lake.spark.readStream.schema(CELLS)
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(landed)
    )
    return score_rows(with_path(cells))


def ingest_arrivals(
    lake: Lake, landed: str, checkpoint: str, files_per_batch: int = 200
) -> StreamingQuery:
    """Append all files landed since the last run and stop.

    A micro-batch that is run again after a failure finds its days in the catalog, or
    replaces what was left of them, so every day is stored once.
    """

    def append(batch: DataFrame, _: int) -> None:
        add_score_days(lake, batch)

    return (
        score_stream(lake, landed, files_per_batch)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
