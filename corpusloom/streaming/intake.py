"""Incremental intake: new index files join a table of records, prior decisions stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import collapse_duplicates
from ..sources.tables import INDEX


def new_rows(batch: DataFrame, known: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` whose id the table lacks, exact repeats collapsed to the first by ``order`` (by default by title and
    path: files have no order of their own). Only the ids of the table are read."""
    fresh = batch.join(known.select("eo_id").distinct(), "eo_id", "left_anti")
    return collapse_duplicates(fresh, "eo_id", "source_pdf_url", order or ["title", "pdf_path"])[0].select(*batch.columns)


def follow(spark: SparkSession, source: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append what new JSON-lines files in ``source`` bring to the Parquet ``table``; one run takes all there is."""

    def step(batch: DataFrame, _: int) -> None:
        try:
            known = spark.read.schema(batch.schema).parquet(table)
        except Exception as e:  # the first run has no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = batch.limit(0)
        new_rows(batch, known).select(*batch.columns).write.mode("append").parquet(table)

    stream = spark.readStream.schema(INDEX).json(source)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
