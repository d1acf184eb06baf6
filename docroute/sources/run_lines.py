"""The run summary as lines on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.operators import reports as rp

# Columns of the run summary.
SUMMARY = ["date", "step", "processed", "need_review", "errors", "duration_sec", "status"]


def append(records: DataFrame, path: str) -> None:
    """Add run records; the table is append-only."""
    records.select(*SUMMARY).write.mode("append").parquet(path)


def read_legacy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Text lines of old and new width as typed rows, and the lines that are neither."""
    lines = spark.read.text(path).where(~F.col("value").startswith("date,"))
    return rp.run_rows(lines), rp.rejected_lines(lines)
