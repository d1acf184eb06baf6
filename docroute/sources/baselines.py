"""Baseline lists of file names per owner, kind and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions import text as t

# Headers that may name the list column, first match by position wins.
NAME_HEADERS = ["invoice", "filename", "currentfilename", "name", "invoicelist"]


def read_list(raw: DataFrame) -> DataFrame:
    """The names of one list file read with a header row: a known column, else the first non-empty cell."""
    known = [c for c in raw.columns if c.strip().lower() in NAME_HEADERS]
    cells = [F.col(f"`{known[0]}`")] if known else [F.nullif(F.col(f"`{c}`"), F.lit("")) for c in raw.columns]
    return raw.select(t.strip(F.coalesce(*[c.cast("string") for c in cells], F.lit(""))).alias("file_name")).where("file_name <> ''")


def write(baselines: DataFrame, path: str) -> None:
    """Replace exactly the (kind, day, owner) partitions present in the frame; '' records an empty list."""
    baselines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "as_of", "owner_key").parquet(path)


def days(spark: SparkSession, path: str) -> DataFrame:
    """The lists of all days."""
    return spark.read.schema("file_name string, kind string, as_of date, owner_key string").parquet(path)


def read(spark: SparkSession, path: str, as_of: str | None = None) -> DataFrame:
    """Lists of one day (managers compare with yesterday's), or each owner's latest per kind (payers roll on)."""
    df = days(spark, path)
    if as_of is not None:
        return df.where(F.col("as_of") == F.lit(as_of).cast("date"))
    last = df.groupBy("kind", "owner_key").agg(F.max("as_of").alias("as_of"))
    return df.join(last, ["kind", "owner_key", "as_of"], "left_semi")
