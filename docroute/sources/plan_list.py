"""Reading the plan list, its lists by day, and the gate that asks for the list of the run's day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import dimension
from docroute.session import checkpointed
from docroute.sources.files import numbered, place

# List headers, as they come, and the column each one feeds.
HEADERS = {
    "Strata Plan": "strata_plan", "Strata Name": "strata_name", "Address": "address", "Strata Manager": "strata_manager",
    "Manager email": "manager_email", "AP Name": "ap_name", "AP email": "ap_email", "Status": "status",
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A list export with a header row. `row_no` is the row's position in its file, and files follow each other by name."""
    df = spark.read.option("header", True).option("multiLine", False).csv(path)
    named = df.select(*place(), *[F.col(f"`{h}`").cast("string").alias(c) if h in df.columns else F.lit(None).cast("string").alias(c) for h, c in HEADERS.items()])
    rows = numbered(named, [], "row_no").drop("file")
    return rows.where(F.concat_ws("", *[t.strip(F.col(c)) for c in HEADERS.values()]) != "")


def load_plans(raw: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed, validated plan rows; strict also refuses conflicting routing (A1)."""
    plans = dimension.validated(dimension.parse(raw, keep))
    return dimension.require_consistent(plans) if strict else plans


# ---- S2: lists by day, one folder each

_DAILY = ", ".join(["row_no long", *(f"{c} string" for c in HEADERS.values()), "as_of date"])


def put_day(raw: DataFrame, path: str, as_of: str) -> None:
    """Write one day's list in place of that day's; the other days stay as they are."""
    columns = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in HEADERS.values()]
    day = raw.select(F.col("row_no").cast("long"), *columns, F.lit(as_of).cast("date").alias("as_of"))
    day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(path)


def daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_DAILY).parquet(path)


def for_runs(lists: DataFrame, runs: DataFrame) -> DataFrame:
    """The raw rows of the list of each run's day: runs (run_date, ...) decide which days are read."""
    return runs.join(lists, F.col("as_of") == F.col("run_date")).drop("as_of")


def require_fresh(lists: DataFrame, run_date: str) -> DataFrame:
    """The rows of `as_of = run_date`; the job fails when that day has no list."""
    today = lists.where(F.col("as_of") == F.lit(run_date).cast("date"))
    if today.isEmpty():
        raise RuntimeError(f"plan snapshot is not of {run_date}")
    return today


def current(spark: SparkSession, path: str, run_date: str, refresh: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Today's list. A job that may fetch it (`refresh` gives its raw rows) does so once, when today's is missing."""
    lists = daily(spark, path)
    if refresh is not None and lists.where(F.col("as_of") == F.lit(run_date).cast("date")).isEmpty():
        put_day(refresh(), path, run_date)
        lists = daily(spark, path)
    return require_fresh(lists, run_date)


def written(parsed: DataFrame) -> DataFrame:
    """The parsed list, written once to the shared folder, so that all operators of a job read the same rows."""
    return checkpointed(parsed)
