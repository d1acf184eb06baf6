"""Storage against the ledger: orphans, stale rows, repeats, leftovers, totals and a short report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroute.functions import text as t


def orphans(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content is under neither hash column of the ledger."""
    known = ledger.select(F.explode(F.array("sha256", "archive_sha256")).alias("sha256")).where("sha256 <> ''").distinct()
    return files.where(F.col("file_name").endswith(".pdf") & ~t.is_done_marker("file_name")).join(known, "sha256", "left_anti")


def stale(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Archived rows whose file is gone."""
    rows = ledger.where("current_stage = 'archived' and archive_path <> ''")
    return rows.join(files.select(F.col("path").alias("archive_path")).distinct(), "archive_path", "left_anti")


def report(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per finding."""
    blank = F.lit("")
    detail = F.concat(F.lit("dup_count="), F.col("dup_count").cast("string"), F.lit(" last_dup_date="), "last_dup_date", F.lit(" archive="), "archive_path")
    parts = [
        orphans(files, ledger).select(F.lit("orphan").alias("category"), "sha256", blank.alias("plan_norm"), F.col("path").alias("detail")),
        stale(files, ledger).select(F.lit("stale_archive").alias("category"), "sha256", "plan_norm", F.col("archive_path").alias("detail")),
        ledger.where("dup_count > 0").select(F.lit("repeat").alias("category"), "sha256", "plan_norm", detail.alias("detail")),
        files.where(F.col("file_name").contains(".tmp.")).select(F.lit("orphan_tmp").alias("category"), blank.alias("sha256"), blank.alias("plan_norm"), F.col("path").alias("detail")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def totals(files: DataFrame, ledger: DataFrame, findings: DataFrame) -> DataFrame:
    """One row per figure of the summary."""
    scanned = files.where(F.col("file_name").endswith(".pdf") & ~t.is_done_marker("file_name")).agg(F.lit("scanned").alias("category"), F.count("*").alias("n"))
    rows = ledger.agg(F.lit("ledger_rows").alias("category"), F.count("*").alias("n"))
    return scanned.unionByName(rows).unionByName(findings.groupBy("category").agg(F.count("*").alias("n")))


def short_report(findings: DataFrame, k: int = 25) -> DataFrame:
    """The first k of each category with how many more there are.

    The rank filter is applied per task before the shuffle, so a category with very many rows moves only k per task.
    """
    w = Window.partitionBy("category").orderBy("detail", "sha256")
    top = findings.where("category <> 'repeat'").withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)
    n = findings.groupBy("category").agg(F.count("*").alias("n"))
    return top.join(n, "category").withColumn("n_more", F.greatest(F.lit(0), F.col("n") - k)).drop("n")
