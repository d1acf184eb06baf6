"""Monthly roll-up of archived files per plan: candidates, order, status, late arrivals, ledger views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators.ordered import positions

DONE = ["aggregated", "aggregated_late"]  # fixed: statuses that close a month
MONTH = ["plan", "year", "month"]


def scan(files: DataFrame) -> DataFrame:
    """Each file of a plan folder as candidate, unmatched (with reason) or skipped.

    files: plan_folder, file_name and anything to carry along.
    """
    parsed = files.withColumn("p", t.parse_archive_name(F.col("file_name"))).withColumn("plan", t.norm_plan("plan_folder"))
    summary = F.lower("file_name").startswith("summary -")
    other = F.upper("p.plan") != F.upper("plan")
    return parsed.select(
        *files.columns, "plan", F.col("p.check").alias("check"), F.col("p.year").alias("year"), F.col("p.month").alias("month"), F.col("p.plan").alias("file_plan"),
        F.when(summary, "skipped").when(F.col("p").isNull(), "unmatched").when(other, "unmatched").otherwise("candidate").alias("kind"),
        F.when(summary, "").when(F.col("p").isNull(), "Filename does not match the archive convention")
        .when(other, F.concat(F.lit("Filename plan "), "p.plan", F.lit(" disagrees with folder plan "), "plan")).otherwise("").alias("reason"))


def in_month(candidates: DataFrame, month) -> DataFrame:
    """T8 for one target month: files of other months are passed over in silence."""
    first = F.lit(month).cast("date")
    return candidates.where((F.col("kind") != "candidate") | ((F.col("year") == F.year(first)) & (F.col("month") == F.month(first))))


def for_plan(df: DataFrame, plan: str) -> DataFrame:
    """One plan only."""
    return df.where(F.upper("plan") == plan.upper())


def manifest(candidates: DataFrame, tie: str = "file_no") -> DataFrame:
    """Merge order of each plan-month by check number, then name.

    Positions come from a range-partitioned count, so a plan-month with very many files is not one task's work.
    """
    c = candidates.withColumn("k", t.check_key("check")).withColumns({"k1": F.col("k.prefix"), "k2": F.struct("k.n_digits", "k.num"), "k3": F.col("k.suffix")}).drop("k")
    return positions(c, MONTH, [F.asc("k1"), F.asc("k2"), F.asc("k3"), F.asc("file_name"), F.asc(tie)])


def month_status(ledger: DataFrame) -> DataFrame:
    """Plan-months closed by the ledger, with their rows and latest time."""
    return ledger.where(F.col("status").isin(DONE)).groupBy(F.upper("plan_norm").alias("plan"), F.col("target_year").alias("year"), F.col("target_month").alias("month")).agg(
        F.count("*").alias("n_rows"), F.max("run_timestamp").alias("latest"))


def preflight(ledger: DataFrame, active: DataFrame) -> DataFrame:
    """Per month, how many of the active plans are closed, in one of three wordings."""
    total = active.agg(F.count("*")).scalar()
    g = month_status(ledger).groupBy("year", "month").agg(F.count("*").alias("n_done"), F.max("latest").alias("latest"))
    head = F.concat(F.lit("Ledger: "), F.col("n_done").cast("string"), F.lit(" of "), total.cast("string"), F.lit(" active plans aggregated for "), t.month_name(F.col("month")), F.lit(" "), F.col("year").cast("string"))
    return g.withColumn("line", F.when(F.col("n_done") == 0, F.concat(head, F.lit(" — will process all"))).when(
        (F.col("n_done") >= total) & (total > 0), F.concat(head, F.lit(" (latest "), "latest", F.lit(") — nothing to do (pass --force to redo)"))
    ).otherwise(F.concat(head, F.lit(" (latest "), "latest", F.lit(") — rerun will idempotently skip them"))))


def target_month(run_date: Column, requested: Column | None = None) -> Column:
    """The requested month or the one before the run; a refused month fails the job."""
    m = t.previous_month(run_date) if requested is None else t.parse_month(requested)
    why = t.month_refusal(m, run_date)
    return F.when(m.isNull(), F.raise_error(F.lit("month must be YYYY-MM")).cast("date")).when(
        why.isNotNull(), F.raise_error(F.concat(F.lit("month refused: "), why)).cast("date")).otherwise(m)


def rollup(targets: DataFrame, folders: DataFrame, root: DataFrame, processed: DataFrame, ledger: DataFrame, summaries: DataFrame,
           force: bool = False, dry_run: bool = False) -> DataFrame:
    """One ledger-ready row per target plan-month.

    targets: plan, year, month. folders: plan. root, processed: candidates by area. summaries: plan, year, month
    whose summary file is present. Everything is counted per plan-month first; the joins see one row each.
    """
    count = lambda df, name: df.groupBy(*MONTH).agg(F.count("*").alias(name))
    j = (
        targets.join(folders.select("plan").distinct().withColumn("has_folder", F.lit(True)), "plan", "left")
        .join(count(root, "n_root"), MONTH, "left")
        .join(count(processed, "n_processed"), MONTH, "left")
        .join(month_status(ledger).select(*MONTH, F.lit(True).alias("done")), MONTH, "left")
        .join(summaries.select(*MONTH).distinct().withColumn("summary_ok", F.lit(True)), MONTH, "left")
    )
    j = j.withColumns({**{c: F.coalesce(c, F.lit(False)) for c in ("has_folder", "done", "summary_ok")}, **{c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_root", "n_processed")}})
    redo = F.lit(force) & (F.col("n_root") == 0) & (F.col("n_processed") > 0)
    n = F.when(redo, F.col("n_processed")).otherwise(F.col("n_root"))
    intact = F.col("summary_ok") & (F.col("n_processed") > 0)
    write = n > 0
    status = (
        F.when(~F.col("has_folder"), "skipped_no_folder")
        .when(F.col("done") & ~write & F.lit(not force), F.when(intact, "skipped_already_done").otherwise("error"))
        .when(~write, "skipped_no_files")
        .when(F.lit(dry_run), "dry_run")
        .when(F.col("done"), "aggregated_late")
        .otherwise("aggregated")
    )
    j = j.withColumns({"from_processed": redo, "n": n, "status": status})
    merged = F.col("status").isin("dry_run", *DONE)
    late = F.when(F.col("done"), "would have aggregated_late").otherwise("would have aggregated")
    flag = lambda c: F.when(c, "True").otherwise("False")
    notes = (
        F.when(F.col("status") == "error", F.concat(F.lit("ledger-filesystem disagreement (summary="), flag(F.col("summary_ok")), F.lit(", processed="), flag(F.col("n_processed") > 0), F.lit(")")))
        .when(F.col("status") == "dry_run", F.concat(late, F.when(F.col("from_processed"), " (from Processed/)").otherwise("")))
        .when(F.col("status").isin(DONE) & F.col("from_processed"), F.when(F.col("done"), "re-aggregated from Processed/ (force, plan was previously done)").otherwise("re-aggregated from Processed/ (force)"))
        .otherwise("")
    )
    return j.select(
        F.col("plan").alias("plan_norm"), F.col("year").alias("target_year"), F.col("month").alias("target_month"), "status",
        F.when(merged, t.summary_name(F.col("month"), F.col("year"), F.col("plan"))).otherwise("").alias("summary_filename"),
        F.when(merged, F.col("n")).otherwise(0).alias("sources_merged"), notes.alias("notes"))
