"""Monthly roll-up: X5, F8, F13, J17, J18, O1, O6, P18, P24, A16-A18, T1-T9, S7, S9."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import dimension as dim
from docroute.operators import monthly as mo
from docroute.plans.dimension_queries import plans
from docroute.plans.registry import norm, query, view
from docroute.session import checkpointed
from docroute.sources.ledger_store import monthly_rows, parse_monthly
from docroute.sources.tables import table

_ARCH = r"'(?i)^(.+?)\s*-\s*(0[1-9]|1[0-2])\s*-\s*([A-Z]{2,6}\d{1,6}[A-Z]{0,3})\s+([A-Za-z]+)\s+(\d{4})\s+inv(?:\s*\(\d+\))?\.pdf$'"
_MONTHS = "['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November', 'December']"
view("arch_parsed", rf"""
SELECT *, ok AND upper(file_plan) = upper(plan) AS good FROM (
  SELECT *, {norm('plan_folder')} AS plan, g1 <> '' AND NOT regexp_matches(lower(file_name), '^(processed|paid|summary) ?-') AND lower(mname) = lower({_MONTHS}[month]) AS ok FROM (
    SELECT *, trim(regexp_extract(file_name, {_ARCH}, 1)) AS g1, coalesce(try_cast(regexp_extract(file_name, {_ARCH}, 2) AS INT), 1) AS month, upper(regexp_extract(file_name, {_ARCH}, 3)) AS file_plan,
      regexp_extract(file_name, {_ARCH}, 4) AS mname, coalesce(try_cast(regexp_extract(file_name, {_ARCH}, 5) AS INT), 0) AS year FROM fx_archive_files))""")


def files(spark, d) -> DataFrame:
    return table(spark, d, "fx_archive_files")


@query("archive_parse", "SELECT file_no, CASE WHEN ok THEN g1 ELSE '' END AS check_no, CASE WHEN ok THEN month ELSE 0 END AS month, CASE WHEN ok THEN year ELSE 0 END AS year, CASE WHEN ok THEN file_plan ELSE '' END AS plan FROM arch_parsed")
def archive_parse(spark, d):
    p = files(spark, d).withColumn("p", t.parse_archive_name(F.col("file_name")))
    return p.select("file_no", t.blank("p.check").alias("check_no"), F.coalesce("p.month", F.lit(0)).alias("month"), F.coalesce("p.year", F.lit(0)).alias("year"), t.blank("p.plan").alias("plan"))


@query("monthly_candidates", """
SELECT file_no, plan, CASE WHEN starts_with(lower(file_name), 'summary -') THEN 'skipped' WHEN good THEN 'candidate' ELSE 'unmatched' END AS kind,
  CASE WHEN starts_with(lower(file_name), 'summary -') OR good THEN '' WHEN NOT ok THEN 'Filename does not match the archive convention' ELSE 'Filename plan ' || file_plan || ' disagrees with folder plan ' || plan END AS reason FROM arch_parsed""")
def monthly_candidates(spark, d):
    return mo.scan(files(spark, d)).select("file_no", "plan", "kind", "reason")


view("arch_order", r"""
SELECT *, CASE WHEN regexp_matches(g1, '\d') THEN upper(regexp_extract(g1, '^([^\d]*)', 1)) ELSE '~' || upper(g1) END AS k1,
  CASE WHEN regexp_matches(g1, '\d') THEN CAST(regexp_extract(g1, '^[^\d]*(\d+)', 1) AS DECIMAL(38, 0)) ELSE 0 END AS k2,
  CASE WHEN regexp_matches(g1, '\d') THEN regexp_extract(g1, '^[^\d]*\d+(.*)$', 1) ELSE g1 END AS k3 FROM arch_parsed WHERE good""")


@query("check_order", "SELECT file_no, g1 AS check_no, k1, CAST(k2 AS VARCHAR) AS k2, k3 FROM arch_order")
def check_order(spark, d):
    c = mo.scan(files(spark, d)).where("kind = 'candidate'").withColumn("k", t.check_key("check"))
    return c.select("file_no", F.col("check").alias("check_no"), F.col("k.prefix").alias("k1"), F.when(F.col("k.num") == "", "0").otherwise(F.col("k.num")).alias("k2"), F.col("k.suffix").alias("k3"))


@query("merge_manifest", "SELECT plan, year, month, file_no, file_name, row_number() OVER (PARTITION BY plan, year, month ORDER BY k1, k2, k3, file_name, file_no) AS position FROM arch_order")
def merge_manifest(spark, d):
    c = mo.scan(files(spark, d)).where("kind = 'candidate'").select("plan", "year", "month", "check", "file_no", "file_name")
    return mo.manifest(c).select("plan", "year", "month", "file_no", "file_name", "position")


# ---- two runs: the first closes the months of every other base number, the second meets what is left

FIRST_RUN, SECOND_RUN = "2001-09-01 15:30:00", "2001-10-01 15:30:00"
view("run_files", r"""
SELECT *, CASE WHEN CAST(regexp_extract(plan, '(\d+)', 1) AS INT) % 2 = 0 AND file_no % 3 <> 0 THEN 'processed' ELSE 'root' END AS area FROM arch_parsed""")
view("agg_ledger_v", r"""
SELECT plan, year, month, count(*) AS n FROM arch_parsed WHERE good AND CAST(regexp_extract(plan, '(\d+)', 1) AS INT) % 2 = 0 AND plan IN (SELECT plan_norm FROM plan_rows WHERE status_active) GROUP BY ALL""")
view("target_v", """
SELECT DISTINCT plan, CAST(year(mtime) AS INT) AS year, CAST(month(mtime) AS INT) AS month FROM run_files WHERE plan IN (SELECT plan_norm FROM plan_rows WHERE status_active)
UNION ALL SELECT DISTINCT plan_norm, 2001, 9 FROM plan_rows WHERE status_active AND plan_norm NOT IN (SELECT plan FROM run_files)""")


def _rollup_sql(force: bool) -> str:
    f = "true" if force else "false"
    return rf"""
SELECT plan AS plan_norm, year AS target_year, month AS target_month, status, CASE WHEN merged THEN lpad(CAST(month AS VARCHAR), 2, '0') || ' - ' || plan || ' ' || {_MONTHS}[month] || ' ' || year || ' inv.pdf' ELSE '' END AS summary_filename,
  CASE WHEN merged THEN n ELSE 0 END AS sources_merged, CASE WHEN status = 'error' THEN 'ledger-filesystem disagreement (summary=' || CASE WHEN summary_ok THEN 'True' ELSE 'False' END || ', processed=' || CASE WHEN np > 0 THEN 'True' ELSE 'False' END || ')'
    WHEN merged AND redo THEN CASE WHEN done THEN 're-aggregated from Processed/ (force, plan was previously done)' ELSE 're-aggregated from Processed/ (force)' END ELSE '' END AS notes
FROM (SELECT *, status IN ('aggregated', 'aggregated_late') AS merged FROM (SELECT *, CASE WHEN NOT has_folder THEN 'skipped_no_folder' WHEN done AND n = 0 AND NOT {f} THEN CASE WHEN summary_ok AND np > 0 THEN 'skipped_already_done' ELSE 'error' END
    WHEN n = 0 THEN 'skipped_no_files' WHEN done THEN 'aggregated_late' ELSE 'aggregated' END AS status
  FROM (SELECT *, {f} AND nr = 0 AND np > 0 AS redo, CASE WHEN {f} AND nr = 0 AND np > 0 THEN np ELSE nr END AS n FROM (
    SELECT t.*, coalesce(r.n, 0) AS nr, coalesce(p.n, 0) AS np, l.plan IS NOT NULL AS done, l.plan IS NOT NULL AND t.month <> 2 AS summary_ok, t.plan IN (SELECT plan FROM run_files) AS has_folder FROM target_v t
    LEFT JOIN (SELECT plan, year, month, count(*) AS n FROM run_files WHERE good AND area = 'root' GROUP BY ALL) r ON r.plan = t.plan AND r.year = t.year AND r.month = t.month
    LEFT JOIN (SELECT plan, year, month, count(*) AS n FROM run_files WHERE good AND area = 'processed' GROUP BY ALL) p ON p.plan = t.plan AND p.year = t.year AND p.month = t.month
    LEFT JOIN agg_ledger_v l ON l.plan = t.plan AND l.year = t.year AND l.month = t.month))))"""


def runs(spark, d):
    """Targets, folders, candidates by area, and the ledger the first run left."""
    first_half = F.regexp_extract("plan", r"(\d+)", 1).cast("int") % 2 == 0
    c = checkpointed(mo.scan(files(spark, d)).select("plan", "year", "month", "kind", "mtime", "file_no"))
    active = dim.unique_active(plans(spark, d)).select(F.col("plan_norm").alias("plan"))
    good = c.where("kind = 'candidate'")
    nothing = good.limit(0)
    ledger0 = parse_monthly(spark.createDataFrame([], "run_date string, run_timestamp string, plan_norm string, target_year string, target_month string, status string, summary_filename string, sources_merged string, notes string"))
    first = good.where(first_half).join(active, "plan", "left_semi")
    ledger = checkpointed(monthly_rows(mo.rollup(first.select(*mo.MONTH).distinct(), first, first, nothing, ledger0, nothing), F.lit(FIRST_RUN).cast("timestamp")))
    seen = c.join(active, "plan", "left_semi").select("plan", F.year("mtime").alias("year"), F.month("mtime").alias("month")).distinct()
    last = mo.target_month(F.to_date(F.lit(SECOND_RUN)))
    missing = active.join(c.select("plan"), "plan", "left_anti").select("plan", F.year(last).alias("year"), F.month(last).alias("month"))
    moved = first_half & (F.col("file_no") % 3 != 0)
    summaries = ledger.where("target_month <> 2").select(F.col("plan_norm").alias("plan"), F.col("target_year").alias("year"), F.col("target_month").alias("month"))
    return dict(targets=seen.unionByName(missing), folders=c, root=good.where(~moved), processed=good.where(moved), ledger=ledger, summaries=summaries)


@query("monthly_rollup", _rollup_sql(False))
def monthly_rollup(spark, d):
    return mo.rollup(**runs(spark, d))


@query("monthly_forced", _rollup_sql(True))
def monthly_forced(spark, d):
    return mo.rollup(**runs(spark, d), force=True)


@query("monthly_late", f"SELECT plan_norm, target_year, target_month, sources_merged FROM ({_rollup_sql(False)}) WHERE status = 'aggregated_late'")
def monthly_late(spark, d):
    """T5: late arrivals only, in months the ledger had closed."""
    return mo.rollup(**runs(spark, d)).where("status = 'aggregated_late'").select("plan_norm", "target_year", "target_month", "sources_merged")


@query("monthly_dry_run", f"SELECT plan_norm, target_year, target_month, 'dry_run' AS status, CASE WHEN status = 'aggregated' THEN 'would have aggregated' ELSE 'would have aggregated_late' END AS notes FROM ({_rollup_sql(False)}) WHERE status IN ('aggregated', 'aggregated_late')")
def monthly_dry_run(spark, d):
    return mo.rollup(**runs(spark, d), dry_run=True).where("status = 'dry_run'").select("plan_norm", "target_year", "target_month", "status", "notes")


@query("month_status", "SELECT plan, year, month, 1 AS n_rows, '2001-09-01T08:30:00' AS latest FROM agg_ledger_v")
def month_status(spark, d):
    return mo.month_status(runs(spark, d)["ledger"])


@query("preflight", f"""
SELECT year, month, count(*) AS n_done, 'Ledger: ' || count(*) || ' of ' || (SELECT count(DISTINCT plan_norm) FROM plan_rows WHERE status_active) || ' active plans aggregated for ' || {_MONTHS}[month] || ' ' || year || ' (latest 2001-09-01T08:30:00) — rerun will idempotently skip them' AS line
FROM agg_ledger_v GROUP BY year, month""")
def preflight(spark, d):
    return mo.preflight(runs(spark, d)["ledger"], dim.unique_active(plans(spark, d))).select("year", "month", "n_done", "line")
