"""Reconciliation: S15, S16, F14, J13, J14, U5, A24, O7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.operators import reconcile as rc
from docroute.plans.registry import query, view
from docroute.sources.tables import table

view("disk_v", """
SELECT plan_folder || '/' || file_no || '/' || file_name AS path, file_name, CASE WHEN file_no % 4 = 0 THEN 'a' ELSE 'h' END || file_no AS sha256 FROM fx_archive_files
UNION ALL SELECT stage || '/' || owner || '/' || doc_id || '/' || file_name || CASE WHEN doc_id % 11 = 0 THEN '.tmp.77' ELSE '' END, file_name || CASE WHEN doc_id % 11 = 0 THEN '.tmp.77' ELSE '' END, 'd' || doc_id FROM fx_queue_files""")
view("disk_ledger", """
SELECT 'h' || file_no AS sha256, CASE WHEN file_no % 8 = 0 THEN 'a' || file_no ELSE '' END AS archive_sha256, plan_folder AS plan_norm, CASE WHEN file_no % 3 = 0 THEN 'ap_queue' ELSE 'archived' END AS current_stage,
  CASE WHEN file_no % 6 = 1 THEN '' ELSE plan_folder || '/' || file_no || '/' || CASE WHEN file_no % 17 = 0 THEN 'moved ' ELSE '' END || file_name END AS archive_path, CASE WHEN file_no % 10 = 0 THEN 2 ELSE 0 END AS dup_count,
  CASE WHEN file_no % 10 = 0 THEN CAST(CAST(mtime AS DATE) AS VARCHAR) ELSE '' END AS last_dup_date, CAST(CAST(mtime AS DATE) AS VARCHAR) AS first_seen_date, file_no FROM fx_archive_files WHERE file_no % 5 <> 0 OR file_no % 10 = 0""")


def disk(spark, d) -> DataFrame:
    f, q = table(spark, d, "fx_archive_files"), table(spark, d, "fx_queue_files")
    tmp = F.concat("file_name", F.when(F.col("doc_id") % 11 == 0, ".tmp.77").otherwise(""))
    a = f.select(F.concat_ws("/", "plan_folder", "file_no", "file_name").alias("path"), "file_name", F.concat(F.when(F.col("file_no") % 4 == 0, "a").otherwise("h"), "file_no").alias("sha256"))
    return a.unionByName(q.select(F.concat_ws("/", "stage", "owner", "doc_id", tmp).alias("path"), tmp.alias("file_name"), F.concat(F.lit("d"), "doc_id").alias("sha256")))


def disk_ledger(spark, d) -> DataFrame:
    f = table(spark, d, "fx_archive_files").where("file_no % 5 <> 0 or file_no % 10 = 0")
    n, day = F.col("file_no"), F.to_date("mtime").cast("string")
    return f.select(
        F.concat(F.lit("h"), n).alias("sha256"), F.when(n % 8 == 0, F.concat(F.lit("a"), n)).otherwise("").alias("archive_sha256"), F.col("plan_folder").alias("plan_norm"),
        F.when(n % 3 == 0, "ap_queue").otherwise("archived").alias("current_stage"),
        F.when(n % 6 == 1, "").otherwise(F.concat("plan_folder", F.lit("/"), n, F.lit("/"), F.when(n % 17 == 0, "moved ").otherwise(""), "file_name")).alias("archive_path"),
        F.when(n % 10 == 0, 2).otherwise(0).alias("dup_count"), F.when(n % 10 == 0, day).otherwise("").alias("last_dup_date"), day.alias("first_seen_date"), "file_no")


view("findings", r"""
SELECT 'orphan' AS category, sha256, '' AS plan_norm, path AS detail FROM disk_v WHERE file_name LIKE '%.pdf' AND NOT regexp_matches(lower(file_name), '^\s*processed ?-')
  AND sha256 NOT IN (SELECT sha256 FROM disk_ledger UNION ALL SELECT archive_sha256 FROM disk_ledger)
UNION ALL SELECT 'stale_archive', sha256, plan_norm, archive_path FROM disk_ledger WHERE current_stage = 'archived' AND archive_path <> '' AND archive_path NOT IN (SELECT path FROM disk_v)
UNION ALL SELECT 'repeat', sha256, plan_norm, 'dup_count=' || dup_count || ' last_dup_date=' || last_dup_date || ' archive=' || archive_path FROM disk_ledger WHERE dup_count > 0
UNION ALL SELECT 'orphan_tmp', '', '', path FROM disk_v WHERE contains(file_name, '.tmp.')""")


@query("reconcile", "SELECT * FROM findings")
def reconcile(spark, d):
    return rc.report(disk(spark, d), disk_ledger(spark, d))


@query("reconcile_totals", r"""
SELECT category, count(*) AS n FROM findings GROUP BY category UNION ALL SELECT 'ledger_rows', count(*) FROM disk_ledger
UNION ALL SELECT 'scanned', count(*) FROM disk_v WHERE file_name LIKE '%.pdf' AND NOT regexp_matches(lower(file_name), '^\s*processed ?-')""")
def reconcile_totals(spark, d):
    f, led = disk(spark, d), disk_ledger(spark, d)
    return rc.totals(f, led, rc.report(f, led))


@query("reconcile_short", """
SELECT * FROM (SELECT category, sha256, plan_norm, detail, row_number() OVER (PARTITION BY category ORDER BY detail, sha256) AS nth, greatest(0, count(*) OVER (PARTITION BY category) - 25) AS n_more FROM findings WHERE category <> 'repeat') WHERE nth <= 25""")
def reconcile_short(spark, d):
    return rc.short_report(rc.report(disk(spark, d), disk_ledger(spark, d)))
