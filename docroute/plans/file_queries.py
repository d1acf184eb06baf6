"""Results that pass through files: overrides kept in a ledger on storage, reports, logs and summaries read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.operators import override as ov
from docroute.operators import reconcile as rc
from docroute.operators import reports as rp
from docroute.operators.dedupe import LEDGER_COLUMNS
from docroute.plans import ledger_queries, reconcile_queries, report_queries  # noqa: F401
from docroute.plans.registry import ORACLES, query, view
from docroute.session import shared_dir
from docroute.sources import files as fs
from docroute.sources import run_lines
from docroute.sources.ledger_store import BucketedLedger, append
from docroute.sources.tables import table
from docroute.streaming.ledger_stream import apply_ops


def _home(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


MARKED_AT = "2024-03-05 20:00:00"


def _user_ledger(spark, d) -> DataFrame:
    """A ledger of one row per event user, under real-looking hashes."""
    e = table(spark, d, "events").groupBy("user_id").agg(F.max_by(F.col("event_id") % 3, "event_id").alias("k"))
    stage = F.when(F.col("k") == 0, "manager_queue").when(F.col("k") == 1, "ap_queue").otherwise("archived")
    given = {"first_seen_date": F.lit("2024-01-01"), "sha256": F.sha2(F.col("user_id").cast("string"), 256), "plan_norm": F.concat(F.lit("BCS"), F.col("user_id") % 40 + 1000), "amount_cents": F.lit(None).cast("long"),
             "current_stage": stage, "last_seen_date": F.lit("2024-01-01"), "dup_count": F.lit(0).cast("long")}
    return e.select(F.col("user_id").cast("long").alias("pos"), *[given.get(c, F.lit("")).alias(c) for c in LEDGER_COLUMNS])


@query("override_ledger", f"""
SELECT l.sha, CASE WHEN m.sha256 IS NULL THEN l.stage ELSE 'overridden' END AS current_stage, CASE WHEN m.sha256 IS NULL THEN '2024-01-01' ELSE '2024-03-05' END AS last_seen_date, coalesce(m.prior_stage, '') AS prior_stage, CASE WHEN m.sha256 IS NULL THEN '' ELSE 'reviewed' END AS reason
FROM (SELECT sha256(CAST(user_id AS VARCHAR)) AS sha, CASE arg_max(event_id % 3, event_id) WHEN 0 THEN 'manager_queue' WHEN 1 THEN 'ap_queue' ELSE 'archived' END AS stage FROM events GROUP BY user_id) l
LEFT JOIN ({ORACLES['override_mark']}) m ON m.sha256 = l.sha AND m.result = 'overridden'""")
def override_ledger(spark, d):
    """Requests by prefix, folded as operations into a ledger kept by bucket, and the audit lines appended beside it."""
    home = _home(spark, "override")
    store = BucketedLedger(spark, f"{home}/ledger")
    store.replace(_user_ledger(spark, d), 0)
    u = F.col("user_id").cast("string")
    sha, m = F.sha2(u, 256), F.col("user_id") % 5
    prefix = F.when(m == 0, F.substring(sha, 1, 8)).when(m == 1, F.concat(F.lit("zz"), F.substring(sha, 1, 12))).when(m == 2, F.sha2(F.concat(F.lit("none"), u), 256)).otherwise(F.substring(sha, 1, 16))
    requests = table(spark, d, "events").select(prefix.alias("prefix"), F.lit("reviewed").alias("reason")).distinct()
    resolved, at = ov.resolve(requests, store.read()), F.lit(MARKED_AT).cast("timestamp")
    append(ov.audit_rows(resolved, at), f"{home}/audit")
    apply_ops(store, ov.as_ops(resolved, at), 1)
    audit = spark.read.parquet(f"{home}/audit").select("sha256", "prior_stage", "reason")
    return store.read().join(audit, "sha256", "left").select(
        F.col("sha256").alias("sha"), "current_stage", "last_seen_date", F.coalesce("prior_stage", F.lit("")).alias("prior_stage"), F.coalesce("reason", F.lit("")).alias("reason"))


@query("reconcile_file", "SELECT * FROM findings")
def reconcile_file(spark, d):
    """The report written as tab-separated text and read back."""
    path = _home(spark, "reconcile")
    fs.write_tsv(rc.report(reconcile_queries.disk(spark, d), reconcile_queries.disk_ledger(spark, d)).select(fs.FINDINGS), path)
    return fs.read_tsv(spark, path, fs.FINDINGS).drop("nth")


@query("folder_listing", """
SELECT row_number() OVER (ORDER BY mtime_iso DESC, path_rel_to_root) - 1 AS nth, * FROM (
  SELECT file_name AS filename, CAST(size_bytes AS VARCHAR) AS size_bytes, strftime(mtime, '%Y-%m-%dT%H:%M:%S') AS mtime_iso, plan_folder || '/' || file_no || '/' || file_name AS path_rel_to_root FROM fx_archive_files)""")
def folder_listing(spark, d):
    """Newest first, in that order on file too."""
    f = table(spark, d, "fx_archive_files")
    rows = f.select(F.concat_ws("/", F.lit("/archive"), "plan_folder", "file_no", "file_name").alias("path"), "file_name", "size_bytes", "mtime")
    path = _home(spark, "listing")
    fs.write_tsv(fs.listing(rows, "/archive"), path)
    return fs.read_tsv(spark, path, fs.LISTING)


view("log_lines", """
SELECT 'step_' || (1 + event_id % 6) AS step, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY event_id % 6, CAST(ts AS DATE) ORDER BY event_id) - 1 AS line_no,
  CAST(CAST(ts AS DATE) AS VARCHAR) || ' ' || event_id AS logged_at, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'user | ' || user_id AS message FROM events""")


def _logs(spark, d) -> DataFrame:
    """The events as one log per step and day on storage, a log's lines spread over as many files as its size needs."""
    e, path = table(spark, d, "events"), _home(spark, "logs")
    day = F.to_date("ts").cast("string")
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    value = F.concat(day, F.lit(" "), "event_id", F.lit(" | "), level, F.lit(" | user | "), "user_id")
    lines = e.select(F.concat(F.lit("step_"), F.col("event_id") % 6 + 1, F.lit("_"), day, F.lit(".log")).alias("log"), "event_id", value.alias("value"))
    lines.repartitionByRange("log", "event_id").sortWithinPartitions("log", "event_id").drop("event_id").write.partitionBy("log").text(path)
    return fs.step_logs(spark, path)


@query("step_log_tail", f"SELECT step, line_no, logged_at, level, message FROM (SELECT *, row_number() OVER (PARTITION BY step ORDER BY line_no DESC) AS k FROM log_lines WHERE day = DATE '{report_queries.RUN_DAY}') WHERE k <= 30")
def step_log_tail(spark, d):
    """The last lines of each step's log of one day, from the files."""
    return rp.log_tail(_logs(spark, d), day=report_queries.RUN_DAY).select("step", "line_no", "logged_at", "level", "message")


@query("recent_log_levels", f"SELECT step, CAST(day AS VARCHAR) AS day, level, count(*) AS n FROM log_lines WHERE day >= DATE '{report_queries.RUN_DAY}' - 3 GROUP BY ALL")
def recent_log_levels(spark, d):
    """lines by level in the logs of the last three days."""
    recent = fs.recent_logs(_logs(spark, d), "day", F.lit(report_queries.RUN_DAY).cast("date"), 3)
    return recent.groupBy("step", F.col("day").cast("string").alias("day"), "level").agg(F.count("*").alias("n"))


@query("run_summary_file", f"SELECT date, step, status, count(*) AS runs, CAST(sum(processed) AS BIGINT) AS processed, CAST(sum(errors) AS BIGINT) AS errors FROM ({ORACLES['run_records']}) GROUP BY ALL")
def run_summary_file(spark, d):
    """Run records appended to the summary in two goes, and its totals."""
    path = _home(spark, "summary")
    e = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "processed").when(F.col("event_type") == "view", "review").when(F.col("event_type") == "error", "error").otherwise("note")
    log = e.select(F.col("user_id").alias("run_id"), F.concat(F.lit("step_"), F.col("user_id") % 6 + 1).alias("step"), F.col("ts").cast("timestamp").alias("ts"), kind.alias("kind"))
    for half in range(2):
        run_lines.append(rp.run_record(log.where(F.col("run_id") % 2 == half)), path)
    return spark.read.parquet(path).groupBy("date", "step", "status").agg(F.count("*").alias("runs"), F.sum("processed").alias("processed"), F.sum("errors").alias("errors"))
