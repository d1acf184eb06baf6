"""The ledger fold for an independent engine: one recursive query that takes the next operation of every plan at a time.

Hashes and keys never cross plans in the derived log, so the plans' operations may go side by side; within a plan each
step sees the rows as the step before left them.
"""

from __future__ import annotations

_KEY = "upper(plan_norm) || '|' || nullif(invoice_number, '') || '|' || amount_cents || '|' || nullif(lower(sender_domain), '')"
# The log lies in January, when the business time zone is eight hours behind.
_DAY = "CAST(CAST(ts - INTERVAL 8 HOUR AS DATE) AS VARCHAR)"


def replay(ops: str, ledger: str | None = None) -> str:
    """CTEs `replayed` (kind, id, ...) of a log: kind 'row' is the ledger, 'done' an outcome. `ops` and `ledger` are queries.

    The ledger's columns: sha256, pos, k, st (live | overridden | superseded), grp.
    """
    seed = "" if ledger is None else f"""
  UNION ALL SELECT 'row', sha256, grp, 0, pos, -1, k, st, '', '', '', 0, '', '', '', '', NULL, NULL, '', '', NULL, NULL FROM ({ledger})"""
    return f"""
WITH RECURSIVE log AS MATERIALIZED (SELECT *, plan_norm AS grp, row_number() OVER (PARTITION BY plan_norm ORDER BY seq) AS nth, CASE WHEN op = 'arrive' THEN {_KEY} END AS k, {_DAY} AS day FROM ({ops})),
replayed(kind, id, grp, step, pos, ins, k, st, stage, first_day, seen, dups, dup_day, path, flat, plan_norm, invoice_number, amount_cents, sender_domain, outcome, target, superseded) USING KEY (kind, id) AS (
  SELECT 'clock' AS kind, grp AS id, grp, CAST(0 AS BIGINT) AS step, CAST(NULL AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS ins, CAST(NULL AS VARCHAR) AS k, '' AS st, '' AS stage, '' AS first_day, '' AS seen,
    CAST(0 AS BIGINT) AS dups, '' AS dup_day, '' AS path, '' AS flat, '' AS plan_norm, CAST(NULL AS VARCHAR) AS invoice_number, CAST(NULL AS BIGINT) AS amount_cents, '' AS sender_domain, '' AS outcome,
    CAST(NULL AS VARCHAR) AS target, CAST(NULL AS VARCHAR) AS superseded FROM (SELECT DISTINCT grp FROM log){seed}
  UNION
  (WITH met AS (
    SELECT o.*, r.pos AS own_pos, r.st AS own_st,
      (SELECT arg_min(l.id, l.pos) FROM recurring.replayed l WHERE l.kind = 'row' AND l.st = 'live' AND l.k = o.k) AS live,
      (SELECT arg_min(l.id, l.pos) FROM recurring.replayed l WHERE l.kind = 'row' AND l.st = 'overridden' AND l.k = o.k) AS over
    FROM replayed c JOIN log o ON c.kind = 'clock' AND o.grp = c.grp AND o.nth = c.step + 1
    LEFT JOIN recurring.replayed r ON r.kind = 'row' AND r.id = o.sha256),
  judged AS (
    SELECT *, CASE WHEN op = 'arrive' THEN CASE WHEN own_st IN ('live', 'superseded') OR live IS NOT NULL THEN 'duplicate' ELSE 'inserted' END WHEN own_st IS NOT NULL THEN 'staged' ELSE 'unknown' END AS result,
      CASE WHEN op <> 'arrive' THEN CASE WHEN own_st IS NOT NULL THEN sha256 END WHEN own_st IN ('live', 'superseded') THEN sha256 ELSE coalesce(live, sha256) END AS hit,
      CASE WHEN op = 'arrive' AND own_st IS NULL AND live IS NULL THEN over END AS retired FROM met)
  SELECT 'clock', grp, grp, nth, NULL, NULL, NULL, '', '', '', '', 0, '', '', '', '', NULL, NULL, '', '', NULL, NULL FROM judged
  UNION ALL
  SELECT 'done', CAST(seq AS VARCHAR), grp, seq, NULL, NULL, NULL, '', '', '', '', 0, '', '', '', sha256, NULL, NULL, '', result, hit, retired FROM judged
  UNION ALL
  SELECT 'row', sha256, grp, 0, coalesce(own_pos, seq), seq, k, 'live', 'manager_queue', day, day, 0, '', '', '', plan_norm, invoice_number, amount_cents, sender_domain, '', NULL, NULL FROM judged WHERE result = 'inserted'
  UNION ALL
  SELECT 'row', r.id, r.grp, 0, r.pos, r.ins, r.k, CASE WHEN j.result = 'duplicate' THEN r.st WHEN j.op = 'override' THEN 'overridden' ELSE 'live' END,
    CASE WHEN j.result = 'duplicate' THEN r.stage WHEN j.op = 'override' THEN 'overridden' WHEN j.op = 'archive' THEN 'archived' ELSE 'ap_queue' END, r.first_day, j.day, r.dups + CAST(j.result = 'duplicate' AS INT),
    CASE WHEN j.result = 'duplicate' THEN j.day ELSE r.dup_day END, CASE WHEN j.op = 'archive' THEN 'archive/' || j.sha256 ELSE r.path END, CASE WHEN j.op = 'archive' THEN 'flat-' || j.sha256 ELSE r.flat END,
    r.plan_norm, r.invoice_number, r.amount_cents, r.sender_domain, '', NULL, NULL
  FROM judged j JOIN recurring.replayed r ON r.kind = 'row' AND r.id = j.hit WHERE j.result IN ('duplicate', 'staged')
  UNION ALL
  SELECT 'row', r.id, r.grp, 0, r.pos, r.ins, r.k, 'superseded', 'superseded', r.first_day, r.seen, r.dups, r.dup_day, r.path, r.flat, r.plan_norm, r.invoice_number, r.amount_cents, r.sender_domain, '', NULL, NULL
  FROM judged j JOIN recurring.replayed r ON r.kind = 'row' AND r.id = j.retired))"""


STATE = """
SELECT pos, first_day AS first_seen_date, id AS sha256, plan_norm, invoice_number, coalesce(CAST(amount_cents AS VARCHAR), '') AS amount_cents, sender_domain, path AS archive_path, flat AS archive_sha256, stage AS current_stage, seen AS last_seen_date,
  dups AS dup_count, dup_day AS last_dup_date FROM replayed WHERE kind = 'row'"""
OUTCOMES = "SELECT step AS seq, plan_norm AS sha256, outcome, target, superseded FROM replayed WHERE kind = 'done'"
