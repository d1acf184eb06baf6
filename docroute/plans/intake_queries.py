"""Intake decisions: A7-A15, P25, P29-P32, J21, J22, F9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.operators import attachments as att
from docroute.operators import intake as it
from docroute.operators import linking as lk
from docroute.operators import threads as th
from docroute.plans.dimension_queries import plans
from docroute.plans.linking_queries import linked
from docroute.plans.registry import base_of, name_plan, pretty, query, view
from docroute.session import stored
from docroute.sources.tables import table

view("zip_order", """
SELECT *, sum(file_size) OVER (PARTITION BY zip_id ORDER BY entry_no, file_size, compress_size, entry_name ROWS UNBOUNDED PRECEDING) AS running,
  row_number() OVER (PARTITION BY zip_id ORDER BY entry_no, file_size, compress_size, entry_name) AS nth, greatest(compress_size, 1) AS cs,
  count(*) OVER (PARTITION BY zip_id) AS n_entries, split_part(replace(entry_name, '\\', '/'), '/', -1) AS leaf FROM fx_zip_entries""")
view("zip_audit_v", """
SELECT zip_id, n_entries, total_bytes, CASE WHEN n_entries > 200 THEN 'too many entries (' || n_entries || ' > 200)' ELSE coalesce(reason, '') END AS reason FROM (
  SELECT zip_id, any_value(n_entries) AS n_entries, CAST(sum(file_size) AS BIGINT) AS total_bytes, arg_min(r, nth) FILTER (r IS NOT NULL) AS reason FROM (
    SELECT *, CASE WHEN encrypted THEN 'encrypted entry ''' || entry_name || '''' WHEN file_size > 104857600 THEN 'entry ''' || entry_name || ''' uncompressed size ' || file_size || ' > 104857600'
      WHEN file_size > 100 * cs THEN 'entry ''' || entry_name || ''' ratio ' || file_size || '/' || cs || ' > 100' WHEN running > 524288000 THEN 'total uncompressed size ' || running || ' > 524288000' END AS r
    FROM zip_order) GROUP BY zip_id)""")
view("zip_listed", "SELECT * FROM zip_order WHERE NOT is_dir AND leaf <> '' AND NOT (entry_name LIKE '__MACOSX/%' OR contains(entry_name, '/__MACOSX/') OR starts_with(leaf, '._'))")
view("zip_strict_v", """
SELECT a.zip_id, a.n_entries, CASE WHEN a.reason <> '' THEN a.reason WHEN e.fl IS NOT NULL THEN 'non-PDF entries: ' || e.fl ELSE '' END AS reason,
  CASE WHEN a.reason = '' AND e.fl IS NULL THEN coalesce(e.n, 0) ELSE 0 END AS n_kept
FROM zip_audit_v a LEFT JOIN (SELECT zip_id, string_agg(DISTINCT leaf, ', ' ORDER BY leaf) FILTER (lower(leaf) NOT LIKE '%.pdf' AND lower(leaf) NOT LIKE '%.txt') AS fl,
  count(*) FILTER (lower(leaf) LIKE '%.pdf') AS n FROM zip_listed GROUP BY zip_id) e ON e.zip_id = a.zip_id""")


@query("zip_audit", "SELECT * FROM zip_audit_v")
def zip_audit(spark, d):
    return att.audit(table(spark, d, "fx_zip_entries"))


@query("zip_strict", "SELECT * FROM zip_strict_v")
def zip_strict(spark, d):
    return att.strict(table(spark, d, "fx_zip_entries"))


@query("zip_strict_entries", "SELECT l.zip_id, entry_no, leaf, 'invoices__' || leaf AS routed_name FROM zip_listed l JOIN zip_strict_v s ON s.zip_id = l.zip_id AND s.reason = '' WHERE lower(leaf) LIKE '%.pdf'")
def zip_strict_entries(spark, d):
    return att.strict_entries(table(spark, d, "fx_zip_entries")).withColumn("routed_name", att.zip_inner_name(F.lit("invoices.zip"), F.col("leaf")))


@query("zip_lenient", "SELECT l.zip_id, entry_no, leaf FROM zip_listed l JOIN zip_audit_v s ON s.zip_id = l.zip_id AND s.reason = '' WHERE lower(leaf) LIKE '%.pdf'")
def zip_lenient(spark, d):
    return att.lenient_entries(table(spark, d, "fx_zip_entries"))


# ---- classification

view("pdf_evidence", """
SELECT k.msg_id, k.att_idx, k.base_name, k.sha256, l.plan_norm AS subject_plan, l.has_attachments, d.text_note, d.detected, d.is_base_fallback, d.row_plan, d.row_manager, d.row_email,
  coalesce(x.explicit, '') AS explicit, coalesce(f.r_plan, '') AS fb_plan, coalesce(f.manager_name, '') AS fb_manager, coalesce(f.manager_email, '') AS fb_email,
  d.row_plan <> '' AND d.row_manager <> '' AS text_ok, coalesce(f.manager_name, '') <> '' AS name_ok
FROM (SELECT *, """ + name_plan("base_name") + """ AS bn_plan FROM att_kind WHERE kind = 'pdf' AND is_real_pdf) k
JOIN msg_link l ON l.msg_id = k.msg_id JOIN doc_match d ON d.sha256 = k.sha256 LEFT JOIN doc_labels x ON x.sha256 = k.sha256 LEFT JOIN name_index f ON f.code = k.bn_plan""")
view("pdf_class", f"""
SELECT *, CASE WHEN text_ok THEN row_plan WHEN name_ok THEN fb_plan ELSE '' END AS pdf_plan, CASE WHEN text_ok THEN row_email WHEN name_ok THEN fb_email ELSE '' END AS pdf_email,
  CASE WHEN text_ok AND is_base_fallback THEN 'ambiguous' WHEN text_ok THEN CASE WHEN row_plan = subject_plan THEN 'agree' ELSE 'pdf_override' END
    WHEN name_ok THEN CASE WHEN fb_plan = subject_plan THEN 'agree' ELSE 'clash' END WHEN starts_with(text_note, 'No text') THEN 'empty'
    WHEN detected = '' AND explicit = '' THEN 'no_plan' ELSE 'ambiguous' END AS outcome,
  CASE WHEN text_ok AND is_base_fallback THEN 'PDF identifies base plan ' || {pretty('row_plan')} || ' only; variant is ambiguous — flagged for front-desk correction.' WHEN text_ok THEN text_note
    WHEN name_ok THEN 'matched by filename (' || {pretty('fb_plan')} || '); PDF text: ' || text_note WHEN starts_with(text_note, 'No text') THEN text_note
    WHEN detected = '' AND explicit = '' THEN 'No strata plan number found in PDF text; routing on subject.'
    WHEN detected = '' THEN 'PDF names strata plan(s) not in the managed list: ' || explicit || '; flagged for review.' ELSE text_note END AS note
FROM pdf_evidence WHERE subject_plan <> '' AND has_attachments""")


_PDF = "kind = 'pdf' and is_real_pdf"


def _evidence(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages with branch, all classified attachments, and the evidence of every real PDF.

    Attachments come from a join on the message, so they meet it and are scanned where they are, and are written once.
    """
    p = plans(spark, d)
    msgs = linked(spark, d).withColumn("branch", it.branch(F.col("plan_norm"), F.col("has_attachments"))).withColumnRenamed("plan_norm", "subject_plan")
    msgs = stored(msgs.select("msg_id", "subject", "subject_plan", "manager_email", "match_source", "branch"))
    of_msg = msgs.where("msg_id is not null").groupBy("msg_id").agg(F.collect_list(F.struct("subject_plan", "branch")).alias("of_msg"))
    atts = att.classified(table(spark, d, "fx_attachments"), msgs).join(of_msg, "msg_id")
    atts = atts.select("msg_id", "att_idx", "base_name", "kind", "is_real_pdf", "of_msg", F.when(F.expr(_PDF), F.col("content_text")).alias("content_text"))
    atts = stored(lk.scan_rows(atts, p))
    pdfs = atts.where(_PDF).select("*", F.inline("of_msg")).drop("of_msg")
    return msgs, atts.select("msg_id", "att_idx", "base_name", "kind", "is_real_pdf"), it.evidence(pdfs, p)


def _classified(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    msgs, atts, ev = _evidence(spark, d)
    pdfs = it.classify(ev.where("branch = 'self'"))
    return msgs, atts, stored(pdfs.select("msg_id", "att_idx", "base_name", "subject_plan", "outcome", "pdf_plan", "pdf_email"))


@query("pdf_classification", """
SELECT msg_id, att_idx, base_name, outcome, pdf_plan, note, base_name || ':' || outcome || CASE WHEN pdf_plan <> '' THEN ' pdf=' || pdf_plan ELSE '' END || CASE WHEN note <> '' THEN ' note=''' || note || '''' ELSE '' END
  || CASE WHEN NOT text_ok AND name_ok THEN ' detected=[' || base_name || 'x1]' WHEN detected <> '' THEN ' detected=[' || array_to_string(string_split(detected, ', ')[1:3], ', ') || ']' ELSE '' END AS log_text
FROM pdf_class""")
def pdf_classification(spark, d):
    _, _, ev = _evidence(spark, d)
    return it.classify(ev.where("branch = 'self'")).select("msg_id", "att_idx", "base_name", "outcome", "pdf_plan", "note", it.classification_text().alias("log_text"))


@query("message_branches", """
SELECT CASE WHEN plan_norm <> '' AND has_attachments THEN 'self' WHEN plan_norm <> '' THEN 'thread' WHEN has_attachments THEN 'text_fallback' ELSE 'skip' END AS branch, match_source, count(*) AS n FROM msg_link GROUP BY ALL""")
def message_branches(spark, d):
    m = linked(spark, d)
    return m.groupBy(it.branch(F.col("plan_norm"), F.col("has_attachments")).alias("branch"), "match_source").agg(F.count("*").alias("n"))


view("msg_gate", """
SELECT m.msg_id, m.plan_norm AS subject_plan, m.manager_email, CAST(count(*) FILTER (k.kind = 'pdf' AND NOT k.is_real_pdf) AS BIGINT) AS n_invalid, count(*) FILTER (k.kind = 'extra') AS n_extras
FROM msg_link m LEFT JOIN att_kind k ON k.msg_id = m.msg_id WHERE m.plan_norm <> '' AND m.has_attachments GROUP BY ALL""")
view("msg_counts", f"""
SELECT g.*, coalesce(c.n_pdfs, 0) AS n_pdfs, coalesce(c.n_agree, 0) AS n_agree, coalesce(c.n_empty, 0) AS n_empty, coalesce(c.n_no_plan, 0) AS n_no_plan, coalesce(c.n_amb, 0) AS n_amb,
  coalesce(c.n_clash, 0) AS n_clash, coalesce(c.n_over, 0) AS n_over, coalesce(c.n_plans, 0) AS n_plans, coalesce(c.n_bases, 0) AS n_bases, coalesce(c.lo, '') AS first_plan, coalesce(c.hi, '') AS last_plan
FROM msg_gate g LEFT JOIN (SELECT msg_id, count(*) AS n_pdfs, count(*) FILTER (outcome = 'agree') AS n_agree, count(*) FILTER (outcome = 'empty') AS n_empty, count(*) FILTER (outcome = 'no_plan') AS n_no_plan,
    count(*) FILTER (outcome = 'ambiguous') AS n_amb, count(*) FILTER (outcome = 'clash') AS n_clash, count(*) FILTER (outcome = 'pdf_override') AS n_over,
    count(DISTINCT pdf_plan) FILTER (outcome IN ('agree', 'pdf_override', 'clash')) AS n_plans, count(DISTINCT {base_of('pdf_plan')}) FILTER (outcome IN ('agree', 'pdf_override', 'clash')) AS n_bases,
    min(pdf_plan) FILTER (outcome IN ('agree', 'pdf_override', 'clash')) AS lo, max(pdf_plan) FILTER (outcome IN ('agree', 'pdf_override', 'clash')) AS hi FROM pdf_class GROUP BY msg_id) c ON c.msg_id = g.msg_id""")
view("msg_action", f"""
SELECT *, CASE WHEN reason_code IN ('no PDFs to classify', 'cross-check OK', 'PDF overrides subject') THEN 'route_as_subject' WHEN starts_with(reason_code, 'auto-split') THEN 'auto_split' ELSE 'flag_and_hold' END AS action,
  CASE WHEN reason_code = 'cross-check OK' THEN 'PDF cross-check OK (' || n_agree || ' agree, ' || n_empty || ' empty, ' || n_no_plan || ' no plan # in PDF — routed under subject)'
    WHEN reason_code = 'PDF overrides subject' THEN 'PDF overrides subject: routing to ' || {pretty('first_plan')} || ' (PDF evidence trusted)'
    WHEN reason_code = 'consensus clash' THEN 'consensus clash: every PDF says ' || {pretty('first_plan')} || ', subject says ' || {pretty('subject_plan')}
    WHEN reason_code = 'suffix-variant clash' THEN 'suffix-variant clash across PDFs: ' || n_plans || ' plans from ' || {pretty('first_plan')} || ' to ' || {pretty('last_plan')} || ' share a base'
    WHEN starts_with(reason_code, 'auto-split') THEN 'auto-split across distinct strata bases: ' || n_plans || ' plans from ' || {pretty('first_plan')} || ' to ' || {pretty('last_plan')}
    WHEN reason_code = 'ambiguous PDF text' THEN 'ambiguous PDF text: ' || n_amb || ' of ' || n_pdfs || ' PDFs'
    WHEN reason_code = 'mixed evidence' THEN 'mixed evidence: ' || (n_empty + n_no_plan) || ' PDFs carry no plan while ' || n_clash || ' clash with subject ' || {pretty('subject_plan')} ELSE reason_code END AS reason
FROM (SELECT *, CASE WHEN n_invalid > 0 THEN 'invalid PDF bytes' WHEN n_pdfs = 0 THEN 'no PDFs to classify' WHEN n_amb + n_clash = 0 AND n_over = 0 THEN 'cross-check OK'
    WHEN n_amb + n_clash = 0 AND n_bases < n_plans THEN 'suffix-variant clash' WHEN n_amb + n_clash = 0 AND n_plans <= 1 THEN 'PDF overrides subject' WHEN n_amb + n_clash = 0 THEN 'auto-split'
    WHEN n_amb > 0 THEN 'ambiguous PDF text' WHEN n_empty + n_no_plan > 0 THEN 'mixed evidence' WHEN n_plans = 1 THEN 'consensus clash' WHEN n_bases < n_plans THEN 'suffix-variant clash'
    ELSE 'auto-split, subject ignored' END AS reason_code FROM msg_counts)""")


def _gates(atts: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return atts.groupBy("msg_id").agg(F.count_if((F.col("kind") == "pdf") & ~F.col("is_real_pdf")).alias("n_invalid")).withColumns({"n_download_failed": zero, "n_unsafe_zip": zero})


def _actions(spark, d):
    msgs, atts, pdfs = _classified(spark, d)
    own = msgs.where("branch = 'self'")
    return own, atts.join(own.select("msg_id"), "msg_id", "left_semi"), pdfs, it.email_action(own, pdfs, _gates(atts))


@query("email_action", "SELECT msg_id, subject_plan, n_pdfs, n_plans, n_bases, n_invalid, action, reason_code, reason FROM msg_action")
def email_action(spark, d):
    *_, a = _actions(spark, d)
    return a.select("msg_id", "subject_plan", "n_pdfs", "n_plans", "n_bases", "n_invalid", "action", "reason_code", "reason")


view("pdf_target", """
SELECT c.msg_id, c.att_idx, c.base_name, c.outcome, c.pdf_email, CASE WHEN (a.action = 'auto_split' OR (a.n_over > 0 AND c.outcome IN ('agree', 'pdf_override'))) AND c.pdf_plan <> '' THEN c.pdf_plan ELSE c.subject_plan END AS target_plan,
  a.action, CASE WHEN (c.msg_id + c.att_idx) % 29 = 0 THEN 'failed' WHEN c.att_idx % 3 = 0 THEN 'duplicate_skipped' ELSE 'routed' END AS result
FROM pdf_class c JOIN msg_action a ON a.msg_id = c.msg_id WHERE a.action <> 'flag_and_hold' AND NOT (c.outcome = 'no_plan' AND a.n_pdfs > 1)""")


@query("pdf_targets", "SELECT msg_id, att_idx, base_name, outcome, target_plan, action FROM pdf_target")
def pdf_targets(spark, d):
    _, _, pdfs, a = _actions(spark, d)
    return it.pdf_targets(a, pdfs).select("msg_id", "att_idx", "base_name", "outcome", "target_plan", "action")


view("fwd", """
SELECT DISTINCT msg_id, email FROM (
  SELECT c.msg_id, c.pdf_email AS email FROM pdf_class c JOIN msg_action a ON a.msg_id = c.msg_id WHERE c.outcome IN ('agree', 'pdf_override', 'clash') AND (a.action = 'auto_split' OR (a.action = 'route_as_subject' AND a.n_over > 0))
  UNION ALL SELECT msg_id, manager_email FROM msg_action WHERE action = 'route_as_subject' AND n_over = 0) WHERE email <> ''""")


@query("forward_targets", "SELECT msg_id, email, email AS recipient FROM fwd")
def forward_targets(spark, d):
    msgs, _, pdfs, a = _actions(spark, d)
    return it.forward_targets(a, pdfs, msgs)


def closing(spark, d) -> DataFrame:
    """Routing and sending results are inputs of these operators; here they follow from the ids."""
    msgs, atts, pdfs, a = _actions(spark, d)
    a = stored(a)
    key = F.col("msg_id") + F.col("att_idx")
    routed = it.pdf_targets(a, pdfs).select("msg_id", F.when(key % 29 == 0, "failed").when(F.col("att_idx") % 3 == 0, "duplicate_skipped").otherwise("routed").alias("result"))
    extras = atts.groupBy("msg_id").agg(F.count_if(F.col("kind") == "extra").alias("n_extras"))
    targets = it.forward_targets(a, pdfs, msgs)
    sent = targets.select("msg_id", "email", (F.col("msg_id") % 13 != 0).alias("ok"))
    return it.close_messages(a, routed, extras, targets, sent)


view("msg_close", """
SELECT *, n_failed > 0 AND n_routed + n_dup > 0 AS partial_commit, n_failed > 0 OR forward = 'blocked' AS flagged, CASE WHEN forward = 'blocked' THEN '' WHEN forward = 'sent' THEN 'processed_emails'
  WHEN n_total = 0 OR n_failed > 0 THEN '' WHEN n_routed = 0 AND n_dup > 0 THEN 'duplicate_emails' ELSE 'processed_emails' END AS folder
FROM (SELECT *, CASE WHEN NOT ((n_extras > 0 OR (n_no_plan > 0 AND n_pdfs > 1)) AND n_failed = 0) THEN 'none' WHEN n_targets = 0 OR (msg_id % 13 = 0) THEN 'blocked' ELSE 'sent' END AS forward
  FROM (SELECT a.msg_id, a.n_extras, a.n_no_plan, a.n_pdfs, coalesce(r.n, 0) AS n_total, coalesce(r.nr, 0) AS n_routed, coalesce(r.nd, 0) AS n_dup, coalesce(r.nf, 0) AS n_failed, coalesce(f.n, 0) AS n_targets
    FROM msg_action a LEFT JOIN (SELECT msg_id, count(*) AS n, count(*) FILTER (result = 'routed') AS nr, count(*) FILTER (result = 'duplicate_skipped') AS nd, count(*) FILTER (result = 'failed') AS nf FROM pdf_target GROUP BY msg_id) r ON r.msg_id = a.msg_id
    LEFT JOIN (SELECT msg_id, count(*) AS n FROM fwd GROUP BY msg_id) f ON f.msg_id = a.msg_id WHERE a.action <> 'flag_and_hold'))""")


@query("email_destination", "SELECT msg_id, n_total, n_extras, n_targets, forward, flagged, folder FROM msg_close")
def email_destination(spark, d):
    return closing(spark, d).select("msg_id", "n_total", "n_extras", "n_targets", "forward", "flagged", "folder")


@query("partial_commits", "SELECT msg_id, n_routed + n_dup AS n_committed, n_failed FROM msg_close WHERE partial_commit")
def partial_commits(spark, d):
    return closing(spark, d).where("partial_commit").select("msg_id", (F.col("n_routed") + F.col("n_duplicate")).alias("n_committed"), "n_failed")


view("gate_counts", """
SELECT m.msg_id, coalesce(c.n, 0) AS n_pdfs, coalesce(c.nr, 0) AS n_routable, coalesce(c.nd, 0) AS n_duplicate, coalesce(c.nu, 0) AS n_unmatched, coalesce(i.n, 0) AS n_invalid
FROM msg_link m LEFT JOIN (SELECT msg_id, count(*) AS n, count(*) FILTER ((text_ok OR name_ok) AND att_idx % 3 <> 0) AS nr, count(*) FILTER ((text_ok OR name_ok) AND att_idx % 3 = 0) AS nd, count(*) FILTER (NOT (text_ok OR name_ok)) AS nu FROM pdf_evidence GROUP BY msg_id) c ON c.msg_id = m.msg_id
LEFT JOIN (SELECT msg_id, count(*) AS n FROM att_kind WHERE kind = 'pdf' AND NOT is_real_pdf GROUP BY msg_id) i ON i.msg_id = m.msg_id WHERE m.plan_norm = '' AND m.has_attachments""")


@query("text_fallback_gate", """
SELECT msg_id, n_pdfs, n_unmatched, n_invalid, CASE WHEN n_pdfs > 0 AND n_unmatched + n_invalid = 0 THEN 'route_all' ELSE 'left_in_inbox' END AS decision,
  CASE WHEN n_pdfs > 0 AND n_unmatched + n_invalid = 0 THEN '' WHEN n_pdfs + n_invalid = 0 THEN 'no actionable content' ELSE concat_ws(' | ', CASE WHEN n_routable > 0 THEN 'would-have-routed PDFs: ' || n_routable END,
    CASE WHEN n_duplicate > 0 THEN 'would-have-skipped-as-duplicate: ' || n_duplicate END, CASE WHEN n_unmatched > 0 THEN 'unmatched PDFs: ' || n_unmatched END, CASE WHEN n_invalid > 0 THEN 'invalid PDF bytes: ' || n_invalid END) END AS detail,
  NOT (n_pdfs > 0 AND n_unmatched + n_invalid = 0) AND n_pdfs + n_invalid > 0 AS flagged FROM gate_counts""")
def text_fallback_gate(spark, d):
    msgs, atts, ev = _evidence(spark, d)
    pdfs = it.resolve_unlabelled(ev.where("branch = 'text_fallback'")).withColumn("is_duplicate", F.col("att_idx") % 3 == 0)
    return it.text_gate(msgs.where("branch = 'text_fallback'"), pdfs, _gates(atts)).select("msg_id", "n_pdfs", "n_unmatched", "n_invalid", "decision", "detail", "flagged")


@query("unlabelled_plans", "SELECT e.msg_id, e.att_idx, CASE WHEN text_ok THEN row_plan WHEN name_ok THEN fb_plan ELSE '' END AS pdf_plan, CASE WHEN text_ok THEN 'text' WHEN name_ok THEN 'name' ELSE 'unmatched' END AS plan_source FROM pdf_evidence e WHERE subject_plan = '' AND has_attachments")
def unlabelled_plans(spark, d):
    _, _, ev = _evidence(spark, d)
    return it.resolve_unlabelled(ev.where("branch = 'text_fallback'")).select("msg_id", "att_idx", "pdf_plan", "plan_source")


@query("sweep", "SELECT msg_id FROM fx_inbox WHERE msg_id NOT IN (SELECT msg_id FROM msg_close WHERE folder <> '')")
def sweep(spark, d):
    """First-fetch messages that no step has moved; later arrivals are left alone."""
    first = table(spark, d, "fx_inbox").select("msg_id")
    moved = closing(spark, d).where("folder <> ''").select("msg_id")
    return th.sweep(first.join(moved, "msg_id", "left_anti"), first)
