"""Linking: X1-X4, J1-J6, A4-A6, W6, W7, P7-P13, F2-F4, P14, P19-P22."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import attachments as att
from docroute.operators import linking as lk
from docroute.plans.dimension_queries import plans
from docroute.plans.registry import name_plan, query, view
from docroute.session import stored
from docroute.sources.tables import table

_SUBJ = r"'\b([A-Z]{2,6})\s*[-#:/_ ]?\s*(\d{1,6})([A-Z]{1,2})?\b'"


def _tokens(src: int, col: str) -> str:
    return rf"""SELECT msg_id, {src} AS src, i AS pos, regexp_replace(regexp_extract_all(upper({col}), {_SUBJ})[i + 1], '[\s\-#:/_]', '', 'g') AS token
FROM fx_inbox, LATERAL (SELECT unnest(range(len(regexp_extract_all(upper({col}), {_SUBJ})))) AS i)"""


view("subj_tok", _tokens(0, "subject") + " UNION ALL " + _tokens(1, "body_preview"))
view("msg_link", """
SELECT m.*, coalesce(b.plan_norm, '') AS plan_norm, coalesce(b.manager_name, '') AS manager_name, coalesce(b.manager_email, '') AS manager_email,
  CASE b.src WHEN 0 THEN 'subject' WHEN 1 THEN 'body' ELSE '' END AS match_source
FROM fx_inbox m LEFT JOIN (SELECT msg_id, src, token AS plan_norm, manager_name, manager_email FROM (
    SELECT t.*, p.manager_name, p.manager_email, row_number() OVER (PARTITION BY msg_id ORDER BY src, pos) AS k FROM subj_tok t JOIN first_mgr p ON p.plan_norm = t.token) WHERE k = 1) b
  ON b.msg_id = m.msg_id""")


@query("subject_tokens", "SELECT msg_id, src, min(pos) AS first_pos, token FROM subj_tok GROUP BY ALL")
def subject_tokens(spark, d):
    m = table(spark, d, "fx_inbox")
    return m.select("msg_id", F.inline(lk.token_ladder())).withColumnRenamed("pos", "first_pos")


def linked(spark: SparkSession, d: str) -> DataFrame:
    return lk.link_messages(table(spark, d, "fx_inbox"), plans(spark, d))


@query("message_plan_link", "SELECT msg_id, plan_norm, manager_name, match_source FROM msg_link")
def message_plan_link(spark, d):
    return linked(spark, d).select("msg_id", "plan_norm", "manager_name", "match_source")


@query("sender_domains", r"""
SELECT msg_id, CASE WHEN contains(mail, '@') AND contains(dom, '.') AND NOT regexp_matches(dom, '\s') THEN dom ELSE '' END AS sender_domain,
  CASE WHEN addr <> '' AND nm <> '' THEN nm || ' <' || addr || '>' WHEN addr <> '' THEN addr WHEN nm <> '' THEN nm ELSE '(unknown sender)' END AS sender_display
FROM (SELECT msg_id, mail, lower(split_part(mail, '@', -1)) AS dom, nm, addr FROM (
  SELECT msg_id, CASE WHEN contains(from_addr, '<') THEN regexp_extract(from_addr, '<(.*)>', 1) ELSE from_addr END AS mail,
    CASE WHEN contains(from_addr, '<') THEN trim(split_part(from_addr, '<', 1)) ELSE '' END AS nm,
    CASE WHEN contains(from_addr, '<') THEN regexp_extract(from_addr, '<(.*)>', 1) ELSE from_addr END AS addr FROM fx_inbox))""")
def sender_domains(spark, d):
    m = table(spark, d, "fx_inbox")
    has = F.col("from_addr").contains("<")
    addr = F.when(has, F.regexp_extract("from_addr", "<(.*)>", 1)).otherwise(F.col("from_addr"))
    name = F.when(has, F.substring_index("from_addr", "<", 1)).otherwise("")
    return m.select("msg_id", t.sender_domain("from_addr").alias("sender_domain"), t.sender_display(name, addr).alias("sender_display"))


view("name_index", r"""
SELECT code, arg_min(r_plan, is_base) AS r_plan, arg_min(manager_name, is_base) AS manager_name, arg_min(manager_email, is_base) AS manager_email, min(is_base) AS is_base FROM (
  SELECT plan_norm AS code, plan_norm AS r_plan, manager_name, manager_email, false AS is_base FROM first_mgr
  UNION ALL
  SELECT code, code, min(manager_name), arg_min(manager_email, row_no), true FROM (
    SELECT row_no, manager_name, manager_email, substr(plan_norm, 1, length(plan_norm) - k) AS code FROM plan_rows, (SELECT unnest([1, 2, 3]) AS k)
    WHERE status_active AND manager_name <> '' AND length(plan_norm) > k AND regexp_matches(substr(plan_norm, length(plan_norm) - k + 1), '^[A-Z]+$'))
  GROUP BY code HAVING count(DISTINCT manager_name) = 1)
GROUP BY code""")
view("att_names", f"""
SELECT a.*, {name_plan('name')} AS name_plan FROM fx_attachments a""")


@query("filename_plan_link", """
SELECT msg_id, att_idx, name, a.name_plan, coalesce(e.plan_norm, '') AS exact_plan, coalesce(f.r_plan, '') AS fallback_plan,
  coalesce(f.manager_name, '') AS fallback_manager, coalesce(f.is_base, false) AS fallback_is_base
FROM att_names a LEFT JOIN first_mgr e ON e.plan_norm = a.name_plan LEFT JOIN name_index f ON f.code = a.name_plan""")
def filename_plan_link(spark, d):
    a = table(spark, d, "fx_attachments").select("msg_id", "att_idx", "name")
    return lk.link_file_names(a, plans(spark, d)).select(
        "msg_id", "att_idx", "name", "name_plan", "exact_plan", "fallback_plan", "fallback_manager", "fallback_is_base")


@query("payer_resolution", rf"""
SELECT f.file_no, f.file_name, f.name_plan, coalesce(e.ap_name, b.ap_name, '') AS payer, coalesce(e.ap_email, b.ap_email, '') AS payer_email,
  CASE WHEN f.name_plan = '' THEN 'no plan in name' WHEN e.plan_norm IS NOT NULL THEN 'plan' WHEN b.base IS NOT NULL THEN 'base' ELSE 'no payer' END AS payer_source
FROM (SELECT *, {name_plan('file_name')} AS name_plan FROM (SELECT file_no, plan_folder || ' - ' || file_name AS file_name FROM fx_archive_files)) f
LEFT JOIN first_ap e ON e.plan_norm = f.name_plan
LEFT JOIN (SELECT regexp_extract(plan_norm, '^(.*\d)([A-Z])$', 1) AS base, arg_min(ap_name, row_no) AS ap_name, arg_min(ap_email, row_no) AS ap_email FROM plan_rows
  WHERE status_active AND ap_name <> '' AND regexp_matches(plan_norm, '^(.*\d)([A-Z])$') GROUP BY 1 HAVING count(DISTINCT (ap_name, ap_email)) = 1) b ON b.base = f.name_plan""")
def payer_resolution(spark, d):
    f = table(spark, d, "fx_archive_files").select("file_no", F.concat("plan_folder", F.lit(" - "), "file_name").alias("file_name"))
    return lk.resolve_payer(f, plans(spark, d)).select("file_no", "file_name", "name_plan", "payer", "payer_email", "payer_source")


# ---- document text

_NO = r"(?:(?:NO\.?|NUMBER|NUM\.?)\s*)?(?:#\s*)?"
_TAIL = rf"\s*(?:[.\-_/]*\s*)?{_NO}(\d{{1,5}})(?:\s*[-_.]?\s*([A-Z]{{1,3}})\b(\s*/\s*[A-Z])?)?\b"


def _split(alias: str, src: str, pattern: str) -> str:
    """Tokens of a text column: number of the match, and prefix, number and suffix (dropped when followed by /X)."""
    return f"""
SELECT sha256, i AS pos, regexp_extract(m, {pattern}, 1) AS pre, regexp_extract(m, {pattern}, 2) AS num,
  CASE WHEN regexp_extract(m, {pattern}, 4) = '' THEN regexp_extract(m, {pattern}, 3) ELSE '' END AS suf
FROM (SELECT sha256, i, ms[i + 1] AS m FROM (SELECT sha256, regexp_extract_all(text_up, {pattern}) AS ms FROM {src}), LATERAL (SELECT unnest(range(len(ms))) AS i))"""


view("doc_texts", "SELECT DISTINCT sha256(content_text) AS sha256, content_text, upper(content_text) AS text_up FROM fx_attachments")
view("code_rows", r"SELECT *, regexp_extract(plan_norm, '^([A-Z]{2,6})', 1) AS prefix, regexp_extract(plan_norm, '(\d+)', 1) AS num, regexp_extract(plan_norm, '^([A-Z]{2,6}\d{1,5})', 1) AS base FROM plan_rows WHERE status_active AND regexp_matches(plan_norm, '^[A-Z]{2,6}\d{1,5}[A-Z]{0,3}$')")
view("code_pattern", rf"SELECT '\b(?:STRATA\s+PLAN\s+|STRATA\s+)?(' || string_agg(prefix, '|' ORDER BY length(prefix) DESC, prefix) || '){_TAIL}' AS pat FROM (SELECT DISTINCT prefix FROM code_rows)")
view("code_hits", _split("c", "doc_texts", "(SELECT pat FROM code_pattern)"))
view("doc_tokens", "SELECT sha256, pre || num || suf AS token, num, count(*) AS cnt, min(pos) AS pos FROM code_hits GROUP BY ALL")
view("label_hits", _split("e", "doc_texts", rf"'\b(?:STRATA\s+PLAN\s+|STRATA\s+){_NO}([A-Z]{{2,6}}){_TAIL}'"))
view("doc_labels", "SELECT sha256, string_agg(tok, ', ' ORDER BY pos) AS explicit FROM (SELECT sha256, pre || num || suf AS tok, min(pos) AS pos FROM label_hits GROUP BY ALL) GROUP BY sha256")


def contents(spark: SparkSession, d: str) -> DataFrame:
    """Attachment rows with their content key."""
    return table(spark, d, "fx_attachments").withColumn("sha256", F.sha2(F.col("content_text"), 256))


def stored_contents(spark: SparkSession, d: str) -> DataFrame:
    """The same rows, derived once and read again from storage."""
    return stored(contents(spark, d))


def scanned(spark: SparkSession, d: str, c: DataFrame | None = None) -> DataFrame:
    return lk.scan_texts(c if c is not None else contents(spark, d), plans(spark, d), only=lk.LINKED)


@query("text_tokens", "SELECT sha256, token, cnt, pos FROM doc_tokens")
def text_tokens(spark, d):
    return lk.text_tokens(scanned(spark, d), plans(spark, d)).select("sha256", "token", "cnt", "pos")


@query("explicit_tokens", "SELECT sha256, explicit FROM doc_labels")
def explicit_tokens(spark, d):
    s = scanned(spark, d)
    return s.where(F.size("explicit") > 0).select("sha256", F.array_join("explicit", ", ").alias("explicit"))


view("own_code", "SELECT plan_norm, arg_min(manager_name, row_no) AS manager_name, arg_min(manager_email, row_no) AS manager_email, arg_min(strata_name, row_no) AS strata_name FROM code_rows GROUP BY plan_norm")
view("shared_base", "SELECT base FROM code_rows WHERE manager_name <> '' GROUP BY base HAVING count(DISTINCT manager_name) = 1")
view("tok_score", r"""
SELECT sha256, plan, sum(w * cnt) AS score, min(pos) AS pos FROM (
  SELECT t.sha256, t.cnt, t.pos, CASE WHEN o.plan_norm IS NOT NULL THEN t.token WHEN b.plan_norm IS NOT NULL THEN b.plan_norm WHEN s.base IS NOT NULL THEN t.token END AS plan,
    CASE WHEN o.plan_norm IS NOT NULL THEN 10 WHEN b.plan_norm IS NOT NULL THEN 9 ELSE 7 END AS w
  FROM doc_tokens t LEFT JOIN own_code o ON o.plan_norm = t.token
  LEFT JOIN own_code b ON regexp_matches(t.token, '^[A-Z]{2,6}\d{1,5}[A-Z]{1,3}$') AND b.plan_norm = regexp_extract(t.token, '^([A-Z]{2,6}\d{1,5})', 1)
  LEFT JOIN shared_base s ON s.base = t.token) WHERE plan IS NOT NULL GROUP BY ALL""")
# Each fixture text names one number at most once outside the scored codes, so the fallback order does not matter here.
view("name_win", """
SELECT sha256, num, max(plan_norm) FILTER (rn = 1) AS plan, max(s) FILTER (rn = 1) AS s1, max(s) FILTER (rn = 2) AS s2 FROM (
  SELECT *, row_number() OVER (PARTITION BY sha256, num ORDER BY s DESC, row_no) AS rn FROM (
    SELECT u.sha256, u.num, c.plan_norm, c.row_no, least(12, 3 * len(list_filter(string_split_regex(upper(o.strata_name), '[^A-Z0-9]+'), lambda w: length(w) >= 4 AND contains(d.text_up, w)))) AS s
    FROM (SELECT DISTINCT t.sha256, t.num FROM doc_tokens t WHERE NOT EXISTS (SELECT 1 FROM tok_score k WHERE k.sha256 = t.sha256 AND contains(k.plan, t.num))) u
    JOIN doc_texts d ON d.sha256 = u.sha256 JOIN code_rows c ON c.num = u.num JOIN own_code o ON o.plan_norm = c.plan_norm) WHERE s > 0)
GROUP BY ALL HAVING max(s) FILTER (rn = 1) >= 6 AND (max(s) FILTER (rn = 2) IS NULL OR max(s) FILTER (rn = 1) >= max(s) FILTER (rn = 2) + 3)""")
view("all_score", "SELECT sha256, plan, score, pos FROM tok_score UNION ALL SELECT sha256, plan, 6, 1000000 FROM name_win")
view("doc_rank", """
SELECT sha256, max(plan) FILTER (rn = 1) AS p1, max(score) FILTER (rn = 1) AS s1, max(plan) FILTER (rn = 2) AS p2, max(score) FILTER (rn = 2) AS s2
FROM (SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY score DESC, pos) AS rn FROM all_score) GROUP BY sha256""")
view("doc_detected", """
SELECT sha256, string_agg(token || 'x' || cnt, ', ' ORDER BY cnt DESC, pos) AS detected FROM (
  SELECT *, row_number() OVER (PARTITION BY sha256 ORDER BY cnt DESC, pos) AS rn FROM doc_tokens) WHERE rn <= 10 GROUP BY sha256""")
view("doc_match", r"""
SELECT q.sha256, q.text_plan, q.note AS text_note, coalesce(dd.detected, '') AS detected, q.text_plan <> '' AND o.plan_norm IS NULL AS is_base_fallback,
  coalesce(o.plan_norm, v.plan_norm, '') AS row_plan, coalesce(o.manager_name, v.manager_name, '') AS row_manager, coalesce(o.manager_email, v.manager_email, '') AS row_email
FROM (SELECT d.sha256, CASE WHEN trim(d.content_text) = '' THEN 'No text extracted (scanned PDF?).' WHEN r.p1 IS NULL THEN 'Detected plan text, but no match in list (or not safe to auto-pick).'
    WHEN r.s2 IS NULL OR r.s1 - r.s2 >= 3 THEN '' ELSE 'Ambiguous: ' || r.p1 || ' vs ' || r.p2 || '. Leaving unmatched.' END AS note,
    CASE WHEN r.p1 IS NOT NULL AND (r.s2 IS NULL OR r.s1 - r.s2 >= 3) THEN r.p1 ELSE '' END AS text_plan
  FROM doc_texts d LEFT JOIN doc_rank r ON r.sha256 = d.sha256) q
LEFT JOIN doc_detected dd ON dd.sha256 = q.sha256
LEFT JOIN own_code o ON o.plan_norm = q.text_plan
LEFT JOIN (SELECT base, arg_min(c.plan_norm, row_no) AS first_plan FROM code_rows c GROUP BY base) fb ON fb.base = q.text_plan
LEFT JOIN own_code v ON v.plan_norm = fb.first_plan""")


def matched(spark: SparkSession, d: str, s: DataFrame | None = None, c: DataFrame | None = None) -> DataFrame:
    c = c if c is not None else stored_contents(spark, d)
    return lk.match_texts(s if s is not None else scanned(spark, d, c), plans(spark, d), c.select("sha256", "content_text"))


@query("text_plan_score", "SELECT sha256, text_plan, text_note, detected, is_base_fallback, row_plan, row_manager FROM doc_match")
def text_plan_score(spark, d):
    return matched(spark, d).select("sha256", "text_plan", "text_note", lk.detected_text().alias("detected"), "is_base_fallback", "row_plan", "row_manager")


_INV = [
    r"'(?i)Invoice\s*(?:No\.?|Number|#)\s*[:#\-]?\s*([A-Z0-9][A-Z0-9\-/_]{1,30})'", r"'(?i)\bInv\.?\s*No\.?\s*[:#\-]?\s*([A-Z0-9][A-Z0-9\-/_]{1,30})'",
    r"'(?i)\bINV[\s:#\-]+([0-9][A-Z0-9\-/_]{1,30})'", r"'(?i)\bInvoice\s+([0-9][A-Z0-9\-/_]{1,30})'",
]
_inv = ", ".join(rf"nullif(regexp_replace(regexp_replace(upper(regexp_extract(content_text, {p}, 1)), '[^A-Z0-9\-]', '', 'g'), '^-*$', ''), '')" for p in _INV)
_AMT = [
    r"'(?i)(?:Total\s*Due|Amount\s*Due|Balance\s*Due|Amount\s*Payable|Pay\s*This\s*Amount)\s*[:$]?\s*\$?\s*([0-9][0-9,]*\.\d{2})'",
    r"'(?i)Grand\s*Total\s*[:$]?\s*\$?\s*([0-9][0-9,]*\.\d{2})'", r"'(?i)\bTotal\s*[:$]?\s*\$?\s*([0-9][0-9,]*\.\d{2})'",
]
view("doc_fields", f"""
SELECT sha256, coalesce({_inv}, '') AS invoice_number, CAST(CAST(replace(coalesce(nullif(regexp_extract(content_text, {_AMT[0]}, 1), ''),
  nullif(regexp_extract(content_text, {_AMT[1]}, 1), ''), regexp_extract_all(content_text, {_AMT[2]}, 1)[-1]), ',', '') AS DECIMAL(20, 2)) * 100 AS BIGINT) AS amount_cents FROM doc_texts""")


@query("invoice_fields", "SELECT sha256, invoice_number, coalesce(CAST(amount_cents AS VARCHAR), '') AS amount_cents FROM doc_fields")
def invoice_fields(spark, d):
    c = contents(spark, d).select("sha256", F.struct(t.invoice_number("content_text").alias("i"), F.coalesce(t.amount_cents("content_text").cast("string"), F.lit("")).alias("a")).alias("f"))
    return c.groupBy("sha256").agg(F.any_value("f").alias("f")).select("sha256", F.col("f.i").alias("invoice_number"), F.col("f.a").alias("amount_cents"))


_HINT = "'(?i)(invoice|inv\\b|statement|bill|approved contractor|contractor invoice|remit|payment)'"
view("att_kind", rf"""
SELECT *, CASE WHEN regexp_matches(name, '\.[A-Za-z0-9]{{1,8}}$') THEN trim(name) ELSE (CASE WHEN trim(name) = '' THEN 'file' ELSE trim(name) END) || ext END AS base_name,
  CASE WHEN NOT is_container THEN 'extra' WHEN ext = '.pdf' THEN 'pdf' WHEN ext = '.zip' THEN 'zip' ELSE 'extra' END AS kind, head = '%PDF-' AS is_real_pdf
FROM (SELECT a.*, m.subject, sha256(a.content_text) AS sha256,
    CASE WHEN regexp_matches(name, '\.[A-Za-z0-9]{{1,8}}$') THEN lower(regexp_extract(name, '(\.[A-Za-z0-9]{{1,8}})$', 1)) WHEN contains(lower(content_type), 'pdf') THEN '.pdf'
      WHEN contains(lower(content_type), 'zip') OR contains(lower(content_type), 'compressed') THEN '.zip' WHEN contains(lower(name || ' ' || subject), 'zip') THEN '.zip' ELSE '.pdf' END AS ext,
    regexp_matches(name, '(?i)\.(pdf|zip)(\b|$)') OR contains(lower(content_type), 'pdf') OR contains(lower(content_type), 'zip') OR contains(lower(content_type), 'compressed')
      OR (NOT regexp_matches(name, '\.[A-Za-z0-9]{{1,8}}$') AND (content_type = '' OR contains(lower(content_type), 'octet-stream')) AND regexp_matches(name || ' ' || subject, {_HINT})) AS is_container
  FROM fx_attachments a JOIN fx_inbox m ON m.msg_id = a.msg_id)""")


@query("attachment_filter", r"""
SELECT msg_id, att_idx, sha256, base_name, ext, kind, is_real_pdf, trim(regexp_replace(base_name, '[<>:"/\\|?*\x00-\x1f]', '_', 'g')) AS safe_name FROM att_kind""")
def attachment_filter(spark, d):
    return att.classified(contents(spark, d), table(spark, d, "fx_inbox")).select(
        "msg_id", "att_idx", "sha256", "base_name", "ext", "kind", "is_real_pdf", t.safe_file_name(F.col("base_name")).alias("safe_name"))
