"""Input tables: the driver's parquet files and the domain tables derived from them.

`DERIVED` maps a domain table to (base tables, SQL). The text is portable, so the same definition
feeds Spark here and the SQL checks in `docroute.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_plans": (("customer",), """
SELECT c_custkey AS plan_id, base_no, prefix, suffix,
  concat(prefix, CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE '-' END, base_no, suffix) AS strata_plan,
  concat('Harbour ', CASE base_no % 4 WHEN 0 THEN 'Kimberly' WHEN 1 THEN 'Granville' WHEN 2 THEN 'Seaview' ELSE 'Orchard' END, ' Court ', base_no) AS strata_name,
  CASE WHEN base_no % 13 = 0 THEN '' WHEN base_no % 11 = 0 THEN concat('Manager ', c_custkey % 7) ELSE concat('Manager ', base_no % 7, ', Backup ', base_no % 3) END AS strata_manager,
  concat('mgr', base_no % 7, '@example.com') AS manager_email,
  CASE WHEN base_no % 10 = 0 THEN concat('AP ', c_custkey % 3) ELSE concat('AP ', base_no % 3) END AS ap_name,
  concat('ap', base_no % 3, '@example.com') AS ap_email,
  CASE WHEN c_custkey % 17 = 0 THEN '0' WHEN c_custkey % 5 = 0 THEN NULL ELSE '1' END AS status
FROM (SELECT c_custkey, 1000 + CAST(floor(c_custkey / 3) AS BIGINT) AS base_no,
        CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'B' END AS suffix,
        CASE CAST(floor(c_custkey / 3) AS BIGINT) % 5 WHEN 0 THEN 'BCS' WHEN 1 THEN 'LMS' WHEN 2 THEN 'EPS' WHEN 3 THEN 'NW' ELSE 'VR' END AS prefix
      FROM customer) c
WHERE NOT (suffix = '' AND base_no % 2 = 0)"""),
    "fx_plan_list": (("fx_plans", "nation"), """
SELECT CAST(plan_id * 10 AS BIGINT) AS row_no, strata_plan, strata_name, strata_manager, manager_email, ap_name, ap_email, status FROM fx_plans
UNION ALL
SELECT CAST(plan_id * 10 + 1 AS BIGINT), concat(prefix, '.', base_no, suffix), strata_name, CASE WHEN plan_id % 38 = 0 THEN 'Manager X' ELSE strata_manager END, manager_email, ap_name, ap_email, status FROM fx_plans WHERE plan_id % 19 = 0
UNION ALL
SELECT CAST(100000000000000 + n_nationkey AS BIGINT), split_part('GVCCA,TCLUB,HARBR,SEAVW', ',', CAST(n_nationkey + 1 AS INT)), 'Harbour Club', 'Manager 1', 'mgr1@example.com', 'AP 1', 'ap1@example.com', CAST(NULL AS VARCHAR(1)) FROM nation WHERE n_nationkey < 4
UNION ALL
SELECT CAST(200000000000000 + n_nationkey AS BIGINT), '  ', '', '', '', 'AP/1', '', '1' FROM nation WHERE n_nationkey < 2"""),
    "fx_inbox": (("orders", "fx_plans"), """
SELECT o_orderkey AS msg_id, o_custkey AS conversation_id, o_orderdate AS received_at,
  CASE o_orderkey % 6 WHEN 0 THEN 'Invoice attached' WHEN 1 THEN concat('FW: ', lower(prefix), ' ', base_no, suffix, ' invoice') WHEN 2 THEN concat(prefix, '#', base_no, suffix) WHEN 3 THEN concat('Re: ZZ 99 and ', prefix, ' - ', base_no, suffix) WHEN 4 THEN '' ELSE concat(prefix, base_no, suffix, ' statement') END AS subject,
  CASE WHEN o_orderkey % 6 IN (0, 4) AND o_orderkey % 4 <> 2 THEN concat('Please process for ', prefix, '_', base_no, suffix) ELSE 'See attached.' END AS body_preview,
  o_orderkey % 9 <> 0 AS has_attachments,
  CASE WHEN o_orderkey % 8 = 0 THEN 'not an email' ELSE concat('Billing <AR@Vendor', o_custkey % 20, '.Example.COM>') END AS from_addr
FROM (SELECT o.*, coalesce(p.prefix, 'QQ') AS prefix, coalesce(p.base_no, 7000 + o_custkey % 900) AS base_no, coalesce(p.suffix, '') AS suffix FROM orders o LEFT JOIN fx_plans p ON p.plan_id = o_custkey) p"""),
    "fx_attachments": (("lineitem", "orders", "fx_plans"), """
SELECT l_orderkey AS msg_id, l_linenumber AS att_idx,
  CASE WHEN l_linenumber % 7 = 0 THEN 'image001.png' WHEN l_linenumber % 6 = 0 THEN concat('scan', l_orderkey) WHEN l_orderkey % 32 = 12 THEN concat('scan', l_orderkey, '.pdf') WHEN l_orderkey % 32 IN (10, 26) THEN concat(prefix, ' ', base_no + 5, 'A - inv ', l_linenumber, '.pdf') ELSE concat(prefix, ' ', base_no, suffix, ' - inv ', l_linenumber, '.pdf') END AS name,
  CASE WHEN l_linenumber % 7 = 0 THEN 'image/png' WHEN l_linenumber % 6 = 0 THEN 'application/octet-stream' ELSE 'application/pdf' END AS content_type,
  CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN '<html>' ELSE '%PDF-' END AS head,
  CASE WHEN (l_orderkey + l_linenumber) % 10 = 0 THEN '' ELSE concat('Acme Services Strata Plan ', CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN concat('KAS ', 9000 + l_linenumber)
    WHEN l_orderkey % 16 = 5 OR (l_orderkey % 16 = 7 AND l_linenumber % 2 = 1) THEN concat(prefix, ' ', base_no + 5, 'A')
    WHEN l_orderkey % 16 = 1 OR (l_orderkey % 16 = 3 AND l_linenumber % 2 = 1) THEN concat(prefix, ' ', base_no, CASE WHEN suffix = 'A' THEN 'B' ELSE 'A' END)
    ELSE concat(prefix, ' ', base_no, suffix) END, CASE WHEN l_linenumber % 2 = 0 THEN ' C/O Harbour' ELSE '' END, ' Invoice No. INV-', l_orderkey, '-', CASE WHEN l_linenumber > 4 THEN 1 ELSE l_linenumber END, ' Total 1.00 Total Due: $', CAST(floor(cents / 100) AS BIGINT), '.', lpad(CAST(cents % 100 AS VARCHAR(4)), 2, '0'), CASE WHEN l_linenumber = 6 THEN ' reissued' ELSE '' END) END AS content_text
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 4 THEN 12345 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents FROM lineitem) l
JOIN (SELECT o.*, coalesce(p.prefix, 'QQ') AS prefix, coalesce(p.base_no, 7000 + o_custkey % 900) AS base_no, coalesce(p.suffix, '') AS suffix FROM orders o LEFT JOIN fx_plans p ON p.plan_id = o_custkey) p ON o_orderkey = l_orderkey"""),
    # `+ 0` hides that the branches are partitioned alike: a union that relies on it fails where a skewed join splits one of them.
    "fx_parts": (("fx_attachments", "fx_inbox"), """
SELECT a.msg_id + 0 AS msg_id, CAST(a.att_idx AS BIGINT) AS att_idx, CAST(0 AS BIGINT) AS entry_no, CAST(i.received_at AS TIMESTAMP) + INTERVAL 1 DAY * a.att_idx AS arrived_at,
  CASE WHEN a.msg_id % 32 IN (10, 26) AND a.att_idx = 1 THEN concat('scan', a.msg_id, '.pdf') ELSE a.name END AS name, a.content_type, CASE WHEN (a.msg_id * 3 + a.att_idx) % 41 = 5 THEN NULL ELSE a.head END AS head,
  CASE WHEN a.msg_id % 32 IN (10, 26) AND a.att_idx <= 2 THEN '' ELSE a.content_text END AS content_text, CAST(0 AS BIGINT) AS n_entries, CAST(0 AS BIGINT) AS file_size, CAST(0 AS BIGINT) AS compress_size, false AS encrypted, false AS is_dir
FROM fx_attachments a JOIN fx_inbox i ON i.msg_id = a.msg_id WHERE NOT (a.msg_id % 7 = 3 AND a.att_idx >= 2)
UNION ALL
SELECT a.msg_id + 0 AS msg_id, CAST(2 AS BIGINT), CAST(0 AS BIGINT), max(CAST(i.received_at AS TIMESTAMP)) + INTERVAL 1 DAY * 2, 'bundle.zip', 'application/zip', CASE WHEN a.msg_id % 31 = 7 THEN NULL ELSE 'PK' END, '', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), false, false
FROM fx_attachments a JOIN fx_inbox i ON i.msg_id = a.msg_id WHERE a.msg_id % 7 = 3 AND a.att_idx >= 2 GROUP BY a.msg_id
UNION ALL
SELECT a.msg_id + 0 AS msg_id, CAST(2 AS BIGINT), CAST(a.att_idx AS BIGINT), CAST(i.received_at AS TIMESTAMP) + INTERVAL 1 DAY * (2 + 3 * a.att_idx),
  CASE WHEN a.att_idx = 3 THEN '__MACOSX/._a.pdf' WHEN a.att_idx = 4 THEN 'manifest.txt' WHEN a.att_idx = 7 THEN 'folder/' WHEN a.att_idx = 5 AND a.msg_id % 3 = 0 THEN 'cover.docx' WHEN a.att_idx = 6 THEN concat('in/', a.name, '.PDF') ELSE concat('in/', a.name) END,
  '', a.head, a.content_text, CAST(0 AS BIGINT), CAST(a.att_idx * 20000 AS BIGINT), CAST(CASE WHEN a.msg_id % 11 = 5 THEN 10 ELSE 5000 END AS BIGINT), a.msg_id % 13 = 2, a.att_idx = 7
FROM fx_attachments a JOIN fx_inbox i ON i.msg_id = a.msg_id WHERE a.msg_id % 7 = 3 AND a.att_idx >= 2"""),
    "fx_mail": (("fx_inbox", "fx_parts"), """
SELECT i.msg_id, CAST(i.received_at AS TIMESTAMP) AS received_at, i.subject, i.body_preview, i.has_attachments, n.n_attachments
FROM fx_inbox i JOIN (SELECT msg_id, count(*) AS n_attachments FROM fx_parts WHERE entry_no = 0 GROUP BY msg_id) n ON n.msg_id = i.msg_id"""),
    "fx_archive_files": (("orders", "fx_plans"), """
SELECT concat(p.prefix, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE '' END, p.base_no, p.suffix) AS plan_folder,
  CASE WHEN o_orderkey % 29 = 0 THEN concat('vendor copy ', o_orderkey, '.pdf')
       WHEN o_orderkey % 31 = 0 THEN concat('Summary - ', o_orderkey, '.pdf')
       ELSE concat(CASE o_orderkey % 4 WHEN 0 THEN concat('AB-', o_orderkey % 900) WHEN 1 THEN lpad(CAST(o_orderkey % 9000 AS VARCHAR(8)), 6, '0') WHEN 2 THEN CAST(o_orderkey AS VARCHAR(12)) ELSE 'WIRE' END,
         ' - ', lpad(CAST(month(o_orderdate) AS VARCHAR(2)), 2, '0'), ' - ', p.prefix, p.base_no, p.suffix, ' ',
         split_part('January,February,March,April,May,June,July,August,September,October,November,December', ',', CAST(CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE month(o_orderdate) END AS INT)),
         ' ', year(o_orderdate), ' inv', CASE WHEN o_orderkey % 11 = 0 THEN ' (1)' ELSE '' END, '.pdf') END AS file_name,
  o_orderdate AS mtime, CAST(floor(o_totalprice) AS BIGINT) AS size_bytes, o_orderkey AS file_no
FROM (SELECT o.*, coalesce(p.prefix, 'QQ') AS prefix, coalesce(p.base_no, 7000 + o_custkey % 900) AS base_no, coalesce(p.suffix, '') AS suffix FROM orders o LEFT JOIN fx_plans p ON p.plan_id = o_custkey) p"""),
    "fx_queue_files": (("documents",), """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'To_Approve' WHEN 1 THEN 'Approved' WHEN 2 THEN 'Approved_Invoices' WHEN 3 THEN 'Paid_Invoices' ELSE '_Unmatched' END AS stage,
  concat(CASE WHEN doc_id % 5 IN (0, 1) THEN 'Manager ' ELSE 'AP ' END, doc_id % 7) AS owner,
  CASE WHEN doc_id % 41 = 4 THEN '.DS_Store' WHEN doc_id % 37 = 4 THEN 'step.log' WHEN doc_id % 19 = 0 THEN concat('Processed - inv ', doc_id, '.pdf') ELSE concat(CASE WHEN doc_id % 2 = 0 THEN 'Inv ' ELSE 'INV ' END, doc_id, '.pdf') END AS file_name,
  n_chars AS size_bytes, doc_id % 3 = 0 AS in_notified, doc_id % 4 = 0 AS in_legacy
FROM documents"""),
    "fx_ledger_ops": (("events",), """
SELECT event_id AS seq, ts, concat('h', user_id, '_', event_id % 5) AS sha256,
  CASE WHEN event_id % 50 = 0 THEN 'override' WHEN event_id % 9 = 0 THEN 'archive' WHEN event_id % 7 = 0 THEN 'to_ap' ELSE 'arrive' END AS op,
  concat('BCS', 1000 + user_id % 40) AS plan_norm,
  CASE WHEN event_id % 6 = 0 THEN '' ELSE concat('INV-', CAST(floor(value) AS BIGINT) % 15) END AS invoice_number,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) % 10 * 100 END AS amount_cents,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('vendor', user_id % 5, '.com') END AS sender_domain
FROM events"""),
    "fx_zip_entries": (("lineitem",), """
SELECT l_orderkey AS zip_id, l_linenumber AS entry_no,
  CASE l_linenumber WHEN 3 THEN '__MACOSX/._a.pdf' WHEN 4 THEN 'manifest.txt' WHEN 5 THEN CASE WHEN l_orderkey % 3 = 0 THEN 'cover.docx' ELSE 'dir/B.PDF' END ELSE concat('inv', l_linenumber, '.pdf') END AS entry_name,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS file_size,
  CAST(floor(CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 1 + l_extendedprice * 4 END) AS BIGINT) AS compress_size,
  l_orderkey % 89 = 0 AND l_linenumber = 1 AS encrypted, l_linenumber = 7 AS is_dir
FROM lineitem"""),
    "fx_run_lines": (("events",), """
SELECT user_id, event_id, concat(CAST(CAST(ts AS DATE) AS VARCHAR(10)), ',step_', 1 + event_id % 6, ',', event_id % 30, CASE WHEN event_id % 4 = 0 THEN '' ELSE concat(',', event_id % 5) END, ',', CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, ',', event_id % 90, ',', CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 25 = 0 THEN 'skipped' ELSE 'ok' END) AS value
FROM events"""),
}

# One page of word boxes per order: (word_idx, text, x0, top); $CHECK is replaced by the order key.
PAGE_WORDS = [
    (0, "Check", 20.0, 30.0), (1, "Number:", 50.0, 30.0), (2, "777", 90.0, 30.0), (3, "PAID", 400.0, 300.0),
    (4, "Date:", 380.0, 330.0), (5, "MAY", 420.0, 330.0), (6, "08", 445.0, 330.0), (7, "2026", 470.0, 330.0),
    (8, "Check", 380.0, 350.0), (9, "Number:", 410.0, 350.0), (10, "$CHECK", 450.0, 350.0), (11, "Page", 580.0, 350.0),
]


#: Session setting: tasks that read `lineitem`, `orders` and `events`, whose text work is heavy; unset, one per input split.
SPREAD = "spark.docroute.inputTasks"
_SPREAD = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id"}


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; a setting can deal the rows of coarse files out to more tasks."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tasks = spark.conf.get(SPREAD, None)
    return df.repartition(int(tasks), _SPREAD[name]) if tasks and name in _SPREAD else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a derived one built on the given tables."""
    if name == "fx_words":
        return _words(base(spark, sf_dir, "orders"))
    if name not in DERIVED:
        return base(spark, sf_dir, name)
    deps, sql = DERIVED[name]
    frames = {d: table(spark, sf_dir, d) for d in deps}
    return spark.sql(_placeholders(sql, deps), **frames)


def _placeholders(sql: str, deps: tuple[str, ...]) -> str:
    import re

    for d in deps:
        sql = re.sub(rf"\b(FROM|JOIN) {d}\b", rf"\1 {{{d}}}", sql)
    return sql


def _words(orders: DataFrame) -> DataFrame:
    page = F.array(*[F.struct(F.lit(i).alias("word_idx"), F.lit(t).alias("t"), F.lit(x).alias("x"), F.lit(y).alias("top")) for i, t, x, y in PAGE_WORDS])
    w = orders.select(F.col("o_orderkey").alias("doc_id"), F.inline(page))
    shift = (F.col("doc_id") % 50).cast("double")
    check = F.when(F.col("doc_id") % 12 == 0, "").otherwise(F.col("doc_id").cast("string"))
    return w.select(
        "doc_id", "word_idx", F.when(F.col("t") == "$CHECK", check).otherwise(F.col("t")).alias("text"),
        (F.col("x") + shift).alias("x0"), (F.col("x") + shift + 20.0).alias("x1"), "top", (F.col("top") + 12.0).alias("bottom"),
    )
