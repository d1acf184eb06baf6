"""Message decisions: branch, per-PDF classification, group action, gates, destination, forwarding.

Group decisions are plain aggregates (counts and flags), combined before the shuffle, so a message with very
many attachments is no special case. Lists that grow with a message (names, per-PDF targets) stay rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import linking as lk

OUTCOMES = ["agree", "empty", "no_plan", "ambiguous", "clash", "pdf_override"]


def branch(plan, has_attachments) -> Column:
    """Which of the four paths a message takes."""
    known = t.blank(plan) != ""
    return (
        F.when(known & has_attachments, "self")
        .when(known, "thread")
        .when(has_attachments, "text_fallback")
        .otherwise("skip")
    )


def evidence(pdfs: DataFrame, plans: DataFrame, match_name: str = "base_name") -> DataFrame:
    """Text match (J5), labelled codes (X2) and file-name fallback (J4) of each PDF row, as `linking.scan_rows` left them."""
    return lk.link_file_names(lk.match_rows(pdfs, plans), plans, match_name)


def classify(pdfs: DataFrame) -> DataFrame:
    """Outcome, plan and note of each PDF against the plan its message named (`subject_plan`)."""
    text_ok = (F.col("row_plan") != "") & (F.col("row_manager") != "")
    name_ok = (F.col("fallback_plan") != "") & (F.col("fallback_manager") != "")
    no_text = F.col("text_note").startswith("No text extracted")
    seen, labelled = F.size("detected") > 0, F.size("explicit") > 0
    outcome = (
        F.when(text_ok & F.col("is_base_fallback"), "ambiguous")
        .when(text_ok, F.when(F.col("row_plan") == F.col("subject_plan"), "agree").otherwise("pdf_override"))
        .when(name_ok, F.when(F.col("fallback_plan") == F.col("subject_plan"), "agree").otherwise("clash"))
        .when(no_text, "empty")
        .when(~seen & ~labelled, "no_plan")
        .otherwise("ambiguous")
    )
    note = (
        F.when(text_ok & F.col("is_base_fallback"), F.concat(
            F.lit("PDF identifies base plan "), t.pretty_plan("row_plan"), F.lit(" only; variant is ambiguous — flagged for front-desk correction.")))
        .when(text_ok, F.col("text_note"))
        .when(name_ok, F.concat(F.lit("matched by filename ("), t.pretty_plan("fallback_plan"), F.lit("); PDF text: "), "text_note"))
        .when(no_text, F.col("text_note"))
        .when(~seen & ~labelled, "No strata plan number found in PDF text; routing on subject.")
        .when(~seen, F.concat(F.lit("PDF names strata plan(s) not in the managed list: "), F.array_join("explicit", ", "), F.lit("; flagged for review.")))
        .otherwise(F.col("text_note"))
    )
    by_text = text_ok
    pick = lambda a, b: F.when(by_text, F.col(a)).when(name_ok, F.col(b)).otherwise("")
    return pdfs.withColumns({
        "outcome": outcome,
        "note": note,
        "pdf_plan": pick("row_plan", "fallback_plan"),
        "pdf_manager": pick("row_manager", "fallback_manager"),
        "pdf_email": pick("row_email", "fallback_email"),
        "shown": F.when(~by_text & name_ok, F.array(F.struct(F.col("base_name").alias("token"), F.lit(1).cast("long").alias("cnt")))).otherwise(F.col("detected")),
    })


def classification_text() -> Column:
    """Name, outcome, plan, note and top three tokens on one line."""
    quoted = F.when(F.col("note").contains("'"), F.concat(F.lit('"'), "note", F.lit('"'))).otherwise(F.concat(F.lit("'"), "note", F.lit("'")))
    return F.concat_ws(
        " ",
        F.concat("base_name", F.lit(":"), "outcome"),
        F.when(F.col("pdf_plan") != "", F.concat(F.lit("pdf="), "pdf_plan")),
        F.when(F.col("note") != "", F.concat(F.lit("note="), quoted)),
        F.when(F.size("shown") > 0, F.concat(F.lit("detected=["), lk.detected_text("shown", 3), F.lit("]"))),
    )


def resolve_unlabelled(pdfs: DataFrame) -> DataFrame:
    """Plan of a PDF whose message named none: its text when that has a manager, else its file name."""
    text_ok = (F.col("row_plan") != "") & (F.col("row_manager") != "")
    name_ok = (F.col("fallback_plan") != "") & (F.col("fallback_manager") != "")
    return pdfs.withColumns({
        "pdf_plan": F.when(text_ok, F.col("row_plan")).when(name_ok, F.col("fallback_plan")).otherwise(""),
        "plan_source": F.when(text_ok, "text").when(name_ok, "name").otherwise("unmatched"),
    })


def _plan_counts(rows: DataFrame) -> DataFrame:
    """Distinct plans and bases per message, in two combinable steps instead of a distinct count per group."""
    per_plan = rows.where("pdf_plan <> ''").groupBy("msg_id", "pdf_plan").agg(F.max(F.col("outcome").isin("agree", "pdf_override", "clash")).alias("confident"))
    per_base = per_plan.where("confident").groupBy("msg_id", t.plan_base("pdf_plan").alias("base")).agg(F.count("*").alias("n"), F.min("pdf_plan").alias("lo"), F.max("pdf_plan").alias("hi"))
    return per_base.groupBy("msg_id").agg(F.sum("n").alias("n_plans"), F.count("*").alias("n_bases"), F.min("lo").alias("first_plan"), F.max("hi").alias("last_plan"))


def email_action(messages: DataFrame, pdfs: DataFrame, gates: DataFrame | None = None) -> DataFrame:
    """A7 after A12: one action per message of the `self` path.

    messages: msg_id, subject_plan. pdfs: classified rows. gates: optional msg_id with n_download_failed,
    n_invalid and n_unsafe_zip; each is decided before the PDFs are looked at, in that order.
    """
    counts = pdfs.groupBy("msg_id").agg(F.count("*").alias("n_pdfs"), *[F.count_if(F.col("outcome") == o).alias(f"n_{o}") for o in OUTCOMES])
    m = messages.select("msg_id", "subject_plan").join(counts, "msg_id", "left").join(_plan_counts(pdfs), "msg_id", "left")
    gate_cols = ["n_download_failed", "n_invalid", "n_unsafe_zip"]
    m = m.join(gates.select("msg_id", *gate_cols), "msg_id", "left") if gates is not None else m.withColumns({c: F.lit(0).cast("long") for c in gate_cols})
    m = m.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ["n_pdfs", "n_plans", "n_bases", *gate_cols] + [f"n_{o}" for o in OUTCOMES]})
    m = m.withColumns({c: t.blank(c) for c in ("first_plan", "last_plan")})
    n = lambda o: F.col(f"n_{o}")
    clean = n("ambiguous") + n("clash") == 0
    shared_base = F.col("n_bases") < F.col("n_plans")
    code = (
        F.when(F.col("n_download_failed") > 0, "download failed")
        .when(F.col("n_invalid") > 0, "invalid PDF bytes")
        .when(F.col("n_unsafe_zip") > 0, "unsafe ZIP")
        .when(F.col("n_pdfs") == 0, "no PDFs to classify")
        .when(clean & (n("pdf_override") == 0), "cross-check OK")
        .when(clean & shared_base, "suffix-variant clash")
        .when(clean & (F.col("n_plans") <= 1), "PDF overrides subject")
        .when(clean, "auto-split")
        .when(n("ambiguous") > 0, "ambiguous PDF text")
        .when(n("empty") + n("no_plan") > 0, "mixed evidence")
        .when(F.col("n_plans") == 1, "consensus clash")
        .when(shared_base, "suffix-variant clash")
        .otherwise("auto-split, subject ignored")
    )
    m = m.withColumn("reason_code", code)
    c = F.col("reason_code")
    return m.withColumns({
        "action": F.when(c.isin("no PDFs to classify", "cross-check OK", "PDF overrides subject"), "route_as_subject").when(c.startswith("auto-split"), "auto_split").otherwise("flag_and_hold"),
        "reason": F.when(c == "cross-check OK", F.format_string("PDF cross-check OK (%d agree, %d empty, %d no plan # in PDF — routed under subject)", n("agree"), n("empty"), n("no_plan")))
        .when(c == "PDF overrides subject", F.concat(F.lit("PDF overrides subject: routing to "), t.pretty_plan("first_plan"), F.lit(" (PDF evidence trusted)")))
        .when(c == "consensus clash", F.concat(F.lit("consensus clash: every PDF says "), t.pretty_plan("first_plan"), F.lit(", subject says "), t.pretty_plan("subject_plan")))
        .when(c == "suffix-variant clash", F.format_string("suffix-variant clash across PDFs: %d plans from %s to %s share a base", "n_plans", t.pretty_plan("first_plan"), t.pretty_plan("last_plan")))
        .when(c.startswith("auto-split"), F.format_string("auto-split across distinct strata bases: %d plans from %s to %s", "n_plans", t.pretty_plan("first_plan"), t.pretty_plan("last_plan")))
        .when(c == "ambiguous PDF text", F.format_string("ambiguous PDF text: %d of %d PDFs", n("ambiguous"), "n_pdfs"))
        .when(c == "mixed evidence", F.format_string("mixed evidence: %d PDFs carry no plan while %d clash with subject %s", n("empty") + n("no_plan"), n("clash"), t.pretty_plan("subject_plan")))
        .otherwise(c),
    })


def pdf_targets(actions: DataFrame, pdfs: DataFrame) -> DataFrame:
    """The plan each PDF is routed to; plan-less siblings in a multi-PDF message are left out."""
    a = actions.where("action <> 'flag_and_hold'").select("msg_id", "action", "n_pdfs", F.col("n_pdf_override").alias("overrides"))
    r = pdfs.join(a, "msg_id").where(~((F.col("outcome") == "no_plan") & (F.col("n_pdfs") > 1)))
    own = (F.col("action") == "auto_split") | ((F.col("overrides") > 0) & F.col("outcome").isin("agree", "pdf_override"))
    # An empty or plan-less PDF of a split message has no plan of its own and stays under the subject's.
    return r.withColumn("target_plan", F.when(own & (F.col("pdf_plan") != ""), F.col("pdf_plan")).otherwise(F.col("subject_plan"))).withColumn("own_plan", own)


def destination(n_total: Column, n_routed: Column, n_duplicate: Column, n_failed: Column) -> Column:
    """Folder of a message given how its attachments ended; '' stays in the inbox."""
    return (
        F.when((n_total == 0) | (n_failed > 0), "")
        .when((n_routed == 0) & (n_duplicate > 0), "duplicate_emails")
        .otherwise("processed_emails")
    )


def forward_targets(actions: DataFrame, pdfs: DataFrame, messages: DataFrame, override_recipient: str = "") -> DataFrame:
    """Distinct manager addresses of the plans a message was routed to."""
    split = actions.where("action = 'auto_split' or (action = 'route_as_subject' and n_pdf_override > 0)").select("msg_id")
    many = pdfs.where(F.col("outcome").isin("agree", "pdf_override", "clash")).join(split, "msg_id", "left_semi").select("msg_id", F.col("pdf_email").alias("email"))
    one = messages.join(actions.where("action = 'route_as_subject' and n_pdf_override = 0").select("msg_id"), "msg_id", "left_semi").select("msg_id", F.col("manager_email").alias("email"))
    real = many.unionByName(one).where("email <> ''").distinct()
    return real.withColumn("recipient", F.lit(override_recipient) if override_recipient else F.col("email"))


def close_messages(actions: DataFrame, routed: DataFrame, extras: DataFrame, targets: DataFrame, sent: DataFrame) -> DataFrame:
    """Destination, partial-commit flag and forward decision of every decided message.

    routed: msg_id, result (routed | duplicate_skipped | failed). extras: msg_id, n_extras.
    sent: msg_id, email, ok for each attempted forward.
    """
    r = routed.groupBy("msg_id").agg(
        F.count("*").alias("n_total"), F.count_if(F.col("result") == "routed").alias("n_routed"),
        F.count_if(F.col("result") == "duplicate_skipped").alias("n_duplicate"), F.count_if(F.col("result") == "failed").alias("n_failed"))
    f = targets.join(sent, ["msg_id", "email"], "left").groupBy("msg_id").agg(F.count("*").alias("n_targets"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("n_unsent"))
    a = actions.where("action <> 'flag_and_hold'").select("msg_id", "n_pdfs", "n_no_plan").join(r, "msg_id", "left").join(extras, "msg_id", "left").join(f, "msg_id", "left")
    a = a.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_total", "n_routed", "n_duplicate", "n_failed", "n_extras", "n_targets", "n_unsent")})
    needed = ((F.col("n_extras") > 0) | ((F.col("n_no_plan") > 0) & (F.col("n_pdfs") > 1))) & (F.col("n_failed") == 0)
    a = a.withColumn("forward", F.when(~needed, "none").when((F.col("n_targets") == 0) | (F.col("n_unsent") > 0), "blocked").otherwise("sent"))
    folder = destination(F.col("n_total"), F.col("n_routed"), F.col("n_duplicate"), F.col("n_failed"))
    return a.withColumns({
        "partial_commit": (F.col("n_failed") > 0) & (F.col("n_routed") + F.col("n_duplicate") > 0),
        "flagged": (F.col("n_failed") > 0) | (F.col("forward") == "blocked"),
        "folder": F.when(F.col("forward") == "blocked", "").when(F.col("forward") == "sent", "processed_emails").otherwise(folder),
    })


def text_gate(messages: DataFrame, pdfs: DataFrame, gates: DataFrame) -> DataFrame:
    """A message without a plan is handled only when every PDF in it is; otherwise nothing is.

    pdfs: resolved rows with plan_source and is_duplicate. gates: as for `email_action`.
    """
    matched = F.col("plan_source") != "unmatched"
    c = pdfs.groupBy("msg_id").agg(
        F.count("*").alias("n_pdfs"), F.count_if(matched & ~F.col("is_duplicate")).alias("n_routable"),
        F.count_if(matched & F.col("is_duplicate")).alias("n_duplicate"), F.count_if(~matched).alias("n_unmatched"))
    cols = ["n_pdfs", "n_routable", "n_duplicate", "n_unmatched", "n_download_failed", "n_invalid", "n_unsafe_zip"]
    m = messages.select("msg_id").join(c, "msg_id", "left").join(gates, "msg_id", "left").select("msg_id", *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in cols])
    blocked = F.col("n_unmatched") + F.col("n_download_failed") + F.col("n_invalid") + F.col("n_unsafe_zip")
    label = lambda x, s: F.when(F.col(x) > 0, F.format_string(s + ": %d", F.col(x)))
    detail = F.concat_ws(
        " | ", label("n_routable", "would-have-routed PDFs"), label("n_duplicate", "would-have-skipped-as-duplicate"), label("n_unmatched", "unmatched PDFs"),
        label("n_download_failed", "download failures"), label("n_invalid", "invalid PDF bytes"), label("n_unsafe_zip", "unsafe ZIPs"))
    ok = (F.col("n_pdfs") > 0) & (blocked == 0)
    return m.withColumns({
        "decision": F.when(ok, "route_all").otherwise("left_in_inbox"),
        "detail": F.when(ok, "").when(detail == "", "no actionable content").otherwise(detail),
        "flagged": ~ok & (F.col("n_pdfs") + F.col("n_download_failed") + F.col("n_invalid") + F.col("n_unsafe_zip") > 0),
    })
