"""Conversations: S4, J12, O5, W10."""

from __future__ import annotations

from pyspark.sql import functions as F

from docroute.operators import intake as it
from docroute.operators import threads as th
from docroute.plans.linking_queries import linked
from docroute.plans.registry import query, view
from docroute.session import checkpointed
from docroute.sources.tables import table

view("replies", "SELECT * FROM msg_link WHERE plan_norm <> '' AND NOT has_attachments")


@query("conversation_scan", "SELECT r.msg_id AS reply_id, count(m.msg_id) AS n_messages, min(m.received_at)::DATE::VARCHAR AS first_day, max(m.received_at)::DATE::VARCHAR AS last_day FROM replies r JOIN fx_inbox m ON m.conversation_id = r.conversation_id GROUP BY r.msg_id")
def conversation_scan(spark, d):
    """What each reply's conversation holds; the conversation is summarised once, then joined."""
    m = checkpointed(linked(spark, d).select("msg_id", "conversation_id", "received_at", "plan_norm", "has_attachments"))
    conv = m.groupBy("conversation_id").agg(F.count("*").alias("n_messages"), F.min("received_at").alias("a"), F.max("received_at").alias("b"))
    r = m.where(it.branch(F.col("plan_norm"), F.col("has_attachments")) == "thread").select(F.col("msg_id").alias("reply_id"), "conversation_id")
    return r.join(conv, "conversation_id").select("reply_id", "n_messages", F.to_date("a").cast("string").alias("first_day"), F.to_date("b").cast("string").alias("last_day"))


@query("thread_priors", """
SELECT r.msg_id, count(m.msg_id) AS n_priors, coalesce(arg_max(m.msg_id, (m.received_at, -m.msg_id)), -1) AS newest_prior, coalesce(max(m.received_at)::DATE::VARCHAR, '') AS newest_prior_day
FROM replies r LEFT JOIN fx_inbox m ON m.conversation_id = r.conversation_id AND m.has_attachments AND m.received_at < r.received_at GROUP BY r.msg_id""")
def thread_priors(spark, d):
    m = checkpointed(linked(spark, d).select("msg_id", "conversation_id", "received_at", "plan_norm", "has_attachments"))
    r = m.where(it.branch(F.col("plan_norm"), F.col("has_attachments")) == "thread")
    return th.priors(m, r).select("msg_id", "n_priors", F.coalesce("newest_prior", F.lit(-1)).alias("newest_prior"), F.coalesce(F.to_date("newest_prior_at").cast("string"), F.lit("")).alias("newest_prior_day"))


def recovery_inputs(spark, d):
    """What routing a message under a reply's plan gives is an input here; it follows from the ids."""
    m = checkpointed(linked(spark, d).select("msg_id", "conversation_id", "received_at", "plan_norm", "has_attachments"))
    r = m.where(it.branch(F.col("plan_norm"), F.col("has_attachments")) == "thread").withColumnRenamed("plan_norm", "plan")
    p = m.where("has_attachments")
    kind = F.when(F.col("msg_id") % 5 == 0, "flag").when(F.col("msg_id") % 7 == 0, "none").otherwise("commit")
    plans = r.select("conversation_id", "plan").distinct()
    return r, p, p.join(plans, "conversation_id").select("msg_id", "plan", kind.alias("status"))


# All replies of a fixture conversation name its one plan, so a single pass over each conversation settles it.
view("rec_rows", """
SELECT conversation_id, msg_id, received_at, 1 AS late, 'reply' AS kind FROM replies
UNION ALL SELECT conversation_id, msg_id, received_at, 0, CASE WHEN msg_id % 5 = 0 THEN 'flag' WHEN msg_id % 7 = 0 THEN 'none' ELSE 'commit' END FROM fx_inbox WHERE has_attachments""")
view("rec_seg", "SELECT *, coalesce(count(*) FILTER (kind = 'flag') OVER (PARTITION BY conversation_id ORDER BY received_at DESC, late, msg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM rec_rows")
view("rec_depth", "SELECT *, sum(CASE kind WHEN 'reply' THEN 1 WHEN 'commit' THEN -1 ELSE 0 END) OVER w AS depth, count(*) FILTER (kind = 'reply') OVER w AS rr FROM rec_seg WINDOW w AS (PARTITION BY conversation_id, seg ORDER BY received_at DESC, late, msg_id ROWS UNBOUNDED PRECEDING)")
view("rec_low", "SELECT *, kind = 'commit' AND depth >= least(0, coalesce(min(depth) OVER (PARTITION BY conversation_id, seg ORDER BY received_at DESC, late, msg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS serves FROM rec_depth")
view("rec_served", "SELECT conversation_id, seg, msg_id, row_number() OVER (PARTITION BY conversation_id, seg ORDER BY received_at DESC, late, msg_id) AS sr FROM rec_low WHERE serves")


@query("thread_recovery", """
SELECT r.conversation_id, r.msg_id, CASE WHEN s.msg_id IS NOT NULL THEN 'recovered' WHEN f.msg_id IS NOT NULL THEN 'flagged' WHEN o.first_at < r.received_at THEN 'no routable prior' ELSE 'no eligible prior' END AS outcome, coalesce(s.msg_id, f.msg_id, -1) AS prior_id
FROM rec_low r LEFT JOIN rec_served s ON s.conversation_id = r.conversation_id AND s.seg = r.seg AND s.sr = r.rr LEFT JOIN (SELECT * FROM rec_low WHERE kind = 'flag') f ON f.conversation_id = r.conversation_id AND f.seg = r.seg
LEFT JOIN (SELECT conversation_id, min(received_at) AS first_at FROM rec_rows WHERE kind <> 'reply' GROUP BY 1) o ON o.conversation_id = r.conversation_id WHERE r.kind = 'reply'""")
def thread_recovery(spark, d):
    return th.recover(*recovery_inputs(spark, d)).withColumn("prior_id", F.coalesce("prior_id", F.lit(-1)))
