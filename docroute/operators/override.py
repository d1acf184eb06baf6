"""Marking ledger rows as overridden by hash prefix, with an audit line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.session import checkpointed

MIN_HEX, MAX_HEX = 12, 64  # fixed limits of a hash prefix


def refusal(prefix) -> Column:
    """why a prefix is not accepted; null when it is."""
    p = F.lower(t.strip(prefix))
    return F.when(~p.rlike("^[0-9a-f]+$"), "not hex").when(F.length(p) < MIN_HEX, "too short").when(F.length(p) > MAX_HEX, "too long")


def resolve(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each request with the one row it means, or why there is none.

    The shortest prefix accepted has MIN_HEX digits, so requests and rows meet in an equi-join on those and the
    rest of the prefix is a filter.
    """
    r = requests.withColumn("prefix", F.lower(t.strip(F.col("prefix")))).withColumn("refused", refusal(F.col("prefix")))
    rows = ledger.select(F.substring("sha256", 1, MIN_HEX).alias("head"), "sha256", "plan_norm", "current_stage")
    ask = r.where("refused is null").select("prefix", F.substring("prefix", 1, MIN_HEX).alias("head")).distinct()
    hits = ask.join(rows, "head").where(F.col("sha256").startswith(F.col("prefix"))).groupBy("prefix").agg(
        F.count("*").alias("n"), F.min(F.struct("sha256", "plan_norm", "current_stage")).alias("row"))
    out = r.join(hits, "prefix", "left")
    one = F.col("n") == 1
    return out.select(
        "prefix", "reason", F.coalesce("refused", F.when(F.col("n").isNull(), "no match").when(F.col("n") > 1, "ambiguous").otherwise("overridden")).alias("result"),
        *[F.coalesce(F.when(one, F.col(f"row.{a}")), F.lit("")).alias(b) for a, b in (("sha256", "sha256"), ("plan_norm", "plan_norm"), ("current_stage", "prior_stage"))])


def as_ops(resolved: DataFrame, ts: Column, first_seq: int = 0) -> DataFrame:
    """L4: the accepted requests as ledger operations, one per row however many prefixes mean it."""
    rows = checkpointed(resolved.where("result = 'overridden'").select("sha256").distinct())
    unset = [F.lit(None).cast(ty).alias(c) for c, ty in (("plan_norm", "string"), ("invoice_number", "string"), ("amount_cents", "long"), ("sender_domain", "string"))]
    return rows.select((F.monotonically_increasing_id() + first_seq).alias("seq"), ts.alias("ts"), "sha256", F.lit("override").alias("op"), *unset)


def audit_rows(resolved: DataFrame, ts: Column) -> DataFrame:
    """One audit row per applied override."""
    return resolved.where("result = 'overridden'").select(ts.alias("at"), "sha256", "plan_norm", "prior_stage", "reason")
