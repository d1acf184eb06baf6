"""The plan dimension: parsing, quality checks, first-row rules and base-code indexes.

Every first-row-wins rule is a `min_by` aggregate, so a code repeated on many rows is combined
before the shuffle. The dimension grows with the registry: joins on it carry no broadcast hint,
and AQE broadcasts it only when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import text as t

ROUTE_COLS = [
    "row_no", "plan_norm", "plan_raw", "strata_name", "address", "manager_name", "manager_key", "manager_email", "ap_name", "ap_key",
    "ap_email", "status_active",
]


def _cell(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def parse(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S1 without validation: one parsed row per list row with a plan code, with the columns `keep` in front."""
    status = t.strip(F.col("status"))
    return (
        raw.select(
            *keep,
            "row_no",
            t.norm_plan(t.strip(F.col("strata_plan"))).alias("plan_norm"),
            t.strip(F.col("strata_plan")).alias("plan_raw"),
            t.strip(_cell(raw, "strata_name")).alias("strata_name"),
            t.strip(_cell(raw, "address")).alias("address"),
            t.first_listed(_cell(raw, "strata_manager")).alias("manager_name"),
            t.emails(_cell(raw, "manager_email")).alias("manager_email"),
            t.strip(_cell(raw, "ap_name")).alias("ap_name"),
            t.emails(_cell(raw, "ap_email")).alias("ap_email"),
            status.isin("", "1").alias("status_active"),
        )
        .where(F.col("plan_norm") != "")
        .withColumns({"manager_key": t.name_key(F.col("manager_name")), "ap_key": t.name_key(F.col("ap_name"))})
        .select(*keep, *ROUTE_COLS)
    )


def validated(plans: DataFrame) -> DataFrame:
    """Fail the load on a manager or payer name that is not a safe folder name."""
    names = ("manager_name", "ap_name")
    why = plans.withColumns({f"_why_{c}": F.when(F.col(c) != "", t.unsafe_component(F.col(c))) for c in names})
    bad = F.coalesce(*[F.concat(F.lit(f"{c} is not a safe path component: "), F.col(f"_why_{c}"), F.lit(" in plan "), F.col("plan_raw")) for c in names])
    return why.withColumn("plan_norm", F.when(bad.isNotNull(), F.raise_error(bad).cast("string")).otherwise(F.col("plan_norm"))).select(*plans.columns)


def quality(raw: DataFrame) -> DataFrame:
    """F12 as a report: every list row with an unsafe manager or payer name."""
    p = raw.select("row_no", t.first_listed(F.col("strata_manager")).alias("manager"), t.strip(F.col("ap_name")).alias("ap"))
    cells = p.select("row_no", F.inline(F.array(
        F.struct(F.lit("strata_manager").alias("field"), F.col("manager").alias("value")),
        F.struct(F.lit("ap_name").alias("field"), F.col("ap").alias("value")),
    )))
    return cells.where("value <> ''").withColumn("reason", t.unsafe_component(F.col("value"))).where("reason is not null")


def routing_conflicts(plans: DataFrame) -> DataFrame:
    """A1: active rows of one plan with more than one (manager, payer)."""
    pair = F.struct("manager_name", "ap_name")
    g = plans.where("status_active").groupBy("plan_norm").agg(F.min(pair).alias("lo"), F.max(pair).alias("hi"), F.count("*").alias("n_rows"))
    return g.where("lo <> hi").select(
        "plan_norm", "n_rows", F.col("lo.manager_name").alias("first_manager"), F.col("lo.ap_name").alias("first_ap"),
        F.col("hi.manager_name").alias("last_manager"), F.col("hi.ap_name").alias("last_ap"),
    )


def require_consistent(plans: DataFrame) -> DataFrame:
    """Fail the job when any plan has conflicting routing (A1); the check is one scalar subquery."""
    n = routing_conflicts(plans).agg(F.count("*")).scalar()
    guard = F.when(n > 0, F.raise_error(F.concat(F.lit("conflicting routing for plans: "), n.cast("string"))).cast("string"))
    return plans.withColumn("plan_norm", F.coalesce(guard, F.col("plan_norm")))


def first_row(plans: DataFrame, key: str, keep: Column) -> DataFrame:
    """The earliest active row per key among rows that qualify."""
    rest = [c for c in ROUTE_COLS if c != key]
    best = plans.where(F.col("status_active") & keep & (F.col(key) != "")).groupBy(key).agg(F.min_by(F.struct(*rest), "row_no").alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def first_manager(plans: DataFrame) -> DataFrame:
    return first_row(plans, "plan_norm", F.col("manager_name") != "")


def first_payer(plans: DataFrame) -> DataFrame:
    return first_row(plans, "plan_norm", F.col("ap_name") != "")


def unique_managers(plans: DataFrame) -> DataFrame:
    return first_row(plans, "manager_key", F.lit(True))


def unique_payers(plans: DataFrame) -> DataFrame:
    return first_row(plans, "ap_key", F.lit(True))


def unique_active(plans: DataFrame) -> DataFrame:
    return first_row(plans, "plan_norm", F.lit(True))


def base_index(plans: DataFrame) -> DataFrame:
    """A2: base code -> its one-letter variants (at most 26 of them), with the route agreement J6 needs."""
    m = r"(?i)^(.*\d)([A-Z])$"
    rows = plans.where("status_active").withColumn("base", F.upper(F.regexp_extract("plan_norm", m, 1))).where("base <> ''")
    payer = F.when(F.col("ap_name") != "", F.struct("ap_name", "ap_email"))
    return rows.groupBy("base").agg(
        F.count("*").alias("n_rows"),
        F.array_join(F.array_sort(F.collect_set("plan_norm")), ",").alias("variants"),
        F.min_by("plan_norm", "row_no").alias("first_plan"),
        F.min(payer).alias("payer_lo"),
        F.max(payer).alias("payer_hi"),
        F.min_by(F.struct("plan_norm", "ap_name", "ap_key", "ap_email"), F.when(F.col("ap_name") != "", F.col("row_no"))).alias("payer_row"),
    )


CODE_PARTS = r"^([A-Z]{2,6})(\d{1,5})([A-Z]{0,3})$"


def coded(plans: DataFrame) -> DataFrame:
    """Active rows with prefix, number and base of the code (digit codes only)."""
    return (
        plans.where(F.col("status_active") & F.col("plan_norm").rlike(CODE_PARTS))
        .withColumns({"prefix": F.regexp_extract("plan_norm", CODE_PARTS, 1), "num": F.regexp_extract("plan_norm", CODE_PARTS, 2)})
        .withColumn("base", F.concat("prefix", "num"))
    )


def base_unique_manager(plans: DataFrame) -> DataFrame:
    """A3: base code -> its manager when all variants with a manager agree."""
    g = coded(plans).where("manager_name <> ''").groupBy("base").agg(F.min("manager_name").alias("manager_name"), F.max("manager_name").alias("hi"))
    return g.where("manager_name = hi").select("base", "manager_name")
