"""Plan dimension: S1, S2, P1-P6, F1, F12, A1-A3, W1-W5."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import dimension as dim
from docroute.plans.registry import base_of, parsed, pretty, query, view
from docroute.session import shared_dir
from docroute.sources import plan_list
from docroute.sources.tables import table


def listed(spark: SparkSession, d: str) -> DataFrame:
    """The raw plan list, parsed and validated; its conflicts are reported, not refused."""
    return plan_list.written(plan_list.load_plans(table(spark, d, "fx_plan_list"), strict=False))


def plans(spark: SparkSession, d: str) -> DataFrame:
    """The clean plan dimension that the other queries route on."""
    return plan_list.written(plan_list.load_plans(table(spark, d, "fx_plans").withColumnRenamed("plan_id", "row_no")))


COLS = "plan_norm, plan_raw, strata_name, manager_name, manager_key, manager_email, ap_name, ap_key, ap_email"


@query("plan_dimension", f"SELECT row_no, {COLS}, status_active, {pretty('plan_norm')} AS pretty, {base_of('plan_norm')} AS base FROM list_rows")
def plan_dimension(spark, d):
    p = listed(spark, d)
    return p.select("row_no", *COLS.split(", "), "status_active", t.pretty_plan("plan_norm").alias("pretty"), t.plan_base("plan_norm").alias("base"))


def _first(key: str, keep: str) -> str:
    return f"""SELECT row_no, {COLS} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY row_no) AS rn FROM list_rows
WHERE status_active AND {keep}) WHERE rn = 1"""


def _out(df: DataFrame) -> DataFrame:
    return df.select("row_no", *COLS.split(", "))


@query("plan_first_manager", _first("plan_norm", "manager_name <> ''"))
def plan_first_manager(spark, d):
    return _out(dim.first_manager(listed(spark, d)))


@query("plan_first_payer", _first("plan_norm", "ap_name <> ''"))
def plan_first_payer(spark, d):
    return _out(dim.first_payer(listed(spark, d)))


@query("unique_managers", _first("manager_key", "manager_key <> ''"))
def unique_managers(spark, d):
    return _out(dim.unique_managers(listed(spark, d)))


@query("unique_payers", _first("ap_key", "ap_key <> ''"))
def unique_payers(spark, d):
    return _out(dim.unique_payers(listed(spark, d)))


@query("unique_active_plans", _first("plan_norm", "true"))
def unique_active_plans(spark, d):
    return _out(dim.unique_active(listed(spark, d)))


@query("routing_conflicts", """
SELECT plan_norm, count(*) AS n_rows, min((manager_name, ap_name))[1] AS first_manager, min((manager_name, ap_name))[2] AS first_ap,
  max((manager_name, ap_name))[1] AS last_manager, max((manager_name, ap_name))[2] AS last_ap
FROM list_rows WHERE status_active GROUP BY plan_norm HAVING count(DISTINCT (manager_name, ap_name)) > 1""")
def routing_conflicts(spark, d):
    return dim.routing_conflicts(listed(spark, d))


@query("base_index", r"""
SELECT regexp_extract(plan_norm, '^(.*\d)([A-Z])$', 1) AS base, count(*) AS n_rows, string_agg(DISTINCT plan_norm, ',' ORDER BY plan_norm) AS variants,
  arg_min(plan_norm, row_no) AS first_plan, count(DISTINCT CASE WHEN ap_name <> '' THEN (ap_name, ap_email) END) <= 1 AS one_payer
FROM list_rows WHERE status_active AND regexp_matches(plan_norm, '^(.*\d)([A-Z])$') GROUP BY 1""")
def base_index(spark, d):
    b = dim.base_index(listed(spark, d))
    return b.select("base", "n_rows", "variants", "first_plan", F.coalesce(F.col("payer_lo") == F.col("payer_hi"), F.lit(True)).alias("one_payer"))


@query("base_unique_manager", r"""
SELECT regexp_extract(plan_norm, '^([A-Z]{2,6}\d{1,5})[A-Z]{0,3}$', 1) AS base, min(manager_name) AS manager_name FROM list_rows
WHERE status_active AND manager_name <> '' AND regexp_matches(plan_norm, '^[A-Z]{2,6}\d{1,5}[A-Z]{0,3}$') GROUP BY 1 HAVING count(DISTINCT manager_name) = 1""")
def base_unique_manager(spark, d):
    return dim.base_unique_manager(listed(spark, d))


@query("path_component_quality", r"""
SELECT * FROM (SELECT row_no, field, value, CASE WHEN value IN ('.', '..') THEN 'dots' WHEN contains(value, '/') OR contains(value, '\') THEN 'separator'
  WHEN regexp_matches(value, '^[A-Za-z]:') THEN 'drive letter' WHEN regexp_matches(value, '[<>:"/\\|?*\x00-\x1f]') THEN 'invalid characters'
  WHEN regexp_matches(value, '[. ]+$') THEN 'trailing dot or space'
  WHEN regexp_matches(upper(split_part(value, '.', 1)), '^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$') THEN 'reserved name' END AS reason
FROM (SELECT row_no, 'strata_manager' AS field, trim(split_part(strata_manager, ',', 1)) AS value FROM fx_plan_list UNION ALL SELECT row_no, 'ap_name', trim(ap_name) FROM fx_plan_list)
WHERE value <> '') WHERE reason IS NOT NULL""")
def path_component_quality(spark, d):
    return dim.quality(table(spark, d, "fx_plan_list"))


# ---- lists by day: the first day lacks a third of the rows, on the second some have no manager, the third is the list as it is

DAYS = ["2024-03-01", "2024-03-02", "2024-03-03"]
view("fx_list_day1", "SELECT * FROM fx_plan_list WHERE row_no % 3 <> 0")
view("fx_list_day2", "SELECT row_no, strata_plan, strata_name, CASE WHEN row_no % 7 = 0 THEN '' ELSE strata_manager END AS strata_manager, manager_email, ap_name, ap_email, status FROM fx_plan_list")
for _n in (1, 2):
    view(f"list_day{_n}", parsed(f"fx_list_day{_n}", "row_no"))
view("list_days", "SELECT 0 AS day_no, * FROM list_day1 UNION ALL SELECT 1, * FROM list_day2 UNION ALL SELECT 2, * FROM list_rows")


def _lists(spark: SparkSession, d: str, days: int) -> str:
    """A folder with the lists of the first `days` days."""
    home, raw = f"{shared_dir(spark)}/plan-lists-{uuid.uuid4().hex}", table(spark, d, "fx_plan_list")
    no_manager = F.when(F.col("row_no") % 7 == 0, "").otherwise(F.col("strata_manager"))
    for day, rows in list(zip(DAYS, (raw.where("row_no % 3 <> 0"), raw.withColumn("strata_manager", no_manager), raw)))[:days]:
        plan_list.put_day(rows, home, day)
    return home


@query("plan_list_days", """
SELECT n_nationkey AS run_no, CAST(DATE '2024-03-01' + CAST(day_no AS INT) AS VARCHAR) AS run_date, count(*) AS n_rows, count(*) FILTER (status_active) AS n_active, count(DISTINCT plan_norm) AS n_plans,
  count(*) FILTER (manager_name = '') AS n_unmanaged FROM nation JOIN list_days ON day_no = n_nationkey % 3 WHERE n_nationkey % 3 > 0 GROUP BY ALL""")
def plan_list_days(spark, d):
    """Every run reads the list of its own day; days that no run is of are not read."""
    lists = plan_list.daily(spark, _lists(spark, d, 3))
    runs = table(spark, d, "nation").where("n_nationkey % 3 > 0").select(
        F.col("n_nationkey").alias("run_no"), F.date_add(F.lit(DAYS[0]).cast("date"), (F.col("n_nationkey") % 3).cast("int")).alias("run_date"))
    rows = plan_list.load_plans(plan_list.for_runs(lists, runs), strict=False, keep=("run_no", "run_date"))
    return rows.groupBy("run_no", F.col("run_date").cast("string").alias("run_date")).agg(
        F.count("*").alias("n_rows"), F.count_if("status_active").alias("n_active"), F.count_distinct("plan_norm").alias("n_plans"), F.count_if(F.col("manager_name") == "").alias("n_unmanaged"))


@query("plan_list_run", "SELECT plan_norm, plan_raw, manager_name, manager_email, ap_name, status_active FROM list_rows")
def plan_list_run(spark, d):
    """The third day's list is missing; the job fetches it once, from the export's CSV files, and reads it by day."""
    home = _lists(spark, d, 2)

    def fetch() -> DataFrame:
        heads = {c: h for h, c in plan_list.HEADERS.items()}
        raw = table(spark, d, "fx_plan_list").drop("row_no")
        raw.select(*[F.col(c).alias(heads[c]) for c in raw.columns]).write.option("header", True).csv(f"{home}-export")
        return plan_list.read_csv(spark, f"{home}-export")

    rows = plan_list.load_plans(plan_list.current(spark, home, DAYS[2], fetch), strict=False)
    return rows.select("plan_norm", "plan_raw", "manager_name", "manager_email", "ap_name", "status_active")
