"""Plans stay in the JVM, and queries agree with their SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows

FAST = ["plan_first_manager", "message_plan_link", "filename_plan_link", "payer_resolution", "attachment_filter", "zip_strict", "dup_status", "queue_totals", "archive_parse", "reconcile", "run_lines_upgrade"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"))
    assert rows(df.toPandas()) == rows(duck.execute(entry.oracle_sql()[name]).df())


def test_entry(spark):
    assert entry.entry(spark).columns == ["manager_name", "match_source", "n_messages"]


def test_every_query_has_a_name_in_both_tables():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark, sf):
    scan = entry.queries()["zip_lenient"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in scan and "l_shipdate" not in scan


def test_runs_read_their_days_only(spark, sf):
    df = entry.queries()["plan_list_days"](spark, sf)
    assert {r.run_date for r in df.collect()} == {"2024-03-02", "2024-03-03"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan


def test_stale_list_is_refused_or_fetched_once(spark, tmp_path):
    from docroute.sources import plan_list

    raw = spark.createDataFrame([(1, "BCS 1", "A")], "row_no int, strata_plan string, strata_manager string")
    home, calls = str(tmp_path / "lists"), []
    plan_list.put_day(raw, home, "2024-03-01")
    with pytest.raises(RuntimeError):
        plan_list.current(spark, home, "2024-03-02")
    fetch = lambda: calls.append(1) or raw.withColumn("strata_plan", plan_list.F.lit("BCS 2"))
    for _ in range(2):
        assert [r.strata_plan for r in plan_list.current(spark, home, "2024-03-02", fetch).collect()] == ["BCS 2"]
    assert calls == [1] and [r.strata_plan for r in plan_list.current(spark, home, "2024-03-01").collect()] == ["BCS 1"]
    with pytest.raises(RuntimeError):
        plan_list.current(spark, home, "2024-03-03", lambda: raw.limit(0))
