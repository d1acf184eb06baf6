"""Named queries, and the SQL text that states the same result for an independent engine."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docroute.sources.tables import DERIVED, PAGE_WORDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = expand(sql)
        return fn

    return add


def view(name: str, sql: str) -> str:
    """A named SQL building block that `expand` turns into a leading CTE wherever it is used."""
    VIEWS[name] = sql
    return name


def _words_sql() -> str:
    rows = ", ".join(f"({i}, '{t}', {x}, {y})" for i, t, x, y in PAGE_WORDS)
    return f"""
SELECT o_orderkey AS doc_id, w.word_idx, CASE WHEN w.text = '$CHECK' THEN CASE WHEN o_orderkey % 12 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR(12)) END ELSE w.text END AS text,
  w.x0 + o_orderkey % 50 AS x0, w.x0 + o_orderkey % 50 + 20.0 AS x1, w.top + 0.0 AS top, w.top + 12.0 AS bottom
FROM orders CROSS JOIN (VALUES {rows}) AS w(word_idx, text, x0, top)"""


for _n, (_d, _s) in DERIVED.items():
    view(_n, _s)
view("fx_words", _words_sql())


def expand(sql: str) -> str:
    """Prefix `sql` with the CTEs it needs, in dependency order."""
    done: list[str] = []

    def visit(text: str) -> None:
        for n in VIEWS:
            if n not in done and re.search(rf"\b{n}\b", text):
                visit(VIEWS[n])
                if n not in done:
                    done.append(n)

    visit(sql)
    if not done:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in done)
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)  # a query with common tables of its own
    return f"WITH {own[1] or ''}{ctes},\n{sql[own.end():]}" if own else f"WITH {ctes}\n{sql}"


# ---- SQL spellings of the scalar rules, written for DuckDB

def norm(x: str) -> str:
    return rf"regexp_replace(upper({x}), '[\s\-_./\\#№＃]+', '', 'g')"


def pretty(x: str) -> str:
    return rf"regexp_replace({x}, '^([A-Z]{{2,6}})(\d{{1,6}}[A-Z]{{0,3}})$', '\1 \2')"


def base_of(x: str) -> str:
    return rf"regexp_replace({x}, '^(.*\d)([A-Z])$', '\1')"


def name_plan(x: str) -> str:
    return norm(rf"regexp_extract(trim({x}), '(?i)^\s*(?:Processed\s*-\s*)?(?:Paid\b(?:\s*-\s*|\s+))?\s*([A-Z]{{2,6}}\s*[- ]?\s*\d{{1,6}}[A-Z]{{0,3}})', 1)")


def key_of(x: str) -> str:
    return f"trim(regexp_replace(upper({x}), '[^A-Z0-9]+', '_', 'g'), '_')"


def parsed(src: str, row_no: str) -> str:
    return f"""
SELECT *, {key_of('manager_name')} AS manager_key, {key_of('ap_name')} AS ap_key FROM (
  SELECT {row_no} AS row_no, {norm('strata_plan')} AS plan_norm, trim(strata_plan) AS plan_raw, trim(strata_name) AS strata_name,
    trim(split_part(strata_manager, ',', 1)) AS manager_name, trim(replace(manager_email, ',', ';')) AS manager_email,
    trim(ap_name) AS ap_name, trim(replace(ap_email, ',', ';')) AS ap_email, coalesce(trim(status), '') IN ('', '1') AS status_active
  FROM {src}) WHERE plan_norm <> ''"""


view("list_rows", parsed("fx_plan_list", "row_no"))
view("plan_rows", parsed("fx_plans", "plan_id"))
view("first_mgr", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plan_norm ORDER BY row_no) AS rn FROM plan_rows WHERE status_active AND manager_name <> '') WHERE rn = 1")
view("first_ap", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plan_norm ORDER BY row_no) AS rn FROM plan_rows WHERE status_active AND ap_name <> '') WHERE rn = 1")
