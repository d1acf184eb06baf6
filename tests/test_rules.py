"""Golden values of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators import dimension as dim
from docroute.operators import linking as lk
from docroute.operators import monthly as mo


def values(spark, inputs, expr):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


CASES = [
    ("norm", t.norm_plan, {"BCS 2707": "BCS2707", "bcs-2707": "BCS2707", " BCS#2707 ": "BCS2707", "BCS№2707": "BCS2707", "BCS\xa02707": "BCS2707", None: ""}),
    ("base", t.plan_base, {"LMS4193T": "LMS4193", "BCS2707": "BCS2707", "GVCCA": "GVCCA", " eps4280a ": "EPS4280", "LMS4193AB": "LMS4193AB", "": ""}),
    ("pretty", t.pretty_plan, {"BCS2707": "BCS 2707", "LMS4193C": "LMS 4193C", "GVCCA": "GVCCA"}),
    ("key", t.name_key, {"Jane  O'Neil-Smith": "JANE_O_NEIL_SMITH", "": ""}),
    ("domain", t.sender_domain, {"Name <X@Vendor.COM>": "vendor.com", "x@vendor.com": "vendor.com", "nobody": "", "x@host": "", "a@b .com": "", None: ""}),
    ("invoice", t.invoice_number, {"Invoice No. 12345": "12345", "INVOICE\nINV: 55555": "55555", "Inv. No. X-100": "X-100", "INV-2026-1042": "2026-1042", "Invoice for services": "", "Invoice 777": "777"}),
    ("cents", t.amount_cents, {"Total 5.00 Total Due: $1,234.56": 123456, "Total: 100.00 then Total: 250.00": 25000, "Grand Total $9.10": 910, "Balance": None, "Total 0.00": 0}),
    ("file", t.safe_file_name, {"a/b\\c?.pdf": "c_.pdf", "x  y .pdf. ": "x y .pdf", "": "file", "n" * 200 + ".pdf": "n" * 176 + ".pdf"}),
    ("name plan", t.plan_from_name, {"Processed - BCS 2707 - inv.pdf": "BCS2707", "Paid LMS-4193c x.pdf": "LMS4193C", "Paid - EPS 1 a.pdf": "EPS1", "1 scan.pdf": ""}),
    ("subject", lambda c: F.array_join(lk.subject_tokens(c), ","), {"Invoice for BCS 2707A": "BCS2707A", "LMS 4193C — please review": "LMS4193C", "x BCS-2707 BCS 2707": "BCS2707", "no plan here": "", "bcs_2707": "BCS2707"}),
    ("label", lambda c: F.array_join(lk.explicit_tokens(c), ","), {"Strata Plan KAS 9999": "KAS9999", "Reference KAS9999": "", "STRATA PLAN EPS6763 C/O X": "EPS6763", "Strata Plan No. EPS6008": "EPS6008", "Strata EPS No. 6008 A": "EPS6008A"}),
    ("paid", lambda c: F.concat_ws("-", t.paid_date(c)["month"], t.paid_date(c)["year"]), {"MAY 08 2026": "5-2026", "May 8, 2026": "5-2026", "2026-05-08": "5-2026", "13/05/2026": "5-2026", "05/13/2026": "5-2026", "5-8-2026": "5-2026", "05/08/26": "", "": "", "13/13/2026": ""}),
    ("archive", lambda c: F.concat_ws("|", *[t.parse_archive_name(c)[k] for k in ("check", "month", "year", "plan")]), {
        "12 - 05 - BCS2707 May 2026 inv.pdf": "12|5|2026|BCS2707", "AB-9 - 05 - BCS2707A May 2026 inv (1).pdf": "AB-9|5|2026|BCS2707A", "12 - 05 - BCS2707 June 2026 inv.pdf": "", "Summary - 05 - BCS2707 May 2026 inv.pdf": ""}),
    ("component", t.unsafe_component, {"Jane": None, "a/b": "separator", "C:x": "drive letter", "con": "reserved name", "x.": "trailing dot or space", "..": "dots", "a?b": "invalid characters"}),
]


@pytest.mark.parametrize("name,expr,cases", CASES, ids=[c[0] for c in CASES])
def test_rule(spark, name, expr, cases):
    assert values(spark, list(cases), expr) == list(cases.values())


def test_check_order(spark):
    df = spark.createDataFrame([(c,) for c in ["VOID", "100", "9", "AB-100", "20", "AB-9", "1000", "00015", ""]], "c string")
    assert [r.c for r in df.orderBy(t.check_key(F.col("c"))).collect()] == ["9", "00015", "20", "100", "1000", "AB-9", "AB-100", "", "VOID"]


def test_target_month(spark):
    one = spark.range(1)
    day = F.lit("2026-03-15").cast("date")
    assert one.select(mo.target_month(day).cast("string")).first()[0] == "2026-02-01"
    assert one.select(mo.target_month(day, F.lit("2025-12")).cast("string")).first()[0] == "2025-12-01"
    for bad in ("2026-03", "2023-01", "March"):
        with pytest.raises(Exception):
            one.select(mo.target_month(day, F.lit(bad)).cast("string")).collect()


def test_text_match_edges(spark):
    raw = [(1, "BCS 2707A", "Seaview Towers", "M1"), (2, "BCS 2707B", "Seaview Towers", "M1"), (3, "GVCCA", "Golf Club", "M2"), (4, "EPS 500", "Orchard Grove", "M3"), (5, "LMS 77A", "Granville Kimberly", "M1"), (6, "LMS 77B", "Other House", "M2")]
    from docroute.operators import dimension as dim

    plans = dim.parse(spark.createDataFrame([(*r, "", "AP", "", None) for r in raw], "row_no long, strata_plan string, strata_name string, strata_manager string, manager_email string, ap_name string, ap_email string, status string"))
    texts = {
        "base": "Strata Plan BCS 2707 C/O Harbour", "dropped": "EPS 500A", "plain": "for GVCCA and GVCCA", "tie": "BCS 2707A and EPS 500", "name": "plan LMS 77 GRANVILLE KIMBERLY", "none": "nothing", "blank": "  ",
    }
    docs = spark.createDataFrame(list(texts.items()), "sha256 string, content_text string")
    got = {r.sha256: (r.text_plan, r.is_base_fallback, r.row_plan, r.text_note[:9]) for r in lk.match_texts(lk.scan_texts(docs, plans), plans, docs).collect()}
    assert got["base"] == ("BCS2707", True, "BCS2707A", "")
    assert got["dropped"] == ("EPS500", False, "EPS500", "")
    assert got["plain"] == ("GVCCA", False, "GVCCA", "")
    assert got["tie"][0] == "" and got["tie"][3] == "Ambiguous"
    assert got["name"] == ("LMS77A", False, "LMS77A", "")
    assert got["none"][3] == "Detected " and got["blank"][3] == "No text e"


def test_numbers_inside_numbers_and_many_codes(spark):
    """A number inside one that was added before it adds no plan; scores of a text with very many codes are sums."""
    from docroute.operators import dimension as dim

    raw = [(1, "BCS 2707", "Seaview Towers", "M1"), (2, "EPS 27", "Orchard Grove", "M2"), (3, "EPS 70", "Kimberly House", "M2"), (4, "LMS 5", "Granville Place", "M3"), (5, "NW 500", "Harbour Court", "M3")]
    plans = dim.parse(spark.createDataFrame([(*r, "", "AP", "", None) for r in raw], "row_no long, strata_plan string, strata_name string, strata_manager string, manager_email string, ap_name string, ap_email string, status string"))
    names = "xSEAVIEWx TOWERS-2, orchardgrove, KIMBERLY HOUSE "
    many = "; ".join(f"LMS {n}" for n in range(1000, 3000)) + "; LMS 5; LMS 5; NW 500; NW 500; NW 500"
    texts = {
        "long first": f"EPS 2707; NW 27; {names}", "short first": f"NW 27; EPS 2707; {names}", "chain": f"NW 2707; NW 27; NW 70; {names}", "apart": f"BCS 27; {names}", "many": many,
        "words across": "EPS 2707; SEAV IEW TOW ERS",
    }
    docs = spark.createDataFrame(list(texts.items()), "sha256 string, content_text string")
    got = {r.sha256: r for r in lk.match_texts(lk.scan_texts(docs, plans), plans, docs).collect()}
    assert got["long first"].text_plan == "BCS2707" and got["chain"].text_plan == "BCS2707"
    assert got["short first"].text_note.startswith("Ambiguous: EPS27 vs BCS2707")
    assert got["apart"].text_plan == "EPS27" and got["words across"].text_plan == ""
    assert got["many"].text_plan == "NW500" and [(d.token, d.cnt) for d in got["many"].detected[:2]] == [("NW500", 3), ("LMS5", 2)] and len(got["many"].detected) == 10


def test_no_text_is_joined(spark, sf):
    import __spark_entry__ as entry

    plan = entry.queries()["text_plan_score"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "content_text" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_equal_findings_are_scored_once_and_name_words_stay_apart(spark):
    """Texts with the same codes share one scoring; the words around an open number decide per text; unread fields are not taken."""
    from docroute.operators import dimension as dim

    raw = [(1, "LMS 77A", "Granville Kimberly", "M1"), (2, "LMS 77B", "Orchard Seaview", "M2"), (3, "EPS 500", "Grove House", "M3")]
    plans = dim.parse(spark.createDataFrame([(*r, "", "AP", "", None) for r in raw], "row_no long, strata_plan string, strata_name string, strata_manager string, manager_email string, ap_name string, ap_email string, status string"))
    texts = {"a": "LMS 77 granville kimberly", "b": "LMS 77 orchard seaview", "c": "LMS 77", "d": "EPS 500", "e": "see EPS 500", "f": "Strata EPS 500"}
    docs = spark.createDataFrame(list(texts.items()), "sha256 string, content_text string")
    scanned = lk.scan_texts(docs, plans, only=lk.LINKED)
    assert set(scanned.columns) == {"sha256", *lk.LINKED}
    got = {r.sha256: (r.text_plan, list(r.explicit)) for r in lk.match_texts(scanned, plans, docs).collect()}
    assert got == {"a": ("LMS77A", []), "b": ("LMS77B", []), "c": ("", []), "d": ("EPS500", []), "e": ("EPS500", []), "f": ("EPS500", ["EPS500"])}


def test_rows_of_texts_are_matched_as_the_texts_are(spark):
    plans = dim.parse(spark.createDataFrame([(1, "BCS 12A", "Harbour Court", "Ann", "a@x", "", "", "1"), (2, "BCS 77", "Seaview Orchard", "Bob", "b@x", "", "", "1"), (3, "LMS 77", "Granville House", "Cid", "c@x", "", "", "1"), (4, "BCS 770", "Kimberly Place", "Dan", "d@x", "", "", "1")],
        "row_no long, strata_plan string, strata_name string, strata_manager string, manager_email string, ap_name string, ap_email string, status string"))
    texts = ["Strata Plan BCS 12A", "Strata Plan BCS 12", "EPS 77 Seaview Orchard", "BCS 77 and LMS 77", "", "none", "BCS 770 LMS 99 Strata Plan VR 5"]
    rows = spark.createDataFrame([(i, k, x) for i, x in enumerate([*texts, None]) for k in range(2)], "msg_id long, att_idx int, content_text string").withColumn("sha256", F.sha2("content_text", 256))
    facts = ["text_plan", "text_note", "detected", "is_base_fallback", "row_plan", "row_manager", "row_email", "explicit"]
    want = {r.sha256: tuple(r[c] for c in facts) for r in lk.match_texts(lk.scan_texts(rows.where("sha256 is not null"), plans), plans, rows).collect()}
    scanned = lk.scan_rows(rows, plans)
    assert "Exchange" not in scanned._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    got = lk.match_rows(scanned, plans).collect()
    assert sorted((r.msg_id, r.att_idx) for r in got) == sorted((r.msg_id, r.att_idx) for r in rows.collect())
    assert all(tuple(r[c] for c in facts) == (want[r.sha256] if r.sha256 else (None,) * len(facts)) for r in got)
    assert len({r.text_plan for r in got}) > 2
