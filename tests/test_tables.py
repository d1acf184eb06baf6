"""Sources, sinks, running aggregates and the order-dependent operators against small brute-force versions."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from docroute.operators import archive as ar
from docroute.operators import layout as ly
from docroute.operators import threads as th
from docroute.operators.ordered import Run, running
from docroute.sources import baselines as bl
from docroute.sources import files as fs
from docroute.sources import run_lines as rl
from docroute.sources.ledger_store import MONTHLY_COLUMNS, parse_fingerprints, parse_monthly, sift_monthly


def test_running_over_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", i, rng.randrange(-3, 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    some = F.when(F.col("v") > 2, F.col("i"))
    got = running(df, ["k"], [F.asc("i")], [Run("s", "sum", F.col("v")), Run("lo", "min", F.col("v"), False), Run("last", "last", some, False)]).collect()
    state = {}
    want = {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        s, lo, last = state.get(k, (0, None, None))
        want[i] = (s + v, lo, last)
        state[k] = (s + v, v if lo is None else min(lo, v), i if v > 2 else last)
    assert {r.i: (r.s, r.lo, r["last"]) for r in got} == want


def walk(replies, priors, status):
    """Replies newest first, each over its strictly earlier unused messages, newest first."""
    used, out = set(), {}
    for conv, rid, at, plan in sorted(replies, key=lambda r: (-r[2], r[1])):
        out[rid] = ("no eligible prior", None)
        for _, pid, pat in sorted([p for p in priors if p[0] == conv and p[2] < at], key=lambda p: (-p[2], p[1])):
            out[rid] = ("no routable prior", None) if out[rid][0] == "no eligible prior" else out[rid]
            if pid in used:
                continue
            s = status.get((pid, plan), "none")
            if s == "flag":
                out[rid] = ("flagged", pid)
                break
            if s == "commit":
                used.add(pid)
                out[rid] = ("recovered", pid)
                break
    return out


@pytest.mark.parametrize("plans,small", [(1, th.SMALL), (2, 0), (7, th.SMALL)])
def test_recovery_equals_the_walk(spark, plans, small):
    """One plan: running sums; small = 0: same-plan runs; otherwise one pass over each conversation."""
    rng = random.Random(plans)
    replies = [(rng.randrange(3), 1000 + i, rng.randrange(40), f"P{rng.randrange(plans)}") for i in range(10 if small == 0 else 90)]
    priors = [(rng.randrange(4), i, rng.randrange(40)) for i in range(60)]
    status = {(p[1], f"P{k}"): rng.choice(["commit", "commit", "commit", "none", "flag"]) for p in priors for k in range(plans)}
    r = spark.createDataFrame(replies, "conversation_id long, msg_id long, received_at long, plan string")
    p = spark.createDataFrame(priors, "conversation_id long, msg_id long, received_at long")
    s = spark.createDataFrame([(a, b, c) for (a, b), c in status.items()], "msg_id long, plan string, status string")
    got = th.recover(r, p, s, small).collect()
    assert {x.msg_id: (x.outcome, x.prior_id) for x in got} == walk(replies, priors, status) and len(got) == len(replies)


def test_long_conversation_of_alternating_plans(spark):
    replies = [(1, 10_000 + i, 2 * i + 1, f"P{i % 3}") for i in range(1000)]
    priors = [(1, i, 2 * i) for i in range(1000)]
    status = {(i, f"P{k}"): "flag" if (i + k) % 11 == 0 else "commit" if (i + k) % 2 else "none" for i in range(1000) for k in range(3)}
    got = th.recover(
        spark.createDataFrame(replies, "conversation_id long, msg_id long, received_at long, plan string"), spark.createDataFrame(priors, "conversation_id long, msg_id long, received_at long"),
        spark.createDataFrame([(a, b, c) for (a, b), c in status.items()], "msg_id long, plan string, status string")).collect()
    assert {x.msg_id: (x.outcome, x.prior_id) for x in got} == walk(replies, priors, status)


def test_unique_names_with_gaps(spark):
    rng = random.Random(5)
    have, inc = [], []
    for f in range(6):
        for slot in sorted(rng.sample(range(6), rng.randrange(0, 5))):
            have.append((f"d{f}", "x.pdf", f"c{rng.randrange(6)}", slot))
        inc += [(len(inc) + i, f"d{f}", "x.pdf", f"c{rng.randrange(8)}") for i in range(10)]
    inc = [(i, *r[1:]) for i, r in enumerate(inc)]
    disk = {(f, s): c for f, _, c, s in have}
    want = {}
    for seq, f, _, c in inc:
        s = 0
        while disk.get((f, s), c) != c:
            s += 1
        disk[(f, s)] = c
        want[seq] = "x.pdf" if s == 0 else f"x ({s}).pdf"
    got = ar.unique_names(spark.createDataFrame(inc, "seq long, folder string, name string, content string"), spark.createDataFrame(have, "folder string, name string, content string, slot int"))
    assert {r.seq: r.written for r in got.collect()} == want


def test_lines_follow_the_anchor(spark):
    rng = random.Random(9)
    words = [(d, i, "w", float(rng.randrange(500)), 0.0, round(rng.random() * 30, 1), 0.0) for d in range(4) for i in range(40)]
    df = spark.createDataFrame([(a, b, c, x0, x0 + 5, top, top + 10) for a, b, c, x0, _, top, _ in words], "doc_id long, word_idx int, text string, x0 double, x1 double, top double, bottom double")
    got = {(r.doc_id, r.word_idx): r.line_no for r in ly.lines(df).collect()}
    for d in range(4):
        anchor, n = None, 0
        for w in sorted([w for w in words if w[0] == d], key=lambda w: (round(w[5], 1), w[3], w[1])):
            if anchor is None or abs(w[5] - anchor) > 2.0:
                anchor, n = w[5], n + 1
            assert got[(d, w[1])] == n


def test_bands_need_a_whole_label(spark):
    rows = [(1, 0, "Invoice", 10.0, 100.0), (1, 1, "No:", 50.0, 100.0), (1, 2, "Invoice", 10.0, 200.0), (1, 3, "Date", 50.0, 200.0), (1, 4, "SUBTOTAL:", 10.0, 300.0), (1, 5, "9", 80.0, 301.0)]
    df = spark.createDataFrame([(d, i, x, a, a + 20, y, y + 12) for d, i, x, a, y in rows], "doc_id long, word_idx int, text string, x0 double, x1 double, top double, bottom double")
    assert sorted((r.band_top, r.band_bottom) for r in ly.protected_bands(df).collect()) == [(96.0, 116.0), (296.0, 317.0)]


def test_ledger_parser_refuses_bad_rows(spark):
    ok = spark.createDataFrame([(" h1 ", "P", "", "V.COM ")], "sha256 string, plan_norm string, amount_cents string, sender_domain string")
    r = parse_fingerprints(ok).first()
    assert (r.sha256, r.amount_cents, r.sender_domain, r.dup_count, r.archive_sha256) == ("h1", None, "v.com", 0, "")
    for bad in (("h1", "P", "x", ""), (" ", "P", "1", "")):
        with pytest.raises(Exception):
            parse_fingerprints(spark.createDataFrame([bad], ok.schema)).select("plan_norm").collect()  # whichever columns are read


def test_baselines_and_run_lines(spark):
    home = tempfile.mkdtemp(prefix="run-")
    day = F.lit("2026-05-01").cast("date")
    one = spark.createDataFrame([("a.pdf", "notified", "M1"), ("", "notified", "M2")], "file_name string, kind string, owner_key string").withColumn("as_of", day)
    bl.write(one, f"{home}/b")
    bl.write(one.where("owner_key = 'M1'").withColumn("file_name", F.lit("b.pdf")), f"{home}/b")
    assert sorted((r.owner_key, r.file_name) for r in bl.read(spark, f"{home}/b", "2026-05-01").collect()) == [("M1", "b.pdf"), ("M2", "")]
    assert [r.file_name for r in bl.read_list(spark.createDataFrame([("d", " x.pdf "), ("d", "")], "Date string, Invoice string")).collect()] == ["x.pdf"]
    spark.createDataFrame([("date,step,processed,errors,duration_sec,status",), ("2026-05-01,step_1,3,0,1.5,ok",), ("2026-05-02,step_1,3,2,1,9.0,error",), ("odd,line",)], "value string").coalesce(1).write.text(f"{home}/l")
    rows, bad = rl.read_legacy(spark, f"{home}/l")
    assert sorted((r.date, r.need_review, r.errors, r.status) for r in rows.collect()) == [("2026-05-01", 0, 0, "ok"), ("2026-05-02", 2, 1, "error")]
    assert [r.value for r in bad.collect()] == ["odd,line"]


def test_folder_scan(spark):
    home = tempfile.mkdtemp(prefix="run-")
    for name, data in (("a.pdf", b"%PDF-1"), ("Processed - b.pdf", b"%PDF-2"), ("c.txt", b"x"), ("d.pdf", b"<html")):
        with open(f"{home}/{name}", "wb") as f:
            f.write(data)
    f = fs.scan_folder(spark, home)
    assert sorted(r.file_name for r in fs.hashed(f).collect()) == ["a.pdf", "d.pdf"]
    assert sorted(r.file_name for r in fs.real_pdf(f).collect()) == ["Processed - b.pdf", "a.pdf"]
    assert {r.path_rel_to_root for r in fs.listing(f, home).collect()} == {"a.pdf", "Processed - b.pdf", "d.pdf"}


def test_lists_of_several_days(spark):
    """Each day and owner against the list the rule names, by a loop over all lists."""
    from docroute.operators import queues as qu

    rng = random.Random(8)
    owners = ["M1", "M2", "P1", "P2"]
    exists = {(o, k, d) for o in owners for k in ("notified", "legacy") for d in range(1, 9) if rng.random() < 0.4}
    lists = [(o, k, d, f) for o, k, d in sorted(exists) for f in [""] + [f"f{n}.PDF" for n in range(6) if rng.random() < 0.5]]
    today = [(o, d, f"F{n}.pdf") for o in owners for d in range(1, 10) for n in range(6) if rng.random() < 0.7]
    date = lambda d: dt.date(2024, 3, d)
    want = set()
    for o, d, f in today:
        base = []
        for kind in ("notified", "legacy"):
            have = [x for p, k, x in exists if p == o and k == kind and (x < d if o[0] == "P" else x == d - 1)]
            if have:
                base = [n.lower() for p, k, x, n in lists if (p, k, x) == (o, kind, max(have))]
                break
        want.add((o, date(d), f, f.lower() not in base))
    t_ = spark.createDataFrame([(o, date(d), f) for o, d, f in today], "owner string, day date, file_name string")
    l_ = spark.createDataFrame([(o, k, date(d), f) for o, k, d, f in lists], "owner string, kind string, as_of date, file_name string")
    got = qu.old_new_days(t_, l_, ["owner"], qu.F.col("owner").startswith("P")).collect()
    assert {(r.owner, r.day, r.file_name, r.is_new) for r in got} == want and len(got) == len(want)


def test_monthly_ledger_rows_are_parsed_refused_or_sifted(spark):
    row = lambda **kw: tuple({"plan_norm": "P", "target_year": "2026", "target_month": " ", "sources_merged": "4"}.get(c, "") if c not in kw else kw[c] for c in MONTHLY_COLUMNS)
    raw = spark.createDataFrame([row(), row(target_month="May"), row(sources_merged=None)], ", ".join(f"{c} string" for c in MONTHLY_COLUMNS))
    good, bad = sift_monthly(raw)
    assert sorted((r.target_year, r.target_month, r.sources_merged) for r in good.collect()) == [(2026, 0, 0), (2026, 0, 4)]
    assert [(r.target_month, r.reason) for r in bad.collect()] == [("May", "malformed target_month: May")]
    with pytest.raises(Exception):
        parse_monthly(raw).select("plan_norm").collect()


def test_lines_are_numbered_without_a_sort(spark, tmp_path):
    rows = spark.range(5000).selectExpr("concat('f', id) AS filename", "id AS size_bytes", "'t' AS mtime_iso", "'p' AS path_rel_to_root").repartitionByRange(7, "size_bytes").sortWithinPartitions("size_bytes")
    fs.write_tsv(rows, str(tmp_path / "x"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = fs.read_tsv(spark, str(tmp_path / "x"), fs.LISTING)
        assert "row_number" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.rdd.getNumPartitions() > 7
        assert sorted((r.nth, r.filename) for r in got.collect()) == [(i, f"f{i}") for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_running_keeps_its_rows_compressed(spark):
    import pathlib

    from docroute.session import shared_dir

    home = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in home.rglob("*") if f.is_file())
    rows = spark.range(50_000).selectExpr("id % 3 AS k", "id", "repeat('word ', 20) AS text")
    before = size()
    got = running(rows, ["k"], [F.asc("id")], [Run("n", "sum", F.lit(1).cast("long"))])
    assert size() - before < 2 << 20
    assert got.where("n <> (id - id % 3) / 3 + 1").count() == 0
