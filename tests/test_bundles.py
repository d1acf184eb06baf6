"""Delivered messages: every branch of the decision, what opening finds, and the stream against the batch."""

import pytest
from pyspark.sql import functions as F

from docroute.operators import bundles as bu
from docroute.operators import dimension as dim
from docroute.operators import intake as it
from docroute.streaming import intake_stream as st

PARTS = (
    "msg_id long, att_idx long, entry_no long, arrived_at timestamp, name string, content_type string, head string, content_text string, "
    "n_entries long, file_size long, compress_size long, encrypted boolean, is_dir boolean")
MAIL = "msg_id long, received_at timestamp, subject string, body_preview string, has_attachments boolean, n_attachments long"
PDF, DAY = "application/pdf", "2024-03-%02d 00:00:00"

# per message: gates (not delivered, no PDF bytes, unsafe), (outcome, plan) of each PDF, then the code and the action
BRANCHES = [
    ((1, 1, 1), [("agree", "BCS1")], "download failed", "flag_and_hold"),
    ((0, 1, 1), [("agree", "BCS1")], "invalid PDF bytes", "flag_and_hold"),
    ((0, 0, 1), [("agree", "BCS1")], "unsafe ZIP", "flag_and_hold"),
    ((0, 0, 0), [], "no PDFs to classify", "route_as_subject"),
    ((0, 0, 0), [("agree", "BCS1"), ("empty", ""), ("no_plan", "")], "cross-check OK", "route_as_subject"),
    ((0, 0, 0), [("pdf_override", "BCS2A"), ("pdf_override", "BCS2B")], "suffix-variant clash", "flag_and_hold"),
    ((0, 0, 0), [("pdf_override", "BCS2"), ("empty", "")], "PDF overrides subject", "route_as_subject"),
    ((0, 0, 0), [("pdf_override", "BCS2"), ("agree", "BCS1")], "auto-split", "auto_split"),
    ((0, 0, 0), [("ambiguous", ""), ("clash", "BCS2"), ("empty", "")], "ambiguous PDF text", "flag_and_hold"),
    ((0, 0, 0), [("clash", "BCS2"), ("no_plan", "")], "mixed evidence", "flag_and_hold"),
    ((0, 0, 0), [("clash", "BCS2"), ("clash", "BCS2")], "consensus clash", "flag_and_hold"),
    ((0, 0, 0), [("clash", "BCS2A"), ("clash", "BCS2B")], "suffix-variant clash", "flag_and_hold"),
    ((0, 0, 0), [("clash", "BCS2"), ("agree", "BCS1")], "auto-split, subject ignored", "auto_split"),
]


def test_every_branch_of_the_decision(spark):
    n = range(len(BRANCHES))
    msgs = spark.createDataFrame([(i, "BCS1") for i in n], "msg_id long, subject_plan string")
    pdfs = spark.createDataFrame([(i, o, p) for i in n for o, p in BRANCHES[i][1]], "msg_id long, outcome string, pdf_plan string")
    gates = [g for i in n for g, k in zip(bu.GATES, BRANCHES[i][0]) for _ in range(k)]
    ids = [i for i in n for k in BRANCHES[i][0] for _ in range(k)]
    found = spark.createDataFrame(list(zip(ids, gates)), "msg_id long, gate string")
    got = {r.msg_id: (r.reason_code, r.action) for r in it.email_action(msgs, pdfs, bu.gate_counts(found)).collect()}
    assert got == {i: BRANCHES[i][2:] for i in n}
    assert {b[2] for b in BRANCHES} == {r[2] for r in BRANCHES} and len({b[2] for b in BRANCHES}) == 12


def part(msg, att, name, head="%PDF-", text="", entry=0, day=1, entries=0, ct=PDF, size=10, packed=10, encrypted=False, folder=False):
    return (msg, att, entry, DAY % day, name, ct, head, text, entries, size, packed, encrypted, folder)


def frame(spark, rows, schema):
    times = [f.split()[0] for f in schema.split(", ") if f.endswith("timestamp")]
    return spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumns({c: F.to_timestamp(c) for c in times})


ROWS = [
    part(1, 1, "BCS 2 a.pdf", text="Strata Plan BCS 2"), part(1, 1, "BCS 2 a.pdf", text="Strata Plan BCS 2"),  # the same row twice
    part(1, 2, "lost.pdf", head=None), part(1, 3, "page.pdf", head="<html>"), part(1, 4, None, text=None),
    part(1, 5, "BCS 9.zip", head="PK", ct="application/zip", entries=4),
    part(1, 5, "in/BCS 3 x.PDF", entry=1, day=2, text="nothing"), part(1, 5, "in\\b.pdf", entry=2, day=2, head=None), part(1, 5, "__MACOSX/._b.pdf", entry=3, day=2), part(1, 5, "note.txt", entry=4, day=2),
    part(2, 1, "a.zip", head="PK", ct="application/zip", entries=1), part(2, 1, "x.docx", entry=1, day=3),
    part(2, 2, "b.zip", head="PK", ct="application/zip", entries=1), part(2, 2, "x.pdf", entry=1, day=9, size=5000, packed=1),
    part(3, 1, "none.zip", head="PK", ct="application/zip"), part(3, 2, "gone.zip", head=None, ct="application/zip"), part(3, 2, "c.pdf", entry=1, day=2),
    part(4, 1, "logo.png", head=None, ct="image/png"), part(9, 1, "stray.pdf"),
]
MESSAGES = [(1, DAY % 1, "BCS 2 invoice", "", True, 6), (2, DAY % 1, "BCS 2", "", True, 2), (3, DAY % 1, "BCS 3", None, True, 2), (4, DAY % 1, None, "", True, 1), (5, DAY % 2, "BCS 2", "", False, 0), (6, DAY % 2, "BCS 3", "", True, 1)]


def test_opening(spark):
    pdfs, found = bu.opened(frame(spark, ROWS, PARTS), frame(spark, MESSAGES, MAIL))
    got = sorted((r.msg_id, r.att_idx, r.entry_no, r.base_name, r.match_name, r.content_text) for r in pdfs.collect())
    a = (1, 1, 0, "BCS 2 a.pdf", "BCS 2 a.pdf", "Strata Plan BCS 2")
    assert got == [a, a, (1, 4, 0, "file.pdf", "file.pdf", ""), (1, 5, 1, "BCS 9__BCS 3 x.PDF", "BCS 3 x.PDF", "nothing")]
    assert sorted((r.msg_id, r.att_idx, r.entry_no, r.gate, r.base_name, r.detail) for r in found.collect()) == [
        (1, 2, 0, "download failed", "lost.pdf", ""), (1, 3, 0, "invalid PDF bytes", "page.pdf", ""), (1, 5, 2, "invalid PDF bytes", "BCS 9__b.pdf", ""),
        (2, 1, 0, "unsafe ZIP", "a.zip", "non-PDF entries: x.docx"), (2, 2, 0, "unsafe ZIP", "b.zip", "entry 'x.pdf' ratio 5000/1 > 100"),
        (3, 2, 0, "download failed", "gone.zip", "")]
    none = bu.opened(frame(spark, ROWS, PARTS).limit(0), frame(spark, MESSAGES, MAIL))
    assert none[0].count() == 0 and none[1].count() == 0


@pytest.fixture(scope="module")
def plan_rows(spark):
    raw = [(1, "BCS 2", "Seaview", "M1", "m1@x.com", "AP", "", None), (2, "BCS 3", "Orchard", "M2", "m2@x.com", "AP", "", None)]
    return dim.parse(spark.createDataFrame(raw, "row_no long, strata_plan string, strata_name string, strata_manager string, manager_email string, ap_name string, ap_email string, status string"))


def test_stream_decides_complete_messages_once(spark, tmp_path, plan_rows):
    mail = frame(spark, MESSAGES, MAIL)
    # the archive that came without its entry announces it; message 6 and one part of message 2 are not there yet
    parts = frame(spark, [r if (r[0], r[1], r[2]) != (3, 2, 1) else part(3, 9, "late.pdf") for r in ROWS if r[:3] != (3, 2, 1)], PARTS)
    home = str(tmp_path / "intake")
    early = parts.where(F.col("arrived_at") < DAY % 5)
    st.run_in_ranges(mail, early, plan_rows, home, ranges=2)
    first = {r.msg_id: r.reason_code for r in st.decided(spark, home).collect()}
    assert first == {1: "download failed", 3: "download failed"}
    assert sorted(r.msg_id for r in st.open_messages(spark, home, mail).collect()) == [2, 6]

    parts.where(F.col("arrived_at") >= DAY % 5).write.mode("append").parquet(f"{home}/parts")
    st.run(spark, home, mail.schema, parts.schema, plan_rows)
    want = {r.msg_id: (r.reason_code, r.reason) for r in bu.decide(mail.where("msg_id not in (5, 6)"), parts, plan_rows).actions.collect()}
    got = [(r.msg_id, (r.reason_code, r.reason)) for r in st.decided(spark, home).collect()]
    assert dict(got) == want and len(got) == len(want) == 3
    assert [r.msg_id for r in st.open_messages(spark, home, mail).collect()] == [6]


def test_a_batch_is_joined_once_and_decided_with_adaptive_execution(spark, tmp_path, plan_rows, monkeypatch):
    mail, parts = frame(spark, MESSAGES, MAIL), frame(spark, ROWS, PARTS)
    calls, decide_batch = [], st.decide_batch
    adaptive = lambda df: df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    monkeypatch.setattr(st, "decide_batch", lambda home, batch, *rest: calls.append("batch") or decide_batch(home, batch, *rest))
    monkeypatch.setattr(st.bundles, "decide", lambda m, p, plans: calls.append((adaptive(m), adaptive(p))) or ())
    st.run_in_ranges(mail, parts, plan_rows, str(tmp_path), ranges=1)
    assert calls == ["batch", ("true", "true")]


def test_logs_in_files_and_in_folders(spark, tmp_path):
    from docroute.sources import files as fs

    day = tmp_path / "logs" / "step_2_2024-03-02.log"
    day.mkdir(parents=True)
    (day / "part-0").write_text("09:00 | INFO | a | b\nplain\n")
    (day / "part-1").write_text("09:05 | ERROR | c\n")
    (tmp_path / "logs" / "step_1_2024-03-01.log").write_text("08:00 | INFO | x\n")
    (tmp_path / "logs" / "other.txt").write_text("y\n")
    got = sorted((r.step, str(r.day), r.line_no, r.logged_at, r.level, r.message) for r in fs.step_logs(spark, str(tmp_path / "logs")).collect())
    assert got == [
        ("", "None", 0, "", "", ""), ("step_1", "2024-03-01", 0, "08:00", "INFO", "x"), ("step_2", "2024-03-02", 0, "09:00", "INFO", "a | b"),
        ("step_2", "2024-03-02", 1, "", "", ""), ("step_2", "2024-03-02", 2, "09:05", "ERROR", "c")]


def test_one_override_per_row(spark):
    from docroute.operators import override as ov

    a, b = "a" * 64, "a" * 20 + "b" * 44
    ledger = spark.createDataFrame([(a, "BCS1", "archived"), (b, "BCS2", "ap_queue")], "sha256 string, plan_norm string, current_stage string")
    asked = ["a" * 12, "a" * 21, " " + "A" * 64, "a" * 65, "a" * 11, "xyz", "b" * 12, None]
    r = ov.resolve(spark.createDataFrame([(p, "r") for p in asked], "prefix string, reason string"), ledger)
    got = {x.prefix: x.result for x in r.collect()}
    assert got == {
        "": "not hex", "xyz": "not hex", "a" * 11: "too short", "a" * 65: "too long", "a" * 12: "ambiguous", "b" * 12: "no match", "a" * 21: "overridden", "a" * 64: "overridden"}
    assert [x.sha256 for x in ov.as_ops(r, ov.F.lit(None).cast("timestamp")).collect()] == [a]


def test_parts_are_derived_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    parts = frame(spark, ROWS, PARTS)
    pdfs, found = bu.opened(parts.mapInArrow(count, parts.schema), frame(spark, MESSAGES, MAIL))
    assert pdfs.count() and found.count()
    assert seen.value <= 2 * len(ROWS)  # attachments and entries, each once
