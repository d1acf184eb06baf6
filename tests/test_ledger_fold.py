"""The ledger fold, by components and by rounds, against a plain sequential fold."""

import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest

from docroute.operators import ledger_fold as lf

SCHEMA = "seq long, ts timestamp, sha256 string, op string, plan_norm string, invoice_number string, amount_cents long, sender_domain string"


def key_of(o):
    ok = o["plan_norm"] and o["invoice_number"] and o["amount_cents"] is not None and o["sender_domain"]
    return (o["plan_norm"].upper(), o["invoice_number"], o["amount_cents"], o["sender_domain"].lower()) if ok else None


def sequential(ops):
    """rows: sha -> dict; outcomes in order."""
    rows, order, out = {}, [], []
    for o in sorted(ops, key=lambda x: x["seq"]):
        sha, k, day = o["sha256"], key_of(o), o["ts"].replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo("America/Vancouver")).date().isoformat()
        row = rows.get(sha)
        if o["op"] != "arrive":
            if row is None:
                out.append((o["seq"], "unknown", None, None))
                continue
            row["stage"], row["seen"] = lf.STAGE_OF[o["op"]], day
            if o["op"] == "archive":
                row["path"] = f"archive/{sha}"
            out.append((o["seq"], "staged", sha, None))
            continue
        live = [s for s in order if rows[s]["key"] == k and k and rows[s]["stage"] not in ("overridden", "superseded")]
        if row is not None and row["stage"] != "overridden":
            hit = sha
        else:
            hit = live[0] if live else None
        if hit is not None:
            rows[hit]["dups"] += 1
            rows[hit]["seen"] = rows[hit]["dup_day"] = day
            out.append((o["seq"], "duplicate", hit, None))
            continue
        gone = None
        if row is None and k:
            over = [s for s in order if rows[s]["key"] == k and rows[s]["stage"] == "overridden"]
            if over:
                gone = over[0]
                rows[gone]["stage"] = "superseded"
        if sha not in rows:
            order.append(sha)
        rows[sha] = {"key": k, "stage": "manager_queue", "dups": 0, "seen": day, "dup_day": "", "first": day, "path": "", "inv": o["invoice_number"]}
        out.append((o["seq"], "inserted", sha, gone))
    return rows, order, out


def make_ops(rng, n, n_sha, n_key, hot=0.0):
    ops, t0 = [], dt.datetime(2024, 1, 1, 12)
    for i in range(n):
        is_hot = rng.random() < hot
        kind = rng.choices(["arrive", "to_ap", "archive", "override"], [70, 8, 8, 14])[0]
        inv = "" if rng.random() < 0.15 else f"I{0 if is_hot else rng.randrange(n_key)}"
        ops.append(dict(seq=i, ts=t0 + dt.timedelta(hours=5 * i), sha256=f"h{0 if is_hot else rng.randrange(n_sha)}", op=kind, plan_norm="BCS1", invoice_number=inv,
                        amount_cents=None if rng.random() < 0.1 else 0, sender_domain="v.com"))
    return ops


@pytest.mark.parametrize("seed,n,n_sha,n_key,hot,small", [(1, 24, 6, 3, 0.0, 0), (4, 60, 30, 20, 0.34, 24), (5, 300, 60, 30, 0.1, lf.SMALL)])
def test_fold_equals_sequence(spark, monkeypatch, seed, n, n_sha, n_key, hot, small):
    """small = 0: rounds alone; 24: the giant component by rounds until it falls apart; SMALL: replay alone."""
    monkeypatch.setattr(lf.decide, "__defaults__", (small,))
    ops = make_ops(random.Random(seed), n, n_sha, n_key, hot)
    df = spark.createDataFrame([tuple(o.values()) for o in ops], SCHEMA)
    outcomes, after = lf.fold(lf.empty_ledger(df), df)
    rows, order, want = sequential(ops)
    got = sorted((r.seq, r.outcome, r.target, r.superseded) for r in outcomes.collect())
    assert got == want
    led = {r.sha256: r for r in after.collect()}
    assert set(led) == set(rows)
    for s, r in rows.items():
        g = led[s]
        assert (g.current_stage, g.dup_count, g.last_seen_date, g.last_dup_date, g.first_seen_date, g.archive_path, g.invoice_number) == (
            r["stage"], r["dups"], r["seen"], r["dup_day"], r["first"], r["path"], r["inv"]), s
    assert [r.sha256 for r in sorted(led.values(), key=lambda r: r.pos)] == order


def test_skipped_duplicate_leaves_its_hash_free(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(0, t0, "s1", "arrive", "P1", "I1", 1, "v.com"), (1, t0, "s2", "arrive", "P1", "I1", 1, "v.com"), (2, t0, "s2", "arrive", "P1", "I2", 1, "v.com")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.seq: (r.outcome, r.target) for r in lf.decide(df, lf.empty_ledger(df)).collect()}
    assert got == {0: ("inserted", "s1"), 1: ("duplicate", "s1"), 2: ("inserted", "s2")}


def test_two_batches_equal_one(spark):
    ops = make_ops(random.Random(7), 40, 12, 4)
    df = spark.createDataFrame([tuple(o.values()) for o in ops], SCHEMA)
    _, once = lf.fold(lf.empty_ledger(df), df)
    _, half = lf.fold(lf.empty_ledger(df), df.where("seq < 20"))
    _, twice = lf.fold(half, df.where("seq >= 20"))
    assert sorted(once.collect()) == sorted(twice.collect())
