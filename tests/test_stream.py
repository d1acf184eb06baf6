"""The ledger as a stream into buckets: what a batch writes, and what a batch that comes again does."""

import os
import random

from docroute.operators import ledger_fold as lf
from docroute.sources.ledger_store import BucketedLedger
from docroute.streaming import ledger_stream as ls
from tests.test_ledger_fold import SCHEMA, make_ops


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def frame(spark, ops):
    return spark.createDataFrame([tuple(o.values()) for o in ops], SCHEMA)


def test_stream_equals_batch(spark, tmp_path):
    df = frame(spark, make_ops(random.Random(11), 120, 40, 20))
    got = ls.run_in_ranges(df, str(tmp_path), ranges=3, buckets=8)
    assert sorted(got.collect()) == sorted(lf.fold(lf.empty_ledger(df), df)[1].collect())
    assert ls.run_in_ranges(df.limit(0), str(tmp_path / "none")).count() == 0


def test_batch_writes_the_buckets_it_touches(spark, tmp_path):
    first = make_ops(random.Random(12), 400, 200, 100_000)
    store = BucketedLedger(spark, str(tmp_path / "ledger"), 100)
    ls.apply_ops(store, frame(spark, first), 0)
    before, held = files(store.path + "/rows"), store.read().count()
    assert len(before) > 60
    sha = store.read().select("sha256").first()[0]
    later = [dict(first[0], seq=1000, sha256=sha, op="archive"), dict(first[0], seq=1001, sha256=sha, op="arrive")]
    df = frame(spark, later)
    want = lf.fold(store.read().drop("bucket"), df)[1].collect()
    ls.apply_ops(store, df, 1)
    after = files(store.path + "/rows")
    # one bucket of a hundred was written again, all others are the same files
    assert len(set(before.items()) - set(after.items())) == 1 and len(set(after.items()) - set(before.items())) == 1
    assert sorted(store.read().drop("bucket").collect()) == sorted(want) and len(want) == held

    # the batch again, as after a crash before the stream noted it: the same rows, nothing counted twice
    ls.apply_ops(store, df, 1)
    assert sorted(store.read().drop("bucket").collect()) == sorted(want)
    ls.apply_ops(store, frame(spark, first), 0)
    assert sorted(store.read().drop("bucket").collect()) == sorted(want)

    # a batch that stopped half-way, its buckets not written whole, starts over
    os.makedirs(f"{store.path}/batches/2/_temporary")
    assert store.last_batch() == 1
    ls.apply_ops(store, frame(spark, [dict(first[0], seq=1002, sha256=sha, op="arrive")]), 2)
    assert {r.sha256: r.dup_count for r in store.read().collect()}[sha] == {r.sha256: r.dup_count for r in want}[sha] + 1
