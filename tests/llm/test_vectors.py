"""Whitening and centroid clustering against plain numpy and Python integers; SentencePiece against its library."""

import hashlib
import math
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from docroute.llm import centroids, pieces, queries, whitening

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
VECTORS = "vec_id long, embedding array<float>, n int, cluster string, ids int, data int, whitened string"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash", 2, 3, "clash") for i, v in rows], VECTORS)


def usable(rows, dim):
    return [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]


# ---- whitening


def plain_covariance(rows):
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dim)]
    spread = [[sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x) for j in range(dim)] for i in range(dim)]
    return x, n, s, np.array([[v / n**3 for v in row] for row in spread])


def check_whitening(spark, rows, dim):
    kept = usable(rows, dim)
    x, n, s, v = plain_covariance(kept)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == len(kept)
    want = {}
    for (i, _), r in zip(kept, x):
        dev = sum((n * a - b) ** 2 for a, b in zip(r, s))
        w = (np.array([n * a - b for a, b in zip(r, s)], float) / n) @ axes[:, :8] / np.sqrt(values[:8])
        want.setdefault(i, []).append((str(dev), w))
    sign = None
    for r in got:
        dev, w = next(p for p in want[r.vec_id] if p[0] == r.deviation)
        assert r.n == n and r.identity_error < 1e-6
        np.testing.assert_allclose(r.explained, values[:8] / values.sum(), rtol=1e-9)
        if sign is None and np.abs(w).min() > 1e-3:
            sign = np.sign(np.array(r.whitened) * w)
    for r in got:
        w = next(p for p in want[r.vec_id] if p[0] == r.deviation)[1]
        np.testing.assert_allclose(np.array(r.whitened) * sign, w, atol=1e-6)


def test_whitening_equals_plain_integers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(10) * np.arange(1, 11)).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[8][1]), (400, None), (401, [1.0] * 9 + [None]), (402, [NAN] * 10), (403, [INF] * 10), (404, []), (405, [1.0] * 9)]
    check_whitening(spark, rows, 10)


def test_whitening_of_large_entries(spark):
    """Planes past 31 bits, products past a long, deviations past a long."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(9) * 1e12).tolist()) for i in range(70)]
    check_whitening(spark, rows, 9)
    assert all(len(r.deviation) > 19 for r in whitening.whiten(table(spark, rows)).collect())


def test_products_of_planes():
    rng = np.random.default_rng(5)
    for top in (1, 2, 1000, 1 << 20, 1 << 40):
        y = rng.integers(0, top, (1500, 5))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(5)] for i in range(5)]
        assert np.triu(whitening.products(y).astype(object)).tolist() == np.triu(np.array(want, object)).tolist()


def test_whitening_without_variance(spark):
    out = whitening.whiten(table(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in out] == [(2, "0", [0.0, 0.0], [0.0, 0.0], 0.0)] * 2
    out = whitening.whiten(table(spark, [(1, [0.5, 2.0]), (2, [0.5, 3.0])])).collect()
    assert all(r.whitened[1] == 0 and abs(abs(r.whitened[0]) - 1) < 1e-9 and r.identity_error < 1e-9 for r in out)
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0 and whitening.whiten(table(spark, [])).count() == 0


def test_whitening_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    out = queries.QUERIES["op12_whitening"](spark, sf)
    assert dict(out.dtypes) | {"n": "bigint", "component": "int", "deviation": "bigint", "whitened": "double"} == dict(out.dtypes)
    per = out.groupBy("component").agg(F.count("*").alias("n"), F.avg("whitened").alias("m"), F.stddev_pop("whitened").alias("s")).collect()
    assert sorted(r.component for r in per) == list(range(1, 9)) and all(r.n == rows and abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-6 for r in per)


# ---- centroids


def plain_clusters(rows, clusters, rounds, dim):
    kept = usable(rows, dim)
    y = [[math.floor(64 * float(np.float32(c))) for c in v] for _, v in kept]
    at = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, hashlib.sha256(f"1:{kept[k][0]}".encode()).hexdigest(), kept[k][1]))
    cents = [y[k] for k in at[:clusters]]

    def nearest(r):
        return min((sum((a - b) ** 2 for a, b in zip(r, c)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        own = [nearest(r)[1] for r in y]
        for k in range(len(cents)):
            mine = [r for r, o in zip(y, own) if o == k]
            if mine:
                cents[k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [nearest(r) for r in y]
    return sorted(((i is None, i or 0), k, d) for (i, _), (d, k) in zip(kept, found)), cents


def check_clusters(spark, rows, dim=64, clusters=16, rounds=3):
    found, cents = centroids.cluster(table(spark, rows), clusters, rounds, dim)
    want, plain = plain_clusters(rows, clusters, rounds, dim)
    assert sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance) for r in found.collect()) == want
    assert cents.tolist() == plain
    return found


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(64) * 0.2).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1])]
    rows += [(900, None), (901, [NAN] * 64), (902, [0.0] * 63), (903, [0.0] * 63 + [None]), (904, [INF] * 64), (905, [])]
    check_clusters(spark, rows)


def test_clusters_of_ties_and_few_rows(spark):
    check_clusters(spark, [(i, [0.0] * 64) for i in range(40)])
    check_clusters(spark, [(i, [float(i)] * 64) for i in range(3)])
    check_clusters(spark, [(i, [float(i % 2), 1e5 * (i % 3)]) for i in range(30)], dim=2, clusters=4)
    found, cents = centroids.cluster(table(spark, []))
    assert found.count() == 0 and len(cents) == 0 and centroids.with_inertia(found, cents).count() == 0


def test_boxes_leave_centroids_out(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.standard_normal(4) * 0.05 + 4 * (i % 8) * np.array([1, -1, 1, 0.5])).tolist()) for i in range(4000)]
    found = check_clusters(spark, rows, dim=4, clusters=8)
    assert found.agg(F.avg("n_candidates")).first()[0] < 4


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(8)
    for _ in range(200):
        y, c = rng.integers(-50, 50, (20, 3)), rng.integers(-50, 50, (6, 3))
        near = centroids.candidates(y.min(axis=0), y.max(axis=0), c)
        assert set(centroids.distances(y, c).argmin(axis=1)) <= set(near.tolist())


def test_hilbert_order_walks_by_single_steps():
    for dim, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
        order = sorted(range(len(cells)), key=centroids.hilbert(cells, bits).__getitem__)
        assert len(set(centroids.hilbert(cells, bits))) == len(cells)
        assert all(np.abs(cells[a] - cells[b]).sum() == 1 for a, b in pairwise(order))


# ---- SentencePiece

TEXTS = [
    "", " ", "  ", "a", " a  b ", "▁a ▁▁ b▁", "naïve café\n\n\ttabs", "<s> </s> <unk> <0x0A>", "語語語 日本語", "Ģ\x00\x01", "😀😀 a😀", "a" * 300, " " * 700, "ab" * 100 + "語" * 50,
    "word " * 3000, "1234567890.5%", "don't  stop", "Привет мир", "é", "́e", "﻿x", "x" * 70 + " " + "ü" * 70,
]


def test_agenda_equals_the_library():
    v = pieces.MergeVocabulary(MODEL)
    rng = np.random.default_rng(9)
    alphabet = list("etaoin shrdlu▁éß語\n<s>0😀\x00Ģ")
    texts = TEXTS + ["".join(rng.choice(alphabet, rng.integers(0, 60))) for _ in range(800)]
    want = [np.array(ids, "<u4").tobytes() for ids in v.library.encode(texts, add_bos=True, add_eos=True)]
    assert v.encode(texts) == want
    whole = [v.prefix + t.replace(" ", pieces.MARK) for t in texts if t]
    assert [v._long(w) for w in whole] == [ids[4:-4] for t, ids in zip(texts, want) if t]
    assert v._short(whole) == [ids[4:-4] for t, ids in zip(texts, want) if t]


def test_encoded_rows(spark):
    rows = [*enumerate(TEXTS), (100, None), (0, ""), (None, "null id"), (3, "other row of an id")]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, ids string, decoded string")
    library = pieces.MergeVocabulary(MODEL).library
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, np.array(ids, "<u4").tobytes(), library.decode(ids)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in pieces.encode(docs, MODEL).collect()), key=key) == sorted(want, key=key)
    assert pieces.encode(docs.limit(0), MODEL).count() == 0


def test_slices_hold_every_text():
    texts = ["x" * n for n in (3, 0, 9, 1, 1, 20, 2)]
    got = list(pieces.slices(texts, 10))
    assert [k for a, b in got for k in range(a, b)] == list(range(7)) and all(sum(map(len, texts[a:b])) <= 10 or b - a == 1 for a, b in got)


def test_digests(spark, sf):
    got = {r.doc_id: r for r in queries.QUERIES["op11_sentencepiece"](spark, sf).collect()}
    library = pieces.MergeVocabulary(MODEL).library
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    for r in rows:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_other_vocabularies_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(MODEL, "rb") as f:
        model = proto.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.MergeVocabulary(str(tmp_path / "m"))
