"""Nearest neighbours, PPM, toxicity and repetition against plain Python or brute force, and their edge cases."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docroute.llm import ann, ppm, queries, repetition, toxicity

SCHEMA = "doc_id long, text string, k long, value string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in texts], SCHEMA)


def brute_nearest(rows, is_query, k):
    want = {}
    for q, x in rows:
        if is_query(q):
            scored = sorted({(-float(np.dot(x, y)), v) for v, y in rows if v != q and len(y) == len(x)})
            want[q] = [(v, -s) for s, v in scored[:k]]
    return want


def test_nearest_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_nearest(rows, lambda v: v % 20 == 0, 20)
    got = defaultdict(list)
    for r in queries.op3_ann(spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    vectors = dict(rows)
    hits = sum(len({v for v, _ in want[q]} & {v for v, _ in got[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want) and set(got) == set(want)
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - np.dot(vectors[q], vectors[v])) < 1e-12 for v, s in found)


def test_nearest_with_lengths_ties_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * (1 + i % 4)).tolist()) for i in range(120)] + [(200 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(60)]
    rows += [(400, [1.0, 2.0]), (420, [2.0, 1.0]), (20, rows[20][1])]
    bad = [(500, None), (520, []), (540, [0.0] * 6), (560, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (580, [math.nan] * 6), (600, [math.inf] * 6), (None, [1.0] * 6)]
    table = spark.createDataFrame([(i, x, 1) for i, x in rows + bad], "vec_id long, embedding array<double>, entry int")
    want = brute_nearest(rows, lambda v: v % 20 == 0, 25)
    got = defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, k=25).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, pytest.approx(r.score)))
    assert dict(got) == want
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def plain_ppm(docs, held, order):
    words = lambda t: (t or "").encode().lower().split()
    counts, unigrams = defaultdict(Counter), Counter()
    for i, t in docs:
        if not held(i):
            seq = b"\xff" * order + b" ".join(words(t)) + b"\xff"
            unigrams.update(words(t) + ["end"])
            for p in range(order, len(seq)):
                for k in range(order + 1):
                    counts[seq[p - k : p]][seq[p]] += 1

    def symbol(context, s):
        out, value = set(), 0.0
        for k in range(order, -1, -1):
            live = {a: n for a, n in counts.get(context[order - k :], {}).items() if a not in out}
            if not live:
                continue
            total = 2 * sum(live.values())
            if s in live:
                return value + math.log10((2 * live[s] - 1) / total)
            value += math.log10(len(live) / total)
            out |= set(live)
        return value - math.log10(257 - len(out))

    n, v, found = sum(unigrams.values()), len(unigrams), {}
    for i, t in docs:
        seq, tokens = b"\xff" * order + b" ".join(words(t)) + b"\xff", words(t) + ["end"]
        base = sum(math.log10((unigrams[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        score = sum(symbol(seq[p - order : p], seq[p]) for p in range(order, len(seq)))
        found[i] = (held(i), len(tokens), sum(unigrams[w] > 0 for w in tokens), n, pytest.approx(base), pytest.approx(score))
    return found


def test_ppm_is_the_plain_one(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["the", "cat", "Über", "sat", "ON", "mat", f"q{i % 7}z"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "\t \n"), (66, "é中\U0001f600 zz"), (67, "long " * 3000)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    got = ppm.score(frame(spark, docs), queries.crc_of("doc_id") % 5 == 1).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain_ppm(docs, held, ppm.ORDER)


def test_ppm_symbols_of_a_context_sum_to_one(spark):
    seen = "abracadabra abba"
    docs = [(1, seen)] + [(2 + b, f"abra{chr(b)}") for b in range(33, 65)]
    got = {r.doc_id: r.score for r in ppm.score(frame(spark, docs), F.col("doc_id") > 1).collect()}
    assert all(x < 0 for x in got.values())
    assert {r.train_tokens for r in ppm.score(frame(spark, docs), F.col("doc_id") > 1).collect()} == {3}


def test_ppm_without_training_and_without_rows(spark):
    rows = frame(spark, [(1, "ab"), (None, None), (1, "ab")])
    got = ppm.score(rows, F.lit(True)).collect()
    assert sorted(round(r.score, 6) for r in got) == sorted(round(-n * math.log10(257), 6) for n in (3, 3, 1))
    assert ppm.score(rows.limit(0), F.lit(True)).count() == 0


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(got[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.9
    assert np.mean([s >= 0.5 for s in bad]) < 0.02 and np.mean([s >= 0.5 for s in good]) > 0.6


def test_the_machine_learns_a_pair(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for _ in range(900):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(12)}" for _ in range(6)] + ["insult"] * a + ["group"] * b
        texts.append(" ".join(words))
        labels.append(int(a and b))
    machine = toxicity.train(texts, np.array(labels))
    chance = machine.chances(np.array([machine.worst(toxicity.pieces(t)) for t in texts]))
    assert np.mean((chance >= 0.5) == np.array(labels)) > 0.97


def test_chances_follow_the_share_of_all_labels(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(4000):
        toxic = int(rng.random() < 0.05)
        bad = rng.random() < (0.7 if toxic else 0.2)
        rows.append((i, " ".join([f"w{rng.randrange(12)}" for _ in range(6)] + ["bad"] * bad)))
        labels.append((i, toxic))
    docs = frame(spark, rows)
    machine = toxicity.model(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True), sample=300)
    mean = toxicity.score(docs, machine).agg(F.avg("score")).first()[0]
    assert abs(mean - np.mean([y for _, y in labels])) < 0.02


def test_every_piece_of_a_clean_text_is_learned_from(monkeypatch):
    seen = []
    fit = toxicity.Machine.fit
    monkeypatch.setattr(toxicity.Machine, "fit", lambda self, sets, *rest: (seen.append(len(sets)), fit(self, sets, *rest))[1])
    texts = [" ".join(f"w{k % 50}" for k in range(96 * 20))] * 6
    toxicity.train(texts, np.array([0, 0, 0, 0, 0, 1]))
    n = len(toxicity.pieces(texts[0]))
    assert n > 16 and seen == [6 * n, 5 * n + 1, 5 * n + 1]


def test_toxicity_cases(spark):
    docs = frame(spark, [(1, None), (2, ""), (None, "a b"), (3, "c"), (3, "c"), (4, "word " * 30_000)])
    labels = spark.createDataFrame([(1, 1), (None, 1), (9, 0)], "doc_id long, toxic int")
    machine = toxicity.model(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(docs, machine).collect()} == {0.5}
    got = toxicity.score(docs, toxicity.model(docs, labels, F.lit(True))).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(docs.limit(0), machine).count() == 0


def plain_repeats(data, least):
    mark, longest = bytearray(len(data)), 0
    for i in range(len(data)):
        n = max((next((k for k in range(len(data)) if max(i, j) + k >= len(data) or data[i + k] != data[j + k]), len(data)) for j in range(len(data)) if j != i), default=0)
        if n >= least:
            mark[i : i + n] = b"\1" * n
            longest = max(longest, n)
    return sum(mark), longest


@pytest.mark.parametrize("seed", range(8))
def test_suffix_array_repeats(seed):
    rng = random.Random(seed)
    data = bytes(rng.choice(rng.choice([b"ab", b"a\0b", b"abcdefgh"])) for _ in range(rng.randrange(1, 110)))
    data = data[: rng.randrange(60)] * 2 + data + b"\0" * rng.randrange(4)
    order, lcp = repetition.suffix_lcp(np.frombuffer(data, np.uint8))
    assert list(order) == sorted(range(len(data)), key=lambda i: data[i:])
    assert repetition.repeats(np.frombuffer(data, np.uint8), 9) == plain_repeats(data, 9)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_quality_query_is_the_plain_one(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_repetition(spark, sf).collect():
        assert plain_counts(docs[r.doc_id]) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert not (r.base_failed and r.kept)


def test_quality_cases(spark):
    fresh = " ".join(f"word{i}é" for i in range(200))
    half = " ".join(f"part{i}" for i in range(120))
    rows = frame(spark, [(1, None), (2, ""), (3, fresh), (3, fresh), (None, fresh), (4, half + " sep " + half), (5, "x" * 300_000), (6, "same " * 60_000)])
    got = sorted((r.doc_id or -1, r.kept) for r in repetition.judge(rows).collect())
    assert got == [(-1, True), (1, False), (2, False), (3, True), (3, True), (4, False), (5, False), (6, False)]
    kept = repetition.keep_good(rows)
    assert kept.columns == rows.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 3]
    assert repetition.judge(rows.limit(0)).count() == 0 and repetition.keep_good(rows.limit(0)).count() == 0
