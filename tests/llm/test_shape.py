"""Chat formatting, packing, mixing, the pipeline, and the SQL of the queries."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from docroute.llm import chat, mixing, packing, queries

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, source string, taken string, lang string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", "en") for i, t, s in rows], SCHEMA)


def rounded(rows):
    return sorted((tuple(repr(round(v, 6) if isinstance(v, float) else v) for v in r) for r in rows))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    got = queries.QUERIES[name](spark, sf)
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert rounded(map(tuple, got.collect())) == rounded(want)


def test_quotes_link_to_their_messages(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow are  YOU?\n\nSecond par."), (1, 1, "assistant", "> hello there\n> how are you?\nFine."),
        (1, 2, "user", ">> Hello there\n> Fine.\n\nGood"), (1, 3, "user", ">How are you?\nline only"), (1, 4, "user", "no quotes"),
        (1, 5, "user", "> unknown words"), (1, 4, "user", "no quotes"), (2, 0, "user", None), (2, 3, "user", "x"), (2, 1, "a", "> x"),
        (None, None, "u", "abc"), (None, 1, "u", "> abc\nq"), (3, 5000, "u", "late"), (3, 2, "u", "early"), (3, 9000, "u", "y" * 100_000),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, level int")
    got = {(r.conv_id, r.turn): (r.reply_to, r.n_quoted, r.text) for r in chat.conversations(table).collect()}
    assert got[1, 1] == (0, 2, "Fine.") and got[1, 2] == (1, 2, "Good") and got[1, 3] == (0, 1, "line only")
    assert got[1, 4] == (3, 0, "no quotes") and got[1, 5] == (4, 1, "")
    assert got[2, 0] == (None, 0, "") and got[2, 1] == (0, 1, "") and got[2, 3] == (1, 0, "x")
    assert got[None, None] == (None, 0, "abc") and got[None, 1] == (None, 1, "q")
    assert got[3, 5000][0] == 2 and got[3, 9000][0] == 5000
    assert chat.conversations(table).count() == len(rows) and chat.conversations(table.limit(0)).count() == 0


def encoded(texts):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    return [[*e.ids, 0] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = [
    "", " ", "  a", "a  b \n\n c\t\t", "I'm you'll  don't", "x  y 　z", "1234 5x!? ...", "\n   a", "a \n b", "<|endoftext|> a", "é" * 3000, "\x00\x1c a",
    "\U0001f600 ​", "tab\tsep", "    four", "a\r\nb", "\x85next", "word " * 5000,
]


def test_packing_round_trip(spark):
    texts = [*enumerate(ODD), (99, None), (0, ODD[0]), (None, "null id")]
    rows = packing.pack(frame(spark, [(i, t, "s") for i, t in texts]), PATH, with_ids=True).collect()
    want = defaultdict(list)
    for (i, _), ids in zip(texts, encoded([t for _, t in texts])):
        want[i].append(ids)
    got = defaultdict(list)
    for r in rows:
        assert r.offset == 0 and r.length == 1 << r.bucket <= 1024 and zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        got[r.doc_id].append(r)
    assert len({r.sequence_id for r in rows}) == len(rows)
    for i, docs in want.items():
        if len(docs) == 1:
            pieces = sorted(got[i], key=lambda r: r.start)
            assert np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in pieces]).tolist() == docs[0]
            assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist() and {r.doc_tokens for r in pieces} == {len(docs[0])}
        else:
            assert len(got[i]) == len(docs)
    assert packing.pack(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 5000])
def test_lengths_are_binary(n):
    got = packing.lengths(n)
    assert sum(got) == n and got == sorted(got, reverse=True) and all(x & (x - 1) == 0 and x <= 1024 for x in got)
    assert len(set(x for x in got if x < 1024)) == len([x for x in got if x < 1024])


def test_buckets_are_written_apart(spark, tmp_path):
    pieces = packing.pack(frame(spark, [(1, "word " * 50, "s")]), PATH, with_ids=True)
    packing.write_buckets(pieces, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == pieces.count()


def plain_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=str) + [None] * (None in sizes)
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    total, full, target = sum(sizes.values()), {}, {}
    while True:
        rest = total - sum(full.values())
        open_ = [n for n in names if n not in full]
        target = {n: rest * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = [n for n in open_ if target[n] > 3 * sizes[n]]
        if not over:
            return target | full
        full |= {n: 3 * sizes[n] for n in over}


def test_mix_comes_near_its_targets(spark):
    rng = np.random.default_rng(1)
    sources = ["b", "a", "hot", None, "tiny", "é"]
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 400))), "hot" if i % 3 == 0 else sources[i % 5] if i % 50 else "é") for i in range(900)]
    rows += [(2000, "one two", "tiny2"), (2001, None, "empty"), (None, "x " * 90, "b"), (5, rows[5][1], rows[5][2]), (3000, "v " * 50_000, "a")]
    taken, mixed = mixing.mix(frame(spark, rows))
    got = taken.collect()
    sizes, took = defaultdict(int), defaultdict(int)
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
    for r in got:
        took[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.taken <= 3 * r.size
    want = plain_targets(sizes)
    assert len(got) == len(rows) and {r.source: pytest.approx(r.target) for r in got} == want
    assert all(abs(took[s] - want[s]) <= 1.5 * mixing.BLOCK for s in want)
    assert rounded(map(tuple, mixing.mix(frame(spark, rows))[0].collect())) == rounded(map(tuple, got))
    by_doc = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert by_doc[3000] == next(r.taken for r in got if r.doc_id == 3000)
    assert sum(by_doc.values()) == sum(took.values())


def test_permutation_visits_every_block_once_a_round(spark):
    s = spark.createDataFrame([(0, 2, 0, 37, 100), (0, 5, 0, 1, 3)], "shard long, source_no long, first long, n_blocks long, count long")
    for r in mixing.slots(s).groupBy("source_no", (F.col("nth") / F.when(F.col("source_no") == 2, 37).otherwise(1)).cast("int").alias("round")).agg(F.count("*").alias("n"), F.countDistinct("block").alias("d")).collect():
        assert r.n == r.d


def test_mix_documents(spark):
    rows = [(i, "w " * (50 + i % 90), "abc"[i % 3]) for i in range(600)]
    docs = frame(spark, [*rows, (9000, None, "a")])
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.source] += len(r.text.split())
    total = sum(len(t.split()) for _, t, _ in rows)
    for s, share in zip("abc", (1, 2, 3)):
        assert abs(got[s] - total * share / 6) < 0.12 * total * share / 6
    assert mixing.mix_documents(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0))[0].count() == 0
    assert mixing.mix(docs.where("doc_id = 9000"))[0].collect()[0].target == 0


def test_pipeline_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
        if name == "packing":
            tokens = docs.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
            want = defaultdict(int)
            rows = before.collect()
            for r, ids in zip(rows, encoded([r.text for r in rows])):
                want[r.doc_id] += len(ids)
            assert {r.doc_id: r.n for r in tokens} == want
        else:
            assert docs.columns == columns
            ids = {r.doc_id for r in before.select("doc_id").collect()}
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2]
    run = corpus_pipeline.run(spark, sf)
    assert rounded(map(tuple, run.drop("sequence_id").collect())) == rounded(map(tuple, docs.drop("sequence_id").collect()))


def test_pipeline_stages_on_odd_rows(spark, sf):
    long = " ".join(f"w{i}" for i in range(80))
    rows = frame(spark, [(1, None, None), (2, "", "s"), (3, long, "s"), (3, long, "s"), (None, long + " x", None), (4, "z" * 50_000, "s")])
    for docs in (rows, rows.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs.write.mode("overwrite").format("noop").save()
            docs = stage(spark, docs, sf)
            assert name == "packing" or docs.columns == rows.columns
        docs.collect()
