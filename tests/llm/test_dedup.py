"""SimHash, line dedup and passages against plain Python, and their edge cases."""

import random
import re

import numpy as np
import pytest
import xxhash

from docroute.llm import linededup, passages, queries, simhash
from docroute.llm.common import Scratch, components, released

SCHEMA = "doc_id long, text string, k long, component string, n_chars int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x", len(t or "")) for i, t in texts], SCHEMA)


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, near):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_query_is_the_plain_one(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, sf).collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    want = roots(docs, [(a, b) for a in docs for b in docs if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in docs}


@pytest.mark.parametrize("bits", [0, 6, 12])
def test_near_pairs_are_all_pairs_within_budget(bits):
    rng = random.Random(bits)
    base = [rng.getrandbits(64 - bits) for _ in range(30)]
    near = {x ^ sum(1 << rng.randrange(64 - bits) for _ in range(rng.randrange(4))) for x in base * 20}
    a = np.array(sorted((x & (1 << 64 - bits) - 1) | (5 << 64 - bits if bits else 0) for x in near), np.uint64)
    b = np.array(sorted({int(x) ^ (1 << 64 - bits if bits else 1) for x in a}), np.uint64)
    for x, y, same in ((a, a, True), (a, b, False)):
        got = sorted((int(i), int(j)) for p, q in simhash.near_pairs(x, y, same, bits, 2) for i, j in zip(p, q))
        want = [(i, j) for i in range(len(x)) for j in range(len(y)) if (not same or i < j) and int(x[i] ^ y[j]).bit_count() <= 2]
        assert got == sorted(want)


def test_simhash_of_a_large_group_of_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for i in range(600):
        own = list(words)
        for _ in range(rng.randrange(4)):
            own[rng.randrange(400)] = f"x{rng.random()}"
        texts.append((i, " ".join(own)))
    prints = {i: plain_fingerprint(t) for i, t in texts}
    want = roots(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert {r.doc_id: r.component for r in simhash.group(frame(spark, texts)).collect()} == want


def test_simhash_cases(spark):
    rows = frame(spark, [(4, None), (2, ""), (9, " \n"), (3, "one"), (3, "one"), (None, "ONE"), (8, "a b c d e f g h"), (7, "q r s t u v")])
    got = sorted((r.doc_id or -1, r.component) for r in simhash.group(rows).collect())
    assert got == [(-1, 3), (2, 2), (3, 3), (3, 3), (4, 2), (7, 7), (8, 8), (9, 2)]
    kept = simhash.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "ONE"), (2, ""), (7, "q r s t u v"), (8, "a b c d e f g h")]
    assert simhash.group(rows.limit(0)).count() == 0 and simhash.one_of_each(rows.limit(0)).count() == 0


def test_one_of_each_finds_near_copies_of_five_word_similarity(spark):
    rng = random.Random(6)
    fresh = lambda k: [f"v{rng.randrange(10**9)}" for _ in range(k)]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    texts, near, apart = [], set(), set()
    for pair in range(300):
        a = fresh((100, 300, 1000)[pair % 3])
        b = list(a)
        for k in rng.sample(range(len(b)), max(1, int(len(b) * rng.random() * 0.05))):
            b[k] = f"x{rng.randrange(10**9)}"
        like = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        (near if like >= 0.8 else apart).add(pair)
        texts += [(2 * pair, " ".join(a)), (2 * pair + 1, " ".join(b).upper())]
    got = {r.doc_id for r in simhash.one_of_each(frame(spark, texts)).collect()}
    assert len(near) > 100 and len(apart) > 30 and {2 * p for p in near | apart} <= got
    assert {p for p in near if 2 * p + 1 in got} == set() and {p for p in apart if 2 * p + 1 not in got} == set()


def test_groups_of_the_trie_are_the_components_of_its_links(spark):
    rng = random.Random(12)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = sorted({x ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for x in base * 5})
    rows = [(i, 9, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)] + [(0, 9, prints[-1] - (1 << 64) if prints[-1] >> 63 else prints[-1])]
    got = {}
    for r in simhash.trie_groups(spark.createDataFrame(rows, "fp long, size long, print long"), Scratch(spark, "test")).collect():
        got.setdefault(r.root, set()).add(r.print % (1 << 64))
    want = {}
    for x, r in roots(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]).items():
        want.setdefault(r, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("size", [3, 12, 200])
def test_one_of_each_loses_no_link_in_groups(spark, size):
    rng = random.Random(size)
    fresh = lambda k: [f"v{rng.randrange(10**9)}" for _ in range(k)]
    grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    texts = []
    for _ in range(max(1, 120 // size)):
        own = fresh(200)
        for _ in range(size):
            other = list(own)
            for k in rng.sample(range(200), rng.randrange(3, 9)):
                other[k] = f"x{rng.randrange(10**9)}"
            texts.append((len(texts), " ".join(other)))
    sets = {i: grams(t.split()) for i, t in texts}
    near = [(a, b) for a in sets for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = set(roots(sets, near).values())
    assert {r.doc_id for r in simhash.one_of_each(frame(spark, texts)).collect()} == want


def test_rare_pairs_hold_all_similar_ones_and_few_others(spark):
    rng = random.Random(16)
    sets = {}
    for i in range(400):
        own = list(range(150))
        for k in rng.sample(range(30), rng.randrange(0, 7)):
            own[5 * k : 5 * k + 5] = [10_000 + 1000 * i + 5 * k + j for j in range(5)]
        sets[i] = np.array(sorted(own[: 150 - rng.randrange(3)]), np.uint32)
    like = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    near = {(a, b) for a in sets for b in range(a) if like(sets[a], sets[b])}
    roots_ = roots(sets, near)
    tokens = spark.createDataFrame([(i, x.tobytes()) for i, x in sets.items()], "fp long, tokens binary")
    rare = simhash.rare_tokens(spark.createDataFrame([(i, len(x)) for i, x in sets.items()], "fp long, size long"), tokens).cache()
    pairs = lambda root, hubs: {(r.a, r.b) for r in simhash.rare_pairs(rare, spark.createDataFrame(list(root.items()), "fp long, root long"), hubs).collect()}
    alone = {i: i for i in sets}
    assert len(near) > 1000 and near <= pairs(alone, False)
    assert len(set(roots(sets, near & pairs(alone, True)).values())) < 1.1 * len(set(roots_.values()))
    # texts apart from all others meet next to nobody, though all share most of their tokens
    assert len(set(roots_.values())) > 150 and len(pairs(roots_, False)) < 400


def test_components_of_random_graphs(spark, tmp_path):
    rng = random.Random(5)
    near = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5001 + i) for i in range(50)]
    got = dict(components(spark.createDataFrame(near, "a long, b long"), Scratch(spark, "test")).collect())
    ids = {x for pair in near for x in pair}
    want = roots(ids, near)
    assert {i: got.get(i, i) for i in ids} == want


def plain_line_dedup(docs, least=2):
    seen, cut = set(), {i: set() for i, _ in docs}
    for i, text in sorted(docs):
        wordy = [(n, x) for n, x in enumerate((text or "").split("\n")) if x.strip(" \t\n\r\v\f")]
        for q in range(len(wordy) - least + 1):
            run = tuple(x for _, x in wordy[q : q + least])
            if run in seen:
                cut[i].update(range(wordy[q][0], wordy[q + least - 1][0] + 1))
            seen.add(run)
    return {i: "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in cut[i]) for i, t in docs}


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_is_the_plain_one(spark, seed):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", f"u{rng.random()}"]) for _ in range(rng.randrange(30)))) for i in range(25)]
    docs += [(100 + i, docs[rng.randrange(25)][1]) for i in range(5)]
    got = {r.doc_id: r.text for r in linededup.drop_copied_lines(frame(spark, docs)).collect()}
    assert got == plain_line_dedup(docs)


def test_line_runs_are_maximal(spark):
    body = "\n".join(f"line {i}" for i in range(11))
    rows = frame(spark, [(1, "top\n" + body + "\nend"), (2, body), (3, "x\n" + body + "\ny")])
    got = sorted((r.doc_id, r.line, r.last, r.n, r.first_doc_id, r.first_line) for r in linededup.runs(rows).collect())
    assert got == [(2, 0, 10, 11, 1, 1), (3, 1, 11, 11, 1, 1)]


def test_line_dedup_cases(spark):
    rows = frame(spark, [(1, None), (2, ""), (3, "a\nb"), (3, "a\nb"), (None, "a\nb"), (4, "c\nc\nc\nc"), (5, "z" * 200_000)])
    out = linededup.drop_copied_lines(rows)
    assert out.columns == rows.columns
    got = sorted((r.doc_id or -1, r.text, r.n_chars) for r in out.collect())
    assert got == [(-1, "a\nb", 3), (1, "", 0), (2, "", 0), (3, "", 0), (3, "", 0), (4, "c", 1), (5, "z" * 200_000, 200_000)]
    assert linededup.drop_copied_lines(rows.limit(0)).count() == 0


def shares(a, b, n):
    runs = [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (a.lower().split(), b.lower().split())]
    return bool(runs[0] & runs[1])


def test_passages_of_fifty_words_are_found(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    owner, want = {}, set()
    for i, t in docs.items():
        w = t.lower().split()
        for k in range(len(w) - 49):
            owner.setdefault(tuple(w[k : k + 50]), set()).add(i)
    for ids in owner.values():
        want |= ids if len(ids) > 1 else set()
    got = {r.doc_id for r in queries.op2_passages(spark, sf).collect()}
    assert want <= got
    for i in got - want:  # the rest share a little less
        assert any(shares(docs[i], docs[j], 27) for j in docs if j != i)


def test_near_passages_with_changed_words(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    passage, texts = fresh(150), []
    for i in range(40):
        own = list(passage)
        if i:
            own[rng.randrange(60, 90)] = "changed"
        texts.append((i, " ".join(fresh(80) + own + fresh(80))))
    texts += [(1000 + i, " ".join(fresh(300))) for i in range(20)] + [(2000 + i, " ".join(fresh(60) + passage[:20] + fresh(60))) for i in range(10)]
    got = {r.doc_id: r for r in passages.find(frame(spark, texts)).collect()}
    assert set(got) == set(range(40))
    assert {r.component_id for r in got.values()} == {0}
    assert all(any(s.start <= 90 and s.start + s.n_words >= 135 for s in r.spans) for r in got.values())


@pytest.mark.parametrize("n, changed", [(50, ()), (52, ()), (50, (24,)), (50, (11,)), (60, (30,)), (100, (33, 66))])
def test_short_and_changed_passages_are_all_found(spark, n, changed):
    rng = random.Random(n + len(changed))
    fresh = lambda k: [f"v{rng.randrange(10**9)}" for _ in range(k)]
    texts = []
    for pair in range(100):
        own = fresh(n)
        other = [f"changed{pair}" if k in changed else w for k, w in enumerate(own)]
        for side, passage in enumerate((own, other)):
            before = rng.randrange(400 - n)
            texts.append((2 * pair + side, " ".join(fresh(before) + passage + fresh(400 - n - before))))
    got = {r.doc_id: r.component_id for r in passages.find(frame(spark, texts)).collect()}
    assert got == {i: i - i % 2 for i, _ in texts}


def test_passage_whose_parts_stand_in_others(spark):
    rng = random.Random(4)
    fresh = lambda k: [f"v{rng.randrange(10**9)}" for _ in range(k)]
    texts = []
    for g in range(30):
        own = fresh(60)
        parts = [own[:38], own[22:], own, own[:38], own[22:], own]
        texts += [(10 * g + i, " ".join(fresh(100) + x + fresh(100))) for i, x in enumerate(parts)]
    got = {r.doc_id: r.component_id for r in passages.find(frame(spark, texts)).collect()}
    assert got == {10 * g + i: 10 * g + 2 for g in range(30) for i in (2, 5)}


def test_passages_met_by_seeds_that_many_others_hold(spark):
    rng = random.Random(5)
    fresh = lambda k: [f"v{rng.randrange(10**9)}" for _ in range(k)]
    texts = []
    for g in range(20):
        own = fresh(60)
        one = [*own[:30], "changed", *own[31:]]  # shares seeds with `own` only where the parts below, which hold no passage, come first and just before
        parts = [own[:30], own[31:], own, own[:30], own[31:], one, own[:30], own[31:]]
        texts += [(10 * g + i, " ".join(fresh(100) + x + fresh(100))) for i, x in enumerate(parts)]
    got = {r.doc_id: r.component_id for r in passages.find(frame(spark, texts)).collect()}
    assert got == {10 * g + i: 10 * g + 2 for g in range(20) for i in (2, 5)}


def test_passages_below_the_similarity_are_none(spark):
    rng = random.Random(9)
    fresh = lambda k: [f"v{rng.randrange(10**9)}" for _ in range(k)]
    texts = []
    for pair in range(40):
        own = fresh(30)
        texts += [(2 * pair + side, " ".join(fresh(100) + own + fresh(100))) for side in range(2)]
    assert passages.find(frame(spark, texts)).count() == 0


def test_passage_cases(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = frame(spark, [(1, None), (2, ""), (3, "short text"), (4, long), (4, long), (None, long), (5, "Zed " + long.upper())])
    got = {r.doc_id: (r.component_id, r.n_repeated_words >= 64) for r in passages.find(rows).collect()}
    assert got == {4: (4, True), 5: (4, True)}
    assert passages.find(rows.limit(0)).count() == 0


def test_a_worker_gives_back_what_it_no_longer_holds():
    resident = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
    last = []

    def rows(batches):
        held = [bytes(1000) for _ in range(300_000)]
        last.append(bytes(1000))  # what lies behind keeps the allocator from giving back by itself
        yield len(held)

    before = resident()
    assert list(released(rows)(iter([]))) == [300_000]
    assert resident() - before < 150 << 20
