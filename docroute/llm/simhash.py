"""SimHash near-dedup: fingerprints, a self-join of their binary trie, and the components of its links.

The distinct fingerprints are sorted and cut into blocks, each below one trie node of `bits` bits. Node pairs within the
error budget meet by an equi-join (a node's prefix with up to two bits flipped), and each pair of blocks is traversed
together below its nodes: both halves of one side against both of the other, the differing bit added, a pair dropped
once its errors exceed the budget. A fingerprint has at most 2,080 others within two bits, so the work follows the
number of fingerprints, however large a group of copies is: copies of one fingerprint count once. Each task passes on a
spanning forest of its links, and the components are found from these.

one_of_each() takes the trie's links as candidates, and more than a few bits can tell: near copies of five-word similarity
SIMILAR differ in ten bits or so, which no trie can be searched for. For these it takes min-hashes of the shingle sets in
BANDS bands of ROWS. All candidates are verified on their whole shingle sets. The texts of one band value, or of one trie
component, are first paired with the smallest and the largest of them, in a few orders; then all similar pairs are found
among the texts of a band value or of a trie component that no link has joined yet, by the rarest shingles of each, first
with one text of each shingle.

Cases: a null text is empty; no words give fingerprint zero, linked like any other; one or two words are one shingle; a
null doc_id takes part but does not name a component unless it is alone; repeated rows share a component; an empty table
gives no row; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, components, released, row_hash, small_batches, text_of
from docroute.llm.passages import _mixed, runs_of
from docroute.llm.ppm import _chunks

BUDGET = 2
WIDTH = 3
SEED = 42
#: Fingerprints in a block at most, and those under a trie node that `bits` aims at.
BLOCK, AIM = 1 << 15, 1 << 13
#: Node pairs that are expanded at once.
FRONT = 1 << 17
_SIGN = -(1 << 63)
#: Words of a shingle, and the similarity of shingle sets, of near copies in one_of_each.
KEEP_WIDTH, SIMILAR = 5, 0.8
#: By how much a bound on whole numbers may be lower for errors of floating point.
ROUNDING = 1e-6
#: Min-hashes: a pair of similarity 0.8 agrees in one of 16 bands of 4 with a chance of 0.9998.
BANDS, ROWS = 16, 4
_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(data: bytes, width: int = WIDTH) -> int:
    """Signed 64-bit fingerprint of a text in UTF-8; `bytes.lower` and `bytes.split` know ASCII only, as they should."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()
    if not words:
        return 0
    parts = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, parts, 1 << 14):
        some = words[at : at + (1 << 14) + width - 1]
        shingles = map(b" ".join, zip(*(some[k:] for k in range(width)))) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > parts, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The integer columns `keys`, and the fingerprint of `text`, as `fp`."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py().encode()) for t in batch.column(len(keys))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(found, pa.int64())], [*keys, "fp"])

    texts = docs.select(*[F.col(k).cast("long").alias(k) for k in keys], text_of().alias("text"))
    return texts.mapInArrow(rows, ", ".join(f"{k} long" for k in (*keys, "fp")))


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs within `budget` bits of two sorted arrays of distinct numbers; each pair once if `same`.

    Below 64 - `bits` all of an array share their bits. A node is the range of one prefix; two nodes are expanded together.
    """

    def halves(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        one = np.uint64(1 << bit)
        return np.clip(np.searchsorted(x, (x[lo] & ~(one | (one - np.uint64(1)))) | one), lo, hi)

    start = int(np.bitwise_count((a[:1] ^ b[:1]) >> np.uint64(64 - bits))[0]) if bits and len(a) and len(b) else 0
    zero = np.zeros(1, np.int64)
    work = [(63 - bits, zero, zero + len(a), zero, zero + len(b), zero + start)] if len(a) and len(b) and start <= budget else []
    while work:
        bit, alo, ahi, blo, bhi, err = work.pop()
        if len(alo) > FRONT:
            half = len(alo) // 2
            work += [(bit, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (bit, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        pairs = (ahi - alo) * (bhi - blo)
        small = (pairs <= 4) if bit >= 0 else pairs > 0
        if small.any():
            n, from_a, from_b, wide = pairs[small], alo[small], blo[small], (bhi - blo)[small]
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            i, j = from_a[row] + nth // wide[row], from_b[row] + nth % wide[row]
            near = (np.bitwise_count(a[i] ^ b[j]) <= budget) & ((i < j) if same else True)
            yield i[near], j[near]
        if bit < 0:
            continue
        alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        amid, bmid = halves(a, alo, ahi, bit), halves(b, blo, bhi, bit)
        sides = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1), (amid, ahi, blo, bmid, err + 1)]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*sides))
        keep = (alo < ahi) & (blo < bhi) & (err <= budget) & ((alo <= blo) if same else True)
        if keep.any():
            work.append((bit - 1, *(x[keep] for x in (alo, ahi, blo, bhi, err))))


def forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest node of each node's component."""
    root = np.arange(n)
    for x, y in links:
        while True:
            while (root[root] != root).any():
                root = root[root]
            rx, ry = root[x], root[y]
            apart = rx != ry
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(rx[apart], ry[apart]), np.minimum(rx[apart], ry[apart]))
    return root


def links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Links (a, b) between the distinct numbers in `fp` with the same components as all pairs within `budget` bits."""
    n = distinct.count()
    bits = min(24, max(6, math.ceil(math.log2(max(n, 1) / AIM)))) if n else 6

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)

        def out(x: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.concatenate(([True], x[1:] >> np.uint64(64 - bits) != x[:-1] >> np.uint64(64 - bits))))
            ends = np.append(edges[1:], len(x))
            parts = [(s, min(s + BLOCK, e)) for first, e in zip(edges, ends) for s in range(first, e, BLOCK)]
            columns = [pa.array([int(x[s]) >> (64 - bits) for s, _ in parts], pa.int64()), pa.array([int(x[s]) + _SIGN for s, _ in parts], pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([x[s:e].tobytes() for s, e in parts], pa.binary())], ["node", "least", "data"])

        for batch in batches:
            held = np.concatenate((held, batch.column(0).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)))
            while len(held) > 2 * BLOCK:
                # cut between two nodes, or, where one fills it, after a whole block
                top = held[: 2 * BLOCK] >> np.uint64(64 - bits)
                cut = int(np.flatnonzero(top != top[-1])[-1]) + 1 if top[0] != top[-1] else BLOCK
                yield out(held[:cut])
                held = held[cut:]
        if len(held):
            yield out(held)

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 2]
            for x, y in zip(batch.column(0), batch.column(1)):
                x, y = x.as_py(), y.as_py()
                a, b, same = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), x == y
                pairs = near_pairs(a, b, same, bits, budget)
                both = a if same else np.concatenate((a, b))
                root = forest(len(both), ((i, j if same else j + len(a)) for i, j in pairs))
                linked = np.flatnonzero(root != np.arange(len(root)))
                found.append((both[linked].view(np.int64), both[root[linked]].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], ["a", "b"])

    order = distinct.select(F.col("fp").bitwiseXOR(F.lit(_SIGN)).alias("unsigned"))
    cut = order.repartitionByRange("unsigned").sortWithinPartitions("unsigned").mapInArrow(blocks, "node long, least long, data binary")
    masks = [sum(1 << k for k in some) for m in range(budget + 1) for some in combinations(range(bits), m)]
    there = cut.select(F.explode(F.transform(F.array(*map(F.lit, masks)), lambda m: F.col("node").bitwiseXOR(m))).alias("node"), F.col("least").alias("least_2"), F.col("data").alias("data_2"))
    met = cut.join(there, "node").where("least <= least_2").select("data", "data_2")
    return met.mapInArrow(traverse, "a long, b long")


def _rooted(distinct: DataFrame, scratch: Scratch, budget: int) -> DataFrame:
    """The distinct fingerprints with `root`, which those of one component share."""
    near = scratch.write(links(distinct, budget), "links")
    roots = components(near, scratch).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def group(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(doc_id, fp, component): every row of `docs`, with the smallest doc_id that its fingerprint reaches over links."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write(fingerprints(docs), "fingerprints")
    distinct = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    rooted = scratch.write(_rooted(distinct, scratch, budget), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return prints.join(rooted.join(least, "root").select("fp", "component"), "fp").select("doc_id", "fp", "component")


def shingle_sets(texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """The different hashed shingles of each text; fewer words than a shingle has are one."""
    for part in _chunks(texts, 1):
        words, text = part.words()
        words = words.view(np.uint64)
        bounds = np.searchsorted(text, np.arange(len(part.sizes) + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(runs_of(words[a:b], min(KEEP_WIDTH, b - a))) if b > a else np.zeros(0, np.uint64)


def bands(tokens: np.ndarray) -> np.ndarray:
    """A number for each band of a set's min-hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(tokens), 1 << 12):
        np.minimum(least, ((tokens[at : at + (1 << 12), None] ^ _MULTIPLIERS[0]) * _MULTIPLIERS[1]).min(0), out=least)
    return _mixed((_mixed(least) * _MULTIPLIERS[0]).reshape(BANDS, ROWS).sum(1, dtype=np.uint64))


def similar(near: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets in (fp, tokens) have SIMILAR of all their tokens in common."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True)) if SIMILAR * max(len(x), len(y)) <= min(len(x), len(y)) else 0
                keep.append(both >= SIMILAR * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in "ab":
        near = near.join(sets.select(F.col("fp").alias(side), F.col("tokens").alias(f"of_{side}")), side)
    return near.select("a", "b", "of_a", "of_b").mapInArrow(released(rows), "a long, b long")


def candidates(each: DataFrame, roots: DataFrame, mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of the rows (fp, band, value, size, print) of the groups `mixed` that have not one root: each row and
    both ends of its group in the order of that turn."""
    key = ["band", "value"]
    left = _rooted_rows(each, roots).join(mixed.select(*key), key, "left_semi")
    place = F.struct((F.xxhash64("fp", F.lit(turn)) if turn else F.col("fp")).alias("at"), "fp", "size", "root")
    ends = left.groupBy(*key).agg(F.min(place).alias("low"), F.max(place).alias("high"))
    met = left.join(ends, key).select("fp", "size", "root", F.explode(F.array("low", "high")).alias("end")).where("root <> end.root")
    sized = met.select(F.greatest("fp", "end.fp").alias("a"), F.least("fp", "end.fp").alias("b"), F.col("size").alias("m"), F.col("end.size").alias("n"))
    return sized.where(F.greatest("m", "n") * SIMILAR <= F.least("m", "n")).select("a", "b").distinct()


def rare_tokens(sized: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, rank, fp, size): the rarest tokens of the sets (fp, tokens), with sizes from (fp, size).

    All tokens have one order, the commonest first, and a rank in it among their set's. Sets of m and n tokens that are
    similar have at least SIMILAR / (1 + SIMILAR) * (m + n) in common, so the rarest of these has that rank in both at least.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp, tokens in zip(*batch.columns):
                x = np.frombuffer(tokens.as_buffer(), np.uint32).astype(np.int64)
                for at in range(0, len(x), 1 << 16):
                    part = x[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), fp.as_py())), pa.array(part)], ["fp", "token"])

    each = sets.select("fp", "tokens").mapInArrow(rows, "fp long, token long")
    often = each.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    commonest_first = Window.partitionBy("fp").orderBy(F.desc("n"), F.desc("token"))
    ranked = each.join(often, "token").withColumn("rank", F.row_number().over(commonest_first)).join(sized, "fp")
    return ranked.where(F.col("rank") >= SIMILAR * F.col("size") - ROUNDING).select("token", "rank", "fp", "size")


def rare_pairs(rare: DataFrame, roots: DataFrame, hubs: bool) -> DataFrame:
    """Pairs (a, b) of two roots of the sets that share a row's token in (token, rank, fp, size) at a rank that similar sets
    have; with `hubs` only those with the set of the token that has the fewest rarer ones."""
    rare = _rooted_rows(rare, roots)
    place = F.struct((F.col("size") - F.col("rank")).alias("rarer"), "rank", "fp", "size", "root")
    of_token = rare.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(place).alias("hub"))
    of_token = of_token.where("low < high").select("token", "hub.rank", "hub.fp", "hub.size", "hub.root")
    other = of_token if hubs else rare.join(of_token, "token", "left_semi")
    enough = SIMILAR / (1 + SIMILAR) * (F.col("x.size") + F.col("y.size")) - ROUNDING
    met = rare.alias("x").join(other.alias("y"), "token").where("x.root <> y.root").where(F.least("x.rank", "y.rank") >= enough)
    met = met if hubs else met.where("x.fp > y.fp")
    return met.select(F.greatest("x.fp", "y.fp").alias("a"), F.least("x.fp", "y.fp").alias("b")).distinct()


def _rooted_rows(each: DataFrame, roots: DataFrame) -> DataFrame:
    return each.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_copies(tagged: DataFrame, distinct: DataFrame, each: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, root) of the sets in (fp, least) that verified links join, other than the smallest; texts are those of the rows least._row.

    Pairs that links have joined already change no component, and are not compared. While turns of few pairs join much of
    what is apart, they go on; the last one takes all similar pairs among the texts that are left, by their rarest tokens.
    """
    spark = tagged.sparkSession
    found = seen = scratch.write(spark.createDataFrame([], "a long, b long"), "none")
    roots, left_before, fill = spark.createDataFrame([], "fp long, root long"), None, distinct.count()

    def verify(near: DataFrame, sets: DataFrame | None, step: str) -> None:
        nonlocal found, seen, roots
        near = scratch.write(near.join(seen, ["a", "b"], "left_anti"), f"candidates_{step}")
        if sets is None:
            sets = whole_sets(tagged, distinct, near.select(F.col("a").alias("fp")).union(near.select("b")).distinct(), scratch, f"sets_{step}")
        with small_batches(spark, 200):
            found = scratch.write(found.union(similar(near, sets)), f"links_{step}")
        roots = components(found, Scratch(spark, "simhash-roots")).withColumnRenamed("node", "fp")
        seen = seen.union(near)

    for turn in count():
        sizes = _rooted_rows(each, roots).groupBy("band", "value", "root").agg(F.count("*").cast("double").alias("n")).groupBy("band", "value")
        mixed = scratch.write(sizes.agg(F.count("*").alias("roots"), ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")).where("roots > 1"), f"mixed_{turn}")
        left = mixed.agg(F.sum("pairs")).first()[0]
        if not left:
            return roots
        if turn > 0 and (left <= fill or left > left_before / 2):
            sized = each.join(mixed, ["band", "value"], "left_semi").select("fp", "size").distinct()
            sets = whole_sets(tagged, distinct, sized, scratch, "sets")
            rare = scratch.write(rare_tokens(sized, sets), "rare")
            for hubs in (True, False):
                verify(rare_pairs(rare, roots, hubs), sets, "hubs" if hubs else "all")
            scratch.drop("sets")
            return roots
        verify(candidates(each, roots, mixed, turn), None, str(turn))
        scratch.drop(f"sets_{turn}")
        left_before = left


def whole_sets(tagged: DataFrame, distinct: DataFrame, asked: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(fp, tokens): the different shingles of the whole texts of the sets `fp` that are asked for."""
    needed = asked.select("fp").join(distinct, "fp").select("fp", "least._row")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shingle_sets(t.as_py().encode() for t in batch.column(1))
            sets = [np.unique(x.astype(np.uint32)).tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["fp", "tokens"])

    texts = tagged.select("_row", text_of().alias("text")).join(needed, "_row").dropDuplicates(["_row"])
    with small_batches(tagged.sparkSession, 200):
        return scratch.write(texts.select("fp", "text").mapInArrow(released(rows), "fp long, tokens binary"), name)


def trie_groups(prints: DataFrame, scratch: Scratch) -> DataFrame:
    """The distinct rows of (fp, size, print) with `root`, which those share whose fingerprints the trie's links join."""
    both = scratch.write(prints.select("fp", "size", "print").distinct(), "prints")
    distinct = both.select(F.col("print").alias("fp")).distinct()
    return both.join(_rooted(distinct, Scratch(prints.sparkSession, "simhash-trie"), BUDGET).select(F.col("fp").alias("print"), "root"), "print")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each component of near copies (null first, then by a hash of the row); equal rows count once.

    Near copies are texts of five-word similarity SIMILAR that the trie or a band brings together. A set's first row is an
    aggregate, so no task sees all copies of a text.
    """
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    tagged = docs.withColumn("_row", row_hash(docs))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().encode() for t in batch.column(2)]
            prints, sizes, found = [], [], []
            for tokens in shingle_sets(iter(texts)):
                prints.append(int(_mixed(tokens).sum(dtype=np.uint64).view(np.int64)))
                sizes.append(len(np.unique(tokens.astype(np.uint32))))
                found.append(bands(tokens).view(np.int64) if len(tokens) else np.zeros(0, np.int64))
            columns = [pa.array(prints, pa.int64()), pa.array([fingerprint(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["_doc", "_row", "fp", "print", "size", "bands"])

    texts = tagged.select(F.col("doc_id").cast("long").alias("_doc"), "_row", text_of().alias("text"))
    prints = texts.mapInArrow(released(rows), "_doc long, _row long, fp long, print long, size long, bands array<long>")
    # a set may stand with several fingerprints (repeated shingles), and is met by each of them
    with small_batches(docs.sparkSession, 200):
        per_print = scratch.write(prints.groupBy("fp", "print").agg(F.min(F.struct("_doc", "_row")).alias("least"), F.first("size").alias("size"), F.first("bands").alias("bands")), "by_print")
    distinct = scratch.write(per_print.groupBy("fp").agg(F.min("least").alias("least")), "distinct")
    banded = per_print.groupBy("fp", "size").agg(F.first("bands").alias("bands")).select("fp", "size", F.lit(None).cast("long").alias("print"), F.posexplode("bands").alias("band", "value"))
    of_trie = trie_groups(per_print, scratch).select("fp", "size", "print", F.lit(BANDS).alias("band"), F.col("root").alias("value"))
    each = scratch.write(banded.unionByName(of_trie), "each")
    roots = near_copies(tagged, distinct, each, scratch)
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("least").alias("x")).select("x._row")
    return tagged.join(scratch.write(first, "kept"), "_row").dropDuplicates(["_row"]).select(*docs.columns)
