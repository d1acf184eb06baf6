"""Approximate nearest neighbours by inner product: a hash-prefix forest over sorted arrays of long hash strings.

A tree gives every vector a string of 64 bits, the sides of 64 random planes through the origin. So that near means a
large inner product, a vector counts as scaled by the largest length, with one more coordinate that makes it a unit
vector; a query is made a unit vector with 0 there. Each tree is its strings in sorted order, range-partitioned over
tasks: a query descends to its place, next to the strings of its longest common prefix, and ascends, in all trees by
the same number of strings: those around the place come in order of shorter and shorter common prefixes. The exact
inner products with these are taken in double precision where they meet, the best of each tree are sent on, and the
best of all trees are the result.

Equal vectors are one entry, with the few smallest ids that a result can hold, so a vector repeated in a third of all
rows does not fill the windows. A query near the border of two tasks sees one side less of one tree.

The index holds each vector TREES times. Every row is indexed; nothing is fitted but the largest length.

Cases: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without a
vec_id; vectors of different length are never compared; rows that repeat an id with its vector count once; with fewer
candidates than asked for all of them are returned; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch

TREES, BITS = 32, 64
#: Strings that a query ascends over on either side, in each tree.
REACH = 1024
#: Entries of a tree in one task, about.
TASK = 1 << 18
CHUNK = 1 << 12
SEED = 20


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _planes(tree: int, dim: int) -> np.ndarray:
    return np.random.default_rng((SEED, tree, dim)).standard_normal((dim + 1, BITS))


def _strings(vectors: np.ndarray, last: np.ndarray, tree: int) -> np.ndarray:
    """Hash strings as numbers whose signed order is the strings' order."""
    planes = _planes(tree, vectors.shape[1])
    bits = vectors @ planes[:-1] + last[:, None] * planes[-1] > 0
    return (np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def forest(entries: DataFrame, longest: float, trees: int) -> DataFrame:
    """(dim, tree, string, query, id, vector): the entries (id, vector, query) under their string in each tree."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, query = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            flat, ends = batch.column(1).flatten().to_numpy(), batch.column(1).value_lengths().to_numpy()
            starts = np.cumsum(ends) - ends
            for dim in np.unique(ends):
                for at in np.array_split(np.flatnonzero(ends == dim), max(1, int(np.count_nonzero(ends == dim)) // 2000)):
                    x = flat[starts[at][:, None] + np.arange(dim)]
                    length = np.linalg.norm(x, axis=1)
                    unit = x / np.where(query[at], length, longest)[:, None]
                    last = np.where(query[at], 0.0, np.sqrt(np.maximum(0.0, 1 - (length / longest) ** 2)))
                    data = pa.array([v.tobytes() for v in x], pa.binary())
                    for tree in range(trees):
                        columns = [np.full(len(at), dim, np.int32), np.full(len(at), tree, np.int32), _strings(unit, last, tree), query[at], ids[at]]
                        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), data], ["dim", "tree", "string", "query", "id", "vector"])

    return entries.select("id", "vector", "query").mapInArrow(rows, "dim int, tree int, string long, query boolean, id long, vector binary")


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, smaller ids first among equal ones."""
    if len(scores) > most:
        floor = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= floor)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def walk(sorted_rows: DataFrame, most: int, reach: int) -> DataFrame:
    """(query_id, id, score): for each query and tree the best `most` among `reach` strings on either side."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        part, ids, vectors, queries = None, np.zeros(0, np.int64), np.zeros((0, 0)), []

        def answer(final: bool) -> None:
            """Queries whose window is complete; then forget the entries that no later window holds."""
            nonlocal ids, vectors, queries
            ready = [q for q in queries if final or q[0] + reach <= len(ids)]
            queries = [] if final else queries[len(ready) :]
            for s in range(0, len(ready), 64):
                some = ready[s : s + 64]
                lo, hi = max(0, some[0][0] - reach), min(len(ids), some[-1][0] + reach)
                if lo >= hi:
                    continue
                scores = np.stack([q[2] for q in some]) @ vectors[lo:hi].T
                for (place, query_id, _), own in zip(some, scores):
                    a, b = max(0, place - reach), min(len(ids), place + reach)
                    at = _best(own[a - lo : b - lo], ids[a:b], most)
                    out[0].append(np.full(len(at), query_id))
                    out[1].append(ids[a:b][at])
                    out[2].append(own[a - lo : b - lo][at])
            drop = max(0, (queries[0][0] if queries else len(ids)) - reach)
            ids, vectors, queries = ids[drop:], vectors[drop:], [(q[0] - drop, *q[1:]) for q in queries]

        def flush() -> pa.RecordBatch:
            columns = [np.concatenate(c) if c else np.zeros(0) for c in out]
            out[:] = [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "id", "score"])

        for batch in batches:
            dims, trees = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (dims[1:] != dims[:-1]) | (trees[1:] != trees[:-1])))) if len(dims) else []
            for s, e in zip(edges, [*edges[1:], len(dims)]):
                if (dims[s], trees[s]) != part:
                    answer(True)
                    part, ids, vectors = (dims[s], trees[s]), np.zeros(0, np.int64), np.zeros((0, dims[s]))
                for c in range(s, e, CHUNK):
                    n = min(e, c + CHUNK) - c
                    query, own = batch.column(3).slice(c, n).to_numpy(zero_copy_only=False).astype(bool), batch.column(4).slice(c, n).to_numpy()
                    x = np.frombuffer(b"".join(batch.column(5).slice(c, n).to_pylist()), np.float64).reshape(n, dims[s])
                    place = len(ids) + np.cumsum(~query)
                    queries += [(int(place[i]), int(own[i]), x[i]) for i in np.flatnonzero(query)]
                    ids, vectors = np.concatenate((ids, own[~query])), np.concatenate((vectors, x[~query]))
                    answer(False)
            yield flush()
        answer(True)
        yield flush()

    return sorted_rows.mapInArrow(rows, "query_id long, id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, reach: int = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each query in (vec_id, embedding)."""
    scratch = Scratch(vectors.sparkSession, "ann")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    rows = rows.select("vec_id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"))
    # one entry for equal vectors; a result holds k of their ids at most, and one more is the query's own
    by_id = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = rows.select("vec_id", "h1", "h2").distinct().withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
    few = few.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    one = rows.join(few.select("h1", "h2", "id"), ["h1", "h2"]).where("vec_id = id").dropDuplicates(["h1", "h2"])
    asked = rows.where(is_query).select("vec_id", "h1", "h2").distinct()
    queries = scratch.write(asked.join(few.select("h1", "h2", "id"), ["h1", "h2"]), "queries")
    few = scratch.write(few, "entries")
    # An id may have several vectors, and then be the smallest of more than one: entries go by their own number.
    entry = F.xxhash64("h1", "h2")
    one = scratch.write(one.select("id", entry.alias("entry"), "vector"), "vectors")
    facts = one.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()
    n, longest = facts[0], facts[1] or 1.0

    wanted = queries.select(entry.alias("entry")).distinct()
    items = one.select(F.col("entry").alias("id"), "vector", F.lit(False).alias("query"))
    both = items.union(one.join(wanted, "entry").select(F.col("entry").alias("id"), "vector", F.lit(True).alias("query")))
    parts = max(trees, -(-n * trees // TASK))
    order = ["dim", "tree", "string", "query", "id"]
    found = walk(forest(both, longest, trees).repartitionByRange(parts, *order).sortWithinPartitions(*order), k + 1, reach)
    # a query's own vector, which its equals share, is always met
    own = one.join(wanted, "entry").select(F.col("entry").alias("query_id"), F.col("entry").alias("id"), F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x).alias("score"))
    met = scratch.write(found.union(own).groupBy("query_id", "id").agg(F.max("score").alias("score")), "met")
    members = met.join(few.select(entry.alias("id"), "ids"), "id").select("query_id", "score", F.explode("ids").alias("vec_id"))
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = members.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k + 1)
    lists = best.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("best"))
    each = queries.select(F.col("vec_id").alias("asked"), entry.alias("query_id")).join(lists, "query_id")
    rest = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("asked")), 1, k)
    each = each.select(F.col("asked").alias("query_id"), F.posexplode(rest).alias("pos", "x"))
    return each.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
