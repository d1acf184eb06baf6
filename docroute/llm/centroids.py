"""Centroid clustering over zone maps: vectors in Hilbert order, in blocks with min/max boxes.

Components become integers floor(64 x). A vector's place on a Hilbert curve through all its dimensions orders the
table (range-partitioned over tasks), and runs of BLOCK vectors become blocks that carry the smallest and largest value
of each dimension. In a round, a block's box bounds its distance to each centroid from below and from above: centroids
whose lower bound is past the smallest upper bound can be nearest to none of its vectors. The rest are compared with all
vectors exactly, in integers. Tasks send sums and counts per centroid; the driver holds the centroids alone.

Cases: vectors of another length than asked, null, or with a null or non-finite component take no part; components
beyond +-2^21 count as that (the distances then fit a long); a null vec_id stays, after all others in the choice of
first centroids; rows that repeat count as often as they occur, and of rows with equal ids the smaller vector comes first
in that choice; with fewer vectors than centroids each vector starts one; equal vectors are spread over blocks and tasks; an
empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import Scratch
from docroute.llm.whitening import finite, matrix

SCALE, DIM, CLUSTERS, ROUNDS = 64, 64, 16, 3
#: Vectors of one block, and of one task about.
BLOCK, TASK = 256, 1 << 17
#: Bits of each dimension in the Hilbert order.
LEVELS = 5
_LIMIT = 1 << 27


def hilbert(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve, as byte strings in its order, of integer cells [row, dimension] below 2^bits.

    Skilling's rule: undo the excess turns bit by bit, Gray-code the dimensions, then interleave their bits.
    """
    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    for b in range(bits - 1, 0, -1):
        one, rest = np.uint32(1 << b), np.uint32((1 << b) - 1)
        for i in range(len(x)):
            turn = (x[i] & one) != 0
            swap = np.where(turn, np.uint32(0), (x[0] ^ x[i]) & rest)
            x[0] ^= np.where(turn, rest, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & np.uint32(1 << b), np.uint32((1 << b) - 1), np.uint32(0))
    x ^= turn
    shift = np.arange(bits - 1, -1, -1, dtype=np.uint32)[:, None, None]
    places = np.packbits((x >> shift & 1).astype(np.uint8).reshape(-1, x.shape[1]), axis=0)
    return [p.tobytes() for p in np.ascontiguousarray(places.T)]


def integers(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * SCALE), -_LIMIT, _LIMIT).astype(np.int64)


def blocks(rows: DataFrame, scratch: Scratch, dim: int) -> DataFrame | None:
    """(ids, data, low, high): blocks in Hilbert order with their boxes, written to the shared folder."""
    facts = rows.agg(F.count("*"), F.min(F.array_min("embedding")), F.max(F.array_max("embedding"))).first()
    if not facts[0]:
        return None
    low, high = (int(v) for v in integers(np.array(facts[1:], np.float64)))
    kind = next(t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = integers(matrix(batch.column(1), dim))
            places = hilbert(((y - low) << LEVELS) // (high - low + 1), LEVELS)
            data = [r.tobytes() for r in y.astype(kind)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.binary()), pa.array(data, pa.binary())], ["vec_id", "place", "data"])

    # The row's number parts equal vectors; written once, it stays the same when a task is repeated.
    coded = rows.mapInArrow(code, "vec_id long, place binary, data binary").withColumn("nth", F.monotonically_increasing_id())
    coded = scratch.write(coded, "coded")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.frombuffer(b"".join(batch.column(1).to_pylist()), kind).reshape(-1, dim)
            starts = range(0, len(y), BLOCK)
            parts = [y[s : s + BLOCK] for s in starts]
            columns = [[p.tobytes() for p in parts], [p.min(axis=0).tobytes() for p in parts], [p.max(axis=0).tobytes() for p in parts]]
            ids = pa.ListArray.from_arrays(pa.array([*starts, len(y)], pa.int32()), batch.column(0))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.binary()) for c in columns)], ["ids", "data", "low", "high"])

    parts = max(1, -(-facts[0] // TASK), min(facts[0] // (16 * BLOCK), rows.sparkSession.sparkContext.defaultParallelism))
    ordered = coded.repartitionByRange(int(parts), "place", "nth").sortWithinPartitions("place", "nth").select("vec_id", "data")
    done = scratch.write(ordered.mapInArrow(cut, "ids array<long>, data binary, low binary, high binary").withColumn("item", F.lit(np.dtype(kind).itemsize)), "blocks")
    scratch.drop("coded")
    return done


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that can be nearest to a point of the box, by number."""
    nearest = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    least, most = (nearest * nearest).sum(axis=1), (farthest * farthest).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def distances(y: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances [row, centroid]; products in doubles only where no sum can pass 2^53."""
    top = int(max(np.abs(y).max(initial=0), np.abs(centroids).max(initial=0)))
    kind = np.float64 if 4 * y.shape[1] * top * top < 1 << 53 else np.int64
    a, c = y.astype(kind), centroids.astype(kind)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(ids, vectors, cluster, distance, candidates) of each block."""
    for batch in batches:
        for k in range(batch.num_rows):
            kind = {1: np.int8, 2: np.int16, 4: np.int32}[batch.column(4)[k].as_py()]
            data, low, high = (np.frombuffer(batch.column(c)[k].as_buffer(), kind).astype(np.int64) for c in (1, 2, 3))
            y, near = data.reshape(-1, centroids.shape[1]), candidates(low, high, centroids)
            far = distances(y, centroids[near])
            best = far.argmin(axis=1)  # the first, so the smaller number, of equally near ones
            yield batch.column(0)[k].values, y, near[best], far[np.arange(len(y)), best], len(near)


def _moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floored means, empty ones as they were."""
    k, dim = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)
        for _, y, cluster, _, _ in _assigned(batches, centroids):
            for c in np.unique(cluster):
                mine = y[cluster == c]
                total[c, 0] += len(mine)
                total[c, 1:] += mine.sum(axis=0)
        i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["cluster", "place", "value"])

    out = np.zeros((k, dim + 1), np.int64)
    for r in table.mapInArrow(sums, "cluster int, place int, value long").groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect():
        out[r.cluster, r.place] = r.value
    return np.where(out[:, :1] > 0, out[:, 1:] // np.maximum(out[:, :1], 1), centroids)


def first_hash(vec_id: Column) -> Column:
    return F.sha2(F.concat(F.lit("1:"), vec_id.cast("string")).cast("binary"), 256)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance, n_candidates), final centroids) of (vec_id, embedding).

    `n_candidates` is the number of centroids that the vector's block was compared with.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(finite(F.col("embedding")) & (F.size("embedding") == dim))
    first = rows.orderBy(F.asc_nulls_last(first_hash(F.col("vec_id"))), "embedding").limit(clusters).collect()
    scratch = Scratch(rows.sparkSession, "centroids")
    table = blocks(rows, scratch, dim)
    schema = "vec_id long, cluster int, distance long, n_candidates int"
    if table is None:
        return rows.sparkSession.createDataFrame([], schema), np.zeros((0, dim), np.int64)
    centroids = integers(np.array([r.embedding for r in first]))
    for _ in range(rounds):
        centroids = _moved(table, centroids)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, own, far, near in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.int32()), pa.array(far), pa.array(np.full(len(own), near, np.int32))], ["vec_id", "cluster", "distance", "n_candidates"])

    out = scratch.write(table.mapInArrow(final, schema), "clusters")
    scratch.drop("blocks")
    return out, centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each row with the distances' sums over its cluster and over all, and its centroid's hash: one small row a cluster."""
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    rows = [(c, v, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, v in sums.items()]
    facts = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster")


def oracle_sql() -> str:
    """The same result for DuckDB, with a common table per round."""
    far = "list_sum(list_transform(list_zip(v.y, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS y FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS k, y AS c FROM (SELECT sha256('1:' || vec_id) AS h, y FROM v ORDER BY h LIMIT {CLUSTERS}))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"d{r} AS (SELECT v.rid, min((CAST({far} AS BIGINT), c.k)) AS best FROM v, c{r} c GROUP BY v.rid)")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (SELECT k, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT d.best[2] AS k, unnest(v.y) AS x, generate_subscripts(v.y, 1) AS i FROM v JOIN d{r} d ON d.rid = v.rid) GROUP BY k, i) GROUP BY k),
c{r + 1} AS (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m ON m.k = c.k)""")
    return ",\n".join(steps) + f"""
SELECT v.vec_id, CAST(d.best[2] AS INTEGER) AS cluster, d.best[1] AS distance, CAST(sum(d.best[1]) OVER (PARTITION BY d.best[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(d.best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM v JOIN d{ROUNDS} d ON d.rid = v.rid JOIN c{ROUNDS} c ON c.k = d.best[2]"""
