"""Toxicity by a factorization machine over hashed terms.

A document is scored by pieces of WINDOW words and takes the worst piece, so a passage is not lost among thousands of
clean words. A piece is the set of its hashed words. The machine adds a bias, a weight per term, and for each pair of
terms the inner product of their factor vectors over the number of terms, so that an insult beside a mention of a group
can weigh more than either.

It is fitted on at most SAMPLE labelled documents (those of the smallest hashes, half of them toxic where there are as
many), on the log loss, with weights that stay 0 until the evidence passes a floor, in one task: the sample and the tables are of fixed size. A first fit on whole
documents picks each toxic document's worst piece; the next ones learn from those pieces. Every piece is read; those of
a long document weigh as much as PIECES together. A line through the sampled documents' margins then turns a margin into
a chance; each class weighs there as many times as its labels were sampled, so chances follow the class share of all
labels, not that of the sample.

Cases: null and empty texts are scored from the bias alone; a null doc_id counts as '' for the fold; a document with
several labels is toxic if one of them is; without labels every score is 0.5; repeated rows are scored each; an empty
table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import text_of

BITS, FACTORS = 18, 4
SAMPLE = 8_000
#: Sampled documents that a term is in at least; others are no evidence and not read.
LEAST = 5
WINDOW, STEP = 128, 96
#: Pieces that those of a longer document weigh as much as.
PIECES = 8
EPOCHS = 4
#: Steps of weights and factors, the sum of slopes below which a term's weight stays 0, and the factors' shrinkage.
RATE, FACTOR_RATE, FLOOR, DECAY = 0.3, 0.03, 4.0, 1e-3
SEED = 6
_STRIP = b".,;:!?\"'()[]{}<>*_-|#"


def pieces(text: str, window: int = WINDOW, step: int = STEP) -> list[np.ndarray]:
    """The different hashed terms of each run of `window` words, A-Z lower-cased, punctuation at the ends stripped."""
    from zlib import crc32

    mask = (1 << BITS) - 1
    terms = np.fromiter((crc32(w.strip(_STRIP)) & mask for w in text.encode().lower().split()), np.int64)
    ends = range(0, max(1, len(terms) - window + step), step)
    return [np.unique(terms[s : s + window]) for s in ends]


class Machine:
    """margin = bias + sum of weights + sum over pairs of inner products / number of terms; chance = sigmoid(slope * margin + shift)."""

    def __init__(self, bias: float = 0.0, weight: np.ndarray | None = None, factor: np.ndarray | None = None, slope: float = 1.0, shift: float = 0.0):
        n = 1 << BITS
        self.bias, self.slope, self.shift = bias, slope, shift
        self.weight = np.zeros(n, np.float32) if weight is None else weight
        self.factor = np.random.default_rng(SEED).normal(0, 0.01, (n, FACTORS)).astype(np.float32) if factor is None else factor

    def known(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        """The terms that the fit has seen often enough."""
        return [s[self.factor[s, 0] != 0] for s in sets]

    def worst(self, sets: list[np.ndarray]) -> float:
        return float(self.margins(self.known(sets)).max())

    def chances(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))

    def calibrate(self, margins: np.ndarray, labels: np.ndarray, stands_for: tuple[float, float] = (1.0, 1.0)) -> None:
        """Slope and shift by Newton's steps on the log loss, with a little shrinkage; a document of class y counts stands_for[y] times."""
        times = np.where(np.asarray(labels) > 0, stands_for[1], stands_for[0])
        times = times * len(times) / times.sum()  # the sample's size is what the evidence is
        x, at = np.stack((margins, np.ones(len(margins))), 1), np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            gradient = x.T @ (times * (p - labels)) + 0.1 * (at - [1.0, 0.0])
            at = at - np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), gradient)
        self.slope, self.shift = map(float, at)

    def margins(self, sets: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(s) for s in sets])
        out = np.full(len(sets), self.bias)
        some = np.flatnonzero(sizes)
        if len(some):
            terms = np.concatenate([sets[i] for i in some])
            at = np.cumsum(sizes[some]) - sizes[some]
            v = self.factor[terms]
            total, squares = np.add.reduceat(v, at), np.add.reduceat(v * v, at)
            n = sizes[some]
            out[some] += np.add.reduceat(self.weight[terms], at) + ((total**2 - squares).sum(1) / (2 * n))
        return out

    def fit(self, sets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray | None = None, epochs: int = EPOCHS, batch: int = 16) -> None:
        weights = np.ones(len(sets)) if weights is None else weights
        rng = np.random.default_rng(SEED)
        gw, z, gv, gb = np.zeros(self.weight.shape), np.zeros(self.weight.shape), np.full(self.factor.shape, 1e-6, np.float32), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(sets))
            for s in range(0, len(order), batch):
                some = order[s : s + batch]
                own = [sets[i] for i in some]
                slope = (1 / (1 + np.exp(-self.margins(own))) - labels[some]) * weights[some]
                gb += float((slope.mean()) ** 2)
                self.bias -= RATE * float(slope.mean()) / gb**0.5
                sizes = np.array([len(x) for x in own])
                if not sizes.sum():
                    continue
                terms, n = np.concatenate(own), np.repeat(np.maximum(sizes, 1), sizes)
                v = self.factor[terms]
                row = np.repeat(np.arange(len(own)), sizes)
                total = np.zeros((len(own), FACTORS), np.float32)
                np.add.at(total, row, v)
                each = np.repeat(slope, sizes).astype(np.float32)
                ids, back = np.unique(terms, return_inverse=True)
                dw, dv = np.zeros(len(ids), np.float32), np.zeros((len(ids), FACTORS), np.float32)
                np.add.at(dw, back, each)
                np.add.at(dv, back, (each / n)[:, None] * (total[row] - v))
                dv += DECAY * self.factor[ids]
                gv[ids] += dv**2
                self.factor[ids] -= FACTOR_RATE * dv / np.sqrt(gv[ids])
                grown = gw[ids] + dw**2
                z[ids] += dw - (np.sqrt(grown) - np.sqrt(gw[ids])) / RATE * self.weight[ids]
                gw[ids] = grown
                past = np.sign(z[ids]) * np.maximum(np.abs(z[ids]) - FLOOR, 0)
                self.weight[ids] = -past * RATE / (1 + np.sqrt(grown))


def train(texts: list[str], labels: np.ndarray, rounds: int = 3, stands_for: tuple[float, float] = (1.0, 1.0)) -> Machine:
    """First on all pieces of clean documents and all of toxic ones, then on the worst piece of each toxic one."""
    parts = [pieces(t) for t in texts]
    times = np.zeros(1 << BITS, np.int64)
    for own in parts:
        times[np.unique(np.concatenate(own))] += 1
    parts = [[s[times[s] >= LEAST] for s in own] for own in parts]
    machine = Machine()
    machine.factor[times < LEAST] = 0
    for again in range(rounds):
        sets, y, weights = [], [], []
        for own, label in zip(parts, labels):
            if label and again:
                own = [own[int(np.argmax(machine.margins(own)))]]
            sets += own
            y += [label] * len(own)
            weights += [min(1.0, PIECES / len(own))] * len(own)
        if again:
            machine = Machine()
            machine.factor[times < LEAST] = 0
        machine.fit(sets, np.array(y, float), np.array(weights))
    machine.calibrate(np.array([machine.worst(own) for own in parts]), labels, stands_for)
    return machine


def model(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Machine:
    """A machine fitted on the labelled rows of (doc_id, text) where `learn` holds."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    ids = known.where(learn).withColumn("order", F.xxhash64("doc_id"))
    chosen = [r for y in (1, 0) for r in ids.where(F.col("toxic") == y).orderBy("order", "doc_id").limit(sample // 2).collect()]
    total = {r["toxic"]: r["n"] for r in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows
    taken = {y: sum(r["toxic"] == y for r in chosen) for y in (0, 1)}
    stands_for = tuple(total.get(y, 0) / max(1, taken[y]) for y in (0, 1))
    spark = docs.sparkSession
    few = spark.createDataFrame([(r["doc_id"], r["toxic"]) for r in chosen], "doc_id long, toxic int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(few), "doc_id")

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("text", "ascending")])
        got = train(table["text"].to_pylist(), table["toxic"].to_numpy(), stands_for=stands_for)
        numbers = [pa.array([x], pa.float64()) for x in (got.bias, got.slope, got.shift)]
        tables = [pa.array([x.tobytes()], pa.binary()) for x in (got.weight, got.factor)]
        return pa.table([*numbers, *tables], ["bias", "slope", "shift", "weight", "factor"])

    fitted = rows.withColumn("order", F.xxhash64("doc_id")).groupBy(F.lit(0).alias("one")).applyInArrow(fit, "bias double, slope double, shift double, weight binary, factor binary").collect()
    if not fitted:
        return Machine(0.0, factor=np.zeros((1 << BITS, FACTORS), np.float32))
    bias, slope, shift, weight, factor = fitted[0]
    return Machine(bias, np.frombuffer(bytes(weight), np.float32), np.frombuffer(bytes(factor), np.float32).reshape(-1, FACTORS), slope, shift)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score, predicted) of each row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weight, machine.factor, machine.slope, machine.shift))  # of fixed size

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*shared.value)
        for batch in batches:
            scores = own.chances(np.array([own.worst(pieces(t.as_py())) for t in batch.column(1)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(rows, "doc_id long, score double, predicted int")
