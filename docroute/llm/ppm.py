"""LM scoring by prediction by partial matching: byte contexts with escape estimation and symbol exclusion.

A text is coded as its words (A-Z lower-cased) with one space between and an end. The model is the trie of all contexts
of up to ORDER bytes before each symbol of the training texts; ends stand before the start. A symbol that a context has
seen n times has probability (2 n - 1) / 2 N there, N the context's symbols, D its different ones; D / 2 N is the escape
to the next shorter context, where the symbols of the longer one are excluded; below the empty context all symbols left
are equally likely. Contexts that training never saw are passed over.

The trie is a table and never one task's: each input split counts its own grams (a context and a symbol), they are
summed by key, and the sums of shorter grams are sums of longer ones. As the symbols of a longer context are among
those of its suffix, what exclusion takes away is one number per context, so a gram's probability takes one join per
order it escapes. The probabilities go back to the splits that hold the gram, where the texts meet them, so that a
split's own different grams are shuffled and never its every byte. The list of splits of a gram is bounded by their number.

Base: a unigram word model with half a count added. Words go by a 64-bit hash.

Cases: a null text is empty, and is one end; a null doc_id counts as '' for the fold; repeated rows are trained on and
scored each; without training texts every symbol has the uniform probability; an empty table gives no row; other
columns are not read. A task holds one split's texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, small_batches, text_of

ORDER = 5
SYMBOLS = 257
#: Bytes of text that are counted or scored at once.
CHUNK = 1 << 19
_END = 0xFF
_END_WORD = 0x656E64


class Joined:
    """Texts one after another, each with its end, and the starts of contexts before it."""

    def __init__(self, texts: list[bytes], order: int):
        texts = [b" ".join(t.lower().split()) for t in texts]  # on bytes both know ASCII only
        pad = bytes([_END]) * order
        self.bytes = np.frombuffer(b"".join(x for t in texts for x in (pad, t, bytes([_END]))), np.uint8)
        self.sizes = np.array([len(t) + 1 for t in texts])
        self.starts = np.cumsum(self.sizes + order) - self.sizes
        self.order = order

    def grams(self) -> np.ndarray:
        """The gram that ends at each symbol, text by text."""
        key = np.zeros(len(self.bytes) - self.order, np.uint64)
        for k in range(self.order + 1):
            key = (key << np.uint64(8)) | self.bytes[k : k + len(key)]
        skip = np.repeat(self.starts - self.order - (np.cumsum(self.sizes) - self.sizes), self.sizes)
        return key[np.arange(len(skip)) + skip].view(np.int64)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and the text it is in."""
        inside = (self.bytes != 32) & (self.bytes != _END)
        edge = np.diff(inside.astype(np.int8), prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # the last symbol is no word's
        power, inverse = _powers(len(self.bytes))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * power)))
        value = (total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (value ^ (value >> np.uint64(32))).view(np.int64), np.searchsorted(self.starts, start, "right") - 1


_BASE = 0x9E3779B97F4A7C15
_TABLES = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2 ** 64."""
    while len(_TABLES[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            have = _TABLES[k]
            _TABLES[k] = np.concatenate((have, have * np.uint64(pow(base, len(have), 1 << 64))))
    return [t[:n] for t in _TABLES]


def _chunks(texts: Iterator[bytes], order: int) -> Iterator[Joined]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t) + order + 1
        if size >= CHUNK:
            yield Joined(held, order)
            held, size = [], 0
    if held:
        yield Joined(held, order)


def _release() -> None:
    """Give freed memory back, as the worker lives on beside the next task's."""
    pa.default_memory_pool().release_unused()


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(k)), bool), k[1:] != k[:-1])))
    return k[first], np.add.reduceat(n, first) if len(first) else n


def gather(docs: DataFrame, order: int) -> DataFrame:
    """(kind, key, split, n) of (split, held_out, text): how often a split's training texts have each of its grams (kind 0) and words (1)."""
    names = ["kind", "key", "split", "n"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: list[tuple[list, list]] = [([], []), ([], [])]
        split = None
        for batch in batches:
            if not batch.num_rows:
                continue
            split = batch.column(0)[0].as_py()
            for held in (False, True):
                texts = (t.as_py().encode() for t, h in zip(batch.column(2), batch.column(1)) if h.as_py() == held)
                for part in _chunks(texts, order):
                    ends = np.full(len(part.sizes), _END_WORD)
                    for kind, found in enumerate((part.grams(), np.concatenate((part.words()[0], ends)))):
                        keys, counts = np.unique(found, return_counts=True)
                        sums[kind][0].append(keys)
                        sums[kind][1].append(counts * (not held))
            for kind, (keys, counts) in enumerate(sums):
                if len(keys) > 1 and sum(map(len, keys[1:])) > len(keys[0]):
                    k, n = _summed(keys, counts)
                    sums[kind] = ([k], [n])
        for kind, (keys, counts) in enumerate(sums):
            if keys:
                k, n = _summed(keys, counts)
                for at in range(0, len(k), 1 << 17):
                    x, y = k[at : at + (1 << 17)], n[at : at + (1 << 17)]
                    columns = [np.full(len(x), kind, np.int32), x, np.full(len(x), split, np.int32), y.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names)
        _release()

    return docs.select("split", "held_out", "text").mapInArrow(rows, "kind int, key long, split int, n long")


def _suffix(key: Column, k: int) -> Column:
    """The last k + 1 bytes: a gram of order k."""
    return key.bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))


def _context(key: Column) -> Column:
    return F.shiftrightunsigned(key, 8)


def probabilities(grams: DataFrame, scratch: Scratch, order: int) -> DataFrame:
    """`value`, the log10 probability of each gram in (key, n, splits); n is 0 for those that training does not have."""
    seen = grams.where("n > 0")
    within = Window.partitionBy(_context(F.col("key")))
    known = seen.select("key", "splits", F.log10((2 * F.col("n") - 1) / (2 * F.sum("n").over(within))).alias("value"))

    counts = {order: seen.select("key", "n")}
    for k in range(order - 1, -1, -1):
        counts[k] = scratch.write(counts[k + 1].groupBy(_suffix(F.col("key"), k).alias("key")).agg(F.sum("n").alias("n")), f"order_{k}")
    todo = scratch.write(grams.where("n = 0").select("key", "splits"), "unseen")
    rest = todo.withColumns({"value": F.lit(0.0), "done": F.lit(False), "gone": F.lit(0).cast("long"), "out": F.lit(0).cast("long")})
    for k in range(order, -1, -1):
        # what is below these contexts, and how much of it stays below the next shorter ones
        asked = todo.select(_context(_suffix(F.col("key"), k)).alias("context")).distinct()
        own = counts[k].withColumn("context", _context(F.col("key"))).join(asked, "context", "left_semi")
        if k:
            lower = counts[k - 1].select(F.col("key").alias("short"), F.col("n").alias("n_short"))
            own = own.withColumn("short", _suffix(F.col("key"), k - 1)).join(lower, "short")
        else:
            own = own.withColumn("n_short", F.lit(0).cast("long"))
        node = own.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("n_short").alias("short_total"))
        here = counts[k].select(F.col("key").alias("gram"), F.col("n").alias("own"))
        rest = rest.withColumns({"gram": _suffix(F.col("key"), k), "context": _context(_suffix(F.col("key"), k))})
        rest = rest.join(node, "context", "left").join(here, "gram", "left")
        left, kinds = F.col("total") - F.col("gone"), F.col("kinds") - F.col("out")
        met = F.col("total").isNotNull() & ~F.col("done")
        step = F.when(met & F.col("own").isNotNull(), F.log10((2 * F.col("own") - 1) / (2 * left))).when(met & (kinds > 0), F.log10(kinds / (2 * left))).otherwise(0.0)
        rest = rest.select(
            "key", "splits", (F.col("value") + step).alias("value"), (F.col("done") | F.col("own").isNotNull()).alias("done"),
            F.coalesce("short_total", F.lit(0)).alias("gone"), F.coalesce("kinds", F.lit(0)).alias("out"),
        )
    last = F.when(F.col("done"), 0.0).otherwise(-F.log10(F.lit(SYMBOLS) - F.col("out")))
    return known.unionByName(rest.select("key", "splits", (F.col("value") + last).alias("value")))


class _Lookup:
    """Places of keys in a sorted array, by a hash table with the sorted array behind it."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.shift = keys, np.uint64(64 - max(4, int(len(keys) * 4).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.table[self._slot(keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(_BASE)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.table[self._slot(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        if len(other):
            at[other] = np.searchsorted(self.keys, keys[other])
            if (self.keys[np.minimum(at[other], len(self.keys) - 1)] != keys[other]).any():
                raise ValueError("a split's texts are not those that were counted")
        return at


def score(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "ppm")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), text_of().alias("text"), F.spark_partition_id().alias("split"))
    counted = gather(texts, order).groupBy("kind", "key").agg(F.sum("n").alias("n"), F.collect_list("split").alias("splits"))
    with small_batches(docs.sparkSession):
        model = scratch.write(counted, "counts")
    words = model.where("kind = 1")
    train, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    grams = probabilities(model.where("kind = 0").select("key", "n", "splits"), scratch, order).withColumn("kind", F.lit(0))
    values = grams.unionByName(words.select("kind", "key", "splits", F.col("n").cast("double").alias("value")))
    values = values.select(F.explode("splits").alias("split"), "kind", "key", "value")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in schema.split(", ")]

    def sorted_values(table: pa.Table, kind: int) -> tuple[_Lookup, np.ndarray]:
        own = table.filter(pc.equal(table["kind"], kind))
        keys = own["key"].to_numpy()
        by = np.argsort(keys)
        return _Lookup(keys[by]), own["value"].to_numpy()[by]

    def rows(texts: pa.Table, table: pa.Table) -> pa.Table:
        (gram_at, gram_value), (word_at, word_count) = sorted_values(table, 0), sorted_values(table, 1)
        base = np.log10((word_count + 0.5) / (train + 0.5 * (kinds + 1)))
        end = word_at(np.array([_END_WORD]))[0]
        found: list[list[np.ndarray]] = [[], [], [], []]
        for part in _chunks((t.as_py().encode() for t in texts["text"]), order):
            value = gram_value[gram_at(part.grams())]
            hashes, text = part.words()
            at, n = word_at(hashes), len(part.sizes)
            found[0].append(np.bincount(text, minlength=n) + 1)
            found[1].append(np.bincount(text, word_count[at] > 0, n).astype(np.int64) + int(word_count[end] > 0))
            found[2].append(np.bincount(text, base[at], n) + base[end])
            found[3].append(np.add.reduceat(value, np.cumsum(part.sizes) - part.sizes))
        tokens, known, bases, scores = (np.concatenate(x) if x else np.zeros(0) for x in found)
        columns = [texts["doc_id"], texts["held_out"], tokens, known, np.full(len(tokens), train), bases, scores]
        return pa.table([pa.chunked_array([pa.array(c, t)]) if isinstance(c, np.ndarray) else c for c, t in zip(columns, types)], names)

    with small_batches(docs.sparkSession):
        scored = scratch.write(texts.groupBy("split").cogroup(values.groupBy("split")).applyInArrow(rows, schema), "scored")
    scratch.drop("counts", "unseen", *(f"order_{k}" for k in range(order)))
    return scored
