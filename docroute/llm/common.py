"""Helpers shared by the operators: reading tables, and tables written to the shared folder to cut lineage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def n_words(col: Column) -> Column:
    return F.regexp_count(col, F.lit(WORD)).cast("long")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Fewer rows than usual in the batches between the JVM and Python, for jobs that run meanwhile and hold long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`rows` for mapInArrow, at whose end the worker gives freed memory back: workers stay for later stages beside the JVM's heap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return run


class Scratch:
    """Parquet tables under the shared folder named by `spark.checkpoint.dir` (a temporary folder where that is unset).

    A written table replaces the plan that made it, so a lost executor repeats one step, not all. `drop` removes a
    table that later steps no longer read; what a returned DataFrame still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="docroute-llm-")
        self.spark, self.root = spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for n in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def row_hash(df: DataFrame) -> Column:
    """One number for rows that are equal in all columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def with_text(df: DataFrame, text: Column) -> DataFrame:
    """`df` with another text, and its length in `n_chars` where that column exists."""
    cols = {"text": text.cast("string")}
    if "n_chars" in df.columns:
        cols["n_chars"] = F.char_length(text).cast(df.schema["n_chars"].dataType)
    return df.withColumns(cols)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of each node of the links (a, b) other than the smallest of its component, its root.

    Large and small stars in turn: each round links neighbours to the smallest node that a node knows, until nothing
    changes. A hub's links are aggregated before the shuffle and never gathered.
    """
    e = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges_0")
    before, step = None, 0
    while True:
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())
        if state == before or not state[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, step = state, step + 1
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least)
        e = scratch.write(small.distinct(), f"edges_{step}")
        scratch.drop(f"edges_{step - 1}")
