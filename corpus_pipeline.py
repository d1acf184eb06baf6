"""Documents to training sequences: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns the rows that it keeps, with the columns of `documents`; the last one
returns the packed pieces. A stage's result is written and read again as the next one's `docs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docroute.llm import linededup, mixing, packing, repetition, simhash
from docroute.llm.common import Scratch, load
from docroute.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counts or their own repetition reject go."""
    return repetition.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut from the texts; no row goes."""
    return linededup.drop_copied_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of binary length, each a sequence."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: The last stage's tokens and the first one's suffix arrays are beyond SQL; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, name)
    return docs
