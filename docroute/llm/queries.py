"""The registered queries of the operators, and the SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.llm.common import load
from docroute.llm import ann, centroids, chat, linededup, mixing, passages, pieces, ppm, repetition, simhash, toxicity, whitening
from docroute.llm.packing import pack

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.group(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


@query("op2_passages")
def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that share near-duplicate passages, where, and their class."""
    return passages.find(load(spark, sf_dir, "documents"))


@query("op3_ann")
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return ann.nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_linededup", linededup.ORACLE_SQL)
def op4_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs."""
    out = linededup.dedup(load(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_deleted").alias("n_deleted"), "text")


def crc_of(col: str) -> Column:
    """CRC-32 of a number as text; of a null, as of an empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


@query("op5_ppm")
def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability, learned from four fifths of them, and that of a unigram word model."""
    return ppm.score(load(spark, sf_dir, "documents"), crc_of("doc_id") % 5 == 1)


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels of four fifths of them."""
    docs = load(spark, sf_dir, "documents")
    held = crc_of("doc_id") % 5 == 0
    found = toxicity.score(docs, toxicity.model(docs, load(spark, sf_dir, "labels"), ~held))
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op7_repetition")
def op7_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the verdict of every document."""
    return repetition.judge(load(spark, sf_dir, "documents"))


@query("op8_chat", chat.ORACLE_SQL)
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, and what it replies to."""
    found = chat.conversations(load(spark, sf_dir, "conversations"))
    return found.withColumn("reply_to", F.coalesce("reply_to", F.lit(-1)))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as binary-length sequences."""
    return pack(load(spark, sf_dir, "documents"), tokenizer_path())


@query("op10_mixing", mixing.oracle_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    taken, _ = mixing.mix(load(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def pieces_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_sentencepiece")
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and their decoding, as digests."""
    found = pieces.encode(load(spark, sf_dir, "documents"), pieces_path())
    n = (F.octet_length("ids") / 4).cast("long")
    return found.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first eight whitened components; `deviation` is null where a long cannot hold `deviation_text`."""
    found = whitening.whiten(load(spark, sf_dir, "embeddings"))
    each = found.select("vec_id", "n", F.col("deviation").alias("deviation_text"), F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "z"), "identity_error")
    return each.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", F.col("deviation_text").try_cast("long").alias("deviation"), "z.whitened", "z.explained", "identity_error", "deviation_text")


@query("op13_centroids", centroids.oracle_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds from sixteen chosen vectors."""
    found = centroids.with_inertia(*centroids.cluster(load(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
