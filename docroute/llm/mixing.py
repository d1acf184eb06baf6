"""Mixing sources to target weights, by blocks of words: columns and SQL functions only.

The words of a source, its documents in pseudorandom order, form one stream that is cut into blocks of `block` words. A
source's target, as a share of its size, fixes how many blocks the mix takes of it, at most three rounds. All blocks of
the mix fall into output shards of `shard` slots: each shard draws its source counts without putting drawn ones back,
so the counts of a shard are multinomial given that every source reaches its target. The slots of a source, counted
through the shards, run through one pseudorandom permutation of its blocks per round, and the block numbers are joined
with the documents' spans.

The permutations need no memory: in each of a few steps an index stays or swaps with `key - index` (mod n), as a hash of
the two decides, so a slot finds its block alone and reruns agree.

Cases: a null text has size 0, and no block; a null source is a source, the last one; a null doc_id is a document like
any other; repeated rows are documents of their own, next to each other in the stream; an empty table gives no row; no
words at all give targets of 0; other columns are not read. One row per source passes through one task (the order of
the sources fixes their weights); everything else is split by source and bucket, block or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import Scratch, n_words, text_of

BLOCK = 64
SHARD = 1 << 16
ROUNDS = 12
MOST = 3
#: Parts of a source's stream that are laid out on their own: hex digits of a hash.
BUCKET_DIGITS = 3


def _bucket(doc_id: Column) -> Column:
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, BUCKET_DIGITS)


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds source_no, target to (unnamed, name, source_size): shares by weight 1, 2, 3, ..., none above `most` sizes.

    In rising order of size per weight, the sources before the first that its share does not overfill are full.
    """
    by_name, whole = Window.orderBy("unnamed", "name"), Window.partitionBy()
    s = sources.withColumn("source_no", F.row_number().over(by_name) - 1).withColumn("weight", F.col("source_no") % 3 + 1)
    s = s.withColumn("full", F.col("source_size") * most).withColumn("_all", F.sum("source_size").over(whole))
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("_level", (F.col("_all") - F.coalesce(F.sum("full").over(before), F.lit(0))) / F.sum("weight").over(onward))
    fits = F.when(F.col("_level") * F.col("weight") <= F.col("full"), F.struct(F.row_number().over(rising), "_level"))
    s = s.withColumn("_fits", fits).withColumn("_level", F.min("_fits").over(whole)["_level"])
    return s.withColumn("target", F.least(F.col("full").cast("double"), F.col("_level") * F.col("weight"))).drop("_all", "_level", "_fits", "full")


def _swapped(index: Column, n: Column, keys: Column, decides) -> Column:
    """`index` below `n` under the permutation that `keys` (one struct of round and key each) gives."""

    def step(x: Column, k: Column) -> Column:
        y = F.pmod(k["key"] - x, n)
        return F.when(decides(k["round"], F.greatest(x, y)), y).otherwise(x)

    return F.aggregate(keys, index.cast("long"), step)


def _md5_keys(source_no: Column, epoch: Column, n: Column) -> Column:
    def key(r: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit("key"), source_no, epoch, r))
        return F.struct(r.alias("round"), (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % n).alias("key"))

    return F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), key)


def _width(df: DataFrame) -> int:
    """Tasks for few rows that make many: a stated number is not joined into one for their small size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def draw(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """(shard, source_no, n_blocks, first, count): the slots of every source in every shard, `first` of them before it."""
    total = Window.partitionBy()
    start = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    s = sources.withColumn("n_slots", F.sum("uses").over(total)).withColumn("start", F.coalesce(F.sum("uses").over(start), F.lit(0)))
    piece = 1 << 13
    s = s.where("uses > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("uses") - 1).cast("long"), F.lit(piece).cast("long"))).alias("piece"))
    keys = F.transform(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        lambda r: F.struct(r.alias("round"), F.pmod(F.xxhash64(F.lit("shard"), r), F.col("n_slots")).alias("key")),
    )
    s = s.repartition(_width(s), "source_no", "piece").withColumn("keys", keys)
    s = s.select("*", F.explode(F.sequence("piece", F.least(F.col("piece") + piece, F.col("uses")) - 1)).alias("use"))
    slot = _swapped(F.col("start") + F.col("use"), F.col("n_slots"), F.col("keys"), lambda r, hi: F.xxhash64(r, hi) < 0)
    counts = s.groupBy((slot / shard).cast("long").alias("shard"), "source_no", "n_blocks").agg(F.count("*").alias("count"))
    so_far = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum("count").over(so_far), F.lit(0)))


def slots(counts: DataFrame) -> DataFrame:
    """(shard, source_no, nth, block): a row per slot, `nth` of its source over all shards."""
    n, first, last = F.col("n_blocks"), F.col("first"), F.col("first") + F.col("count") - 1
    s = counts.repartition(_width(counts), "shard", "source_no").select(
        "*", F.explode(F.sequence((first / n).cast("long"), (last / n).cast("long"))).alias("epoch")
    )
    s = s.withColumn("keys", _md5_keys(F.col("source_no"), F.col("epoch"), n))
    nth = F.sequence(F.greatest(first, F.col("epoch") * n), F.least(last, F.col("epoch") * n + n - 1))
    s = s.select("*", F.explode(nth).alias("nth"))

    def swaps(r: Column, hi: Column) -> Column:
        return F.md5(F.concat_ws(":", "source_no", "epoch", r, hi)) < "8"

    return s.select("shard", "source_no", "nth", _swapped(F.col("nth") % n, n, F.col("keys"), swaps).alias("block"))


def mix(docs: DataFrame, block: int = BLOCK, shard: int = SHARD, most: int = MOST, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of them, and the mix itself.

    Documents: doc_id, source, size, source_size, target, taken (words), and the columns of `carry`. Mix: shard,
    source_no, nth (order within the shard), doc_id, first_word, n_words: the words of each slot's block, by document.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    d = scratch.write(
        docs.select(
            F.col("doc_id").cast("long"), "source", *carry, F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name"),
            n_words(text_of()).alias("size"), _bucket(F.col("doc_id")).alias("bucket"),
        ),
        "sizes",
    )
    buckets = scratch.write(d.groupBy("unnamed", "name", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    sources = targets(buckets.groupBy("unnamed", "name").agg(F.sum("bucket_size").alias("source_size")), most)
    sources = sources.withColumn("n_blocks", F.ceil(F.col("source_size") / block))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = scratch.write(sources.withColumn("uses", F.floor(share * F.col("n_blocks") + 0.5)), "sources")

    before = Window.partitionBy("unnamed", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    buckets = buckets.join(sources.select("unnamed", "name", "source_no", "source_size", "target"), ["unnamed", "name"])
    within = Window.partitionBy("unnamed", "name", "bucket").orderBy("doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    placed = d.join(buckets, ["unnamed", "name", "bucket"]).withColumn("at", F.col("bucket_start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = scratch.write(placed.select("doc_id", "source", *carry, "size", "source_no", "source_size", "target", "at"), "placed")

    end = F.col("at") + F.col("size")
    spans = placed.where("size > 0").select("*", F.explode(F.sequence((F.col("at") / block).cast("long"), ((end - 1) / block).cast("long"))).alias("block"))
    first = F.greatest("at", F.col("block") * block)
    spans = spans.withColumn("first_word", first - F.col("at")).withColumn("n_words", F.least(end, F.col("block") * block + block) - first)

    picked = scratch.write(slots(draw(sources, shard)), "slots")
    uses = picked.groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    keep = ["doc_id", "source", *carry, "size", "source_size", "target"]
    taken = spans.join(uses, ["source_no", "block"], "left").groupBy(*keep, "source_no", "at").agg(F.sum(F.col("n_words") * F.coalesce("uses", F.lit(0))).alias("taken"))
    documents = taken.select(*keep, "taken").unionByName(placed.where("size = 0").select(*keep, F.lit(0).cast("long").alias("taken")))
    mixed = picked.join(spans, ["source_no", "block"]).select("shard", "source_no", "nth", "doc_id", "first_word", "n_words")
    return documents, mixed


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes its words, in whole copies.

    A document whose words the mix takes 1.4 times has two copies with chance 0.4 and else one, by its hash; one of no
    words has none. Rows equal in all columns have equally many copies.
    """
    row = F.xxhash64(*[F.col(c) for c in docs.columns])
    taken, _ = mix(docs.select("doc_id", "source", "text", row.alias("_row")), carry=("_row",), **how)
    times = taken.where("size > 0").groupBy("_row").agg((F.sum("taken") / F.sum("size")).alias("_times"))
    chance = F.pmod(F.xxhash64(F.lit("copies"), "_row"), F.lit(1 << 20)) / (1 << 20)
    times = times.select("_row", F.floor(F.col("_times") + chance).cast("int").alias("_copies")).where("_copies > 0")
    both = docs.withColumn("_row", row).join(times, "_row")
    return both.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def oracle_sql(block: int = BLOCK, most: int = MOST) -> str:
    """The same result in DuckDB's SQL; the draw by shards does not change which blocks a source's slots reach."""
    steps = "picks_0 AS (SELECT source_no, n_blocks, j // n_blocks AS epoch, j % n_blocks AS x FROM (SELECT source_no, n_blocks, unnest(range(uses)) AS j FROM planned))"
    for r in range(1, ROUNDS + 1):
        steps += f""",
keyed_{r} AS (SELECT *, ((CAST('0x' || substr(md5('key:' || source_no || ':' || epoch || ':{r}'), 1, 12) AS BIGINT) % n_blocks - x) % n_blocks + n_blocks) % n_blocks AS y FROM picks_{r - 1}),
picks_{r} AS (SELECT source_no, n_blocks, epoch, CASE WHEN md5(source_no || ':' || epoch || ':{r}:' || greatest(x, y)) < '8' THEN y ELSE x END AS x FROM keyed_{r})"""
    return rf"""
WITH docs AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BUCKET_DIGITS}) AS bucket FROM documents),
named AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS source_no FROM named),
rising AS (SELECT *, source_no % 3 + 1 AS weight, row_number() OVER (ORDER BY source_size / (source_no % 3 + 1), source_no) AS nth FROM weighed),
levels AS (SELECT *, ((SELECT sum(source_size) FROM named) - coalesce(sum({most} * source_size) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM rising),
aimed AS (SELECT *, least(CAST({most} * source_size AS DOUBLE), weight * (SELECT min_by(level, nth) FROM levels WHERE level * weight <= {most} * source_size)) AS target, CAST(ceil(source_size / {block}) AS BIGINT) AS n_blocks FROM levels),
planned AS (SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * n_blocks + 0.5) AS BIGINT) AS uses FROM aimed),
{steps},
used AS (SELECT source_no, x AS block, count(*) AS uses FROM picks_{ROUNDS} GROUP BY 1, 2),
placed AS (SELECT d.doc_id, d.size, p.source_no, p.source_size, p.target, row_number() OVER () AS row_no, CAST(coalesce(sum(d.size) OVER (PARTITION BY p.source_no ORDER BY d.bucket, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_word
  FROM docs d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source),
spans AS (SELECT *, unnest(range(start_word // {block}, (start_word + size - 1) // {block} + 1)) AS block FROM placed WHERE size > 0),
took AS (SELECT s.row_no, sum((least(s.start_word + s.size, s.block * {block} + {block}) - greatest(s.start_word, s.block * {block})) * u.uses) AS taken FROM spans s JOIN used u USING (source_no, block) GROUP BY 1)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM placed LEFT JOIN took USING (row_no)"""
