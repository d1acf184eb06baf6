"""The ledger fed by a file stream. One writer folds each batch into the buckets that it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.operators import ledger_fold as lf
from docroute.sources.ledger_store import BucketedLedger


def apply_ops(store: BucketedLedger, ops: DataFrame, batch_id: int) -> None:
    """Fold one batch of operations into the stored ledger; a batch that was written before is only put in place again.

    The fold reads the columns of the rows that share a hash or key with the batch; of whole rows, only the buckets of
    changed ones are read and written.
    """
    last = store.last_batch()
    if batch_id <= last:
        if batch_id == last:
            store.put(batch_id)
        return
    stored = store.read()
    ledger = lf.empty_ledger(ops) if stored is None else stored.drop("bucket")
    outcomes = lf.checkpointed(lf.decide(ops, ledger))
    changed = outcomes.select(F.explode(F.array_compact(F.array("target", "superseded"))).alias("sha256"))
    touched = [r.bucket for r in changed.select(store.bucket().alias("bucket")).distinct().collect()]  # as many as there are buckets, at most
    if stored is not None:
        ledger = stored.where(F.col("bucket").isin(touched)).drop("bucket")
    store.replace(lf.apply(ledger, ops, outcomes), batch_id)


def run(spark: SparkSession, source: str, schema, store: BucketedLedger, checkpoint: str) -> None:
    """Fold all files under `source` that were not read before, as one batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply_ops(BucketedLedger(batch.sparkSession, store.path, store.buckets), batch, batch_id)

    q = (
        spark.readStream.schema(schema).parquet(source)
        .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()


def run_in_ranges(ops: DataFrame, home: str, ranges: int = 4, buckets: int = 64) -> DataFrame:
    """A whole log through the stream, in `ranges` batches of equal sequence ranges, and the ledger after it.

    A batch is a range of the sequence, not a file: a range is written by as many tasks as its size needs, then read
    as one batch by a stream that goes on where it stopped.
    """
    spark = ops.sparkSession
    store = BucketedLedger(spark, f"{home}/ledger", buckets)
    lo, hi = ops.agg(F.min("seq"), F.max("seq")).first()
    if lo is None:
        return lf.empty_ledger(ops)
    step = (hi - lo) // ranges + 1
    for i in range(ranges):
        part = ops.where((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        part.repartitionByRange("seq").write.mode("append").parquet(f"{home}/ops")
        run(spark, f"{home}/ops", ops.schema, store, f"{home}/progress")
    stored = store.read()
    return lf.empty_ledger(ops) if stored is None else stored.drop("bucket")
