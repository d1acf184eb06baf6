"""Ledgers on storage. A version is a directory; a pointer file names the current one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators.dedupe import LEDGER_COLUMNS

# Columns of the monthly ledger.
MONTHLY_COLUMNS = ["run_date", "run_timestamp", "plan_norm", "target_year", "target_month", "status", "summary_filename", "sources_merged", "notes"]


def _int_or(c: str, default) -> Column:
    s = t.strip(F.col(c).cast("string"))
    return F.when(s == "", F.lit(default).cast("long")).otherwise(s.try_cast("long"))


def _problem(ints: tuple[str, ...], empty: Column | None = None) -> Column:
    """What is wrong with a row of strings, or null."""
    found = []
    for c in ints:
        s = t.strip(F.col(c).cast("string"))
        found.append(F.when((s != "") & s.try_cast("long").isNull(), F.concat(F.lit(f"malformed {c}: "), s)))
    return F.nullif(F.concat_ws("; ", *found, *([] if empty is None else [empty])), F.lit(""))


def _guarded(df: DataFrame, problem: Column) -> DataFrame:
    """The rows; a bad one fails the job, whichever columns are read afterwards."""
    return df.where(F.coalesce(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")), F.lit(True)))


def _headed(raw: DataFrame) -> DataFrame:
    """Missing columns default."""
    return raw.withColumns({c: F.lit("") for c in LEDGER_COLUMNS if c not in raw.columns})


def _fingerprint_problem() -> Column:
    return _problem(("amount_cents", "dup_count"), F.when(t.strip(F.col("sha256")) == "", "ledger row with an empty sha256"))


def _fingerprint_rows(have: DataFrame) -> DataFrame:
    return have.select(*[c for c in ["pos"] if c in have.columns], *[
        (_int_or(c, None) if c == "amount_cents" else _int_or(c, 0) if c == "dup_count" else F.lower(t.strip(F.col(c))) if c == "sender_domain" else t.strip(F.col(c))).alias(c)
        for c in LEDGER_COLUMNS])


def parse_fingerprints(raw: DataFrame) -> DataFrame:
    """String rows by header; missing columns default, a bad number or an empty hash fails the job."""
    have = _headed(raw)
    return _fingerprint_rows(_guarded(have, _fingerprint_problem()))


def sift_fingerprints(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S6 that goes on: (good rows, rejected rows as they came, with a `reason`)."""
    marked = _headed(raw).withColumn("reason", _fingerprint_problem())
    return _fingerprint_rows(marked.where("reason is null")), marked.where("reason is not null").select(*raw.columns, "reason")


_MONTHLY_INTS = ("target_year", "target_month", "sources_merged")


def _monthly_rows(raw: DataFrame) -> DataFrame:
    return raw.select(*[(_int_or(c, 0) if c in _MONTHLY_INTS else t.blank(c)).alias(c) for c in MONTHLY_COLUMNS])


def parse_monthly(raw: DataFrame) -> DataFrame:
    """Blank numbers are 0, a bad number fails the job."""
    return _monthly_rows(_guarded(raw, _problem(_MONTHLY_INTS)))


def sift_monthly(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S7 that goes on: (good rows, rejected rows as they came, with a `reason`)."""
    marked = raw.withColumn("reason", _problem(_MONTHLY_INTS))
    return _monthly_rows(marked.where("reason is null")), marked.where("reason is not null")


def monthly_rows(rollup: DataFrame, run_ts) -> DataFrame:
    """Stamp roll-up results with the run's business date and time."""
    local = F.from_utc_timestamp(run_ts, t.ZONE)
    return rollup.withColumns({"run_date": F.date_format(local, "yyyy-MM-dd"), "run_timestamp": F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")}).select(*MONTHLY_COLUMNS)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


class BucketedLedger:
    """The ledger in folders by a bucket of its hash; a batch rewrites the buckets it touches and no other.

    A batch's new buckets are first written apart, under the batch's number; once that write is whole (Spark's own
    `_SUCCESS` file says so) they replace the old ones by dynamic partition overwrite. A batch that comes again after a
    crash finds them and only replaces again, which gives the same rows; an older batch is passed over. Hashes are
    spread evenly, so a batch of a few hashes for each bucket touches all of them: choose more buckets than that.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def bucket(self, sha: str = "sha256") -> Column:
        return F.pmod(F.xxhash64(sha), F.lit(self.buckets)).cast("int")

    def _exists(self, name: str) -> bool:
        fs, hpath = _fs(self.spark, self.path)
        return fs.exists(hpath(f"{self.path}/{name}"))

    def last_batch(self) -> int:
        """The newest batch whose buckets were written whole; -1 when there is none."""
        fs, hpath = _fs(self.spark, self.path)
        root = hpath(f"{self.path}/batches")
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return max((int(n) for n in names if self._exists(f"batches/{n}/_SUCCESS")), default=-1)

    def read(self) -> DataFrame | None:
        """The ledger, with its `bucket`."""
        return self.spark.read.schema(self.schema()).parquet(f"{self.path}/rows") if self._exists("rows") else None

    @staticmethod
    def schema() -> str:
        types = {"amount_cents": "long", "dup_count": "long"}
        return ", ".join(["pos long"] + [f"{c} {types.get(c, 'string')}" for c in LEDGER_COLUMNS] + ["bucket int"])

    def replace(self, rows: DataFrame, batch: int) -> None:
        """Put `rows`, the whole content of the buckets they lie in, in place of those buckets."""
        staged = f"{self.path}/batches/{batch}"
        rows.withColumn("bucket", self.bucket()).write.mode("overwrite").parquet(staged)
        self.put(batch)

    def put(self, batch: int) -> None:
        """Replace the buckets of a batch that was written whole; doing it again changes nothing."""
        staged = self.spark.read.schema(self.schema()).parquet(f"{self.path}/batches/{batch}")
        # one file a bucket
        staged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/rows")
        fs, hpath = _fs(self.spark, self.path)
        for status in fs.listStatus(hpath(f"{self.path}/batches")):
            if int(status.getPath().getName()) < batch:
                fs.delete(status.getPath(), True)
