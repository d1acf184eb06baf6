"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "docroute", master: str | None = None, shuffle: int | None = None) -> SparkSession:
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", "12g")
    if shuffle:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, named by `spark.checkpoint.dir`; where that is unset, in one process, a folder of our own."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
        configured = tempfile.mkdtemp(prefix="docroute-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor never changes row placement."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage through a compressed table in the shared folder: readers take only the columns they name.

    Unlike `checkpointed` it keeps no partitioning, so a later join deals its rows out itself and can split a frequent key.
    """
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
