"""Queue folders, hashed files, listings and step logs as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docroute.functions import text as t

# Columns of the two tab-separated reports.
LISTING = ["filename", "size_bytes", "mtime_iso", "path_rel_to_root"]
FINDINGS = ["category", "sha256", "plan_norm", "detail"]
LOG_LINE = r"^(.*?) \| (.*?) \| (.*)$"


def place() -> list[Column]:
    """Where a line was read: within one split of a file the reader's order is the file's."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth")]


def numbered(lines: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Replaces the place of each row by its number, from 0, within `keys` (columns, or none for all), files in order of their paths.

    Each split numbers its own lines, which `place` numbered one after another, and is moved on by the lines of the splits
    before it, so no file is one task's work, and no line is shuffled or sorted.
    """
    splits = lines.groupBy(*keys, "file", "block").agg(F.count("*").alias("_n"), F.min("nth").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    out = lines.join(splits, [*keys, *(c for c in ("file", "block") if c not in keys)])
    return out.withColumn(name, F.col("_before") + F.col("nth") - F.col("_first")).drop("_first", "_before", "block", "nth")


def scan_folder(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of a folder tree with their bytes; columns that are not used are not read."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return f.select("path", F.substring_index("path", "/", -1).alias("file_name"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"), "content")


def hashed(files: DataFrame) -> DataFrame:
    """Content hash of every file that is not a done-marker; the bytes go no further."""
    return files.where(~t.is_done_marker("file_name")).select("path", "file_name", "size_bytes", "mtime", F.sha2("content", 256).alias("sha256"))


def real_pdf(files: DataFrame) -> DataFrame:
    """files whose bytes start like a PDF."""
    return files.where(F.substring("content", 1, 5) == F.lit("%PDF-").cast("binary"))


def listing(files: DataFrame, root: str) -> DataFrame:
    """Name, size, time and path relative to `root`, newest first."""
    inside = F.lit(root.rstrip("/") + "/")
    at = F.instr(F.col("path"), inside)
    rel = F.when(at > 0, F.substring(F.col("path"), at + F.length(inside), F.length("path"))).otherwise(F.col("path"))
    out = files.select(F.col("file_name").alias("filename"), "size_bytes", F.date_format("mtime", "yyyy-MM-dd'T'HH:mm:ss").alias("mtime_iso"), rel.alias("path_rel_to_root"))
    return out.select(*LISTING).orderBy(F.desc("mtime_iso"), "path_rel_to_root")


def write_tsv(df: DataFrame, path: str) -> None:
    """One header per part file; a global order in the frame is kept across parts."""
    df.write.mode("errorifexists").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A report's rows as text, in the written order by `nth` (from 0)."""
    lines = numbered(spark.read.text(path).where(F.col("value") != "\t".join(columns)).select("value", *place()), [], "row")
    cells = F.split("value", "\t", len(columns))
    return lines.select(F.col("row").alias("nth"), *[cells[i].alias(c) for i, c in enumerate(columns)])


def step_logs(spark: SparkSession, path: str) -> DataFrame:
    """Step, day, file, line_no and the three fields of each log line; line_no is the position within the log.

    A log is a file named after its step and day, or a folder of that name whose files are its lines in order of their names.
    """
    named = r"/[^/]*?(step_\w+?)_(\d{4}-\d{2}-\d{2})[^/]*"
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", *place())
    log = F.regexp_extract("file", "^(.*" + named + ")", 1)
    raw = numbered(lines.withColumn("log", F.when(log == "", F.col("file")).otherwise(log)), ["log"], "line_no")
    step, day = F.regexp_extract("log", named + "$", 1), F.regexp_extract("log", named + "$", 2).try_cast("date")
    g = [F.regexp_extract("value", LOG_LINE, i) for i in (1, 2, 3)]
    return raw.select(step.alias("step"), day.alias("day"), F.col("log").alias("file"), "line_no", "value", g[0].alias("logged_at"), g[1].alias("level"), g[2].alias("message"))


def recent_logs(logs: DataFrame, mtime: str, run_ts, days: int) -> DataFrame:
    """logs of the last days, by a time or day of theirs."""
    return logs.where(F.col(mtime) >= run_ts - F.expr(f"INTERVAL {int(days)} DAYS"))
