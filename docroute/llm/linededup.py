"""Line dedup: the suffixes of all line sequences by prefix doubling, and the later copies of repeated runs deleted.

Columns and SQL functions only. A line stands for its hash; lines without a word are passed over. Doubling: a round
pairs the class of the h lines from a place with that of the h lines after them; places with a pair of their own drop
out, so the rounds shrink to what repeats longest. A class is named after its first occurrence, in order of doc_id and
place, so each place knows where the run from it was seen first, and how far. Places whose first occurrences follow each
other too lie in one interval of common prefix: a maximal run. A run is a later copy if its first occurrence is
elsewhere; its lines are deleted. The first occurrence of a line always stays.

Cases: a null text has no lines; a null doc_id comes first; rows equal in doc_id and text are one document, and both get
its result (an empty text); copies may overlap themselves; an empty table gives no row; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import WORD, Scratch, text_of, with_text

#: Lines with a word that a repeated run has at least; a power of two.
MIN_LINES = 2


def _key() -> Column:
    return F.xxhash64("doc_id", text_of())


def _lines() -> Column:
    return F.split(text_of(), "\n", -1)


def _named(rows: DataFrame, by: list[str], scratch: Scratch, name: str) -> DataFrame:
    """The rows whose `by` occurs at another place too, with the first place it occurs at as `first`.

    The classes are written first: a join of two plain shuffles is one whose hot keys Spark can split.
    """
    place = F.struct("doc_id", "k", "q", "line")
    classes = rows.groupBy(*by).agg(F.min(place).alias("first"), F.max(place).alias("other")).where("first.k <> other.k OR first.q <> other.q")
    return rows.join(scratch.write(classes.drop("other"), name), by).select("doc_id", "k", "q", "line", "last", "first")


def repeated(docs: DataFrame, scratch: Scratch, least: int = MIN_LINES) -> list[tuple[int, DataFrame]]:
    """(h, places) for h = least, 2 * least, ...: the places whose next h lines occur elsewhere too, with their first place.

    A place is doc_id, k (the document), q (the line among those with a word), line, and last, the last of the h lines.
    """
    wordy = F.filter(F.transform(_lines(), lambda x, i: F.struct(x.alias("text"), i.alias("line"))), lambda x: x["text"].rlike(WORD))
    lines = docs.select(F.col("doc_id").cast("long"), _key().alias("k"), F.posexplode(wordy).alias("q", "at"))
    hashes = F.xxhash64("at.text").alias("h1"), F.xxhash64(F.lit(1), "at.text").alias("h2")
    lines = scratch.write(lines.select("doc_id", "k", "q", F.col("at.line").alias("line"), F.col("at.line").alias("last"), *hashes), "lines")
    h, level, found = 1, scratch.write(_named(lines, ["h1", "h2"], scratch, "classes_1").distinct(), "level_1"), []
    scratch.drop("lines", "classes_1")
    while level.count():
        if h >= least:
            found.append((h, level))
        ahead = level.select("k", (F.col("q") - h).alias("q"), "last", F.col("first.k").alias("k2"), F.col("first.q").alias("q2"))
        pairs = level.select("doc_id", "k", "q", "line", F.col("first.k").alias("k1"), F.col("first.q").alias("q1")).join(ahead, ["k", "q"])
        h *= 2
        pairs = scratch.write(pairs, f"pairs_{h}")
        level = scratch.write(_named(pairs, ["k1", "q1", "k2", "q2"], scratch, f"classes_{h}"), f"level_{h}")
        scratch.drop(f"pairs_{h}", f"classes_{h}")
        if h // 2 < least:
            scratch.drop(f"level_{h // 2}")
    return found


def runs(docs: DataFrame, least: int = MIN_LINES) -> DataFrame:
    """The later copies: doc_id, k, line, last, n (lines with a word), and first_doc_id, first_line, which they copy."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    later = None
    for h, places in repeated(docs, scratch, least):
        own = places.where("k <> first.k OR q <> first.q").withColumn("h", F.lit(h))
        later = own if later is None else later.unionByName(own)
    if later is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, k long, line int, last int, n int, first_doc_id long, first_line int")
    at = F.struct("h", "doc_id", "line", "last", "first")
    longest = later.groupBy("k", "q").agg(F.max_by(at, "h").alias("x")).select("k", "q", "x.*")
    # Along one shift between two documents, places that touch make one run.
    shift = Window.partitionBy("k", F.col("first.k"), F.col("q") - F.col("first.q")).orderBy("q")
    end = F.max(F.col("q") + F.col("h")).over(shift.rowsBetween(Window.unboundedPreceding, -1))
    longest = longest.withColumn("fresh", F.coalesce((F.col("q") > end).cast("int"), F.lit(1))).withColumn("run", F.sum("fresh").over(shift))
    run = longest.groupBy("k", F.col("first.k").alias("first_k"), (F.col("q") - F.col("first.q")).alias("shift"), "run")
    end = F.col("q") + F.col("h")
    one = run.agg(F.min_by(F.struct("doc_id", "line", "q", "first"), "q").alias("x"), F.max(end).alias("end"), F.max_by("last", end).alias("last"))
    return one.select(
        "x.doc_id", "k", "x.line", "last", (F.col("end") - F.col("x.q")).alias("n"), F.col("x.first.doc_id").alias("first_doc_id"), F.col("x.first.line").alias("first_line")
    )


def _gaps(copies: DataFrame) -> DataFrame:
    """What stays of each document: `_gaps`, the (first line from 1, number of lines) before, between and after its copies."""
    along = Window.partitionBy("k").orderBy("line", "last").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("last").over(along), F.lit(-1))
    before = copies.select("k", "line", "last", (reached + 2).alias("start"), (F.col("line") - reached - 1).alias("n"))
    gap = F.when(F.col("n") > 0, F.struct("start", "n"))
    return before.groupBy(F.col("k").alias("_k")).agg(F.array_sort(F.collect_list(gap)).alias("_gaps"), (F.max("last") + 2).alias("_rest"))


def dedup(docs: DataFrame, least: int = MIN_LINES) -> DataFrame:
    """`docs` without the lines of later copies, and the columns _n_lines and _n_deleted."""
    kept = _gaps(runs(docs, least))
    # The lines travel as an array, so that they are split once and not for every gap.
    both = docs.withColumns({"_k": _key(), "_lines": _lines()}).drop("text").join(kept, "_k", "left")
    size = F.size("_lines")
    slices = F.concat(F.transform("_gaps", lambda g: F.slice("_lines", g["start"], g["n"])), F.array(F.slice("_lines", F.col("_rest"), size)))
    left = F.when(F.col("_gaps").isNull(), F.col("_lines")).otherwise(F.flatten(slices))
    both = both.withColumn("_left", left)
    out = with_text(both, F.array_join("_left", "\n")).withColumns({"_n_lines": size, "_n_deleted": size - F.size("_left")})
    return out.select(*docs.columns, "_n_lines", "_n_deleted")


def drop_copied_lines(docs: DataFrame, **how) -> DataFrame:
    """`docs` with the later copies of repeated runs cut from their texts."""
    return dedup(docs, **how).select(*docs.columns)


ORACLE_SQL = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
wordy AS (SELECT *, lead(line) OVER w AS next_line, lead(i) OVER w AS next_i FROM lines WHERE regexp_matches(line, '[^ 	-
]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
seen AS (SELECT *, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, i) AS nth FROM wordy WHERE next_line IS NOT NULL),
cut AS (SELECT DISTINCT doc_id, unnest(range(i, next_i + 1)) AS i FROM seen WHERE nth > 1)
SELECT l.doc_id, CAST(count(*) AS INT) AS n_lines, CAST(count(c.i) AS INT) AS n_deleted, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE c.i IS NULL), '') AS text
FROM lines l LEFT JOIN cut c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id"""
