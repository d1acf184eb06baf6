"""Chat formatting by quotation linking: columns and SQL functions only.

A line's quote level is the number of `>` before it. Consecutive lines of one level with text make a passage; it is
normalised (lower case, single spaces) and hashed, whole and line by line. A quoted passage belongs to the first earlier
message of its conversation that says the same without quoting it: by the whole passage, or else by a line of it. A
message replies to the latest message that its outermost linked quotes belong to, and one without linked quotes to the
message before it. Messages come in order of turn, so each follows what it replies to, and their quotes are cut.

Cases: a null text is empty; a null conv_id is a conversation of its own, and rows with a null turn come before all
others of theirs; rows equal in conversation and turn are messages side by side; a message of nothing but quotes is left
with an empty text; an empty table gives no row; other columns are not read. No conversation is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docroute.llm.common import text_of

PREFIX = r"^[ \t]*(>[ \t]*)+"
SPACES = r"[\x20\x09-\x0D]+"
#: Turns of a conversation that are laid out together.
STRETCH = 1024


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, PREFIX, 0), "[^>]", ""))


def _plain(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, PREFIX, "")), SPACES, " "))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, whole, text) of (conv, turn, m, text): every passage of each message, then its lines."""
    lines = messages.select("conv", "turn", "m", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    lines = lines.select("conv", "turn", "m", "i", _level(F.col("line")).alias("level"), _plain(F.col("line")).alias("text"))
    along = Window.partitionBy("conv", "turn", "m").orderBy("i")
    last, wordy = F.lag("level").over(along), F.lag("text").over(along) != ""
    fresh = F.coalesce((F.col("level") != last) | ~wordy, F.lit(True))
    lines = lines.withColumn("fresh", fresh.cast("int")).withColumn("run", F.sum("fresh").over(along)).where("text <> ''")
    runs = lines.groupBy("conv", "turn", "m", "level", "run").agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("x"))
    whole = runs.select("conv", "turn", "m", "level", "run", F.lit(True).alias("whole"), F.array_join("x.text", " ").alias("text"))
    return whole.unionByName(lines.select("conv", "turn", "m", "level", "run", F.lit(False).alias("whole"), "text"))


def links(messages: DataFrame) -> DataFrame:
    """(conv, turn, m, reply_to): the turn that each message with linked quotes replies to."""
    quoting = messages.where(F.col("text").rlike("(?m)" + PREFIX)).select("conv").distinct()
    found = passages(messages.join(quoting, "conv", "left_semi").dropDuplicates(["conv", "turn", "m"]))
    hashed = found.select("conv", "turn", "m", "level", "run", "whole", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    said = hashed.where("level = 0").groupBy("conv", "whole", "h1", "h2").agg(F.min("turn").alias("original"))
    quoted = hashed.where("level > 0").join(said, ["conv", "whole", "h1", "h2"]).where("original < turn")
    of_run = quoted.groupBy("conv", "turn", "m", "level", "run").agg(F.max(F.struct("whole", "original")).alias("x"))
    return of_run.groupBy("conv", "turn", "m").agg(F.max(F.struct((-F.col("level")).alias("near"), F.col("x.original").alias("turn"))).alias("y")).select("conv", "turn", "m", F.col("y.turn").alias("reply_to"))


def _before(messages: DataFrame) -> DataFrame:
    """Adds `before`, the next smaller turn of the conversation; stretches of turns are laid out apart and then joined."""
    turns = messages.select("conv", "turn").distinct().withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    whole = Window.partitionBy("conv").orderBy("stretch")
    ends = turns.groupBy("conv", "stretch").agg(F.max("turn").alias("end")).withColumn("carried", F.lag("end").over(whole))
    within = F.lag("turn").over(Window.partitionBy("conv", "stretch").orderBy("turn"))
    turns = turns.withColumn("own", within).join(ends.drop("end"), ["conv", "stretch"])
    return messages.join(turns.select("conv", "turn", F.coalesce("own", "carried").alias("before")), ["conv", "turn"])


def unquoted(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(PREFIX))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\n+|\n+$", "")


#: Stands for a null turn while turns are compared.
_NO_TURN = -(1 << 62)


def conversations(table: DataFrame) -> DataFrame:
    """(conv_id, turn, role, reply_to, n_quoted, text, formatted) of each row of (conv_id, turn, role, text)."""
    m = table.select(
        F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("id")).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_NO_TURN)).alias("turn"), "role", text_of().alias("text"),
    )
    m = m.withColumn("m", F.xxhash64("role", "text"))
    rows = _before(m).join(links(m), ["conv", "turn", "m"], "left")
    n_quoted = F.size(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(PREFIX)))
    turn = lambda c: F.nullif(c, F.lit(_NO_TURN))
    rows = rows.select(
        F.when(~F.col("conv.none"), F.col("conv.id")).alias("conv_id"), turn(F.col("turn")).alias("turn"), "role",
        turn(F.coalesce("reply_to", "before")).alias("reply_to"), n_quoted.cast("int").alias("n_quoted"), unquoted(F.col("text")).alias("text"),
    )
    return rows.withColumn("formatted", F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "text", F.lit("\n")))


ORACLE_SQL = r"""
WITH lines AS (SELECT conv_id, turn, md5(concat(role, ':', text)) AS m, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM conversations),
plain AS (SELECT conv_id, turn, m, i, length(regexp_replace(regexp_extract(line, '^[ \t]*(>[ \t]*)+'), '[^>]', '', 'g')) AS level,
  trim(regexp_replace(lower(regexp_replace(line, '^[ \t]*(>[ \t]*)+', '')), '[\x20\x09-\x0D]+', ' ', 'g')) AS text FROM lines),
marked AS (SELECT *, CASE WHEN level = lag(level) OVER w AND lag(text) OVER w <> '' THEN 0 ELSE 1 END AS fresh FROM plain WINDOW w AS (PARTITION BY conv_id, turn, m ORDER BY i)),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, m ORDER BY i) AS run FROM marked),
passages AS (SELECT conv_id, turn, m, level, run, true AS whole, string_agg(text, ' ' ORDER BY i) AS text FROM run WHERE text <> '' GROUP BY ALL
  UNION ALL SELECT conv_id, turn, m, level, run, false, text FROM run WHERE text <> ''),
said AS (SELECT conv_id, whole, text, min(turn) AS original FROM passages WHERE level = 0 GROUP BY ALL),
quoted AS (SELECT p.conv_id, p.turn, p.m, p.level, p.run, p.whole, s.original FROM passages p JOIN said s ON p.conv_id = s.conv_id AND p.whole = s.whole AND p.text = s.text WHERE p.level > 0 AND s.original < p.turn),
best AS (SELECT conv_id, turn, m, level, max(original) AS original FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, m, level, run ORDER BY whole DESC, original DESC) AS nth FROM quoted) WHERE nth = 1 GROUP BY ALL),
linked AS (SELECT conv_id, turn, m, min_by(original, level) AS reply_to FROM best GROUP BY ALL),
before AS (SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM (SELECT DISTINCT conv_id, turn FROM conversations))
SELECT c.conv_id, c.turn, c.role, coalesce(l.reply_to, b.before, -1) AS reply_to, CAST(len(list_filter(string_split(coalesce(c.text, ''), chr(10)), lambda x: regexp_matches(x, '^[ \t]*>'))) AS INT) AS n_quoted,
  regexp_replace(array_to_string(list_filter(string_split(coalesce(c.text, ''), chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)), '^\n+|\n+$', '', 'g') AS text,
  '<|' || coalesce(c.role, '') || '|>' || chr(10) || regexp_replace(array_to_string(list_filter(string_split(coalesce(c.text, ''), chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)), '^\n+|\n+$', '', 'g') || chr(10) AS formatted
FROM conversations c LEFT JOIN before b ON c.conv_id = b.conv_id AND c.turn = b.turn LEFT JOIN linked l ON c.conv_id = l.conv_id AND c.turn = l.turn AND md5(concat(c.role, ':', c.text)) = l.m"""
