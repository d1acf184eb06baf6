"""The ledger as the result of an ordered operation log.

Operations: arrive (with plan, invoice, cents, domain), to_ap, archive, override. Each one sees the ledger as all
earlier ones left it; a skipped duplicate adds nothing, so its own hash and key stay free. Written as a sequence
this is one long fold.

Two operations can matter to each other only when hashes and keys link them, so the log falls apart into the connected
components of the links (hash, key) of its arrivals and of the ledger rows it touches:

* Small components are replayed all at once, in one pass over partitions sorted by (component, order); a task holds the
  ledger rows of one component at a time. Their number, and the length of their chains, cost no rounds.
* What is left, if anything, is one or a few giant components. They advance by a round over all their operations:
  an operation that cannot change which row answers for a hash or key ("light": a repeat of a live row, a stage step
  of a live row, a repeat under a key whose live row stays put) is decided together with all others like it, as far as
  no open operation before it can change the row it meets; of the rest, the first one per hash is carried out when no
  open operation before it touches its keys. Such operations touch disjoint hashes and keys, so a round may carry out
  all of them. The rows that they leave are carried on; rows that no open operation can meet are let go. Then the
  components of what is open are taken again.

The earliest open operation always qualifies, so the rounds end, and the result is exactly the sequential one. Only
aggregates, equi-joins and that pass are used; repeats of one hot hash or key are settled in bulk, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docroute.functions import text as t
from docroute.operators.components import connected
from docroute.operators.dedupe import LEDGER_COLUMNS, checked_stage, semantic_key
from docroute.session import checkpointed

# The stage each operation sets.
STAGE_OF = {"arrive": "manager_queue", "to_ap": "ap_queue", "archive": "archived", "override": "overridden"}

#: A component of up to this many operations and rows is replayed in one task.
SMALL = 1 << 16

_STATE = ["sha256", "pos", "ins", "row_key", "st"]
_OPS = ["seq", "sha256", "op", "key"]
_DONE = pa.schema([
    ("seq", pa.int64()), ("sha256", pa.string()), ("op", pa.string()), ("outcome", pa.string()), ("target", pa.string()), ("target_ins", pa.int64()),
    ("first_pos", pa.int64()), ("superseded", pa.string()), ("superseded_ins", pa.int64()),
])
_DONE_DDL = ", ".join(f"{f.name} {'bigint' if f.type == pa.int64() else 'string'}" for f in _DONE)


def _state_of(ledger: DataFrame) -> DataFrame:
    st = F.when(F.col("current_stage").isin("overridden", "superseded"), F.col("current_stage")).otherwise("live")
    return ledger.select("sha256", "pos", F.lit(-1).cast("long").alias("ins"), semantic_key(F.col("pos")).alias("row_key"), st.alias("st"))


def decide(ops: DataFrame, ledger: DataFrame, small: int = SMALL) -> DataFrame:
    """Outcome of every operation.

    ops: seq (unique, after every ledger `pos`), sha256, op, plan_norm, invoice_number, amount_cents, sender_domain.
    Result: seq, sha256, op, outcome (inserted | duplicate | staged | unknown), target and target_ins (the row
    changed, by the seq that wrote it; -1 for rows of the given ledger), first_pos, and superseded (a consumed override).
    """
    key = F.when(F.col("op") == "arrive", semantic_key(F.col("seq"))).otherwise(F.concat(F.lit("\x02"), F.col("seq").cast("string")))
    todo = checkpointed(ops.select("seq", "sha256", "op", key.alias("key")))
    state = _met(_state_of(ledger), todo)
    settled: list[DataFrame] = []
    n_open, n_split = todo.count(), 0
    while n_open:
        if not n_split or n_open <= n_split // 2:  # taken again when half of the operations are settled
            replayed, todo, state = _replay_small(todo, state, small)
            settled.append(replayed)
            n_open = n_split = todo.count()
            if not n_open:
                break
        seen = checkpointed(_look(todo, state))
        settled.append(_light(seen))
        ready = checkpointed(_ready(seen))
        settled.append(_outcomes(ready))
        delta = _delta(ready)
        todo = checkpointed(seen.where("seq >= first_hard").join(ready.select("seq"), "seq", "left_anti").select(*_OPS))
        state = _met(state.join(delta.select("sha256"), "sha256", "left_anti").unionByName(delta), todo)
        n_open = todo.count()
    if not settled:
        return todo.sparkSession.createDataFrame([], _DONE_DDL)
    return reduce(DataFrame.unionByName, settled)


def _met(state: DataFrame, todo: DataFrame) -> DataFrame:
    """The rows that an open operation can meet, by hash or by key."""
    by_key = state.join(todo.select(F.col("key").alias("row_key")).distinct(), "row_key", "left_semi").select(*_STATE)
    by_hash = state.join(todo.select("sha256").distinct(), "sha256", "left_semi").select(*_STATE)
    return checkpointed(by_key.unionByName(by_hash).distinct())


def _node(c: str) -> Column:
    """A number for a hash; should two share one, their components are taken as one, and the result stays right."""
    return F.xxhash64(c)


def _replay_small(todo: DataFrame, state: DataFrame, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(outcomes of the small components, operations and rows of the others)."""
    pairs = todo.select("sha256", "key").unionByName(state.select("sha256", F.col("row_key").alias("key")))
    links = pairs.where(~F.col("key").startswith("\x02")).select(_node("sha256").alias("a"), F.xxhash64(F.lit("key"), "key").alias("b"))
    roots = connected(links)
    placed = lambda df: df.withColumn("node", _node("sha256")).join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("node", "root")
    todo, state = checkpointed(placed(todo)), checkpointed(placed(state))
    rows = state.groupBy("component").agg(F.count("*").alias("n_rows"))
    sizes = todo.groupBy("component").agg(F.count("*").alias("n")).join(rows, "component", "left")
    met = F.col("n") + F.coalesce("n_rows", F.lit(0))
    large = checkpointed(sizes.where(met > small).select("component"))
    none = F.lit(None)
    sorted_ = todo.select("component", "seq", none.cast("long").alias("pos"), "sha256", "op", "key", none.cast("long").alias("ins"), none.cast("string").alias("st")).unionByName(
        state.select("component", F.lit(-1).cast("long").alias("seq"), "pos", "sha256", none.cast("string").alias("op"), F.col("row_key").alias("key"), "ins", "st"))
    # The number of tasks is set: little data, but all the work, so tasks are not to be drawn together.
    n = int(todo.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = sorted_.join(large, "component", "left_anti").repartition(n, "component").sortWithinPartitions("component", "seq", "pos")
    done = _replay(sorted_.select("component", "seq", "pos", "sha256", "op", "key", "ins", "st"))
    rest = todo.join(large, "component", "left_semi").select(*_OPS)
    return checkpointed(done), checkpointed(rest), checkpointed(state.join(large, "component", "left_semi").select(*_STATE))


def _replay(rows: DataFrame) -> DataFrame:
    """The outcomes of whole components, each in order after the ledger rows it meets, one pass over sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ledger = None, _Rows()
        for batch in batches:
            done = []
            for component, seq, pos, sha, op, key, ins, st in zip(*(c.to_pylist() for c in batch.columns)):
                if component != now:
                    now, ledger = component, _Rows()
                if seq < 0:
                    ledger.put(sha, pos, ins, key, st)
                else:
                    done.append((seq, sha, op, *ledger.apply(seq, sha, op, key)))
            columns = zip(*done) if done else [()] * len(_DONE.names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _DONE)], _DONE.names)

    return rows.mapInArrow(run, _DONE_DDL)


class _Rows:
    """The ledger rows of one component while its operations are replayed."""

    def __init__(self):
        self.by_hash: dict[str, tuple] = {}
        self.by_key: dict[str, set[str]] = {}

    def put(self, sha: str, pos: int, ins: int, key: str, st: str) -> None:
        if sha in self.by_hash:
            self.by_key[self.by_hash[sha][2]].discard(sha)
        self.by_hash[sha] = (pos, ins, key, st)
        self.by_key.setdefault(key, set()).add(sha)

    def first(self, key: str, st: str) -> str | None:
        """The earliest row of a key in this state."""
        held = [(self.by_hash[s][0], s) for s in self.by_key.get(key, ()) if self.by_hash[s][3] == st]
        return min(held)[1] if held else None

    def apply(self, seq: int, sha: str, op: str, key: str) -> tuple:
        """outcome, target, target_ins, first_pos, superseded, superseded_ins."""
        own = self.by_hash.get(sha)
        if op != "arrive":
            if own is None:
                return "unknown", None, None, None, None, None
            self.put(sha, *own[:3], "overridden" if op == "override" else "live")
            return "staged", sha, own[1], None, None, None
        hit = sha if own is not None and own[3] != "overridden" else self.first(key, "live")
        if hit is not None:
            return "duplicate", hit, self.by_hash[hit][1], None, None, None
        gone = self.first(key, "overridden") if own is None else None
        gone_ins = None
        if gone is not None:
            pos, gone_ins, *_ = self.by_hash[gone]
            self.put(gone, pos, gone_ins, key, "superseded")
        first = seq if own is None else own[0]
        self.put(sha, first, seq, key, "live")
        return "inserted", sha, seq, first, gone, gone_ins


def _look(todo: DataFrame, state: DataFrame) -> DataFrame:
    """Each open operation with the row under its hash, the rows under its key, and the first hard operation of its hash."""
    a = todo.join(state, "sha256", "left")
    stage_op = F.col("op") != "arrive"
    # A stage operation is hard when it moves a row into or out of the live set.
    moves = stage_op & (
        ((F.col("st") == "live") & (F.col("op") == "override"))
        | (F.col("st") == "superseded")
        | ((F.col("st") == "overridden") & (F.col("op") != "override"))
    )
    move_at = a.where(moves).groupBy(F.col("row_key").alias("key")).agg(F.min("seq").alias("move_at"))
    answers = state.groupBy(F.col("row_key").alias("key")).agg(
        F.min_by(F.struct("sha256", "ins"), F.when(F.col("st") == "live", F.col("pos"))).alias("live_row"),
        F.min_by(F.struct("sha256", "ins", "pos"), F.when(F.col("st") == "overridden", F.col("pos"))).alias("over_row"),
    )
    b = a.join(answers.join(move_at, "key", "left"), "key", "left")
    key_repeat = F.col("live_row").isNotNull() & (F.col("move_at").isNull() | (F.col("seq") < F.col("move_at")))
    b = b.withColumn("key_repeat", key_repeat)
    # An overridden row may be retired by a new hash under its key: from then on it answers differently.
    retire_at = b.where(~stage_op & F.col("st").isNull() & ~F.col("key_repeat")).groupBy(F.col("key").alias("own_key")).agg(F.min("seq").alias("retire_at"))
    b = b.withColumn("own_key", F.when(F.col("st") == "overridden", F.col("row_key")).otherwise(F.concat(F.lit("\x02"), F.col("seq").cast("string")))).join(retire_at, "own_key", "left")
    repeat = F.coalesce(F.col("st").isin("live", "superseded"), F.lit(False)) | F.col("key_repeat")
    exposed = F.coalesce((F.col("st") == "overridden") & (F.col("seq") > F.col("retire_at")), F.lit(False))
    hard = exposed | F.when(~stage_op, ~repeat).otherwise(F.coalesce(moves, F.lit(False)))
    b = b.withColumn("hard", hard).drop("own_key", "retire_at", "key_repeat")
    first = b.where("hard").groupBy("sha256").agg(F.min("seq").alias("first_hard"))
    return b.join(first, "sha256", "left").withColumn("first_hard", F.coalesce("first_hard", F.lit((1 << 63) - 1))).drop("move_at", "hard")


def _decided(df: DataFrame) -> DataFrame:
    has_row = F.col("st").isNotNull()
    by_hash = F.col("st").isin("live", "superseded")
    arrive = F.col("op") == "arrive"
    key_dup = F.col("live_row").isNotNull()
    outcome = (
        F.when(arrive & (F.coalesce(by_hash, F.lit(False)) | key_dup), "duplicate")
        .when(arrive, "inserted")
        .when(has_row, "staged")
        .otherwise("unknown")
    )
    own = F.struct("sha256", "ins")
    target = F.when(arrive & F.coalesce(by_hash, F.lit(False)), own).when(arrive & key_dup, F.col("live_row")).when(~arrive & has_row, own)
    return df.withColumns({"outcome": outcome, "hit": target})


def _light(seen: DataFrame) -> DataFrame:
    return _outcomes(seen.where("seq < first_hard"))


def _outcomes(df: DataFrame) -> DataFrame:
    d = _decided(df)
    inserted = F.col("outcome") == "inserted"
    # An override under the same hash is consumed by the new row itself; one under the key is retired.
    retired = F.when(inserted & F.col("st").isNull(), F.col("over_row.sha256"))
    return d.select(
        "seq", "sha256", "op", "outcome", F.when(inserted, F.col("sha256")).otherwise(F.col("hit.sha256")).alias("target"),
        F.when(inserted, F.col("seq")).otherwise(F.col("hit.ins")).alias("target_ins"),
        F.when(inserted, F.coalesce("pos", "seq")).alias("first_pos"), retired.alias("superseded"), F.when(retired.isNotNull(), F.col("over_row.ins")).alias("superseded_ins"),
    )


def _ready(seen: DataFrame) -> DataFrame:
    """The first hard operation of each hash, where no open operation before it touches the same keys."""
    rest = seen.where("seq >= first_hard")
    touched = rest.select("seq", F.explode(F.array_distinct(F.array_compact(F.array("key", "row_key")))).alias("k")).groupBy("k").agg(F.min("seq").alias("first_touch"))
    head = rest.where("seq = first_hard")
    own, row = touched.select(F.col("k").alias("key"), F.col("first_touch").alias("t1")), touched.select(F.col("k").alias("k2"), F.col("first_touch").alias("t2"))
    # Hashes without a row look for a key nobody has, each its own, so that they do not meet in one partition.
    head = head.withColumn("k2", F.coalesce("row_key", F.concat(F.lit("\x02"), F.col("seq").cast("string"))))
    return head.join(own, "key").join(row, "k2", "left").where("t1 = seq and (row_key is null or t2 = seq)").select(*seen.columns)


def _delta(ready: DataFrame) -> DataFrame:
    """Rows written by the operations carried out: a projection of what they had in hand."""
    d = _decided(ready)
    rows = d.where("outcome in ('inserted', 'staged')").select(
        "sha256", F.coalesce("pos", "seq").alias("pos"), F.when(F.col("outcome") == "inserted", F.col("seq")).otherwise(F.col("ins")).alias("ins"),
        F.when(F.col("outcome") == "inserted", F.col("key")).otherwise(F.col("row_key")).alias("row_key"),
        F.when(F.col("op") == "override", "overridden").otherwise("live").alias("st"))
    retired = d.where("outcome = 'inserted' and st is null and over_row is not null").select(
        F.col("over_row.sha256").alias("sha256"), F.col("over_row.pos").alias("pos"), F.col("over_row.ins").alias("ins"), F.col("key").alias("row_key"), F.lit("superseded").alias("st"))
    return rows.unionByName(retired)


def apply(ledger: DataFrame, ops: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The ledger after the log: the rows it changed are rebuilt from outcomes, all others pass through."""
    day = t.business_date(F.col("ts")).cast("string")
    o = outcomes.join(ops.select("seq", "plan_norm", "invoice_number", "amount_cents", "sender_domain", day.alias("day"), *(["archive_path", "archive_sha256"] if "archive_path" in ops.columns else [])), "seq")
    for c in ("archive_path", "archive_sha256"):
        if c not in o.columns:
            o = o.withColumn(c, F.when(F.col("op") == "archive", F.concat(F.lit("archive/" if c == "archive_path" else "flat-"), "sha256")))
    # Everything that happened to one written row, keyed by the seq that wrote it.
    hits = o.where("outcome in ('duplicate', 'staged')").select(F.col("target").alias("sha256"), F.col("target_ins").alias("ins"), "seq", "op", "outcome", "day", "archive_path", "archive_sha256")
    gone = o.where("superseded is not null").select(F.col("superseded").alias("sha256"), F.col("superseded_ins").alias("ins"), "seq", F.lit("superseded").alias("op"), F.lit("staged").alias("outcome"))
    ev = hits.unionByName(gone, allowMissingColumns=True)
    dup, staged = F.col("outcome") == "duplicate", F.col("outcome") == "staged"
    stage = F.coalesce(*[F.when(F.col("op") == k, v) for k, v in STAGE_OF.items() if k != "arrive"], F.col("op"))
    at = lambda cond: F.when(cond, F.col("seq"))
    sums = ev.groupBy("sha256", "ins").agg(
        F.count_if(dup).alias("n_dup"), F.max_by("day", at(dup)).alias("dup_day"), F.max_by("day", at(F.col("day").isNotNull())).alias("seen_day"),
        F.max_by(stage, at(staged)).alias("new_stage"), F.max_by("archive_path", at(F.col("archive_path").isNotNull())).alias("new_path"),
        F.max_by("archive_sha256", at(F.col("archive_sha256").isNotNull())).alias("new_flat"))
    ins = o.where("outcome = 'inserted'").groupBy("sha256").agg(
        F.max_by(F.struct("seq", "day", "plan_norm", "invoice_number", "amount_cents", "sender_domain"), "seq").alias("n"), F.min("first_pos").alias("pos"))
    fresh = ins.select(
        "pos", F.col("n.seq").alias("ins"), F.col("n.day").alias("first_seen_date"), "sha256", "n.plan_norm", "n.invoice_number", "n.amount_cents", "n.sender_domain", F.lit("").alias("archive_path"),
        F.lit("").alias("archive_sha256"), F.lit("manager_queue").alias("current_stage"), F.col("n.day").alias("last_seen_date"), F.lit(0).cast("long").alias("dup_count"), F.lit("").alias("last_dup_date"))
    kept = ledger.join(ins.select("sha256"), "sha256", "left_anti").withColumns({"ins": F.lit(-1).cast("long"), "dup_count": F.col("dup_count").cast("long")})
    rows = fresh.unionByName(kept.select(*fresh.columns)).join(sums, ["sha256", "ins"], "left")
    new = {
        "archive_path": F.coalesce("new_path", "archive_path"), "archive_sha256": F.coalesce("new_flat", "archive_sha256"),
        "current_stage": F.coalesce("new_stage", "current_stage"), "last_seen_date": F.coalesce("seen_day", "last_seen_date"),
        "dup_count": F.col("dup_count") + F.coalesce("n_dup", F.lit(0)), "last_dup_date": F.coalesce("dup_day", "last_dup_date"),
    }
    rows = rows.withColumns(new)
    return rows.withColumn("current_stage", checked_stage("current_stage")).select("pos", *LEDGER_COLUMNS)


def empty_ledger(ops: DataFrame) -> DataFrame:
    types = {"amount_cents": "long", "dup_count": "long"}
    return ops.sparkSession.createDataFrame([], ", ".join(["pos long"] + [f"{c} {types.get(c, 'string')}" for c in LEDGER_COLUMNS]))


def fold(ledger: DataFrame, ops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outcomes, new ledger) of a log over a ledger."""
    outcomes = checkpointed(decide(ops, ledger))
    return outcomes, apply(ledger, ops, outcomes)
