"""Conversations: earlier messages with attachments, and which of them each plan-only reply recovers."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.operators.ordered import Run, running
from docroute.session import checkpointed


def sweep(remaining: DataFrame, first_fetch: DataFrame) -> DataFrame:
    """Messages still in the inbox that were already there at the first fetch."""
    return remaining.join(first_fetch.select("msg_id"), "msg_id", "left_semi").select("msg_id")


def priors(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """Per reply the number of strictly earlier messages with attachments, and the newest of them.

    A conversation is one running count over its distinct times, never a self-join: n messages give n rows.
    """
    times = messages.groupBy("conversation_id", "received_at").agg(
        F.count_if("has_attachments").alias("n"), F.min(F.when(F.col("has_attachments"), F.col("msg_id"))).alias("first_id"))
    newest = F.when(F.col("n") > 0, F.struct("received_at", "first_id"))
    before = running(times, ["conversation_id"], [F.col("received_at")], [Run("n_priors", "sum", F.col("n"), False), Run("newest", "last", newest, False)])
    out = replies.select("msg_id", "conversation_id", "received_at").join(before.select("conversation_id", "received_at", "n_priors", "newest"), ["conversation_id", "received_at"])
    return out.select("msg_id", "conversation_id", "n_priors", F.col("newest.first_id").alias("newest_prior"), F.col("newest.received_at").alias("newest_prior_at"))


#: A conversation with several plans and up to this many replies and eligible messages is walked in one task.
SMALL = 1 << 16


def recover(replies: DataFrame, prior_messages: DataFrame, status: DataFrame, small: int = SMALL) -> DataFrame:
    """Replies, newest first, each take their newest unused earlier message that commits.

    replies: conversation_id, msg_id, received_at, plan. prior_messages: conversation_id, msg_id, received_at.
    status: msg_id, plan, status in commit | flag | none (missing is none): what routing that message under a
    reply's plan gives. A flagged message stops every walk that reaches it and stays unused.

    The walk is a queue read against time: a reply joins it, a committing message serves its newest reply, a flagged
    message turns its replies away. Where all replies of a conversation name one plan, queue lengths are running sums,
    which makes the pairing an equi-join on (segment, rank) whatever the conversation's size. Where they name several,
    the conversations are read in one pass over partitions sorted by (conversation, time), however often plans change.
    Only a conversation past `small` with several plans is taken in maximal same-plan runs, newest run first.
    """
    replies = checkpointed(replies.select("conversation_id", "msg_id", "received_at", "plan"))
    eligible = (
        status.where("status in ('commit', 'flag')").join(prior_messages.select("msg_id", "conversation_id", "received_at"), "msg_id")
        .join(replies.select("conversation_id", "plan").distinct(), ["conversation_id", "plan"], "left_semi")
    )
    asked = replies.groupBy("conversation_id").agg(F.count("*").alias("n"), (F.min("plan") < F.max("plan")).alias("several"))
    held = eligible.groupBy("conversation_id").agg(F.count("*").alias("n_eligible"))
    mixed = asked.where("several").join(held, "conversation_id", "left").where(F.col("n") + F.coalesce("n_eligible", F.lit(0)) <= small).select("conversation_id")
    mixed = checkpointed(mixed)
    done = _walk(replies.join(mixed, "conversation_id", "left_semi"), eligible.join(mixed, "conversation_id", "left_semi"))

    left = checkpointed(replies.join(mixed, "conversation_id", "left_anti"))
    free = prior_messages.select("conversation_id", "msg_id", "received_at")
    while not left.isEmpty():
        order = F.struct("received_at", (-F.col("msg_id")).alias("k"))
        head = left.groupBy("conversation_id").agg(F.max_by("plan", order).alias("head_plan"))
        mark = left.join(head, "conversation_id")
        stop = mark.where("plan <> head_plan").groupBy("conversation_id").agg(F.max(order).alias("stop"))
        run = mark.join(stop, "conversation_id", "left").where(F.col("stop").isNull() | (order > F.col("stop")))
        run = checkpointed(run.select("conversation_id", "msg_id", "received_at", "plan"))
        got = checkpointed(_serve(run, free, status))
        done = done.unionByName(got)
        left = checkpointed(left.join(run.select("msg_id"), "msg_id", "left_anti"))
        free = free.join(got.where("outcome = 'recovered'").select(F.col("prior_id").alias("msg_id")), "msg_id", "left_anti")
    oldest = prior_messages.groupBy("conversation_id").agg(F.min("received_at").alias("oldest"))
    out = done.join(replies.select("conversation_id", "msg_id", "received_at"), ["conversation_id", "msg_id"]).join(oldest, "conversation_id", "left")
    none = F.when(F.col("oldest") < F.col("received_at"), "no routable prior").otherwise("no eligible prior")
    return out.select("conversation_id", "msg_id", F.coalesce("outcome", none).alias("outcome"), "prior_id")


def _walk(replies: DataFrame, eligible: DataFrame) -> DataFrame:
    """conversation_id, msg_id, outcome (null: none), prior_id of whole conversations, read newest first."""
    # At one instant messages come before replies, because a reply only reaches earlier ones.
    rows = replies.select("conversation_id", "received_at", F.lit(1).alias("late"), "msg_id", "plan", F.lit("reply").alias("kind")).unionByName(
        eligible.select("conversation_id", "received_at", F.lit(0).alias("late"), "msg_id", "plan", F.col("status").alias("kind")))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "conversation_id").sortWithinPartitions("conversation_id", F.desc("received_at"), "late", "msg_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, offer = _Queue(), None
        for batch in batches:
            done: list[tuple] = []
            for conversation, msg, plan, kind in zip(*(c.to_pylist() for c in batch.columns)):
                if offer is not None and offer[:2] != (conversation, msg):
                    done += queue.offer(*offer)
                    offer = None
                if queue.conversation != conversation:
                    done += queue.rest()
                    queue = _Queue(conversation)
                if kind == "reply":
                    queue.join(msg, plan)
                elif offer is None:
                    offer = (conversation, msg, {plan: kind})
                else:
                    offer[2][plan] = kind
            yield _outcomes(done, batch.schema)
            schema = batch.schema
        if offer is not None:
            last = queue.offer(*offer)
            yield _outcomes(last + queue.rest(), schema)
        elif queue.waiting:
            yield _outcomes(queue.rest(), schema)

    ids = {c: rows.schema[c].dataType.simpleString() for c in ("conversation_id", "msg_id")}
    return rows.select("conversation_id", "msg_id", "plan", "kind").mapInArrow(run, f"conversation_id {ids['conversation_id']}, msg_id {ids['msg_id']}, outcome string, prior_id {ids['msg_id']}")


def _outcomes(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    types = [schema.field("conversation_id").type, schema.field("msg_id").type, pa.string(), schema.field("msg_id").type]
    columns = zip(*done) if done else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conversation_id", "msg_id", "outcome", "prior_id"])


class _Queue:
    """The replies of one conversation that wait for a message, by plan, newest first."""

    def __init__(self, conversation=None):
        self.conversation, self.waiting, self.n = conversation, {}, 0

    def join(self, msg, plan) -> None:
        self.waiting.setdefault(plan, deque()).append((self.n, msg))
        self.n += 1

    def offer(self, conversation, msg, kinds: dict) -> list[tuple]:
        """A message: the newest reply it commits for takes it; those newer than that reply that it is flagged for stop."""
        heads = [(self.waiting[p][0][0], p) for p, kind in kinds.items() if kind == "commit" and self.waiting.get(p)]
        taker = min(heads, key=lambda h: h[0]) if heads else (self.n, None)
        done = []
        for plan, kind in kinds.items():
            held = self.waiting.get(plan)
            while kind == "flag" and held and held[0][0] < taker[0]:
                done.append((conversation, held.popleft()[1], "flagged", msg))
        if heads:
            done.append((conversation, self.waiting[taker[1]].popleft()[1], "recovered", msg))
        return done

    def rest(self) -> list[tuple]:
        done = [(self.conversation, msg, None, None) for held in self.waiting.values() for _, msg in held]
        self.waiting = {}
        return done


def _serve(run: DataFrame, free: DataFrame, status: DataFrame) -> DataFrame:
    plans = run.select("conversation_id", "plan").distinct()
    cand = free.join(plans, "conversation_id").join(status, ["msg_id", "plan"], "left")
    rows = run.select("conversation_id", "msg_id", "received_at", F.lit("reply").alias("kind")).unionByName(
        cand.select("conversation_id", "msg_id", "received_at", F.coalesce("status", F.lit("none")).alias("kind")))
    # Newest first; at one instant messages come before replies, because a reply only reaches earlier ones.
    late = (F.col("kind") == "reply").cast("int")
    order = [F.desc("received_at"), F.asc("late"), F.asc("msg_id")]
    flag, reply, commit = (F.when(F.col("kind") == k, 1).otherwise(0).cast("long") for k in ("flag", "reply", "commit"))
    a = running(rows.withColumn("late", late), ["conversation_id"], order, [Run("segment", "sum", flag, False)], more=True)
    keys = ["conversation_id", "segment"]
    a = running(a, keys, order, [Run("depth", "sum", reply - commit), Run("reply_rank", "sum", reply)], more=True)
    a = running(a, keys, order, [Run("lowest", "min", F.col("depth"), False)], more=True)
    serves = (F.col("kind") == "commit") & (F.col("depth") >= F.least(F.lit(0), F.coalesce("lowest", F.lit(0))))
    a = checkpointed(running(a.withColumn("serves", serves), keys, order, [Run("serve_rank", "sum", serves.cast("long"))]))

    taken = a.where("serves").select(*keys, F.col("serve_rank").alias("reply_rank"), F.col("msg_id").alias("prior_id"))
    stops = a.where("kind = 'flag'").select(*keys, F.col("msg_id").alias("stop_id"))
    out = a.where("kind = 'reply'").join(taken, [*keys, "reply_rank"], "left").join(stops, keys, "left")
    outcome = F.when(F.col("prior_id").isNotNull(), "recovered").when(F.col("stop_id").isNotNull(), "flagged")
    return out.select("conversation_id", "msg_id", outcome.alias("outcome"), F.coalesce("prior_id", "stop_id").alias("prior_id"))
