"""Preference data for chat models: a shared prompt and two masked completions.

A pair is two conversations, one chosen and one rejected. Their longest common prefix of turns is rendered
once as the prompt; what follows in either is its completion. Completions are rows of rendered turns with a
mask: only the assistant's turns count for the loss.

Turns are compared by number: the prefix ends before the smallest turn number at which the two sides differ,
that is where one side holds a (role, text) more often than the other. That number is a minimum over a full
join on (pair, turn, role, text), so no conversation is ever gathered: one with a third of all rows is spread
like any other, and turns that repeat exactly are counted before the join.

Several turns under one number are ordered by role and text; a null number comes last, null roles and texts
are values of their own and render as empty. Pairs whose sides are equal have a prompt and no completions. A
pair that lacks a side has no prompt. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import col, stored

LAST = 2**62  # stands for a null turn number
RANGE = 1_000_000  # conversations in a range of ids
_TURN = ["pair", "turn", "role", "text"]


def rendered(role: Column, text: Column) -> Column:
    """One turn in chat markup."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def formatted(sides: DataFrame, *, assistant: str = "assistant") -> DataFrame:
    """(pair, part, turn, role, content, copies, loss) from turns (pair, chosen, turn, role, text).

    ``part`` is ``prompt``, ``chosen`` or ``rejected``; ``copies`` says how often the turn stands there.
    """
    turns = sides.select("pair", F.coalesce(F.col("turn").cast("bigint"), F.lit(LAST)).alias("turn"), "role", "text", "chosen")
    turns = turns.groupBy(*_TURN).agg(
        F.sum(F.col("chosen").cast("int")).alias("in_chosen"), F.sum((~F.col("chosen")).cast("int")).alias("in_rejected")
    )
    turns = stored(turns, "preference-turns")
    end = turns.where("in_chosen != in_rejected").groupBy("pair").agg(F.min("turn").alias("end"))
    turns = turns.join(end.withColumnRenamed("pair", "p"), F.col("pair").eqNullSafe(F.col("p")), "left").drop("p")
    shared = F.col("end").isNull() | (F.col("turn") < F.col("end"))
    parts = F.when(shared, F.array(F.struct(F.lit("prompt").alias("part"), F.col("in_chosen").alias("copies")))).otherwise(
        F.array(
            F.struct(F.lit("chosen").alias("part"), F.col("in_chosen").alias("copies")),
            F.struct(F.lit("rejected").alias("part"), F.col("in_rejected").alias("copies")),
        )
    )
    out = turns.select("pair", "turn", "role", "text", F.inline(parts)).where("copies > 0")
    return out.select(
        "pair", "part", F.nullif(F.col("turn"), F.lit(LAST)).alias("turn"), "role",
        rendered(F.col("role"), F.col("text")).alias("content"), "copies",
        ((F.col("part") != "prompt") & F.coalesce(F.col("role") == assistant, F.lit(False))).alias("loss"),
    )


def mismatched_replies(
    turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    assistant: str = "assistant",
) -> DataFrame:
    """Pairs (pair, chosen, turn, role, text) for conversations without a rejected side of their own.

    Rejected is the conversation with its last assistant reply replaced by that of the next conversation by
    id (none, for the last one); conversations without a reply are equal on both sides. Ids are dealt in ranges
    of equal size, whatever their gaps; one row a range meets the others in one task.
    """
    rows = turns.select(
        col(conv_id).alias("pair"), col(turn).cast("bigint").alias("turn"), col(role).cast("string").alias("role"), col(text).cast("string").alias("text")
    )
    replies = rows.where((F.col("role") == assistant) & F.col("pair").isNotNull() & F.col("turn").isNotNull())
    last = replies.groupBy("pair").agg(F.max_by(F.struct("turn", "text"), F.struct("turn", "text")).alias("last"))
    last = last.select("pair", F.col("last.turn").alias("at"), F.col("last.text").alias("reply"))
    last = stored(last, "last-replies")
    # The next conversation by id: inside ranges of ids, and from each range to the next one's first.
    ranges = max(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-last.count() // RANGE))
    dealt = last.repartitionByRange(ranges, "pair").withColumn("bucket", F.spark_partition_id())
    buckets = stored(dealt, "reply-ranges")
    firsts = buckets.groupBy("bucket").agg(F.min_by("reply", "pair").alias("first"))
    beyond = firsts.select("bucket", F.lead("first").over(Window.orderBy("bucket")).alias("beyond"))
    inside = Window.partitionBy("bucket").orderBy("pair")
    follow = buckets.withColumn("next", F.lead("reply").over(inside)).withColumn("ends", F.lead("pair").over(inside).isNull())
    other = follow.join(beyond, "bucket").select(
        F.col("pair").alias("p"), "at", F.when(F.col("ends"), F.col("beyond")).otherwise(F.col("next")).alias("other")
    )
    joined = rows.join(other, F.col("pair") == F.col("p"), "left")
    replaced = F.when((F.col("turn") == F.col("at")) & (F.col("role") == assistant), F.col("other")).otherwise(F.col("text"))
    sides = F.array(
        F.struct(F.lit(True).alias("chosen"), F.col("text").alias("t")), F.struct(F.lit(False).alias("chosen"), replaced.alias("t"))
    )
    return joined.select("pair", "turn", "role", F.inline(sides)).select("pair", "chosen", "turn", "role", F.col("t").alias("text"))
