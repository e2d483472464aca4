"""Chat formatting by perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker
as ``assistant`` and all others as named users; loss masks cover exactly the speaker's
turns. System turns stay system turns, and ``system`` is nobody's perspective.

Turns are numbered in order (turn, role, text; nulls first) by range partitioning, and
a rendering is cut into parts of at most ``part_turns`` turns, so no task ever holds
a conversation of unbounded length; short conversations have the one part 0.

Edge cases: a null conversation id is a conversation of its own; a null role speaks as
``unknown``; a null text is empty; repeated turns are kept, each as a turn; a
conversation with system turns only has no rendering; an empty table gives an empty
result; extra columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import row_number_within
from .common import checkpoint, pick

PART_TURNS = 256
SYSTEM, UNKNOWN, END = "system", "unknown", "<|end|>"


def _piece(role: Column, speaker: Column) -> Column:
    """Header of a message: ``<|assistant|>``, ``<|system|>`` or ``<|user name=...|>``."""
    return (F.when(role == SYSTEM, F.lit("<|system|>\n")).when(role == speaker, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n"))))


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, perspective, part, n_turns, dialogue, masks``.

    ``masks`` holds ``(begin, length)`` in characters of ``dialogue``: the speaker's texts
    with their end marks, in order.
    """
    rows = pick(turns, "conv_id", "turn", "role", "text").select(
        "conv_id", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("k"),
        "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    ranked = checkpoint(row_number_within(rows, ["k"], ["turn", "role", "text"], out="rn"))
    speakers = ranked.where(F.col("role") != SYSTEM).select(
        F.col("k").alias("_k"), F.col("role").alias("perspective")).distinct()
    part = F.floor((F.col("rn") - 1) / part_turns).cast("long")
    each = ranked.join(speakers, F.col("k") == F.col("_k")).select(
        "k", "conv_id", "perspective", part.alias("part"),
        F.struct("rn", _piece(F.col("role"), F.col("perspective")).alias("head"),
                 F.concat("text", F.lit(END)).alias("body"),
                 (F.col("role") == F.col("perspective")).alias("own")).alias("m"))
    parts = each.groupBy("k", "conv_id", "perspective", "part").agg(
        F.sort_array(F.collect_list("m")).alias("m"))
    size = lambda m: F.length(m["head"]) + F.length(m["body"]) + 1
    begin = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<begin:bigint,length:bigint>>").alias("masks"))
    walked = F.aggregate("m", begin, lambda s, m: F.struct(
        (s["at"] + size(m)).cast("long").alias("at"),
        F.when(m["own"], F.array_append(s["masks"], F.struct(
            (s["at"] + F.length(m["head"])).cast("long").alias("begin"),
            F.length(m["body"]).cast("long").alias("length")))).otherwise(s["masks"]).alias("masks")))
    text = F.array_join(F.transform("m", lambda m: F.concat(m["head"], m["body"], F.lit("\n"))), "")
    return parts.select("conv_id", "perspective", "part", F.size("m").cast("long").alias("n_turns"),
                        text.alias("dialogue"), walked["masks"].alias("masks"))
