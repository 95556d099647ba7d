"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once as the prompt; what follows on either side
becomes a completion whose mask marks the characters to train on: the text and the end mark of
assistant turns. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
END = "<|end|>\n"


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"))


def ordered_turns(turns: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Turns (pair_id, side, turn, role, text) with their ``position`` from 1 on their side.

    Rows without a pair belong to none and are left out; repeated rows count once. Turns are
    ordered by number (null first), ties by role and text. A null text is an empty one. All
    rows of a pair are dealt to one task, so that nothing after this moves the texts again;
    ``dealt_by`` names columns of the rows that they already are dealt by, all pairs whole.
    """
    rows = turns.where(F.col("pair_id").isNotNull()).select(
        *dealt_by, "pair_id", "side", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = (rows if dealt_by else rows.repartition("pair_id")).distinct()
    order = Window.partitionBy(*dealt_by, "pair_id", "side").orderBy("turn", "role", "text")
    return rows.withColumn("position", F.row_number().over(order))


def with_prefix(placed: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Ordered turns with ``prefix``: how many turns both sides of their pair share from the start.

    The first position that only one side has, or at which role or text differ, ends the
    prefix; a pair with one side has none.
    """
    here = Window.partitionBy(*dealt_by, "pair_id", "position")
    said = F.struct("role", "text")
    same = (F.count("*").over(here) == 2) & F.min(said).over(here).eqNullSafe(F.max(said).over(here))
    pair = Window.partitionBy(*dealt_by, "pair_id")
    return placed.withColumn("same", same).withColumn("prefix", F.coalesce(
        F.min(F.when(~F.col("same"), F.col("position") - 1)).over(pair), F.max("position").over(pair))).drop("same")


def segments(turns: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """Rendered turns: pair, part (prompt, chosen, rejected), position, text, start and mask.

    ``start`` is where the turn begins in its part; ``mask_start`` and ``mask_end`` (null for
    other roles and in the prompt) span the characters to train on, in code points.
    """
    rows = with_prefix(ordered_turns(turns, dealt_by), dealt_by)
    shared = F.col("position") <= F.col("prefix")
    rows = rows.where(~shared | (F.col("side") == "chosen")).withColumn(
        "part", F.when(shared, F.lit("prompt")).otherwise(F.col("side")))
    rows = rows.withColumn("rendered", F.concat(header(F.col("role")), "text", F.lit(END)))
    so_far = (Window.partitionBy(*dealt_by, "pair_id", "part").orderBy("position")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum(F.length("rendered")).over(so_far), F.lit(0)).cast("long")
    trained = (F.col("part") != "prompt") & (F.col("role") == TRAINED_ROLE)
    rows = rows.withColumn("start", start)
    return rows.select(
        *dealt_by, "pair_id", "part", "prefix", "position", "role", "rendered", "start",
        F.when(trained, F.col("start") + F.length(header(F.col("role")))).alias("mask_start"),
        F.when(trained, F.col("start") + F.length("rendered")).alias("mask_end"))


def preference_records(turns: DataFrame, dealt_by: Sequence[str] = ()) -> DataFrame:
    """One row per pair: prompt, chosen and rejected completions, and their masks.

    Masks are arrays of (start, end) in their completion. Conversations of equal turns have
    empty completions, a side without turns an empty one. A record holds one conversation
    pair; use ``segments`` for conversations too long for one row. An empty table gives none.
    """
    turn = F.struct("position", "rendered", F.col("mask_start").alias("start"),
                    F.col("mask_end").alias("end"))

    def part(name: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("part") == name, turn))).alias(name)

    def text(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: s["rendered"]), "").alias(name)

    def mask(name: str) -> Column:
        held = F.filter(name, lambda s: s["start"].isNotNull())
        return F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
                           ).alias(f"{name}_mask")
    return (segments(turns, dealt_by).groupBy(*dealt_by, "pair_id")
            .agg(F.max("prefix").cast("long").alias("prompt_turns"),
                 part("prompt"), part("chosen"), part("rejected"))
            .select("pair_id", "prompt_turns", text("prompt"), text("chosen"), mask("chosen"),
                    text("rejected"), mask("rejected")))


def sibling_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations (conv_id, turn, role, text).

    The chosen side is the conversation. The rejected side has its turns before the last
    assistant reply and then the last reply of its sibling, the conversation whose id differs
    in the lowest bit; without such a reply it ends there. A conversation without a reply is
    the same on both sides. Siblings are dealt to one task by the column ``siblings``, so each
    text is moved once and copied to the two sides after that. Rows without an id are left out.
    """
    rows = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.shiftright("conv_id", 1).alias("siblings"), F.col("conv_id").alias("pair_id"),
                    "turn", "role", "text").repartition("siblings"))
    first = F.col("pair_id") == F.shiftleft("siblings", 1)
    reply = F.when(F.col("role") == TRAINED_ROLE, F.struct("turn", "text"))
    both = Window.partitionBy("siblings")
    rows = (rows.withColumn("of_first", F.max(F.when(first, reply)).over(both))
            .withColumn("of_second", F.max(F.when(~first, reply)).over(both)))
    own = F.when(first, F.col("of_first")).otherwise(F.col("of_second"))
    other = F.when(first, F.col("of_second")).otherwise(F.col("of_first"))
    before = own.isNull() | own["turn"].isNull() | F.col("turn").isNull() | (F.col("turn") < own["turn"])
    replaced = other.isNotNull() & (F.col("role") == TRAINED_ROLE) & F.col("turn").eqNullSafe(own["turn"])

    def side(name: str, text: Column) -> Column:
        return F.struct(F.lit(name).alias("side"), text.alias("text"))
    sides = F.array_compact(F.array(
        side("chosen", F.col("text")), F.when(before, side("rejected", F.col("text"))),
        F.when(replaced, side("rejected", other["text"]))))
    return (rows.select("siblings", "pair_id", "turn", "role", F.explode(sides).alias("said"))
            .select("siblings", "pair_id", "said.side", "turn", "role", "said.text"))
