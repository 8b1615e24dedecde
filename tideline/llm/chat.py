"""Preference formatting: common turns once as prompt, the rest as masked completions.

Chosen and rejected turns meet by pair and turn number; the first turn at which
they differ is a minimum per pair, found with partial aggregation.  Turns before
it are rendered once into the prompt, the others into the completion of their
side.  Turns are rendered where they are and only the rendered strings of a
pair are gathered, since they become one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def opening(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def closing(text: Column) -> Column:
    """A turn's text with its end mark; marks inside the text are broken up."""
    return F.concat(F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def _turns(side: DataFrame, pair_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One row per pair and turn."""
    role = F.coalesce(F.col(role_col), F.lit("unknown"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        side.filter(F.col(pair_col).isNotNull() & F.col(turn_col).isNotNull())
        .groupBy(F.col(pair_col).alias("pair"), F.col(turn_col).alias("turn"))
        .agg(F.min(F.struct(role.alias("role"), text.alias("text"))).alias("said"))
    )


def format_preferences(
    chosen: DataFrame, rejected: DataFrame, pair_col: str = "pair_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", trained: str = ASSISTANT,
) -> DataFrame:
    """One row per pair: pair id, prompt, prompt_turns, chosen, rejected.

    Both inputs have a row per turn.  ``prompt`` renders the longest common
    prefix of turns (equal number, role and text); ``chosen`` and ``rejected``
    are arrays of (text, trained): the rest of each side in order, an opening
    that is masked and a text with its end mark that is trained if the role is
    ``trained``.  A pair that has one side only has the other side empty and no
    common turn.  NULL texts are empty, NULL roles are "unknown"; rows without a
    pair or turn number belong to no conversation and are left out.  Rows that
    repeat a turn are one turn, with the smallest (role, text).  Empty tables
    give an empty result; other columns are ignored.
    """
    columns = (pair_col, turn_col, role_col, text_col)
    left = _turns(chosen, *columns).withColumnRenamed("said", "c")
    right = _turns(rejected, *columns).withColumnRenamed("said", "r")
    both = left.join(right, ["pair", "turn"], "full")
    same = F.col("c").eqNullSafe(F.col("r"))
    first = F.min(F.when(~same, F.col("turn"))).alias("first")
    told = both.join(both.groupBy("pair").agg(first), "pair")
    common = F.col("first").isNull() | (F.col("turn") < F.col("first"))

    def piece(said: str, when: Column) -> Column:
        at = F.col(said)
        return F.when(
            when & at.isNotNull(),
            F.struct(
                "turn", opening(at["role"]).alias("head"), closing(at["text"]).alias("body"),
                (at["role"] == trained).alias("trained"),
            ),
        )

    gathered = told.groupBy("pair").agg(
        F.array_sort(F.collect_list(piece("c", common))).alias("p"),
        F.array_sort(F.collect_list(piece("c", ~common))).alias("c"),
        F.array_sort(F.collect_list(piece("r", ~common))).alias("r"),
    )

    def segments(side: str) -> Column:
        return F.flatten(
            F.transform(
                side,
                lambda t: F.array(
                    F.struct(t["head"].alias("text"), F.lit(False).alias("trained")),
                    F.struct(t["body"].alias("text"), t["trained"].alias("trained")),
                ),
            )
        ).alias({"c": "chosen", "r": "rejected"}[side])

    return gathered.select(
        F.col("pair").alias(pair_col),
        F.array_join(F.transform("p", lambda t: F.concat(t["head"], t["body"])), "").alias("prompt"),
        F.size("p").cast("long").alias("prompt_turns"),
        segments("c"),
        segments("r"),
    )


def flat(side: str) -> Column:
    """Text of a completion."""
    return F.array_join(F.transform(side, lambda s: s["text"]), "")


def mask(side: str) -> Column:
    """Mask of a completion as mark:length of its segments, 1 for trained."""
    return F.array_join(
        F.transform(
            side,
            lambda s: F.concat(
                F.when(s["trained"], "1:").otherwise("0:"), F.length(s["text"]).cast("string")
            ),
        ),
        ",",
    )


def swapped_endings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides made from conversations (conv_id, turn, role, text).

    A conversation as it stands is chosen; rejected is the same with its last
    assistant turn's text replaced by that of the conversation numbered one
    higher, or by nothing if there is none.
    """
    last = turns.filter(F.col("role") == ASSISTANT).groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("end")
    )
    other = last.select((F.col("conv_id") - 1).alias("conv_id"), F.col("end.text").alias("taken"))
    ends = last.select("conv_id", F.col("end.turn").alias("at")).join(other, "conv_id", "left")
    rejected = turns.join(ends, "conv_id", "left").select(
        "conv_id", "turn", "role",
        F.when(F.col("turn") == F.col("at"), F.coalesce("taken", F.lit(""))).otherwise(
            F.col("text")
        ).alias("text"),
    )
    return turns, rejected
