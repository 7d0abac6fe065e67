"""Preference formatting of conversations (operator 10).

A pair of a chosen and a rejected conversation is split at its longest common
prefix of turns. The prefix is rendered once, as the prompt; what follows on
either side is a completion, with the spans that a loss may look at: the
texts and end marks of assistant turns. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks around a turn (fixed values of the chat format).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

TURNS = "array<struct<role:string,text:string>>"
SPANS = "array<struct<start:int,end:int>>"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("unknown")), F.lit("\n"))


def _body(turn: Column) -> Column:
    """The text, in which marks are broken by a space, and the end mark."""
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit("<|"), F.lit("< |")), F.lit(CLOSE))


def rendered(turns: Column) -> Column:
    """The turns as text, each with its marks on lines of their own."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t), F.lit("\n"))), "")


def loss_spans(turns: Column) -> Column:
    """Where the assistant's texts and end marks are in ``rendered(turns)`` (code points, end exclusive)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.length(_header(t))
        end = begin + F.length(_body(t))
        own = F.array(F.struct(begin.alias("start"), end.alias("end")))
        spans = F.when(t["role"] == "assistant", F.concat(acc["spans"], own)).otherwise(acc["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """The number of turns, from the first, that are equal in role and text."""
    places = F.sequence(F.lit(0), F.least(F.size(a), F.size(b)))
    # Beyond the shorter one there is no turn on one side, so the last place differs or ends it.
    differs = F.filter(places, lambda i: (i >= F.least(F.size(a), F.size(b))) | ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.array_min(differs)


def format_pairs(pairs: DataFrame, *, id_col: str = "pair_id", chosen_col: str = "chosen", rejected_col: str = "rejected") -> DataFrame:
    """``pair_id, prefix_turns, prompt, chosen, rejected, chosen_spans, rejected_spans``.

    ``pairs`` has two arrays of ``role, text`` per row; a null array counts as
    empty. One row per row of ``pairs``, nothing shuffled. If one side is a
    prefix of the other, or both are equal, its completion is empty and has no
    spans. A null role is rendered as ``unknown``, a null text as empty.
    """
    side = lambda c: F.coalesce(F.col(c).cast(TURNS), F.array().cast(TURNS))
    rows = pairs.select(F.col(id_col).alias("pair_id"), side(chosen_col).alias("c"), side(rejected_col).alias("r"))
    rows = rows.withColumn("n", common_turns(F.col("c"), F.col("r")))
    rest = lambda turns: F.slice(turns, F.col("n") + 1, F.greatest(F.size(turns) - F.col("n"), F.lit(0)))
    rows = rows.select("pair_id", "n", F.slice("c", F.lit(1), F.col("n")).alias("p"), rest(F.col("c")).alias("c"), rest(F.col("r")).alias("r"))
    return rows.select(
        "pair_id",
        F.col("n").cast("long").alias("prefix_turns"),
        rendered(F.col("p")).alias("prompt"),
        rendered(F.col("c")).alias("chosen"),
        rendered(F.col("r")).alias("rejected"),
        loss_spans(F.col("c")).alias("chosen_spans"),
        loss_spans(F.col("r")).alias("rejected_spans"),
    )


def swapped_replies(
    turns: DataFrame,
    *,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    repeated: bool = False,
) -> DataFrame:
    """``pair_id, chosen, rejected`` for every conversation of ``turns``.

    Chosen is the conversation up to its last assistant turn. Rejected has in
    that turn's place the last assistant turn of the conversation whose id
    differs in the lowest bit, or nothing if there is none; ids need not be
    dense. A conversation without an assistant turn is paired with itself.

    Turns are ordered by number, then role and text, nulls first. Equal rows of
    a conversation count once, so any number of them combine before the
    shuffle; with ``repeated`` they are turns as often as they come. A
    conversation is one row, its turns have to fit into a task. A row without a conversation id is in no conversation. An empty
    table gives no row.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    by_id = turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("pair_id"))
    whole = by_id.agg(F.array_sort((F.collect_list if repeated else F.collect_set)(turn)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    whole = whole.select("pair_id", plain.cast(TURNS).alias("turns"))
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.get("turns", i - 1)["role"] == "assistant")
    whole = whole.withColumn("last", F.coalesce(F.array_max(places), F.lit(0)))
    reply = F.get("turns", F.col("last") - 1)
    others = whole.where("last > 0").select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.array(reply).alias("other"))
    rows = whole.join(others, "pair_id", "left")
    empty = F.array().cast(TURNS)
    before = F.slice("turns", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0)))
    chosen = F.when(F.col("last") > 0, F.slice("turns", F.lit(1), F.col("last"))).otherwise(F.col("turns"))
    rejected = F.when(F.col("last") > 0, F.concat(before, F.coalesce("other", empty))).otherwise(F.col("turns"))
    return rows.select("pair_id", chosen.alias("chosen"), rejected.alias("rejected"))


def digest(formatted: DataFrame) -> DataFrame:
    """The spans as ``start:end`` joined by commas."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return formatted.withColumns({c: joined(c) for c in ("chosen_spans", "rejected_spans")})
