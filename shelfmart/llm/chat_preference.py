"""Preference formatting: one prompt, two masked completions, in DataFrame functions.

A pair holds a chosen and a rejected conversation as arrays of turns. Their longest common
turn prefix is rendered once, as the prompt; the rest of each side is a completion whose
assistant texts (with the mark that ends them) carry the loss. Everything is higher-order
functions over the two arrays of a row: no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE, END = "<|", "|>", "<|end|>"
LEARNED_ROLE = "assistant"
_TURNS = "array<struct<role string, text string>>"


def _safe(text: Column) -> Column:
    """A text cannot open a mark of its own: ``<|`` in it becomes ``< |``."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _safe(F.coalesce(turn["role"], F.lit("unknown"))), F.lit(CLOSE + "\n"))


def _body(turn: Column) -> Column:
    return F.concat(_safe(turn["text"]), F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def loss_mask(turns: Column) -> Column:
    """Character ranges [start, end) of the rendered turns that carry the loss."""
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start long, end long>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(_body(t))
        span = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct((end + 1).cast("long").alias("at"),
                        F.when(t["role"].eqNullSafe(LEARNED_ROLE), F.concat(acc["spans"], span))
                         .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix; turns are equal if role and text are (null equals null)."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n),
                      lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]))
    first_other = F.array_position(same, False)
    return F.when(first_other > 0, first_other - 1).otherwise(n).cast("long")


def format_pairs(pairs: DataFrame, id_col: str = "pair_id", chosen_col: str = "chosen",
                 rejected_col: str = "rejected") -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask, status) per row.

    ``status`` is ``ok``, ``identical`` (the sides do not differ: both completions empty),
    ``chosen_empty`` or ``rejected_empty`` (that side is a prefix of the other). A null side
    counts as a conversation without turns, a null turn as one without role and text. Roles
    and texts may be null: null role renders as ``unknown``, null text as empty. Masks are
    character offsets into the completion; a completion without an assistant turn has an
    empty mask. Repeated and null ids are rows like any other, other columns are ignored. An
    empty table gives none.
    """
    none = F.array().cast(_TURNS)

    def turns(name: str) -> Column:
        return F.transform(F.coalesce(F.col(name), none), lambda t: F.struct(
            t["role"].cast("string").alias("role"), t["text"].cast("string").alias("text")))

    sides = pairs.select(F.col(id_col).alias("pair_id"), turns(chosen_col).alias("c"), turns(rejected_col).alias("r"))
    cut = sides.withColumn("n_common", common_turns(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(F.col(side), (F.col("n_common") + 1).cast("int"), F.size(side))
    prefix = F.slice(F.col("c"), 1, F.col("n_common").cast("int"))
    split = cut.select("pair_id", "n_common", prefix.alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    status = (F.when((F.size("c") == 0) & (F.size("r") == 0), "identical").when(F.size("c") == 0, "chosen_empty")
              .when(F.size("r") == 0, "rejected_empty").otherwise("ok"))
    return split.select("pair_id", "n_common", render(F.col("p")).alias("prompt"), render(F.col("c")).alias("chosen"),
                        render(F.col("r")).alias("rejected"), loss_mask(F.col("c")).alias("chosen_mask"),
                        loss_mask(F.col("r")).alias("rejected_mask"), status.alias("status"))


def reply_pairs(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(pair_id, chosen, rejected): a preference pair from each conversation with a reply.

    Chosen is the conversation up to its last assistant turn. Rejected has, instead of that
    turn, the last assistant turn of the neighbour (ids 2k and 2k + 1 are neighbours): a reply
    to something else. Without a neighbour's reply the rejected side ends at the prompt.
    Turns are ordered by (turn, role, text), nulls first; rows with a null conversation id
    belong to no conversation. The turns of two neighbours are gathered in one row, as the
    rendered conversation is one value.
    """
    narrow = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    both = narrow.groupBy(F.shiftright("conv", 1).alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("conv", "turn", "role", "text"))).alias("rows"))
    own = lambda bit: F.filter("rows", lambda x: F.pmod(x["conv"], F.lit(2)) == bit)

    def last(side: str) -> Column:
        return F.size(side) - F.coalesce(F.nullif(F.array_position(
            F.transform(F.reverse(side), lambda t: t["role"].eqNullSafe(LEARNED_ROLE)), True),
            F.lit(0)), F.size(side) + 1) + 1

    split = both.select(own(0).alias("a"), own(1).alias("b"))
    marked = split.withColumns({"la": last("a").cast("int"), "lb": last("b").cast("int")})

    def pair(mine: str, at: str, other: str, its: str) -> Column:
        prompt = F.slice(mine, 1, F.greatest(F.col(at) - 1, F.lit(0)))
        reply = F.slice(other, F.greatest(F.col(its), F.lit(1)), F.when(F.col(its) > 0, 1).otherwise(0))
        return F.struct((F.col(at) > 0).alias("replied"), F.get(mine, F.lit(0))["conv"].alias("pair_id"),
                        F.slice(mine, 1, F.col(at)).alias("chosen"), F.concat(prompt, reply).alias("rejected"))

    pairs = marked.select(F.explode(F.array(pair("a", "la", "b", "lb"), pair("b", "lb", "a", "la"))).alias("p"))
    turns = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return pairs.filter("p.replied").select(F.col("p.pair_id").alias("pair_id"), turns("p.chosen").alias("chosen"),
                                            turns("p.rejected").alias("rejected"))
