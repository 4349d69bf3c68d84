"""Preference pairs: the common beginning once as prompt, the rest as two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# How a turn is written; "<|" inside a text is parted so that it can't be taken for a mark.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def _header(turn: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.replace(F.coalesce(turn["text"], F.lit("")), F.lit("<|"), F.lit("< |")), F.lit(END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _spans(turns: Column) -> Column:
    """``start:end`` in characters of what is trained on: assistants' bodies with their end mark."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_header(turn))
        end = start + F.length(_body(turn))
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(turn["role"].eqNullSafe(TRAINED), F.array_append(state["spans"], span))
                        .otherwise(state["spans"]).alias("spans"))
    return F.aggregate(turns, zero, step, lambda state: F.array_join(state["spans"], ","))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pair_id, n_prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans``.

    ``pairs`` has ``pair_id`` and the turns ``chosen`` and ``rejected`` (``TURNS``).
    The prompt is the longest common prefix in whole turns; of equal
    conversations it is everything and both completions are empty.  A null
    conversation has no turns, a null turn, role or text is an empty one, and
    nulls equal each other.  Long texts are rendered whole; repeated pairs give
    repeated rows; other columns are not read; an empty table gives an empty
    result.
    """
    empty = F.array().cast(TURNS)
    chosen, rejected = F.coalesce("chosen", empty), F.coalesce("rejected", empty)
    turns = pairs.select("pair_id", chosen.alias("chosen"), rejected.alias("rejected"))
    # Positions beyond the shorter one are null there and differ.
    same = F.zip_with(
        F.transform("chosen", lambda t: F.struct(t["role"], t["text"])),
        F.transform("rejected", lambda t: F.struct(t["role"], t["text"])), lambda a, b: a.eqNullSafe(b))
    differ = F.array_position(same, False)
    common = F.when(differ > 0, differ - 1).otherwise(F.size("chosen")).cast("int")
    cut = turns.select(
        "pair_id", common.alias("n_prompt_turns"), F.slice("chosen", F.lit(1), common).alias("prompt"),
        F.slice("chosen", common + 1, F.size("chosen")).alias("chosen"),
        F.slice("rejected", common + 1, F.size("rejected")).alias("rejected"),
    )
    return cut.select(
        "pair_id", "n_prompt_turns", _rendered(F.col("prompt")).alias("prompt"),
        _rendered(F.col("chosen")).alias("chosen"), _spans(F.col("chosen")).alias("chosen_spans"),
        _rendered(F.col("rejected")).alias("rejected"), _spans(F.col("rejected")).alias("rejected_spans"),
    )


def answer_pairs(conversations: DataFrame) -> DataFrame:
    """``pair_id, chosen, rejected`` from ``conversations (conv_id, turn, role, text)``.

    Each conversation is chosen; rejected is the same with its last assistant turn
    replaced by that of its neighbour (ids 2k and 2k+1 are neighbours; without
    one by an empty text).  A conversation is one record, its turns in order of
    turn, role and text, however many there are.  A row without ``conv_id`` is a
    conversation of its own, with no neighbour and a null ``pair_id``.  A null
    turn number sorts first, a null role is no assistant's, a null text stays
    null; repeated rows are repeated turns; other columns are not read; an empty
    table gives an empty result.
    """
    turn = F.struct("turn", "role", "text")
    whole = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    lone = conversations.where(F.col("conv_id").isNull()).select("conv_id", F.array(turn).alias("turns"))
    other = _placed(whole).select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("neighbour"),
        F.when(F.col("at").isNotNull(), F.element_at("turns", F.coalesce("at", F.lit(1)))["text"]).alias("other"))
    placed = _placed(whole).unionByName(_placed(lone))
    return placed.join(other, F.col("conv_id") == F.col("neighbour"), "left").select(
        F.col("conv_id").alias("pair_id"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("chosen"),
        F.transform("turns", lambda t, k: F.struct(
            t["role"].alias("role"),
            F.when((k + 1).eqNullSafe(F.col("at")), F.coalesce("other", F.lit(""))).otherwise(t["text"]).alias("text"),
        )).alias("rejected"),
    )


def _placed(whole: DataFrame) -> DataFrame:
    """Conversations with the place of their last assistant turn, from 1 (``at``)."""
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda k: F.element_at("turns", k)["role"].eqNullSafe(TRAINED))
    return whole.select("conv_id", "turns", F.array_max(places).alias("at"))
