"""Preference pairs: what two conversations share is the prompt, where they part are two completions.

The longest common prefix of turns is rendered once. What is left of either conversation is its
completion, with the places of it that are trained on: what assistants say, end mark included, and
nothing of the turns of others or of the marks before a turn.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of a turn in the common chat form, and whose turns are trained on.
OPEN, HEAD, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def _turn() -> Column:
    """A row as a turn; a NULL role or text is empty."""
    return F.struct(
        F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def _said(turns: Column) -> Column:
    """Collected turns in order, without their numbers; equal numbers are ordered by role and text."""
    return F.transform(F.sort_array(turns), lambda turn: F.struct(turn["role"], turn["text"]))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda turn: F.concat(
        F.lit(OPEN), turn["role"], F.lit(HEAD), turn["text"], F.lit(CLOSE)
    )), "")


def _trained(turns: Column) -> Column:
    """`start` and `end`, in code points of the rendered turns, of what is trained on."""
    def step(seen: Column, turn: Column) -> Column:
        start = seen["at"] + F.length(F.concat(F.lit(OPEN), turn["role"], F.lit(HEAD)))
        end = start + F.length(turn["text"]) + len(CLOSE)
        span = F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(turn["role"] == TRAINED, F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, begin, step, lambda seen: seen["spans"])


def _shared(one: Column, other: Column) -> Column:
    """How many turns both begin with."""
    n = F.least(F.size(one), F.size(other))
    same = F.zip_with(F.slice(one, 1, n), F.slice(other, 1, n), lambda turn, with_turn: turn == with_turn)
    parting = F.array_position(same, False)
    return F.when(parting == 0, n).otherwise((parting - 1).cast("int"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """`pairs` with `prompt_turns`, `prompt`, and for each side the completion and its trained spans, in place of
    `chosen` and `rejected`, which are arrays of turns (`role`, `text`).

    If one side ends where the other goes on, its completion is empty; if both are alike, both are, and all
    turns are the prompt: `differs` says whether there is anything to prefer. A column of `pairs` that has the name of
    one of the result gives way to it.
    """
    made = ("prompt_turns", "prompt", "chosen", "chosen_trained", "rejected", "rejected_trained", "differs")
    others = [F.col(f"`{name}`") for name in pairs.columns if name not in made]
    counted = pairs.withColumn("prompt_turns", _shared(F.col("chosen"), F.col("rejected")))
    rest = {side: F.slice(side, F.col("prompt_turns") + 1, F.size(side)) for side in ("chosen", "rejected")}
    # A slice of no length is not allowed to start behind an empty array.
    rest = {side: F.when(F.size(side) > F.col("prompt_turns"), part).otherwise(F.array().cast(TURNS))
            for side, part in rest.items()}
    shared = F.when(F.col("prompt_turns") > 0, F.slice("chosen", 1, F.col("prompt_turns"))).otherwise(F.array().cast(TURNS))
    return counted.withColumns({f"{side}_rest": part for side, part in rest.items()}).select(
        *others, "prompt_turns", _rendered(shared).alias("prompt"),
        _rendered(F.col("chosen_rest")).alias("chosen"), _trained(F.col("chosen_rest")).alias("chosen_trained"),
        _rendered(F.col("rejected_rest")).alias("rejected"), _trained(F.col("rejected_rest")).alias("rejected_trained"),
        (F.col("chosen_rest") != F.col("rejected_rest")).alias("differs"),
    )


def _alone(rows: DataFrame, key: str) -> DataFrame:
    """`rows` with a number `_alone` for those without a key, which belong to no conversation: each is one of its own,
    so that however many there are, no task holds them all."""
    return rows.withColumn("_alone", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Pairs from two tables of turns (`key`, `turn`, `role`, `text`), one row per key of either, as `format_pairs` has it.

    Both tables meet in one shuffle. A key that one of them lacks has no turns on that side; each turn of a NULL key
    makes a pair of its own; repeated rows are repeated turns; NULL roles and texts are empty, and turns of equal number
    go by role and text; without rows there are no pairs; other columns are not looked at.
    """
    sides = [rows.select(key, F.lit(side).alias("side"), _turn().alias("said"))
             for side, rows in (("chosen", chosen), ("rejected", rejected))]
    pairs = _alone(sides[0].union(sides[1]), key).groupBy(key, "_alone").agg(*[
        _said(F.collect_list(F.when(F.col("side") == side, F.col("said")))).alias(side) for side in ("chosen", "rejected")
    ])
    return format_pairs(pairs.drop("_alone"))


def against_earlier_reply(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs out of plain conversations: each is preferred to itself with the text of its last assistant turn taken
    from the assistant turn before, or, without one, to itself without that turn and what follows.

    A conversation in which no assistant speaks has nothing to prefer, and one that repeats its reply neither. NULLs, ties,
    repeated rows, tables without rows and other columns are as `preference_pairs` has them: a turn of a NULL key
    is a conversation of its own.
    """
    whole = _alone(conversations.select(key, _turn().alias("said")), key).groupBy(key, "_alone").agg(
        _said(F.collect_list("said")).alias("chosen")
    ).drop("_alone")
    turns = F.col("chosen")
    places = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda place: F.element_at(turns, place)["role"] == TRAINED)
    last, before = F.try_element_at("places", F.lit(-1)), F.try_element_at("places", F.lit(-2))
    replaced = F.transform(turns, lambda turn, place: F.when(
        place + 1 == last, F.struct(turn["role"], F.element_at(turns, before)["text"].alias("text"))
    ).otherwise(turn))
    cut = F.when(last > 1, F.slice(turns, 1, last - 1)).otherwise(F.array().cast(TURNS))
    rejected = F.when(last.isNull(), turns).when(before.isNull(), cut).otherwise(replaced)
    return format_pairs(
        whole.withColumn("places", places).withColumn("rejected", rejected).drop("places")
    )
