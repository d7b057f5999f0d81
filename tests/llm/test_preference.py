"""Preference pairs against a plain version and SQL."""

import pytest

from curate.llm.preference import TURNS, against_earlier_reply, format_pairs, preference_pairs
from curate.llm.queries import ORACLES, QUERIES
from tests.compare import connect, kind, rows
from tests.llm.conftest import SF_DIR


def render(turns):
    """The text of turns, and the spans of what assistants say."""
    text, spans = "", []
    for role, said in turns:
        text += f"<|im_start|>{role}\n"
        if role == "assistant":
            spans.append((len(text), len(text) + len(said) + len("<|im_end|>\n")))
        text += f"{said}<|im_end|>\n"
    return text, spans


def plain(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    return (n, render(chosen[:n])[0], *render(chosen[n:]), *render(rejected[n:]), chosen[n:] != rejected[n:])


U, A, S = "user", "assistant", "system"
PAIRS = {
    1: ([(U, "hi 😀"), (A, "good"), (U, "more"), (A, "fine")], [(U, "hi 😀"), (A, "bad é")]),
    2: ([(S, "be"), (U, "q"), (A, "x")], [(S, "be"), (U, "q"), (A, "y")]),
    3: ([(U, "q"), (A, "x")], [(U, "q"), (A, "x")]),
    4: ([(U, "q")], [(U, "q"), (A, "x")]),
    5: ([(U, "a")], [(U, "b"), (A, "")]),
    6: ([], [(U, "b")]), 7: ([(A, "x" * 5000)], []),
    8: ([(U, "same"), (A, "x")], [(A, "same"), (A, "x")]),
}
SCHEMA = "pair_id long, turn int, role string, text string"


def table(spark, side):
    found = [(key, place, *turn) for key, pair in PAIRS.items() for place, turn in enumerate(pair[side])]
    return spark.createDataFrame(found[::-1], SCHEMA)


def test_pairs(spark):
    found = {row["pair_id"]: row for row in preference_pairs(table(spark, 0), table(spark, 1)).collect()}
    assert set(found) == set(PAIRS)
    for key, (chosen, rejected) in PAIRS.items():
        row = found[key]
        assert (row["prompt_turns"], row["prompt"], row["chosen"], [tuple(s) for s in row["chosen_trained"]],
                row["rejected"], [tuple(s) for s in row["rejected_trained"]], row["differs"]) == plain(chosen, rejected), key


def test_nulls_ties_repeats_and_no_rows(spark):
    from pyspark.sql import functions as F

    one = spark.createDataFrame([(None, 0, U, "q"), (None, 1, A, None), (9, None, None, "z"), (9, 0, U, "b"), (9, 0, U, "a"),
                                 (9, 0, U, "a")], SCHEMA).withColumn("chosen", F.lit("clash"))
    rows = preference_pairs(one, one.where("text <> 'b' or text is null")).collect()
    found = {row["pair_id"]: row for row in rows}
    # Each turn without a key is a pair of its own, with nothing on the other side.
    alone = [render([turn])[0] for turn in ((U, "q"), (A, ""))]
    assert sorted((row["chosen"], row["rejected"]) for row in rows if row["pair_id"] is None) == sorted(
        [(text, "") for text in alone] + [("", text) for text in alone])
    assert len(against_earlier_reply(one.withColumnRenamed("pair_id", "conv_id")).where("conv_id is null").collect()) == 2
    clashing = format_pairs(spark.createDataFrame([(1, [(U, "a")], [], "x", 5)], f"key int, chosen {TURNS}, rejected {TURNS}, prompt string, differs int"))
    assert clashing.columns.count("prompt") == clashing.columns.count("differs") == 1 and clashing.first()["prompt"] == ""
    assert found[9]["prompt"] == render([("", "z"), (U, "a"), (U, "a")])[0]
    assert found[9]["chosen"] == render([(U, "b")])[0] and found[9]["rejected"] == ""
    assert preference_pairs(one.limit(0), one.limit(0)).count() == 0
    assert against_earlier_reply(one.withColumnRenamed("pair_id", "conv_id").limit(0)).count() == 0


@pytest.mark.parametrize("turns, rejected", [
    ([(U, "a"), (A, "1"), (U, "b"), (A, "2"), (U, "c")], [(U, "a"), (A, "1"), (U, "b"), (A, "1"), (U, "c")]),
    ([(U, "a"), (A, "1")], [(U, "a")]), ([(A, "1")], []), ([(U, "a")], [(U, "a")]),
    ([(A, "1"), (A, "1")], [(A, "1"), (A, "1")]),
])
def test_earlier_replies(spark, turns, rejected):
    rows = spark.createDataFrame([(1, n, *turn) for n, turn in enumerate(turns)], "conv_id long, turn int, role string, text string")
    row = against_earlier_reply(rows).first()
    assert (row["prompt_turns"], row["prompt"], row["chosen"], [tuple(s) for s in row["chosen_trained"]],
            row["rejected"], [tuple(s) for s in row["rejected_trained"]], row["differs"]) == plain(turns, rejected)


def test_against_sql(spark):
    found = QUERIES["op2_preference_pairs"](spark, SF_DIR)
    wanted = connect(SF_DIR).execute(ORACLES["op2_preference_pairs"])
    names = [column[0] for column in wanted.description]
    assert {name: kind(type_) for name, type_ in found.dtypes} == {c[0]: kind(c[1]) for c in wanted.description}
    assert rows(found.columns, map(tuple, found.collect())) == rows(names, wanted.fetchall())
