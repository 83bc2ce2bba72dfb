"""Cue phrases, ends of scope and the order of the sides."""

import pytest

from notequarry.operators import context
from notequarry.operators.context import Cues

ROW = "words array<string>, tok_start int, tok_end int"
OWN = Cues(
    ("no",), before=("no evidence of", "free of"), after=("was ruled out",), stops=("but", "apart from"),
    plain=("not only", "no change"),
)


def marked(spark, text, cues=OWN, order=("LEFT", "RIGHT"), **sizes):
    words = text.replace("[", "").replace("]", "").split()
    at = [i for i, w in enumerate(text.split()) if "[" in w or "]" in w]
    rows = spark.createDataFrame([(words, min(at), max(at))], ROW)
    found = context.negation_scope(rows, cues, order=order, told=True, **sizes).first()
    return found.polarity, found.polarity_cue, found.polarity_side


@pytest.mark.parametrize(
    "text,expected",
    [
        ("no [fever]", (-1, "no", "LEFT")),
        ("there is no evidence of acute [fever]", (-1, "no evidence of", "LEFT")),
        ("evidence of [fever]", (0, None, None)),
        ("[fever] was ruled out", (-1, "was ruled out", "RIGHT")),
        ("was ruled out [fever]", (0, None, None)),
        ("[fever] free of", (0, None, None)),
        ("no cough but [fever]", (0, None, None)),
        ("no cough apart from [fever]", (0, None, None)),
        ("but no [fever]", (-1, "no", "LEFT")),
        ("[fever] but pain was ruled out", (0, None, None)),
        ("[fever] was ruled out but", (-1, "was ruled out", "RIGHT")),
        ("no change [fever]", (0, None, None)),
        ("no no change [fever]", (-1, "no", "LEFT")),
        ("no x x x x x x [fever]", (-1, "no", "LEFT")),
        ("no x x x x x x x [fever]", (0, None, None)),
        ("no evidence of x x x x x [fever]", (0, None, None)),
        ("no pain free of [high fever] no", (-1, "free of", "LEFT")),
        ("[no fever]", (0, None, None)),
    ],
)
def test_cues(spark, text, expected):
    assert marked(spark, text) == expected


def test_order_of_the_sides(spark):
    text = "no [fever] was ruled out"
    assert marked(spark, text) == (-1, "no", "LEFT")
    assert marked(spark, text, order=("RIGHT", "LEFT")) == (-1, "was ruled out", "RIGHT")
    assert marked(spark, text, order=("RIGHT",), right=2) == (0, None, None)
    assert marked(spark, "no [fever]", order=()) == (0, None, None)


def test_lists_and_defaults(spark):
    assert marked(spark, "x (a) [fever]", ["(a)"]) == (-1, "(a)", "LEFT")
    assert marked(spark, "x [fever]", []) == (0, None, None)
    assert marked(spark, "not only [fever] ; not seen", context.NEGATION) == (0, None, None)
    assert marked(spark, "denies [fever]", context.NEGATION) == (-1, "denies", "LEFT")
    rows = spark.createDataFrame([(["possible", "but", "fever"], 2, 2), (["likely", "fever"], 1, 1), (None, 0, 0)], ROW)
    assert [r.uncertainty for r in context.uncertainty_scope(rows).collect()] == [0, 1, 0]
