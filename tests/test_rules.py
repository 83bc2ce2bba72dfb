"""Suffix rules whose patterns mix classes with letters and use a captured letter again."""

import pytest

from notequarry.operators import variants
from notequarry.sources import lexicon

RULES = """
RULE: Cy$|adj|positive|Ciom$|adj|comparative
RULE: CVC$|adj|positive|CVSCom$|adj|comparative
RULE: e$|adj|positive|om$|adj|comparative
RULE: D$|noun|base|Dth$|adj|base
RULE: ^CVC$|noun|singular|CVCs$|noun|plural
RULE: LhL$|verb|infinitive|LLeL$|verb|past
RULE: BVtG$|verb|infinitive|GVtB$|verb|past
RULE: eLC$|noun|singular|eLCaL$|noun|plural
RULE: x$|noun|base|xC$|noun|base
""".strip()


@pytest.fixture(scope="module")
def rules(spark):
    return lexicon.rule_lines(lexicon.text_lines(spark, "own", RULES))


def table(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


@pytest.mark.parametrize(
    "word,forms",
    [
        ("happy", {"happiom"}),
        ("big", {"biggom", "bigs"}),
        ("ebig", {"ebiggom"}),
        ("wide", {"widom"}),
        ("4", {"4th"}),
        ("y", set()),
        ("ahb", {"abeb"}),
        ("batn", {"natb"}),
        ("seal", {"sealaa"}),
        ("ox", set()),
        ("", set()),
        ("ähb", set()),
        ("sHxé", set()),
    ],
)
def test_forms(spark, rules, word, forms):
    got = variants.inflect_by_rule(table(spark, [word, word]), rules).collect()
    assert {r.form for r in got} - {"bigs"} == forms - {"bigs"} and ("bigs" in {r.form for r in got}) == ("bigs" in forms)


def test_bases(spark, rules):
    words = ["happiom", "biggom", "bigom", "widom", "4th", "aaeb", "abeb", "natb", "sealaa", "sealab", "bigs", "xn"]
    got = variants.uninflect_candidates(table(spark, words), rules).collect()
    found = {w: {r.base for r in got if r.word == w} for w in words}
    assert found["happiom"] == {"happy", "happie"}
    # a doubled letter is one letter, and so is one that stands twice in the form and once in the base
    assert found["biggom"] == {"big", "bigge"} and found["bigom"] == {"bige"}
    assert found["aaeb"] == set() and found["abeb"] == {"ahb"}
    assert found["sealaa"] == {"seal"} and found["sealab"] == set()
    assert (found["4th"], found["natb"], found["bigs"]) == ({"4"}, {"batn"}, {"big"})
    assert found["widom"] == {"wide"} and found["xn"] == {"x"}


def test_no_rules_and_no_words(spark, rules):
    none = lexicon.rule_lines(lexicon.text_lines(spark, "own", "# nothing"))
    assert variants.inflect_by_rule(table(spark, ["a"]), none).count() == 0
    assert variants.uninflect_by_rule(table(spark, []), rules).count() == 0
