"""Ordered folds: long rows in time, sweeps and walks against plain loops, notes beyond a row."""

import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from notequarry.functions.arrays import BLOCK, running_sum, scan
from notequarry.operators import spans, structure, temporal
from notequarry.operators.parts import parts_of_lines, split_to_parts
from notequarry.plans.lookup_table import LookupTable
from notequarry.sources.files import line_rows, whole_texts

SECONDS = 40


def within(seconds, action):
    began = time.time()
    found = action()
    assert time.time() - began < seconds
    return found


def test_scan_hands_the_state_on(spark):
    sizes = (0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK)
    rows = spark.createDataFrame([(list(range(1, n + 1)),) for n in sizes] + [(None,)], "a array<int>")
    step = lambda s, x: (s + x, F.concat(s.cast("string"), F.lit("+"), x.cast("string")))
    got = rows.select("a", running_sum(F.col("a")).alias("s"), scan(F.col("a"), F.lit(0), step, "string").alias("t")).collect()
    for r in got:
        if r.a is None:
            assert r.s is None and r.t is None
        else:
            assert r.s == [sum(r.a[: i + 1]) for i in range(len(r.a))]
            assert r.t == [f"{sum(r.a[:i])}+{x}" for i, x in enumerate(r.a)]


def test_long_sentence_is_linear(spark):
    part = spark.createDataFrame([(1, 1, "Word , next " * 16_700)], "doc_id long, part int, text string")
    sentences = structure.sentence_split(part)
    tokens = structure.tokenize(sentences)
    assert within(SECONDS, tokens.count) == 50_100
    last = tokens.orderBy(F.desc("tok_idx")).first()
    assert (last.text, last.begin, last.end) == ("next", 12 * 16_700 - 5, 12 * 16_700 - 1)
    tagged = tokens.withColumn("pos", F.when(F.col("text") == ",", ",").otherwise("NN"))
    assert within(SECONDS, structure.chunk(tagged).count) == 33_401
    words = LookupTable.fixed(spark, [("next", "Adjuster"), ("word", "Unit")], "time_word string, time_class string")
    assert within(SECONDS, temporal.time_mentions(tokens, words).count) == 16_699


def test_many_sentences_in_a_part(spark):
    part = spark.createDataFrame([(1, 1, "A b. " * 20_000)], "doc_id long, part int, text string")
    assert within(SECONDS, structure.sentence_split(part).count) == 20_000


def test_many_parts_of_a_note(spark):
    note = spark.createDataFrame([(1, "abcdefghi\n" * 40_000)], "doc_id long, text string")
    parts = split_to_parts(note, 100)
    got = within(SECONDS, parts.collect)
    assert len(got) == 3334 and {len(r.text) for r in got[:-1]} == {120}
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "inline" in plan


def longer(rows, r):
    return any(
        o[:2] == r[:2] and o[4] == r[4] and o[3] - o[2] > r[3] - r[2] and any(o[2] <= p < o[3] for p in (r[2], r[3] - 1))
        for o in rows
    )


@pytest.fixture(scope="module")
def mentions():
    rand = random.Random(1)
    rows = []
    for doc in range(40):
        for _ in range(rand.randrange(40)):
            begin = rand.randrange(60)
            group = rand.choice(["finding", "disorder", "anatomy", None])
            rows.append((doc, 1, begin, begin + rand.choice([0, 1, 2, 3, 5, 8, 13]), group, rand.randrange(3)))
    return [*rows, *rows[:5]]


SPANS = "doc_id long, part int, begin int, end int, sem_group string, x int"


def test_precision_consumer_against_all_pairs(spark, mentions):
    frame = spark.createDataFrame(mentions, SPANS)
    got = Counter(map(tuple, spans.precision_consumer(frame).collect()))
    assert got == Counter(r for r in mentions if not longer(mentions, r))


def test_semantic_cleanup_against_all_pairs(spark, mentions):
    def dropped(r):
        same = [o for o in mentions if o[:2] == r[:2]]
        if r[4] == "finding" and any(o[4] == "disorder" and o[2] <= r[2] and o[3] >= r[3] for o in same):
            return True
        return r[4] in ("finding", "disorder") and any(o[4] == "anatomy" and o[2:4] == r[2:4] for o in same)

    frame = spark.createDataFrame(mentions, SPANS)
    cleaned = spans.semantic_cleanup(frame)
    assert Counter(map(tuple, cleaned.collect())) == Counter(r for r in mentions if not longer(mentions, r) and not dropped(r))
    plan = spans.semantic_cleanup(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan") == 1


def test_mentions_without_a_place_stay(spark):
    rows = [(1, 1, None, None, "g", 1), (1, 1, 0, 5, "g", 2), (1, 1, 1, 2, "g", 3), (1, 1, None, 4, "g", 4)]
    got = spans.precision_consumer(spark.createDataFrame(rows, SPANS)).collect()
    assert sorted(r.x for r in got) == [1, 2, 4]
    assert spans.precision_consumer(spark.createDataFrame([], SPANS)).count() == 0


@pytest.mark.parametrize("shape,kept", [("nested", 1), ("stairs", 5000), ("equal", 5000)])
def test_many_overlapping_spans(spark, shape, kept):
    n = 5000
    place = {"nested": lambda i: (i, 2 * n - i), "stairs": lambda i: (i, i + 50), "equal": lambda i: (3, 9)}[shape]
    frame = spark.createDataFrame([(1, 1, *place(i), "g", i) for i in range(n)], SPANS)
    assert within(SECONDS, spans.precision_consumer(frame).count) == kept


def trie(spark, rows, limit=None):
    nodes = temporal.phrase_trie(spark.createDataFrame(rows, "phrase string, relation string"))
    return LookupTable.prepare(nodes, "trie") if limit is None else LookupTable.prepare(nodes, "trie", limit)


@pytest.mark.parametrize("limit", [None, 0])
def test_phrases_leftmost_longest(spark, limit):
    lexicon = [
        ("on", "A"), ("on the next day", "B"), ("on the", "C"), ("next day", "D"), ("day before", "E"),
        ("the", "F"), ("The ", "E"), ("before the end of the next", "G"),
    ]
    text = "On the next day before. On the next. It ended the day before the end of the next day; on"
    part = spark.createDataFrame([(1, 1, text), (2, 1, ""), (3, 1, "nothing here")], "doc_id long, part int, text string")
    words = structure.sentence_words(structure.sentence_split(part))
    found = temporal.lexicon_phrases(words, trie(spark, lexicon, limit)).orderBy("doc_id", "sent_id", "tok_start").collect()
    assert [(r.sent_id, r.tok_start, r.tok_end, r.phrase, r.relation) for r in found] == [
        (0, 0, 3, "on the next day", "B"), (1, 0, 1, "on the", "C"), (2, 2, 2, "the", "E"), (2, 3, 4, "day before", "E"),
        (2, 5, 5, "the", "E"), (2, 8, 8, "the", "E"), (2, 9, 10, "next day", "D"), (2, 12, 12, "on", "A"),
    ]
    assert all(text[r.begin : r.end].lower() == r.phrase for r in found)


def test_phrases_against_a_plain_walk(spark):
    rand = random.Random(4)
    lexicon = sorted({" ".join(rand.choice("abc") for _ in range(rand.randrange(1, 6))) for _ in range(40)})
    texts = [" ".join(rand.choice("abcd") for _ in range(rand.randrange(60))) for _ in range(40)]
    part = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)], "doc_id long, part int, text string")
    words = structure.sentence_words(structure.sentence_split(part))
    got = temporal.lexicon_phrases(words, trie(spark, [(p, "R") for p in lexicon])).collect()
    expected = []
    for i, text in enumerate(texts):
        own, at = text.split(), 0
        while at < len(own):
            fits = [n for n in range(1, 6) if at + n <= len(own) and " ".join(own[at : at + n]) in lexicon]
            if fits:
                expected.append((i, at, " ".join(own[at : at + max(fits)])))
            at += max(fits, default=1)
    assert sorted((r.doc_id, r.tok_start, r.phrase) for r in got) == sorted(expected)


def test_one_first_word_of_many_phrases_costs_one_probe(spark):
    lexicon = trie(spark, [(f"on the {'x' * (i % 140)}{'y' * (i // 140)}z way", "R") for i in range(20_000)])
    part = spark.createDataFrame([(i, 1, "on the xyz way " * 200) for i in range(20)], "doc_id long, part int, text string")
    words = structure.sentence_words(structure.sentence_split(part))
    assert within(SECONDS, temporal.lexicon_phrases(words, lexicon).count) == 4000


def test_files_beyond_a_row(spark, tmp_path):
    rand = random.Random(7)
    for name, n in (("a.txt", 6000), ("b.txt", 30), ("blank.txt", 0)):
        lines = [rand.choice(["", "  ", "x" * rand.randrange(200), "é word", "y" * 900]) for _ in range(n)]
        ends = [rand.choice(["\n", "\r\n"]) for _ in lines]
        (tmp_path / name).write_bytes("".join(a + b for a, b in zip(lines, ends)).encode() + b"\n\r\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        lines = line_rows(spark, str(tmp_path))
        assert lines.select("path", "block").distinct().count() > 8
        got = parts_of_lines(lines, 700).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = split_to_parts(whole_texts(spark, str(tmp_path)).select("path", "text"), 700).collect()
    assert len(expected) > 500
    name = lambda path: re.sub(".*/", "", path)
    assert {(name(r.path), r.part): r.text for r in got} == {(name(r.path), r.part): r.text for r in expected}


def test_lines_of_no_note(spark):
    none = spark.createDataFrame([], "path string, block long, pos long, line string")
    assert parts_of_lines(none, 10).count() == 0
    blank = spark.createDataFrame([("p", 0, 0, ""), ("p", 0, 1, "")], "path string, block long, pos long, line string")
    assert parts_of_lines(blank, 10).count() == 0


def test_words_are_tried_first(spark):
    """The order of the token shapes costs time and changes no token."""
    text = "it's 12/3/2024 at 12:30, 3/4 or 5-6; 1,000.5 mg 'self' na\u00efve\U0001F600x 12/345/6 1:2 a_b\tc \u0661 'zz 're'd"
    row = spark.createDataFrame([(1, 1, 0, 0, text)], "doc_id long, part int, sent_id int, begin int, text string")
    words = structure.sentence_words(row)
    by_list = row.select(F.regexp_extract_all("text", F.lit(structure.TOKEN), F.lit(0)).alias("p")).first()["p"]
    assert words.first()["pieces"] == by_list
    shown = words._jdf.queryExecution().analyzed().toString()
    assert r"(?:\p{L}+|" in shown
