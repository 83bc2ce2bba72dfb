"""Collocations against DuckDB and against plain counting over small tables."""

import random
import re
from collections import Counter

import compare
import numpy as np
import pytest

from notequarry.llm import collocations
from notequarry.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, least=30, top=2000):
    """All of it with dictionaries."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for size in range(1, min(4, len(words) - i) + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = [
            q for (x, q), b in f.items()
            if x == lang and len(q) > len(p) and b >= least and 100 * b >= 80 * a
            and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if not longer:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        seen[lang] += 1
        if seen[lang] <= top:
            out.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rand = random.Random(5)
    words = ["the", "New", "York", "Times", "ähre", "a b", "x", "y", "z", "日本"]
    texts = []
    for _ in range(250):
        made = []
        for _ in range(rand.randrange(30)):
            made += [["new", "york", "times"], [rand.choice(words)], ["of", "the"], ["very", "hot", "very", "hot"]][rand.randrange(4)]
        marks = [rand.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", "\r", "!", " \x0b"]) for _ in made]
        texts.append("".join(w + m for w, m in zip(made, marks)))
    languages = ["en", "de", None, "und", ""]
    found = [(t, languages[i % 5]) for i, t in enumerate(texts)]
    return [*found, *[("hot key " * 400, "en")] * 30, (None, "en"), ("", None), (" \t", "fr"), ("...", "fr"), ("unique", "sv")]


@pytest.mark.parametrize("budget,vocabulary", [(2_000_000, 4_000_000), (800, 4_000_000), (800, 0), (40, 0), (40, 4_000_000)])
def test_against_plain_counting(spark, rows, budget, vocabulary):
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "text string, lang string, s0 int, word string").repartition(3)
    got = collocations.collocations(docs, budget=budget, vocabulary=vocabulary)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_fewer_are_the_first(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, collocations.collocations(docs, least=5, top=3).collect())) == plain(rows, 5, 3)


def test_stretches_and_collisions(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 64)
    collocations._powers.cache_clear()
    raw, whole = np.frombuffer(b"one two. " * 40 + b"long " * 60, np.uint8), 0
    batch = collocations.pa.record_batch([["one two. " * 40 + "long " * 60], ["en"]], ["text", "lang"])
    for split, *_ in collocations._stretches(batch, 0):
        whole += len(split.start)
    assert whole == 140 and len(raw) == 660
    collocations._powers.cache_clear()
    # words that hash alike under one seed are hashed anew under the next
    real = collocations.counted_words
    tried = []
    monkeypatch.setattr(collocations, "counted_words", lambda docs, seed: tried.append(seed) or (None if seed < 2 else real(docs, seed)))
    docs = spark.createDataFrame(rows[:60], "text string, lang string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == plain(rows[:60])
    assert tried == [0, 1, 2]


def test_words_that_share_a_symbol_are_seen(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows[:20], "text string, lang string").coalesce(1)
    docs = docs.na.fill("und", "lang")
    assert collocations.counted_words(docs) is not None

    def clash(seed):
        def run(batches):
            list(batches)
            yield collocations.pa.record_batch([[1, 1], ["en", "de"], [b"a", b"a"], [1, 1]], ["symbol", "lang", "word", "n"])

        return run

    monkeypatch.setattr(collocations, "_count_words", clash)
    assert collocations.counted_words(docs) is None


def test_empty_table(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(none).count() == 0


def test_query_matches_sql(spark):
    name = "op13_collocations"
    duck = compare.connect("/root/testdata/sf0.01")
    assert compare.compare(QUERIES[name](spark, "/root/testdata/sf0.01"), duck, ORACLES[name]) == []
