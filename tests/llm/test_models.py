"""Language-model scores, language, quality, top-k: against plain versions and held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from notequarry.llm import common, language_id, lm_scoring, quality, top_k
from notequarry.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare.compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def plain_scores(rows):
    """n_tokens, n_known, tokens, base and PPM score of each (doc_id, text), by dictionaries of contexts."""
    words, counts, coded = Counter(), defaultdict(Counter), []
    for doc_id, text in rows:
        own = (text or "").encode().translate(lm_scoring.LOWER).split()
        line = b"\n" * 5 + b" ".join(own) + b"\n"
        coded.append((own, line))
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10:
            words.update([*own, None])
            for k in range(5, len(line)):
                for o in range(6):
                    counts[line[k - o : k]][line[k]] += 1
    tokens, kinds = sum(words.values()), len(words)
    for own, line in coded:
        score = 0.0
        for k in range(5, len(line)):
            out = set()
            if not counts:
                score += math.log10(1 / 256)
                continue
            for o in range(5, -1, -1):
                seen = counts.get(line[k - o : k])
                if not seen:
                    continue
                left = {a: c for a, c in seen.items() if a not in out}
                total = sum(left.values())
                if line[k] in seen:
                    score += math.log10((seen[line[k]] - lm_scoring.ESCAPE) / total)
                    break
                if total:
                    score += math.log10(lm_scoring.ESCAPE * len(left) / total)
                out |= set(seen)
            else:
                score += math.log10(1 / max(1, 256 - len(counts[b""])))
        base = sum(math.log10((words.get(w, 0) + 0.1) / (tokens + 0.1 * (kinds + 1))) for w in [*own, None])
        yield len(own) + 1, sum(w in words for w in [*own, None]), tokens, base, score


def small_corpus():
    rand = random.Random(4)
    texts = [" ".join(rand.choice("the a of Cat dog über x1 zz".split()) for _ in range(rand.randrange(40))) for _ in range(60)]
    return [*enumerate(texts), (100, None), (101, ""), (102, " \t\n"), (3, texts[3]), (None, "no id"), (104, "你好 new ## words"), (105, "a" * 9000)]


@pytest.mark.parametrize("segment", [4_000_000, 64])
def test_lm_scores_match_plain_tries(spark, monkeypatch, segment):
    monkeypatch.setattr(lm_scoring, "SEGMENT_BYTES", segment)
    rows = small_corpus()
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = sorted(tuple(r) for r in lm_scoring.score_documents(docs).drop("held_out").na.fill(-1, ["doc_id"]).collect())
    expected = sorted((-1 if i is None else i, *s) for (i, _), s in zip(rows, plain_scores(rows), strict=True))
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_lm_segments_cover_a_long_text(monkeypatch):
    monkeypatch.setattr(lm_scoring, "SEGMENT_BYTES", 50)
    text = b"some Words " * 40
    whole = b" ".join(text.lower().split()) + b"\n"
    assert b"".join(s[5:] for s in lm_scoring.segments(text)) == whole


def test_lm_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = lm_scoring.score_documents(docs, F.lit(True)).first()
    assert (row.train_tokens, row.n_known, row.score) == (0, 0, pytest.approx(-3 * math.log10(256)))
    assert lm_scoring.score_documents(docs.limit(0)).count() == 0


def test_lm_beats_words_on_held_out_rows(spark):
    got = lm_scoring.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    row = got.agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.language_id(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en", 0) for i in range(20)] + [(i, "der hund und die katze", "de", 0) for i in range(20, 40)]
    rows += [(50, None, "en", 0), (51, "", "en", 0), (52, "12 345 !!", None, 0), (53, "the unknownish dogs", None, 0), (54, "ünd kätzchen", None, 0), (55, "你好", None, 0), (53, "the unknownish dogs", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.language_id(docs).collect()}
    assert all(got[i] == ("und", 0.0) for i in (50, 51, 52))
    assert (got[53][0], got[54][0]) == ("en", "de")
    assert got[55][0] in ("de", "en") and all(0 <= s <= 1 for _, s in got.values())
    assert language_id.language_id(docs).count() == len(rows)
    kept = language_id.keep_identified(docs, language_id.fit(language_id.learnable(docs)))
    assert kept.columns == docs.columns
    assert kept.count() == len(rows) - 3
    named = {r.doc_id: r.lang for r in kept.collect()}
    assert (named[53], named[54], named[0], named[39]) == ("en", "de", "en", "de")
    nothing = language_id.fit(language_id.learnable(docs.limit(0)))
    assert language_id.keep_identified(docs, nothing).count() == 0
    sure = language_id.keep_identified(docs, language_id.fit(language_id.learnable(docs)), least=0.9).collect()
    assert {r.doc_id for r in sure} == {i for i, (_, s) in got.items() if s >= 0.9}
    unlearnt = language_id.language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlearnt.collect()} == {"und"}
    assert language_id.language_id(docs.limit(0)).count() == 0


def test_backoff_uses_the_longest_known_string(spark):
    rows = [(i, "abcdef xyz", "a", 0) for i in range(5)] + [(i, "defghi xyw", "b", 0) for i in range(5, 10)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, n int"))
    assert model.languages == ["a", "b"]
    assert model.judge(["abcdef", "bcdeq", "qfghi", "xyz"])[0] == ["a", "a", "b", "a"]


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality(docs, labels).filter("held_out").join(labels, "doc_id")
    right = found.groupBy("quality").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")).alias("right"))
    assert all(r.right > 0.9 for r in right.collect())


def test_quality_edge_cases(spark):
    rows = [(i, "a fine text of words" if i % 2 else "BUY!! NOW!! BUY!!", 0.5) for i in range(60)]
    rows += [(100, None, 0.5), (101, "", 0.5), (102, "İ ﬁ 你", 0.5), (101, "", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id < 60)
    assert quality.quality(docs, labels.limit(0)).count() == len(rows)
    assert quality.quality(docs.limit(0), labels).count() == 0


def plain_top_k(rows, k, query):
    whole = {}
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for i, v in kept:
        if query(i):
            whole[i] = min(whole.get(i, v), v)
    out = []
    for q, v in whole.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in kept if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("n", "k"), [(300, 10), (3, 10), (1, 2)])
def test_top_k_against_sorting(spark, n, k):
    rand = random.Random(n)
    rows = [(i, [rand.choice((-0.5, 0.0, 0.25, rand.random())) for _ in range(4)]) for i in range(n)]
    rows += [(1000, None), (1010, []), (1020, [None, 1.0, 0.0, 0.0]), (1030, [float("nan"), 0.0, 0.0, 0.0]), (1040, [float("inf")] * 4), (None, [1.0] * 4)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(2000, 2000 + n)] + [(2000, [0.5, 0.5, 0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0)).repartition(3)
    got = top_k.top_k(table, F.col("id") % 10 == 0, k)
    assert sorted(map(tuple, got.collect())) == plain_top_k(rows, k, lambda i: i % 10 == 0)


def test_top_k_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k.top_k(table, F.col("id") % 100 == 0).count() == 0


def test_products_beyond_doubles_are_exact():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0], [2.0**30, 1.0]])
    assert top_k.products(a, b).tolist() == [[2**60 + 3, 2**63 - 1]]


def sent_whole(monkeypatch, module) -> list[str]:
    """Fills up with the broadcasts planned for the tables that ``module`` stores."""
    kept, found = module.materialise, []

    def seen(df, name):
        mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        plan = df._jdf.queryExecution().explainString(mode)
        found.extend(f"{name}: {x.strip()}" for x in plan.splitlines() if "BroadcastExchange" in x)
        return kept(df, name)

    monkeypatch.setattr(module, "materialise", seen)
    return found


def test_top_k_sends_no_blocks_whole(spark, monkeypatch):
    rand = random.Random(1)
    rows = [(i, [rand.random() for _ in range(4)]) for i in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sent_whole(monkeypatch, top_k)
    got = top_k.top_k(table, F.col("id") % 10 == 0)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    assert found == [] and "BroadcastExchange" not in got._jdf.queryExecution().explainString(mode)
    assert sorted(map(tuple, got.collect())) == plain_top_k(rows, 10, lambda i: i % 10 == 0)


@pytest.mark.parametrize("top", [0, 127, 128, 2**15, 2**31 - 1, 2**31, 2**60])
def test_blocks_hold_their_numbers_in_few_bytes(top):
    whole = np.array([[float(top), -float(top), 1.0], [0.0, -1.0, 3.0]])
    data = common.narrowed(whole)
    assert (common.widened(data, 2, 3) == whole).all()
    assert len(data) == 6 * (1 if top <= 127 else 2 if top < 2**15 else 4 if top < 2**31 else 8)
