"""What must not grow: broadcasts, folds, sorts and files of the joins and operators."""

import random
import re
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from notequarry import session
from notequarry.catalog import io_queries, time_queries
from notequarry.functions import arrays, intervals
from notequarry.operators import consume, dictionary, spans, structure
from notequarry.plans import jobs
from notequarry.plans.lookup_table import LookupTable, met_by_key
from notequarry.sources import files
from notequarry.streaming import incremental


def broadcasts(frame) -> int:
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return frame._jdf.queryExecution().explainString(mode).count("BroadcastExchange")


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Small files: by their bytes alone, anything derived from them would be sent to every executor."""
    path = str(tmp_path_factory.mktemp("notes") / "parts")
    rows = [(i, 1, f"Red apples and pears {i}. No plums.") for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, part int, text string").write.parquet(path)
    return spark.read.parquet(path)


def test_sentences_are_not_sent_whole_to_their_variants_or_tags(spark, parts):
    sentences = structure.sentence_split(parts)
    words = structure.sentence_words(sentences)
    variants = LookupTable.fixed(spark, [("apples", "apple")], "form string, canonical string")
    lexicon = LookupTable.fixed(spark, [("red", 1)], "lex_word string, lex_bits int")
    named = jobs.add_variants(words, variants, structure.KEYS)
    assert broadcasts(named) == 1  # the variants
    first = named.filter("doc_id = 3 and sent_id = 0").first()
    assert first.variants == [None, "apple", None, None, None, None]
    settings = jobs.Settings(variants, variants, lexicon)
    assert broadcasts(jobs.add_tags(words, sentences, settings, structure.KEYS)) == 1


def test_spans_are_not_sent_whole_to_the_spans_around_them(spark, parts):
    sentences = structure.sentence_split(parts)
    tokens = structure.tokenize(sentences)
    assert broadcasts(spans.covered_by(tokens, sentences)) == 0
    windows = tokens.groupBy("doc_id", "part", "sent_id").agg(
        F.min("tok_idx").alias("tok_start"), F.max("tok_idx").alias("tok_end")
    )
    assert broadcasts(structure.window_frames(structure.sentence_words(sentences), windows)) == 0


@pytest.mark.parametrize("n", [0, 1, arrays.BLOCK, arrays.BLOCK + 1, 5 * arrays.BLOCK + 3])
def test_running_sums_in_one_block_and_more(spark, n):
    rows = spark.createDataFrame([(list(range(n)),), (None,)], "v array<int>")
    found = [r.s for r in rows.select(arrays.running_sum(F.col("v")).alias("s")).collect()]
    assert found == [[i * (i + 1) // 2 for i in range(n)], None]


def test_a_phrase_that_is_bare_is_not_looked_at_again(spark):
    frame = spark.createDataFrame([("march",), ("end of march",), ("2024",)], "p string")
    value = intervals.composed_value(F.col("p"), F.lit("2024-05-01").cast("timestamp"))
    assert "bare" in str(value._jc)
    found = frame.select("p", value.alias("v")).select("p", F.col("v.start").cast("string").alias("s"), "v.modifier")
    assert {r.p: (r.s, r.modifier) for r in found.collect()} == {
        "march": ("2024-03-01 00:00:00", None),
        "end of march": ("2024-03-01 00:00:00", "END"),
        "2024": ("2024-01-01 00:00:00", None),
    }


def test_note_files_lie_in_many_folders(spark, tmp_path):
    rows = [(i, f"note {i}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    read = files.load(io_queries.written_files(spark, str(tmp_path))).select("path", F.col("content").cast("string"))
    found = read.collect()
    assert sorted(r.content for r in found) == sorted(f"note {i}\n" for i in range(200))
    # beyond 32 folders Spark lists them in tasks
    assert len({r.path.rsplit("/", 1)[0] for r in found}) > 32


def test_note_files_are_written_by_their_tasks(spark, tmp_path):
    rows = [(1, "a"), (2, None), (3, ""), (4, "a"), (5, "zwei\nZeilen é")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    root = Path(session.mounted_folder(spark, io_queries.written_files(spark, str(tmp_path))))
    # Hadoop's writer leaves a file of checksums beside every note
    found = sorted(p.read_text() for p in root.rglob("*") if p.is_file())
    assert found == sorted(["a\n", "\n", "\n", "a\n", "zwei\nZeilen é\n"])


def test_notes_of_a_batch_are_read_by_few_tasks(spark, tmp_path):
    table = LookupTable.fixed(spark, [(7, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string")
    concepts = LookupTable.fixed(
        spark, [(7, 100, "alpha", "drug", "RX", "9", "C0000007")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    notes, out, n = tmp_path / "notes", str(tmp_path / "out"), 40 * spark.sparkContext.defaultParallelism
    notes.mkdir()
    for i in range(n):
        (notes / f"{i}.txt").write_text(f"alpha {i}")
    before = dict(spark.conf.getAll)
    with session.job(spark):
        known = set(session._HELD.get(spark, []))
        stream = incremental.incremental_extract(
            spark, str(notes), out, str(tmp_path / "marks"), jobs.Settings(table, concepts), lambda batch: "202601010930"
        )
        stream.awaitTermination()
        held = [p for paths in session._HELD.values() for p in paths if "batch-parts" in p and p not in known]
        # a task for every 4 MB, as Spark rates a file by itself, would leave more files than cores
        assert len(list(Path(held[-1]).glob("part-*.parquet"))) <= spark.sparkContext.defaultParallelism
    assert dict(spark.conf.getAll) == before
    assert sorted(r.text for r in incremental.read_batches(spark, out).collect()) == sorted(f"alpha {i}\n" for i in range(n))


def exchanged(frame) -> list[str]:
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return [x for x in frame._jdf.queryExecution().explainString(mode).splitlines() if "- Exchange " in x]


def test_sentences_stay_where_they_are_to_meet_their_windows_and_variants(spark, parts):
    words = structure.sentence_words(structure.sentence_split(parts.repartition(5, "doc_id")))
    sentences = structure.sentence_split(parts.repartition(5, "doc_id"))
    windows = structure.tokenize(sentences).groupBy("doc_id", "part", "sent_id").agg(
        F.min("tok_idx").alias("tok_start"), F.max("tok_idx").alias("tok_end")
    )
    variants = LookupTable.fixed(spark, [("apples", "apple")], "form string, canonical string")
    for frame in (structure.window_frames(words, windows), jobs.add_variants(words, variants, structure.KEYS)):
        assert not any("sent_id" in x for x in exchanged(frame))


def test_rows_met_by_key_are_those_of_a_join(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, None), (2, None, "b"), (3, 1, "c")], "k int, s int, x string")
    right = spark.createDataFrame([(1, 1, 5, 6), (1, 1, 5, 6), (1, 2, None, None), (2, None, 7, 8), (4, 1, 9, 9)], "k int, s int, y int, z int")
    got = met_by_key(left, right, ["k", "s"])
    wanted = left.join(right, ["k", "s"])
    assert got.columns == wanted.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    assert got.count() == 5


def test_only_reference_tables_are_sent_whole_to_event_notes(spark, tmp_path):
    rows = [(i, datetime(2024, 5, 1 + i, 9), "click") for i in range(20)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    deepest = max(len(p.split(" ")) for p, _ in time_queries.NOTE_RELATIONS)
    # terms, plurals and concepts; the relations and the phrases, word by word
    assert broadcasts(time_queries.event_mentions(spark, str(tmp_path))) == 3
    assert broadcasts(time_queries.doctime_string(spark, str(tmp_path))) == 3 + 1 + deepest


def test_many_codes_of_a_part_in_time(spark):
    mentions = spark.range(80_000).selectExpr(
        "1L AS doc_id", "1 AS part", "CAST(id DIV 2 AS int) AS begin", "CAST(id DIV 2 + 3 AS int) AS end",
        "concat('C', id DIV 2) AS concept", "'drug' AS sem_group", "0 AS polarity", "0 AS uncertainty", "'event' AS mention_class",
    )
    began = time.time()
    line = consume.cui_sequence(mentions).first().cuis
    assert line.split(" ") == [f"C{i}" for i in range(40_000)]
    assert jobs.summarise(mentions, structure.KEYS).first().cuis == line
    assert time.time() - began < 30


def test_chunks_are_the_runs_of_the_pattern(spark):
    tags = {"D": "DT", "J": "JJ", "N": "NN", "V": "VB", "M": "MD", "I": "IN", "O": "RB"}
    kinds = {"N": "NP", "V": "VP", "I": "PP"}
    drawn = random.Random(3)
    sentences = ["".join(drawn.choices("DJNVMIO", k=drawn.choice([1, 2, 5, 30, 200]))) for _ in range(200)]
    rows = [(1, 1, s, i, 2 * i, 2 * i + 1, tags[x]) for s, letters in enumerate(sentences) for i, x in enumerate(letters)]
    rows += [(None, 1, 0, i, i, i + 1, "NN") for i in (0, 1, 1)]  # a null key, a repeated token
    tagged = spark.createDataFrame(rows, "doc_id bigint, part int, sent_id int, tok_idx int, begin int, end int, pos string")
    found = structure.chunk(tagged)
    wanted = [(None, 1, 0, 0, 0, 2, 0, 2, "NP")]
    for s, letters in enumerate(sentences):
        for i, m in enumerate(re.finditer(structure.CHUNK, letters)):
            kind = next((k for x, k in kinds.items() if x in m[0]), "O")
            wanted.append((1, 1, s, i, m.start(), m.end() - 1, 2 * m.start(), 2 * m.end() - 1, kind))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))
    # letters are made in compiled code, below the aggregate
    aggregates = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in x]
    assert aggregates and not any("CASE" in x for x in aggregates)


def test_tokens_are_tagged_once_for_all_spans(spark, parts):
    lexicon = LookupTable.fixed(spark, [("red", 2)], "lex_word string, lex_bits int")
    spans = jobs.preprocess_only(parts, lexicon)
    assert broadcasts(spans) == 1
    found = {tuple(r)[2:] for r in spans.filter("doc_id = 3").collect()}
    sentences = structure.sentence_split(parts)
    tagged = structure.pos_tag(structure.tokenize(sentences), lexicon).filter("doc_id = 3")
    listed = [("segment", 0, 33, "SIMPLE_SEGMENT")]
    listed += [("sentence", r.begin, r.end, str(r.sent_id)) for r in sentences.filter("doc_id = 3").collect()]
    listed += [("token", r.begin, r.end, r.pos) for r in tagged.collect()]
    listed += [("chunk", r.begin, r.end, r.chunk_type) for r in structure.chunk(tagged).collect()]
    assert found == set(listed) and spans.filter("doc_id = 3").count() == len(listed)


def test_a_variant_beside_the_rare_word_is_told_before_the_phrase(spark):
    rows = [(1, 1, 0, 0, ["reds", " apples", " fall", " down"], ["reds", "apples", "fall", "down"], ["red", "apple", None, None])]
    schema = "doc_id bigint, part int, sent_id int, sent_begin int, pieces array<string>, words array<string>, variants array<string>"
    terms = [(1, 1, 2, "red apple", "apple"), (2, 0, 3, "apple fall down", "apple"), (3, 0, 2, "apple red", "apple"),
             (4, 1, 2, "reds apples", "apples"), (5, 0, 1, "fall", "fall"), (6, 2, 3, "apples fall up", "up"), (7, 0, 2, "down now", "down")]
    table = LookupTable.fixed(spark, terms, "cui bigint, rindex int, tcount int, term string, rword string")
    found = dictionary.find_terms(structure.sentence_frames(spark.createDataFrame(rows, schema)), table, match_variants=True)
    got = sorted((r.cui, r.tok_start, r.tok_end, r.begin, r.end) for r in found.collect())
    assert got == [(1, 0, 1, 0, 11), (2, 1, 3, 5, 21), (4, 0, 1, 0, 11), (5, 2, 2, 12, 16)]
    assert "term_near" in found._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_sentence_are_looked_up_one_at_a_time(spark, parts):
    """Compiled, a generator would make all copies of a sentence, one for each word or window, before the first is looked up."""
    words = structure.sentence_words(structure.sentence_split(parts))
    table = LookupTable.fixed(spark, [(7, 1, 2, "red apples", "apples")], "cui bigint, rindex int, tcount int, term string, rword string")
    windows = structure.tokenize(structure.sentence_split(parts)).groupBy("doc_id", "part", "sent_id").agg(
        F.min("tok_idx").alias("tok_start"), F.max("tok_idx").alias("tok_end")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan shows what is compiled
    try:
        for frames in (structure.sentence_frames(words), structure.window_frames(words, windows)):
            found = dictionary.find_terms(frames, table)
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
            plan = found._jdf.queryExecution().explainString(mode)
            made = [x for x in plan.splitlines() if re.search(r"Generate (pos)?explode\(", x)]
            assert made and not any(re.search(r"\*\(\d+\) Generate", x) for x in made)
            assert found.count() == 20
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_arrays_one_by_one_are_the_same(spark):
    rows = spark.createDataFrame([([1, None, 2],), ([],), (None,)], "v array<int>")
    assert [r.w for r in rows.select(arrays.one_by_one(F.col("v")).alias("w")).collect()] == [[1, None, 2], [], None]


def test_files_listed_by_tasks_are_those_of_the_reader(spark, tmp_path):
    names = ["a.txt", "b c.txt", "é%1#2.txt", "d.xml", ".hidden.txt", "_odd.txt", "_k=1.txt", "in/e.txt", "in/deep/er/f.txt", ".in/g.txt", "_in/h.txt", "k=2/i.txt"]
    root = tmp_path / "notes"
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(name.encode() + b"\xff\r\n")
    (root / "empty.txt").write_bytes(b"")
    for glob in (None, "*.txt", "?.txt"):
        read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        wanted = (read.option("pathGlobFilter", glob) if glob else read).load(str(root)).select("path", "content")
        got = files.whole_files(spark, str(root), glob)
        assert "mapInArrow" in got._jdf.queryExecution().optimizedPlan().toString() or "MapInArrow" in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    shown = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(str(root)).select("_metadata.file_path")
    listed = files.listed_files(spark, str(root)).collect()
    assert sorted(files.path_uri(r.path) for r in listed) == sorted(r.file_path for r in shown.collect())
    assert all(r.length == Path(r.path).stat().st_size for r in listed)


def test_the_stream_holds_no_entry_for_a_note(spark, tmp_path):
    table = LookupTable.fixed(spark, [(7, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string")
    concepts = LookupTable.fixed(
        spark, [(7, 100, "alpha", "drug", "RX", "9", "C0000007")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    notes, out, marks = tmp_path / "notes", str(tmp_path / "out"), tmp_path / "marks"
    notes.mkdir()

    def run() -> list[str]:
        incremental.incremental_extract(
            spark, str(notes), out, str(marks), jobs.Settings(table, concepts), lambda batch: f"20260101{batch:04d}"
        ).awaitTermination()
        return sorted(f"{r.loaded} {r.text}" for r in incremental.read_batches(spark, out).collect())

    for i in range(50):
        (notes / f"{i}.txt").write_text("alpha")
    first = run()
    assert first == ["202601010000 alpha\n"] * 50
    held = "".join(p.read_text() for p in (marks / "sources").rglob("[0-9]*") if p.is_file())
    assert held.count('"path"') < 10 and "/notes/" not in held
    assert run() == first
    (notes / "late.txt").write_text("beta alpha")
    assert run() == [*first, "202601010001 beta alpha\n"]
