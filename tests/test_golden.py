"""Golden cases and edges of single operators."""

import os
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from notequarry.functions import codes, keys, text, times
from notequarry.operators import context, spans, structure, temporal, variants
from notequarry.operators.dictionary import find_terms
from notequarry.operators.parts import split_to_parts
from notequarry.plans import jobs
from notequarry.plans.lookup_table import LookupTable
from notequarry.session import job, materialise
from notequarry.sinks.results import annotation_documents
from notequarry.sources import annotations, files, lexicon
from notequarry.sources import dictionary as dictionary_sources
from notequarry.streaming import incremental


def parts_of(spark, content, cap):
    frame = spark.createDataFrame([(1, content)], "doc_id bigint, text string")
    return [r.text for r in split_to_parts(frame, cap).orderBy("part").collect()]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "content, cap, expected",
    [
        (
            "This is a line\n This is second line\n This is third line \n",
            20,
            ["This is a line\n This is second line\n", " This is third line \n"],
        ),
        ("", 20, []),
        ("\n\n\n", 20, []),
        ("a\r\nb", 20, ["a\nb\n"]),
        ("no break", 20, ["no break\n"]),
        ("x" * 50 + "\ny", 20, ["x" * 50 + "\n", "y\n"]),
        ("aa\n\nbb\n\n", 3, ["aa\n\nbb\n"]),
    ],
)
def test_split_to_parts(spark, content, cap, expected):
    assert parts_of(spark, content, cap) == expected


@pytest.mark.parametrize(
    "path, expected",
    [
        ("hdfs://host:8020/user/notes/Notes_2017_1/16127120020.txt", "16127120020"),
        ("/a.b/c", None),
        ("/a/.txt", ""),
        ("plain.tar.gz", "plain.tar"),
    ],
)
def test_encounter_id(spark, path, expected):
    assert value(spark, keys.encounter_id(F.lit(path))) == expected


def test_failed_rows_keep_what_was_parsed(spark):
    rows = [("/d/4490.txt-1", "t"), ("/d/4490.txt", "t"), ("/d/4490.txt-x", "t"), ("/d/4490.txt-2", None), (None, "t")]
    frame = keys.parse_keys(spark.createDataFrame(rows, "key string, value string"))
    got = [(r.fname, r.part, r.failure) for r in frame.collect()]
    assert got == [
        ("4490", "1", None),
        (None, None, "KEY_WITHOUT_PART"),
        ("4490", "x", "PART_NOT_A_NUMBER"),
        ("4490", "2", "TEXT_MISSING"),
        (None, None, "KEY_WITHOUT_PART"),
    ]


def test_scrub_keeps_supplementary_characters(spark):
    assert value(spark, text.legal_char_scrub(F.lit("a\x01\x0c\t\U0001f60a"))) == "a\t\U0001f60a"


def test_token_strings(spark):
    rows = spark.createDataFrame([("Num", "12"), ("Word", "Pain"), ("Newline", "\n")], "k string, t string")
    shown = [r.v for r in rows.select(text.token_to_string(F.col("k"), F.col("t")).alias("v")).collect()]
    assert shown == ["number_token", "pain", None]
    with pytest.raises(Exception, match="unknown token type"):
        rows.select(text.token_to_string(F.lit("Other"), F.col("t"))).collect()


def test_negation_dialects(spark):
    frame = spark.createDataFrame([(-1,), (0,), (1,)], "p int")
    shown = frame.select(
        codes.negation_prefix(F.lit("C1"), F.col("p"), "N").alias("a"),
        codes.negation_prefix(F.lit("C1"), F.col("p"), "n").alias("b"),
    ).collect()
    assert [(r.a, r.b) for r in shown] == [("NC1", "nC1"), ("C1", "C1"), ("C1", "nC1")]


def test_paren_s(spark):
    assert value(spark, text.paren_s_removal(F.lit("2(s) alpha(s)"))) == "2 alpha"


def token_spans(spark, content):
    frame = spark.createDataFrame([(1, 1, content)], "doc_id bigint, part int, text string")
    return structure.tokenize(structure.sentence_split(frame)).orderBy("begin").collect()


@pytest.mark.parametrize("words", [5, 63, 64, 65, 200])
def test_offsets_slice_to_the_token(spark, words):
    content = " \n".join([" ".join(f"w{'é' * (i % 3)}" for i in range(words)), "It's 12/31/2020 at 10:30, 3,5 1-2!"])
    rows = token_spans(spark, content)
    assert all(content[r.begin : r.end] == r.text for r in rows)
    assert [r.text for r in rows if r.token_type == "Num"] == ["12/31/2020", "10:30", "3,5", "1-2"]
    assert [r.text for r in rows if r.token_type == "Contraction"] == ["'s"]


def lookup(spark, content, term, rindex):
    words = term.split(" ")
    table = LookupTable.fixed(
        spark,
        [(7, rindex, len(words), term, words[rindex])],
        "cui bigint, rindex int, tcount int, term string, rword string",
    )
    frame = spark.createDataFrame([(1, 1, content)], "doc_id bigint, part int, text string")
    words_of = structure.sentence_words(structure.sentence_split(frame))
    return find_terms(structure.sentence_frames(words_of), table)


@pytest.mark.parametrize("rindex", [0, 1, 2])
def test_phrase_at_both_ends_of_a_sentence(spark, rindex):
    content = "Alpha beta gamma. x alpha  beta gamma"
    rows = lookup(spark, content, "alpha beta gamma", rindex).orderBy("begin").collect()
    assert [content[r.begin : r.end] for r in rows] == ["Alpha beta gamma", "alpha  beta gamma"]


@pytest.mark.parametrize("between, polarity", [(6, -1), (7, 0)])
def test_cue_distance(spark, between, polarity):
    content = " ".join(["no", *["x"] * between, "alpha", "beta"])
    hit = context.negation_scope(lookup(spark, content, "alpha beta", 1)).first()
    assert hit.polarity == polarity
    content = " ".join(["alpha", "beta", *["x"] * between, "no"])
    assert context.negation_scope(lookup(spark, content, "alpha beta", 1)).first().polarity == polarity


def test_shuffled_lookup_equals_broadcast(spark):
    content = "alpha beta and alpha beta. " * 20
    frame = spark.createDataFrame([(i, 1, content) for i in range(5)], "doc_id bigint, part int, text string")
    rows = [(1, 0, 2, "alpha beta", "alpha"), (2, 1, 2, "and alpha", "alpha"), (3, 0, 1, "beta", "beta")]
    table = LookupTable.fixed(spark, rows, "cui bigint, rindex int, tcount int, term string, rword string")
    wide = LookupTable(table.frame, table.size_bytes, limit=0)
    frames = structure.sentence_frames(structure.sentence_words(structure.sentence_split(frame)))
    expected = sorted(find_terms(frames, table).drop("words").collect())
    assert sorted(find_terms(frames, wide).drop("words").collect()) == expected
    assert len(expected) == 5 * 20 * 5


def exchanges(frame):
    """(partitioning, input columns) of every exchange of the plan, broadcasts left out."""
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    shown = frame._jdf.queryExecution().explainString(mode)
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: (\w+\(?[^,)]*)", shown)


def test_only_slim_probes_meet_a_large_dictionary(spark):
    notes = spark.createDataFrame([(1, 1, "alpha beta and alpha.")], "doc_id bigint, part int, text string")
    table = LookupTable.fixed(spark, [(1, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string")
    wide = LookupTable(table.frame, table.size_bytes, limit=0)
    frames = structure.sentence_frames(structure.sentence_words(structure.sentence_split(notes)))
    found = exchanges(find_terms(frames, wide))
    by_word = [columns for columns, kind in found if "word" in kind]
    assert by_word and not any(c.startswith(("words", "pieces", "sent_words")) for x in by_word for c in x.split(", "))
    assert sum("pieces" in columns for columns, _ in found) == 1
    assert exchanges(find_terms(frames, table)) == []


def test_variants_and_tags_in_a_large_dictionary(spark):
    words = ["alphas", "beta", "and", "beta"]
    rows = [(1, 1, i, 0, ["alphas", " beta", " and", " beta"], words, ["alpha", None, None, None], ["NNS", "NN", "CC", "VB"]) for i in range(3)]
    schema = "doc_id bigint, part int, sent_id int, sent_begin int, pieces array<string>, words array<string>, variants array<string>, tags array<string>"
    frames = structure.sentence_frames(spark.createDataFrame(rows, schema))
    terms = [(1, 0, 2, "alpha beta", "alpha"), (2, 1, 2, "and beta", "beta"), (3, 0, 1, "beta", "beta")]
    table = LookupTable.fixed(spark, terms, "cui bigint, rindex int, tcount int, term string, rword string")
    wide = LookupTable(table.frame, table.size_bytes, limit=0)
    for tags in (None, ("VB",)):
        one, two = (sorted(find_terms(frames, t, match_variants=True, excluded_tags=tags).drop("words").collect()) for t in (table, wide))
        assert one == two
        assert sorted({r.cui for r in one}) == ([1, 2, 3] if tags is None else [1, 3])


@pytest.mark.parametrize("partitions", [1, 40])
def test_sentences_and_windows_need_no_exchange_of_their_own(spark, partitions):
    notes = spark.range(20).selectExpr("id AS doc_id", "repeat('The old cat sat by it. ', 9) AS text").repartition(partitions)
    parts = split_to_parts(notes.repartition("doc_id"), 100).select("doc_id", "part", "text")
    lexicon_ = LookupTable.fixed(spark, [("old", 1), ("cat", 128)], "lex_word string, lex_bits int")
    tagged = structure.pos_tag(structure.tokenize(structure.sentence_split(parts)), lexicon_, ("by",))
    windows = structure.lookup_windows(structure.chunk(tagged))
    kinds = [kind for _, kind in exchanges(windows)]
    assert sum(k.startswith("hashpartitioning") for k in kinds) == 1
    assert windows.count() > 0


def test_extract_moves_the_text_once(spark):
    table = LookupTable.fixed(spark, [(7, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string")
    concepts = LookupTable.fixed(
        spark, [(7, 100, "alpha", "drug", "RX", "9", "C0000007")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    parts = spark.range(200).selectExpr("concat('/n/', id, '.txt-1') AS key", "concat('no alpha ', id) AS value").repartition(7)
    result = jobs.extract(parts, jobs.Settings(table, concepts))
    assert result.count() == 200
    by_key = [columns for columns, kind in exchanges(result) if "hashpartitioning(key" in kind]
    assert sum("value" in columns or "text" in columns.replace("text_id", "") for columns in by_key) == 1


def test_windows_keep_one_of_equal_spans(spark):
    rows = [(1, 1, 0, 10), (1, 1, 0, 10), (1, 1, 2, 5), (1, 1, 8, 12), (1, 1, 0, 4)]
    frame = spark.createDataFrame(rows, "doc_id bigint, part int, begin int, end int")
    kept = sorted((r.begin, r.end) for r in structure.window_maximize(frame).collect())
    assert kept == [(0, 10), (8, 12)]


def test_containment_across_buckets_matches_brute_force(spark):
    inner = [(1, 1, b, b + n) for b in range(0, 1200, 37) for n in (1, 40)]
    outer = [(1, 1, b, b + n) for b in range(0, 1200, 101) for n in (3, 300, 700)]
    schema = "doc_id bigint, part int, begin int, end int"
    got = spans.covered_by(
        spark.createDataFrame(inner, schema), spark.createDataFrame(outer, schema), outer_columns=["begin", "end"]
    )
    expected = sorted((*i, o[2], o[3]) for i in inner for o in outer if o[2] <= i[2] and i[3] <= o[3])
    assert sorted(tuple(r) for r in got.collect()) == expected


#: Examples of every rule class: consonant, vowel, doubled consonant, exception, empty tail.
FORMS = """
RULE: Cy$|noun|singular|Cies$|noun|plural
RULE: CVC$|adj|positive|CVSCer$|adj|comparative
RULE: goose$|noun|singular|geese$|noun|plural
RULE: $|noun|singular|s$|noun|plural
EXCEPTION: ga|gas;
""".strip()
MADE = """
RULE: ness$|noun|base|$|adj|base
RULE: $|adj|base|ish$|adj|base
EXCEPTION: red|redish;
""".strip()


def rule_table(spark, rules):
    return lexicon.rule_lines(lexicon.text_lines(spark, "rules", rules))


@pytest.mark.parametrize(
    "word, base", [("geese", "goose"), ("ponies", "pony"), ("redder", "red"), ("gas", None), ("is", "i"), ("trees", "tree")]
)
def test_uninflect(spark, word, base):
    words = spark.createDataFrame([(word,)], "word string")
    found = variants.uninflect_by_rule(words, rule_table(spark, FORMS)).collect()
    assert [r.base for r in found] == ([base] if base else [])


def test_derive(spark):
    words = spark.createDataFrame([("goodness",), ("red",)], "word string")
    made = variants.derive_by_rule(words, rule_table(spark, MADE)).collect()
    assert {(r.word, r.form) for r in made} == {("goodness", "good"), ("goodness", "goodnessish")}


def test_limits_apply_only_where_given(spark):
    rows = [("ab", "a", "r1", 1), *[("word", f"b{i}", f"r{i}", i) for i in range(12)]]
    candidates = spark.createDataFrame(rows, "word string, base string, rule_id string, suffix_length int")
    assert variants.rule_limits(candidates).count() == 13
    limited = variants.rule_limits(candidates, 3, 10).collect()
    assert sorted(r.suffix_length for r in limited) == list(range(2, 12))


def test_insert_script_with_quotes(spark):
    line = "INSERT INTO INFLECTION VALUES('\"a-b\" itides','o''clock',128,8,'E1','x','x','x')"
    row = lexicon.insert_script(spark.createDataFrame([(line,)], "line string"), "INFLECTION").first()
    assert (row.if_term_lc, row.if_term, row.term_cat) == ('"a-b" itides', "o'clock", 128)


@pytest.mark.parametrize(
    "phrase, start, end",
    [
        ("yesterday", "2024-03-12", "2024-03-13"),
        ("last three weeks", "2024-02-19", "2024-03-11"),
        ("two days ago", "2024-03-11", "2024-03-12"),
        ("next month", "2024-04-01", "2024-05-01"),
        ("two hundred days ago", "2023-08-26", "2023-08-27"),
        ("last monday", "2024-03-11", "2024-03-12"),
        ("last wednesday", "2024-03-06", "2024-03-07"),
        ("next wednesday", "2024-03-20", "2024-03-21"),
        ("this friday", "2024-03-15", "2024-03-16"),
        ("latest wednesday", "2024-03-13", "2024-03-14"),
        ("next january", "2025-01-01", "2025-02-01"),
        ("last march", "2023-03-01", "2023-04-01"),
        ("2000000000 years ago", None, None),
        ("99999999 years ago", None, None),
        ("2000000000 weeks ago", None, None),
        ("gibberish", None, None),
    ],
)
def test_relative_span(spark, phrase, start, end):
    v = value(spark, times.relative_span(F.lit(phrase), F.lit("2024-03-13 10:00:00").cast("timestamp")))
    shown = [x and x.strftime("%Y-%m-%d") for x in (v.start, v.end)]
    assert shown == [start, end]


@pytest.mark.parametrize(
    "phrase, start, end",
    [
        ("march 5, 2024", "2024-03-05", "2024-03-06"),
        ("5th of march 2024", "2024-03-05", "2024-03-06"),
        ("3/5/2024", "2024-03-05", "2024-03-06"),
        ("3/5/69", "2069-03-05", "2069-03-06"),
        ("3/5/70", "1970-03-05", "1970-03-06"),
        ("13/5/2024", None, None),
        ("2024-02-29", "2024-02-29", "2024-03-01"),
        ("2024 march", "2024-03-01", "2024-04-01"),
        ("christmas 2024", "2024-12-25", "2024-12-26"),
        ("2035", "2035-01-01", "2036-01-01"),
        ("1935", "1935-01-01", "1936-01-01"),
    ],
)
def test_absolute_date(spark, phrase, start, end):
    v = value(spark, times.absolute_date(F.lit(phrase)))
    assert [x and x.strftime("%Y-%m-%d") for x in (v.start, v.end)] == [start, end]


@pytest.mark.parametrize(
    "text, n",
    [("200", 200), ("two hundred", 200), ("a hundred and five", 105), ("three thousand", 3000), ("ten thousand two hundred one", 10201),
     ("hundred", 100), ("many", None), ("99999999999", None), ("couple of", 2)],
)
def test_count_value(spark, text, n):
    assert value(spark, times.count_value(F.lit(text))) == n


@pytest.mark.parametrize("text, found", [("10:30:15", (10, 30, 15)), ("10:30:75", (None, None, None)), ("9 pm", (21, 0, 0))])
def test_time_of_day(spark, text, found):
    assert tuple(value(spark, times.time_of_day(F.lit(text)))) == found


def test_years_of_any_century_are_years(spark):
    notes = spark.createDataFrame([(1, 1, "In 2035 or 1935 , not 2500 , 12 ab")], "doc_id bigint, part int, text string")
    words = LookupTable.fixed(spark, [("none", "Unit")], "time_word string, time_class string")
    tokens = structure.tokenize(structure.sentence_split(notes))
    found = temporal.time_mentions(tokens, words, anchor=F.lit("2024-03-13").cast("timestamp"))
    assert sorted(r.value_start.year for r in found.collect()) == [1935, 2035]


def test_wrong_bytes_do_not_end_the_job(spark, tmp_path):
    (tmp_path / "good.txt").write_bytes("caf\u00e9".encode())
    (tmp_path / "bad.txt").write_bytes(b"caf\xe9 noir")
    rows = {r.path.rsplit("/", 1)[1]: (r.text, r.failure) for r in files.whole_texts(spark, str(tmp_path)).collect()}
    assert rows == {"good.txt": ("caf\u00e9", None), "bad.txt": ("caf\ufffd noir", "UNDECODABLE_BYTES")}
    one = files.whole_texts(spark, str(tmp_path / "good.txt")).collect()
    assert [r.text for r in one] == ["caf\u00e9"]


def test_excluded_tags_start_no_lookup(spark):
    terms = [(1, 0, 1, "alpha", "alpha"), (2, 0, 1, "beta", "beta")]
    table = LookupTable.fixed(spark, terms, "cui bigint, rindex int, tcount int, term string, rword string")
    concepts = LookupTable.fixed(
        spark, [(1, 1, "a", "drug", "RX", "1", "C1")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    lexicon_ = LookupTable.fixed(spark, [("beta", 1024)], "lex_word string, lex_bits int")
    notes = spark.createDataFrame([(1, 1, "Alpha and beta.")], "doc_id bigint, part int, text string")
    found = lambda tags: sorted(
        r.cui for r in jobs.annotate(notes, jobs.Settings(table, concepts, lexicon=lexicon_, excluded_tags=tags)).collect()
    )
    assert (found(None), found(("VB",))) == ([1, 2], [1])


def test_rule_files_include_each_other_in_place(spark, tmp_path):
    rule = "RULE: {0}$|noun|singular|{0}s$|noun|plural"
    (tmp_path / "top.rul").write_text(f"{rule.format('a')}\nFILE: mid.rul\n{rule.format('d')}\nEXCEPTION: d|ds;\nFILE: none.rul\n")
    (tmp_path / "mid.rul").write_text(f"# comment\n{rule.format('b')}\nFILE: low.rul\n")
    (tmp_path / "low.rul").write_text(f"{rule.format('c')}\nEXCEPTION: c|cs;\n")
    (tmp_path / "loop.rul").write_text("FILE: loop.rul\n")
    lines = lexicon.read_lines(spark, str(tmp_path))
    rules = lexicon.rule_lines(lexicon.include_files(lines, "top.rul")).orderBy("rule_id").collect()
    assert [(r.in_pattern, r.exceptions) for r in rules] == [("a$", []), ("b$", []), ("c$", ["c|cs"]), ("d$", ["d|ds"])]
    with pytest.raises(ValueError, match="loop.rul"):
        lexicon.include_files(lines, "loop.rul")


def test_a_job_removes_what_it_derived(spark):
    with job(spark):
        kept = materialise(spark.range(5), "numbers")
        path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert kept.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_read_lines_keeps_the_order_of_a_file(spark, tmp_path):
    (tmp_path / "words.txt").write_text("".join(f"w{i}\n" for i in range(500)))
    rows = lexicon.read_lines(spark, str(tmp_path / "words.txt")).orderBy("line_no").collect()
    assert [r.line for r in rows] == [f"w{i}" for i in range(500)]
    assert {r.file for r in rows} == {"words.txt"}


def test_character_map(spark):
    lines = spark.createDataFrame([("U+00E9|e|x",), ("U+1F642|:)|x",), ("# note",), ("U+00DF|ss|",)], "line string")
    assert sorted(map(tuple, lexicon.character_map(lines).collect())) == [("\u00df", "ss"), ("\u00e9", "e"), ("\U0001f642", ":)")]


def test_annotation_files(spark, tmp_path):
    spans = spark.createDataFrame([("event", 3, 7, "drug", "C1", -1, 0), ("entity", 9, 12, "anatomy", "C2", 0, 1)], annotations.SPAN_SCHEMA)
    documents = annotation_documents(spans.withColumn("id", F.lit(1)), ["id"])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.xml").write_text(documents.first()["annotations"])
    found = annotations.annotation_files(spark, str(tmp_path))
    assert sorted(map(tuple, found.drop("path").collect())) == sorted(map(tuple, spans.collect()))
    assert found.first()["path"].endswith("in/1.xml")


def test_dictionary_and_concept_tables(spark):
    raw = spark.createDataFrame([("12", "0", "2", "low back", "back")], "CUI string, RINDEX string, TCOUNT string, TEXT string, RWORD string")
    assert tuple(dictionary_sources.dictionary_table(raw).first()) == (12, 0, 2, "low back", "back")
    tui = spark.createDataFrame([(1, 7), (2, 8)], "cui bigint, tui int")
    names = spark.createDataFrame([(1, "one"), (3, "three")], "cui bigint, pref_term string")
    long_codes = spark.createDataFrame([(1, "0042")], "cui bigint, code string")
    text_codes = spark.createDataFrame([(1, "DB0042"), (3, "DB7")], "cui bigint, code string")
    found = dictionary_sources.concept_tables(tui, names, {"A": (long_codes, "long"), "B": (text_codes, "text")})
    assert sorted((r.cui, r.scheme or "", r.code or "") for r in found.collect()) == [
        (1, "A", "42"), (1, "B", "DB0042"), (2, "", ""), (3, "B", "DB7")
    ]


def test_parts_join_up_to_the_note_again(spark):
    notes = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    parts = split_to_parts(notes, 500).select("doc_id", "part", "text")
    joined = parts.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("part", "text")))["text"], "").alias("whole"))
    plain = F.regexp_replace(F.regexp_replace("text", r"(?:\r?\n)+\z", ""), r"\r\n", "\n")
    wrong = notes.filter(F.trim("text") != "").join(joined, "doc_id").filter(F.col("whole") != F.concat(plain, F.lit("\n")))
    assert wrong.count() == 0


def test_batches_of_one_minute_keep_each_other(spark, tmp_path):
    table = LookupTable.fixed(spark, [(7, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string")
    concepts = LookupTable.fixed(
        spark, [(7, 100, "alpha", "drug", "RX", "9", "C0000007")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    notes, out = tmp_path / "notes", str(tmp_path / "out")
    notes.mkdir()
    for i, marks in enumerate(("one", "one", "two")):
        (notes / f"{i}.txt").write_text(f"alpha {i}")
        run = incremental.incremental_extract(spark, str(notes), out, str(tmp_path / marks), jobs.Settings(table, concepts), lambda batch: "202601010930")
        run.awaitTermination()
    found = sorted(r.text.strip() for r in incremental.read_batches(spark, out).collect())
    # the third run has a fresh checkpoint, so it reads all notes again beside the earlier rows
    assert found == sorted(["alpha 0", "alpha 1", "alpha 0", "alpha 1", "alpha 2"])
    assert {(r.cuis, r.loaded) for r in incremental.read_batches(spark, out).collect()} == {("C0000007", "202601010930")}
    assert sorted((r.n_rows, r.n_parsed, r.n_failed) for r in incremental.ledger(spark, out).collect()) == [(1, 1, 0), (1, 1, 0), (3, 3, 0)]


def test_a_batch_that_breaks_off_has_no_rows(spark, tmp_path, monkeypatch):
    table = LookupTable.fixed(spark, [(7, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string")
    concepts = LookupTable.fixed(
        spark, [(7, 100, "alpha", "drug", "RX", "9", "C0000007")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    notes, out = tmp_path / "notes", str(tmp_path / "out")
    notes.mkdir()

    def run():
        stream = incremental.incremental_extract(
            spark, str(notes), out, str(tmp_path / "marks"), jobs.Settings(table, concepts), lambda batch: f"20260101{batch:04d}"
        )
        stream.awaitTermination()

    (notes / "0.txt").write_text("alpha 0")
    run()
    (notes / "1.txt").write_text("alpha 1")

    class Broken:
        @property
        def get(self):
            raise RuntimeError("lost after the rows were written")

    with monkeypatch.context() as m:
        m.setattr(incremental, "observed_counts", lambda rows: (Broken(), rows))
        with pytest.raises(Exception, match="lost after"):
            run()
    assert [r.text.strip() for r in incremental.read_batches(spark, out).collect()] == ["alpha 0"]
    run()
    assert sorted(r.text.strip() for r in incremental.read_batches(spark, out).collect()) == ["alpha 0", "alpha 1"]
    assert sorted(r.batch for r in incremental.ledger(spark, out).collect()) == [0, 1]


def test_missing_root_is_an_error(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.whole_files(spark, "/tmp/no-such-folder-of-notes").count()


def test_legacy_sequence_files(spark, tmp_path):
    pairs = spark.sparkContext.parallelize([("/n/1.txt-1", "text")])
    pairs.saveAsSequenceFile(str(tmp_path / "seq"))
    assert files.keyed_parts_sequence(spark, str(tmp_path / "seq")).collect() == [("/n/1.txt-1", "text")]


def test_repeated_rows_are_each_answered_once(spark):
    table = LookupTable.fixed(
        spark, [(7, 0, 1, "alpha", "alpha")], "cui bigint, rindex int, tcount int, term string, rword string"
    )
    concepts = LookupTable.fixed(
        spark,
        [(7, 100, "alpha", "drug", "RX", "9", "C0000007")],
        "concept_id bigint, tui int, pref_term string, sem_group string, scheme string, code string, concept_cui string",
    )
    rows = [("/n/1.txt-1", "no alpha"), ("/n/1.txt-1", "no alpha"), ("/n/1.txt-1", "alpha"), ("bad", "alpha")]
    results = jobs.extract(spark.createDataFrame(rows, "key string, value string"), jobs.Settings(table, concepts))
    assert sorted((r.parsed, r.cuis or "") for r in results.collect()) == [
        (False, ""), (True, "C0000007"), (True, "NC0000007"), (True, "NC0000007"),
    ]
