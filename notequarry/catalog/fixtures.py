"""Inputs of the registered queries, derived by Spark from the given tables.

The prose of the test tables is invented, so dictionary, concepts and lexicon are
built from the ``benchmark`` table, whose passages occur in ``documents``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.operators.context import Cues, negation_scope, uncertainty_scope
from notequarry.operators.dictionary import concept_enrich, find_terms, rare_word_index
from notequarry.operators.parts import split_to_parts
from notequarry.operators.structure import (
    chunk,
    lookup_windows,
    pos_tag,
    sentence_frames,
    sentence_split,
    sentence_words,
    tokenize,
    window_frames,
)
from notequarry.plans.lookup_table import LookupTable
from notequarry.session import materialise

#: Part cap of the queries; small enough that notes have several parts.
PART_CAP = 2000
#: Cue words of the invented prose.
NEGATION_WORDS = Cues(("was", "by"), before=("of the", "de la"), after=("in the",), stops=(",", "and that"))
UNCERTAINTY_WORDS = Cues(("from", "this"), before=("it is",), stops=("and",))
#: Closed-class words of the invented prose.
CLOSED_WORDS = ("of", "to", "in", "for", "with", "on", "at", "de", "en", "von", "zu", "para")
GROUPS = ("drug", "disorder", "finding", "procedure", "anatomy")
LONG_WORD = 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("hdfs://nn/notes/"), F.col("lang"), F.lit("/"), F.col("doc_id"), F.lit(".txt"))
    return docs.select("doc_id", path.alias("path"), "text")


def dealt_out(notes: DataFrame) -> DataFrame:
    """Notes dealt out by id, once: sentences, chunks and windows are all grouped within a note.

    The same at every size; four parts or more for each core even out notes of unlike length.
    """
    spark = notes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return notes.repartition(max(parts, 4 * spark.sparkContext.defaultParallelism), "doc_id")


def note_parts(spark: SparkSession, sf_dir: str, cap: int = PART_CAP) -> DataFrame:
    docs = dealt_out(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return split_to_parts(docs, cap).select("doc_id", "part", "text")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_split(note_parts(spark, sf_dir))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(sentences(spark, sf_dir))


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark")
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    return bench.select("item_id", words.alias("words"))


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every two- and three-word run of the items, and every long word."""
    listed = benchmark_words(spark, sf_dir).select(
        "item_id", "words", F.posexplode_outer("words").alias("pos", "word")
    )
    spread = listed.filter(F.col("word").isNotNull()).select(
        "item_id",
        "pos",
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("tcount"),
        "words",
        F.size("words").alias("n"),
    )
    run = F.array_join(F.slice("words", F.col("pos") + 1, F.col("tcount")), " ")
    fits = F.col("pos") + F.col("tcount") <= F.col("n")
    long_enough = (F.col("tcount") > 1) | (F.length("term") >= LONG_WORD)
    cui = F.col("item_id") * 100000 + F.col("pos") * 10 + F.col("tcount")
    return (
        spread.filter(fits)
        .select("item_id", "tcount", cui.alias("cui"), run.alias("term"))
        .filter(long_enough)
    )


@lru_cache(maxsize=64)
def _prepared(app: str, sf_dir: str, name: str) -> LookupTable:
    spark = SparkSession.active()
    if name == "terms":
        return LookupTable.prepare(terms(spark, sf_dir), "terms")
    if name == "dictionary":
        listed = _prepared(app, sf_dir, "terms").frame
        wanted = LookupTable.prepare(
            listed.select(F.explode(F.split("term", " ")).alias("wanted")).distinct(), "term-words"
        )
        docs = table(spark, sf_dir, "documents")
        words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
        seen = docs.select("doc_id", words.alias("words")).select(
            "doc_id", F.explode_outer("words").alias("word")
        )
        counts = (
            wanted.join(seen, {"word": "wanted"}, "left_semi")
            .groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_docs"))
        )
        return LookupTable.prepare(rare_word_index(listed, counts), "dictionary")
    if name == "concepts":
        return LookupTable.prepare(concepts(spark, sf_dir), "concepts")
    if name == "lexicon":
        return LookupTable.prepare(lexicon(spark, sf_dir), "lexicon")
    raise KeyError(name)


def prepared(spark: SparkSession, sf_dir: str, name: str) -> LookupTable:
    """A stored reference table of the session, built once."""
    return _prepared(spark.sparkContext.applicationId, sf_dir, name)


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = prepared(spark, sf_dir, "terms").frame
    odd = F.col("item_id") % 2
    group_no = ((F.col("item_id") + 2 * F.col("tcount") * odd) % 5).cast("int")
    names = F.array(*[F.lit(g) for g in GROUPS])
    cui = F.col("cui").cast("string")
    return listed.select(
        F.col("cui").alias("concept_id"),
        (group_no + 100).alias("tui"),
        F.col("term").alias("pref_term"),
        F.element_at(names, group_no + 1).alias("sem_group"),
        F.when(odd == 1, F.lit("RXNORM")).otherwise(F.lit("SNOMEDCT_US")).alias("scheme"),
        cui.alias("code"),
        F.when(odd == 0, F.concat(F.lit("C"), F.lpad(cui, 9, "0"))).alias("concept_cui"),
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = benchmark_words(spark, sf_dir).select(F.explode("words").alias("lex_word")).distinct()
    bits = F.call_function("shiftleft", F.lit(1), F.length("lex_word") % 11)
    return words.select("lex_word", bits.alias("lex_bits"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_words(sentences(spark, sf_dir))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pos_tag(tokens(spark, sf_dir), prepared(spark, sf_dir, "lexicon"), CLOSED_WORDS)


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk(tagged(spark, sf_dir))


def hits(spark: SparkSession, sf_dir: str, window: str = "sentence") -> DataFrame:
    by_sentence = words(spark, sf_dir)
    if window == "np":
        frames = window_frames(by_sentence, lookup_windows(chunks(spark, sf_dir)))
    else:
        frames = sentence_frames(by_sentence)
    return find_terms(frames, prepared(spark, sf_dir, "dictionary"))


def mentions(spark: SparkSession, sf_dir: str, window: str = "sentence") -> DataFrame:
    found = concept_enrich(hits(spark, sf_dir, window), prepared(spark, sf_dir, "concepts"))
    found = negation_scope(found, NEGATION_WORDS)
    return uncertainty_scope(found, UNCERTAINTY_WORDS).drop("words")
