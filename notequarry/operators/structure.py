"""Segments, sentences, tokens, tags, chunks and lookup windows.

The unit of work is one sentence with its tokens in arrays. Everything inside a
sentence is computed on that row, so text flows from scan to tokens without a
shuffle. A pattern covers its text without gaps; the end of match ``k`` is the
summed length of the first ``k`` matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notequarry.functions.arrays import let, running_sum
from notequarry.operators import KEYS
from notequarry.plans.lookup_table import LookupTable, met_by_key
from notequarry.functions.codes import lowest_category_tag

BLANKS = " \t\r\f"

#: A sentence with the blanks and line breaks before it.
SENTENCE = r"[ \t\r\f\n]*(?:[^ \t\r\f\n.!?][^.!?\n]*[.!?]*|[.!?]+)"

#: Token alternatives, longest shapes first: date, time, fraction, range, number,
#: contraction, word, any other single character.
TOKEN_SHAPES = (
    r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}",
    r"[0-9]{1,2}:[0-9]{2}",
    r"[0-9]+/[0-9]+",
    r"[0-9]+-[0-9]+",
    r"[0-9]+(?:[.,][0-9]+)*",
    r"'(?:s|re|ve|ll|d|m)",
    r"\p{L}+",
    r"[^\p{L}0-9 \t\r\f]",
)
TOKEN = r"[ \t\r\f]*(?:" + "|".join(TOKEN_SHAPES) + ")"
#: ``TOKEN`` with words tried first, as most tokens are: no other shape begins with a letter.
WORDS_FIRST = r"[ \t\r\f]*(?:" + "|".join((TOKEN_SHAPES[6], *TOKEN_SHAPES[:6], TOKEN_SHAPES[7])) + ")"
PUNCTUATION = ".,;:!?'\"()[]{}-"

#: Chunks over one letter per token.
CHUNK = "D?J*N+|M?V+|I|."
#: The letters inside of a chunk of ``CHUNK``, after its first.
INSIDE = "(?<=[DJN])N|(?<=[DJ])J(?=J*+N)|(?<=[MV])V"


def _matches(text: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def explode_matches(frame: DataFrame, keep: Sequence[str], matches: str, index: str) -> DataFrame:
    """One row per match: ``keep``, its index, ``_one`` and ``_to``, where it ends.

    The matches are placed inside their row, so only ``keep`` goes with each of them. An outer
    generator: the inner form would add a filter that runs the pattern a second time.
    """
    ends = frame.select(*keep, matches, running_sum(F.transform(matches, F.length)).alias("_ends"))
    named = F.arrays_zip(
        F.sequence(F.lit(0), F.size(matches) - 1).alias(index), F.col(matches).alias("_one"), F.col("_ends").alias("_to")
    )
    placed = ends.select(*keep, F.when(F.size(matches) > 0, named).alias("_placed"))
    return placed.select(*keep, F.inline_outer("_placed")).filter(F.col("_one").isNotNull())


def segment(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The whole part as one segment."""
    return parts.select(
        *keys,
        F.lit("SIMPLE_SEGMENT").alias("seg_id"),
        F.lit(0).alias("begin"),
        F.length("text").alias("end"),
    )


def sentence_split(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sentences with offsets, numbered in order; a line break always ends one."""
    found = parts.select(*keys, _matches("text", SENTENCE).alias("_all"))
    core = F.ltrim(F.col("_one"), F.lit(BLANKS + "\n"))
    cut = explode_matches(found, keys, "_all", "sent_id").select(
        *keys,
        "sent_id",
        (F.col("_to") - F.length(core)).alias("begin"),
        F.rtrim(core, F.lit(BLANKS)).alias("text"),
    )
    return cut.select(
        *keys, "sent_id", "begin", (F.col("begin") + F.length("text")).alias("end"), "text"
    )


def sentence_words(sentences: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sentences with their tokens in arrays: as matched, lower-cased, and where they end."""
    pieces = sentences.select(
        *keys, "sent_id", F.col("begin").alias("sent_begin"), _matches("text", WORDS_FIRST).alias("pieces")
    )
    words = F.transform("pieces", lambda p: F.lower(F.ltrim(p, F.lit(BLANKS))))
    return placed_words(pieces.withColumn("words", words))


def placed_words(words: DataFrame) -> DataFrame:
    """Add ``ends``: the places in the part at which the tokens of a row end.

    Summed once a sentence, so that nothing found in it counts from its beginning again.
    """
    sums = running_sum(F.transform("pieces", F.length))
    return words.withColumn("ends", F.transform(sums, lambda e: F.col("sent_begin") + e))


def token_type(text: Column) -> Column:
    first = F.substring(text, 1, 1)
    punctuation = F.position(first, F.lit(PUNCTUATION))
    return (
        F.when(first.between("0", "9"), F.lit("Num"))
        .when((first == "'") & (F.length(text) > 1), F.lit("Contraction"))
        .when(text == "\n", F.lit("Newline"))
        .when(punctuation > 0, F.lit("Punctuation"))
        .when(first.rlike(r"\p{L}"), F.lit("Word"))
        .otherwise(F.lit("Symbol"))
    )


def _token_rows(frame: DataFrame, keep: Sequence[str]) -> DataFrame:
    carried = [*keep, "sent_begin"]
    cut = explode_matches(frame, carried, "pieces", "tok_idx").select(
        *keep,
        "tok_idx",
        (F.col("sent_begin") + F.col("_to")).alias("end"),
        F.ltrim(F.col("_one"), F.lit(BLANKS)).alias("text"),
    )
    # Blanks at the end of a part are a match of their own, and no token.
    return cut.filter(F.col("text") != "").select(
        *keep,
        "tok_idx",
        (F.col("end") - F.length("text")).alias("begin"),
        "end",
        "text",
        token_type(F.col("text")).alias("token_type"),
    )


def tokenize(sentences: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Typed tokens of every sentence with offsets in the part.

    Dates, times, fractions, ranges and measured numbers are single tokens.
    """
    pieces = sentences.select(
        *keys, "sent_id", F.col("begin").alias("sent_begin"), _matches("text", WORDS_FIRST).alias("pieces")
    )
    return _token_rows(pieces, [*keys, "sent_id"])


def tokenize_parts(parts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Tokens of the whole part, line breaks among them."""
    pieces = parts.select(*keys, F.lit(0).alias("sent_begin"), _matches("text", WORDS_FIRST).alias("pieces"))
    return _token_rows(pieces, list(keys))


def merged_token_kind(text: Column) -> Column:
    """Which context-dependent shape a single token has, null for plain ones."""
    return (
        F.when(text.rlike(r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}\z"), F.lit("date"))
        .when(text.rlike(r"\A[0-9]{1,2}:[0-9]{2}\z"), F.lit("time"))
        .when(text.rlike(r"\A[0-9]+/[0-9]+\z"), F.lit("fraction"))
        .when(text.rlike(r"\A[0-9]+-[0-9]+\z"), F.lit("range"))
        .when(text.rlike(r"\A[0-9]+(?:[.,][0-9]+)+\z"), F.lit("measurement"))
    )


def pos_tag(
    tokens: DataFrame,
    lexicon: LookupTable,
    closed: Sequence[str] = (),
) -> DataFrame:
    """Add ``pos``: number, closed class, lexicon, suffix, noun; first rule wins.

    ``lexicon`` has one row per lower-cased word: lex_word, lex_bits. ``closed`` lists
    prepositions and subordinating conjunctions, as ``sources.lexicon.word_list`` reads them.
    """
    lowered = tokens.withColumn("_lower", F.lower("text"))
    hit = lexicon.join(lowered, {"_lower": "lex_word"}, "left")
    word = F.col("_lower")
    pos = (
        F.when(F.col("token_type") == "Num", F.lit("CD"))
        .when(F.col("token_type") == "Punctuation", F.col("text"))
        .when(F.col("token_type").isin("Symbol", "Newline"), F.lit("SYM"))
        .when(word.isin("and", "or", "but"), F.lit("CC"))
        .when(word.isin(list(closed)), F.lit("IN"))
        .when(F.col("lex_word").isNotNull(), lowest_category_tag(F.col("lex_bits")))
        .when(F.endswith(word, F.lit("ing")), F.lit("VBG"))
        .when(F.endswith(word, F.lit("ed")), F.lit("VBD"))
        .when(F.endswith(word, F.lit("ly")), F.lit("RB"))
        .when(F.endswith(word, F.lit("s")), F.lit("NNS"))
        .otherwise(F.lit("NN"))
    )
    return hit.withColumn("pos", F.coalesce(pos, F.lit("NN"))).drop("_lower", "lex_word", "lex_bits")


def tag_letter(pos: Column) -> Column:
    return (
        F.when(pos == "DT", F.lit("D"))
        .when(pos.isin("JJ", "CD"), F.lit("J"))
        .when(pos.isin("NN", "NNS"), F.lit("N"))
        .when(pos.isin("VB", "VBD", "VBG"), F.lit("V"))
        .when(pos == "MD", F.lit("M"))
        .when(pos == "IN", F.lit("I"))
        .otherwise(F.lit("O"))
    )


def run_ends(runs: Column) -> Column:
    """Runs with the place after each, (run, end)."""

    def placed(held: Column) -> Column:
        return F.arrays_zip(held.alias("run"), running_sum(F.transform(held, F.length)).alias("end"))

    return let(runs, placed)


def chunked_sentences(tagged: DataFrame, keys: Sequence[str] = KEYS, kept: Sequence[str] = ()) -> DataFrame:
    """Sentences with their tokens in order, ``toks``, and their chunks, ``chunks``.

    A chunk is (chunk_idx, first, last), its first and its last token; a token has ``begin``,
    ``end``, ``kept``, its place ``at`` and its ``mark``: a letter where a chunk begins.
    """
    # exploded, the letter is made in compiled code: the input of an aggregate is interpreted
    lettered = tagged.select("*", F.explode_outer(F.array(tag_letter(F.col("pos")))).alias("_letter"))
    entry = F.struct("tok_idx", "begin", "end", F.col("_letter").alias("letter"), *kept)
    by_sentence = lettered.groupBy(*keys, "sent_id").agg(F.sort_array(F.collect_list(entry)).alias("_toks"))
    marks = F.split(F.regexp_replace(F.array_join(F.col("_toks.letter"), ""), INSIDE, "-"), "")
    marked = by_sentence.select(*keys, "sent_id", "_toks", marks.alias("_marks"))
    toks = F.arrays_zip(
        F.sequence(F.lit(0), F.size("_toks") - 1).alias("at"),
        *(F.col(f"_toks.{c}").alias(c) for c in ("begin", "end", *kept)),
        F.col("_marks").alias("mark"),
        F.concat(F.slice("_marks", F.lit(2), F.size("_marks")), F.array(F.lit("."))).alias("next"),
    )
    placed = marked.select(*keys, "sent_id", toks.alias("toks"))
    # the n-th token that begins a chunk and the n-th after which one begins are of one chunk
    ends = placed.select(
        "*",
        F.filter("toks", lambda t: t["mark"] != "-").alias("_first"),
        F.filter("toks", lambda t: t["next"] != "-").alias("_last"),
    )
    chunks = F.arrays_zip(
        F.sequence(F.lit(0), F.size("_first") - 1).alias("chunk_idx"), F.col("_first").alias("first"), F.col("_last").alias("last")
    )
    return ends.select(*keys, "sent_id", "toks", chunks.alias("chunks"))


def chunk_type(first: Column, last: Column) -> Column:
    """NP, VP, PP or O, by the letter a chunk begins with and whether more tokens follow."""
    mark, more = first["mark"], last["at"] > first["at"]
    return (
        F.when((mark == "N") | (mark.isin("D", "J") & more), F.lit("NP"))
        .when((mark == "V") | ((mark == "M") & more), F.lit("VP"))
        .when(mark == "I", F.lit("PP"))
        .otherwise(F.lit("O"))
    )


def chunk(tagged: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Noun, verb and preposition chunks (others O) over the tags of a sentence."""
    found = chunked_sentences(tagged, keys).select(*keys, "sent_id", F.inline_outer("chunks"))
    first, last = F.col("first"), F.col("last")
    return found.filter(F.col("chunk_idx").isNotNull()).select(
        *keys,
        "sent_id",
        "chunk_idx",
        first["at"].alias("tok_start"),
        last["at"].alias("tok_end"),
        first["begin"].alias("begin"),
        last["end"].alias("end"),
        chunk_type(first, last).alias("chunk_type"),
    )


def chunk_extend(chunks: DataFrame, pattern: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Extend a chunk that starts ``pattern`` to the end of the pattern's last chunk."""
    order = W.partitionBy(*keys, "sent_id").orderBy("chunk_idx")
    match = F.col("chunk_type") == pattern[0]
    for step, kind in enumerate(pattern[1:], start=1):
        match = match & (F.coalesce(F.lead("chunk_type", step).over(order), F.lit("")) == kind)
    last = len(pattern) - 1
    return (
        chunks.withColumn("_match", match)
        .withColumn("_end", F.lead("end", last).over(order))
        .withColumn("_tok_end", F.lead("tok_end", last).over(order))
        .withColumn("end", F.when(F.col("_match"), F.col("_end")).otherwise(F.col("end")))
        .withColumn("tok_end", F.when(F.col("_match"), F.col("_tok_end")).otherwise(F.col("tok_end")))
        .drop("_match", "_end", "_tok_end")
    )


def extend_noun_phrases(chunks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """NP NP, then on its result NP PP NP."""
    return chunk_extend(chunk_extend(chunks, ["NP", "NP"], keys), ["NP", "PP", "NP"], keys)


def np_only(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("chunk_type") == "NP")


def window_maximize(windows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Delete every window that another envelops; of equal windows one stays.

    Ordered by begin and falling end, a window is enveloped exactly when some
    earlier one reaches its end, so a running maximum replaces a self join.
    """
    order = W.partitionBy(*keys).orderBy(F.col("begin"), F.col("end").desc())
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    return (
        windows.withColumn("_reach", reach)
        .filter(F.col("_reach").isNull() | (F.col("_reach") < F.col("end")))
        .drop("_reach")
    )


def lookup_windows(chunks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Noun phrases, extended and maximised, as lookup windows."""
    phrases = np_only(extend_noun_phrases(chunks, keys))
    return window_maximize(phrases.drop("chunk_type", "chunk_idx"), keys)


def sentence_frames(words: DataFrame) -> DataFrame:
    """Lookup frames of window type ``sentence``."""
    return words.withColumn("sent_words", F.col("words")).withColumn("offset", F.lit(0))


def window_frames(words: DataFrame, windows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Lookup frames of window type ``np``: the tokens of each window."""
    spans = windows.select(*keys, "sent_id", F.col("tok_start").alias("offset"), "tok_end")
    joined = met_by_key(words, spans, [*keys, "sent_id"])
    inside = F.slice(F.col("words"), F.col("offset") + 1, F.col("tok_end") - F.col("offset") + 1)
    return (
        joined.withColumn("sent_words", F.col("words"))
        .withColumn("words", inside)
        .drop("tok_end")
    )
