"""Dictionary lookup: rare-word join, phrase verify, concept enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notequarry.functions.arrays import one_by_one
from notequarry.functions.codes import concept_code
from notequarry.operators import KEYS
from notequarry.operators.structure import BLANKS, placed_words
from notequarry.plans.lookup_table import LookupTable, never_sent_whole
from notequarry.resources import LOOKUP_EXCLUDED_TAGS

DICTIONARY_SCHEMA = "cui bigint, rindex int, tcount int, term string, rword string"


def rare_word_index(terms: DataFrame, word_counts: DataFrame) -> DataFrame:
    """Index terms (cui, term) by their rarest word, ties to the leftmost.

    ``word_counts`` has word, n_docs; a word it lacks counts as never seen.
    """
    listed = terms.select("cui", "term", F.posexplode(F.split("term", " ")).alias("rindex", "rword"))
    counted = listed.join(
        word_counts.select(F.col("word").alias("rword"), "n_docs"), "rword", "left"
    )
    rarest = F.min(F.struct(F.coalesce("n_docs", F.lit(0)).alias("n"), "rindex", "rword"))
    best = counted.groupBy("cui", "term").agg(rarest.alias("r"))
    return best.select(
        "cui",
        F.col("r.rindex").alias("rindex"),
        F.size(F.split("term", " ")).alias("tcount"),
        "term",
        F.col("r.rword").alias("rword"),
    )


def min_term_length(dictionary: DataFrame, min_span: int = 3) -> DataFrame:
    return dictionary.filter(F.length("term") >= min_span)


def within_window(start: Column, tcount: Column, n_tokens: Column) -> Column:
    """Whether a phrase stays inside its window."""
    return (start >= 0) & (start + tcount <= n_tokens)


def lookup_pos_exclusion(tokens: DataFrame, tags: Sequence[str] = LOOKUP_EXCLUDED_TAGS) -> DataFrame:
    """Drop tokens whose tag never starts a lookup."""
    return tokens.filter(~F.col("pos").isin(list(tags)))


def rare_word_join(
    tokens: DataFrame, dictionary: LookupTable, word: str = "word"
) -> DataFrame:
    """Every (token, term) pair where the token is the term's rarest word."""
    return dictionary.join(tokens, {word: "rword"}, "inner")


def with_neighbour(dictionary: LookupTable) -> LookupTable:
    """The dictionary with the word next to each rare word as a second join key.

    A rare word that begins many terms (or a common one) meets only the terms
    whose neighbour stands there too, instead of all of them.
    """
    words = F.split("term", " ")
    follows = F.col("rindex") < F.col("tcount") - 1
    side = F.when(F.col("tcount") == 1, F.lit(0)).when(follows, F.lit(1)).otherwise(F.lit(2))
    near = (
        F.when(F.col("tcount") == 1, F.lit(""))
        .when(follows, F.get(words, F.col("rindex") + 1))
        .otherwise(F.get(words, F.col("rindex") - 1))
    )
    frame = dictionary.frame.withColumn("term_side", side).withColumn("term_near", near)
    return dictionary.derived(frame, 2)  # a neighbour is no longer than its term


def find_terms(
    frames: DataFrame,
    dictionary: LookupTable,
    keys: Sequence[str] = KEYS,
    min_span: int = 3,
    match_variants: bool = False,
    excluded_tags: Sequence[str] | None = None,
) -> DataFrame:
    """Dictionary hits in lookup frames.

    Frames hold the words of a window in an array. Each word probes the dictionary by its
    rarest word and that word's neighbour. A dictionary that may be broadcast is compared on
    the row of the frame, and nothing is shuffled. Beyond that only slim probes are
    shuffled, a few numbers and words each; the candidates that come back meet their frame
    once, and the phrase is compared there.

    With ``match_variants`` frames also hold ``variants`` (null where a word has none). With
    ``excluded_tags`` they hold ``tags``. Dictionary rows are distinct.
    """
    frame_keys = [*keys, "sent_id", "offset"]
    if "ends" not in frames.columns:
        frames = placed_words(frames)
    carried = [*frame_keys, "pieces", "ends", "words", "sent_words"]
    if match_variants:
        carried.append("variants")
    if excluded_tags is not None:
        carried.append("tags")
    frames = frames.select(*carried)
    probes = frames.select("*", F.posexplode_outer(one_by_one(F.col("words"))).alias("idx", "word"))
    if excluded_tags is not None:
        tag = F.element_at(F.col("tags"), F.col("idx") + 1)
        probes = probes.filter(F.col("word").isNotNull() & ~tag.isin(list(excluded_tags)))
    if match_variants:
        variant = F.element_at(F.col("variants"), F.col("idx") + 1)
        forms = F.array_distinct(F.array_compact(F.array(F.col("word"), variant)))
        probes = probes.withColumn("word", F.explode_outer(forms))

    start = F.col("idx") - F.col("rindex")
    safe_start = F.greatest(start, F.lit(0)) + 1
    window = F.slice(F.col("words"), safe_start, F.col("tcount"))
    wanted = F.split("term", " ")
    if match_variants:
        forms = F.slice(F.col("variants"), safe_start, F.col("tcount"))
        pairs = F.arrays_zip(window.alias("w"), forms.alias("v"), wanted.alias("t"))
        same = F.forall(pairs, lambda p: (p["w"] == p["t"]) | (F.coalesce(p["v"], F.lit("")) == p["t"]))
    else:
        same = window == wanted
    fits = within_window(start, F.col("tcount"), F.size("words")) & same
    residual = (F.length("term") >= min_span) & ((F.col("tcount") == 1) | fits)
    on = {"word": "rword"}
    if match_variants and dictionary.broadcastable:
        # told without a lambda, before the phrase: most terms of a word end here
        dictionary = with_neighbour(dictionary)
        at = F.col("idx") + F.when(F.col("term_side") == 1, F.lit(1)).otherwise(F.lit(-1))
        beside = F.get(F.col("words"), at) == F.col("term_near")
        varied = F.coalesce(F.get(F.col("variants"), at), F.lit("")) == F.col("term_near")
        narrow = (F.col("term_side") == 0) | beside | varied
        residual = narrow & residual if dictionary.broadcastable else residual
    if not match_variants:
        sides = F.array(
            F.struct(F.lit(0).alias("side"), F.lit("").alias("near")),
            F.struct(F.lit(1).alias("side"), F.get(F.col("words"), F.col("idx") + 1).alias("near")),
            F.struct(F.lit(2).alias("side"), F.get(F.col("words"), F.col("idx") - 1).alias("near")),
        )
        probes = probes.select("*", F.inline(sides))
        dictionary = with_neighbour(dictionary)
        on = {"word": "rword", "side": "term_side", "near": "term_near"}
    if dictionary.broadcastable:
        hits = dictionary.join(probes, on, "inner", residual)
    else:
        slim = probes.filter(F.col("word").isNotNull()).select(*frame_keys, "idx", *on)
        found = dictionary.join(slim, on, "inner").select(*frame_keys, "idx", "cui", "rindex", "tcount", "term")
        hits = frames.join(never_sent_whole(found.distinct()), frame_keys, "inner").filter(residual)

    placed = hits.select(
        *keys,
        "sent_id",
        "pieces",
        "ends",
        (F.col("offset") + F.when(F.col("tcount") == 1, F.col("idx")).otherwise(start)).alias("tok_start"),
        "tcount",
        "cui",
        F.col("sent_words").alias("words"),
    )
    # These must hold for any row: the optimizer may test them before the phrase.
    tok_end = F.col("tok_start") + F.col("tcount") - 1
    first = F.ltrim(F.get(F.col("pieces"), F.col("tok_start")), F.lit(BLANKS))
    return placed.select(
        *keys,
        "sent_id",
        "tok_start",
        tok_end.alias("tok_end"),
        (F.get("ends", F.col("tok_start")) - F.length(first)).alias("begin"),
        F.get("ends", tok_end).alias("end"),
        "cui",
        "words",
    )


def concept_enrich(
    hits: DataFrame, concepts: LookupTable
) -> DataFrame:
    """Concept attributes of each hit; hits without a concept stay.

    ``concepts``: concept_id, tui, pref_term, sem_group, scheme, code, concept_cui.
    """
    joined = concepts.join(hits, {"cui": "concept_id"}, "left").drop("concept_id")
    kind = F.when(F.col("sem_group") == "anatomy", F.lit("entity")).otherwise(F.lit("event"))
    named = concept_code(F.col("concept_cui"), F.col("scheme"), F.col("code"))
    return joined.withColumn("mention_class", kind).withColumn("concept", named)


def span_to_cuis(hits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per span, its distinct concept ids in rising order."""
    ids = F.array_sort(F.collect_set("cui"))
    return hits.groupBy(*keys, "begin", "end").agg(ids.alias("cuis"))
