"""The composed jobs: packing, extraction, lookup, preprocessing, time relations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.functions.codes import negation_prefix
from notequarry.functions.keys import parse_keys, part_key_compose, result_envelope
from notequarry.functions.text import form_feed_to_space, legal_char_scrub
from notequarry.operators import KEYS
from notequarry.operators.consume import observed_counts
from notequarry.operators.context import NEGATION, UNCERTAINTY, Cues, negation_scope, uncertainty_scope
from notequarry.operators.dictionary import concept_enrich, find_terms
from notequarry.operators.parts import split_to_parts
from notequarry.operators.structure import (
    chunk,
    chunk_type,
    chunked_sentences,
    lookup_windows,
    pos_tag,
    segment,
    sentence_frames,
    sentence_split,
    sentence_words,
    tokenize,
    window_frames,
)
from notequarry.operators.temporal import doc_time_relation, event_mentions, lexicon_phrases
from notequarry.plans.lookup_table import LookupTable, met_by_key, never_sent_whole
from notequarry.sinks.results import (
    annotation_document,
    delimited,
    packed_parts,
    partitioned_append,
    union_template,
)

#: A row of a keyed part table: its key, and its text in case a key is repeated.
PART_KEYS = ("key", "text_id")


@dataclass(frozen=True)
class Settings:
    """What an extraction needs besides the notes."""

    dictionary: LookupTable
    concepts: LookupTable
    lexicon: LookupTable | None = None
    variants: LookupTable | None = None
    window: str = "sentence"
    min_span: int = 3
    use_default_annotators: bool = True
    negation_cues: Cues | Sequence[str] = field(default=NEGATION)
    uncertainty_cues: Cues | Sequence[str] = field(default=UNCERTAINTY)
    #: Words of the closed class, for the tags that windows and excluded tags need.
    closed_words: Sequence[str] = ()
    #: Tokens with one of these tags start no lookup; needs the lexicon. None looks up all.
    excluded_tags: Sequence[str] | None = None


def pack_notes(notes: DataFrame, max_size: int) -> DataFrame:
    """Notes (path, text) as keyed parts (key, value)."""
    parts = split_to_parts(notes.select("path", "text"), max_size)
    key = part_key_compose(F.col("path"), F.col("part"))
    return parts.select(key.alias("key"), F.col("text").alias("value"))


def pack_note_files(spark: SparkSession, notes: DataFrame, out: str, n_files: int, max_size: int) -> DataFrame:
    """Pack, store in ``n_files`` files and read back."""
    packed_parts(pack_notes(notes, max_size), out, n_files)
    return spark.read.parquet(out)


def add_variants(words: DataFrame, variants: LookupTable, keys: Sequence[str]) -> DataFrame:
    """Sentence rows with the canonical form of each word (null where there is none).

    ``variants``: form, canonical, one row per lower-cased word.
    """
    # an outer generator: the inner form would add a filter that runs the pattern again
    listed = words.select(*keys, "sent_id", F.posexplode_outer("words").alias("i", "w"))
    found = variants.join(listed.filter(F.col("i").isNotNull()), {"w": "form"}, "left")
    entry = F.struct("i", "canonical")
    arrays = found.groupBy(*keys, "sent_id").agg(F.sort_array(F.collect_list(entry)).alias("_v"))
    named = arrays.select(*keys, "sent_id", F.col("_v.canonical").alias("variants"))
    return met_by_key(words, named, [*keys, "sent_id"])


def add_tags(words: DataFrame, sentences: DataFrame, settings: Settings, keys: Sequence[str]) -> DataFrame:
    """Sentence rows with the tag of each word."""
    tagged = pos_tag(tokenize(sentences, keys), settings.lexicon, settings.closed_words)
    listed = F.sort_array(F.collect_list(F.struct("tok_idx", "pos"))).alias("_t")
    arrays = tagged.groupBy(*keys, "sent_id").agg(listed).select(*keys, "sent_id", F.col("_t.pos").alias("tags"))
    return met_by_key(words, arrays, [*keys, "sent_id"])


def annotate(parts: DataFrame, settings: Settings, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mentions of parts (keys, text): looked up, enriched, with polarity."""
    sentences = sentence_split(parts, keys)
    words = sentence_words(sentences, keys)
    match_variants = settings.variants is not None
    if match_variants:
        words = add_variants(words, settings.variants, keys)
    if settings.excluded_tags is not None:
        words = add_tags(words, sentences, settings, keys)
    if settings.window == "np":
        tagged = pos_tag(tokenize(sentences, keys), settings.lexicon, settings.closed_words)
        frames = window_frames(words, lookup_windows(chunk(tagged, keys), keys), keys)
        for column in ("variants", "tags"):
            if column in frames.columns:
                inside = F.slice(F.col(column), F.col("offset") + 1, F.size("words"))
                frames = frames.withColumn(column, inside)
    else:
        frames = sentence_frames(words)
    hits = find_terms(frames, settings.dictionary, keys, settings.min_span, match_variants, settings.excluded_tags)
    found = negation_scope(hits, settings.negation_cues)
    if settings.use_default_annotators:
        found = uncertainty_scope(found, settings.uncertainty_cues)
    else:
        found = found.withColumn("uncertainty", F.lit(0))
    return concept_enrich(found.drop("words"), settings.concepts)


def summarise(mentions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per part the annotation document and the event code string, in one pass."""
    entry = F.struct(
        F.col("begin"),
        (-F.col("end")).alias("back"),
        F.coalesce("concept", F.lit("")).alias("concept"),
        F.coalesce("sem_group", F.lit("")).alias("sem_group"),
        "end",
        "mention_class",
        "polarity",
        "uncertainty",
    )
    # a set: array_distinct compares every struct with every other
    listed = mentions.groupBy(*keys).agg(F.collect_set(entry).alias("_m"))
    ordered = listed.withColumn("_m", F.sort_array("_m"))
    events = F.filter("_m", lambda m: (m["mention_class"] == "event") & (m["concept"] != ""))
    codes = F.transform(events, lambda m: negation_prefix(m["concept"], m["polarity"], "N"))
    spans = F.transform(
        "_m",
        lambda m: F.struct(
            m["mention_class"].alias("kind"),
            m["begin"].alias("begin"),
            m["end"].alias("end"),
            m["sem_group"].alias("label"),
            m["concept"].alias("concept"),
            m["polarity"].alias("polarity"),
            m["uncertainty"].alias("uncertainty"),
        ),
    )
    return ordered.select(
        *keys, annotation_document(spans).alias("annotations"), F.array_join(codes, " ").alias("cuis")
    )


def extract(parts: DataFrame, settings: Settings) -> DataFrame:
    """Keyed parts (key, value) to result rows, one per input row.

    Up to the mentions no text is shuffled. Mentions are shuffled to be put in order per
    part, and the text moves once, to meet them.
    """
    parsed = parse_keys(parts).withColumn("text_id", F.xxhash64("value"))
    good = parsed.filter(F.col("failure").isNull()).select(
        *PART_KEYS, legal_char_scrub(F.col("value")).alias("text")
    )
    summary = summarise(annotate(good, settings, PART_KEYS), PART_KEYS)
    joined = parsed.join(never_sent_whole(summary), list(PART_KEYS), "left")
    empty = annotation_document(F.array().cast("array<struct<kind:string>>"))
    columns = result_envelope(
        F.col("fname"),
        F.col("part"),
        F.col("failure"),
        F.col("value"),
        F.coalesce("annotations", empty),
        F.coalesce("cuis", F.lit("")),
    )
    return joined.select(*columns)


def extract_to_table(
    parts: DataFrame, settings: Settings, path: str, loaded: str, template: DataFrame | None = None
) -> dict[str, int]:
    """Extract, take the shape of the template table, append under ``loaded``.

    Returns n_rows, n_parsed and n_failed of the rows written, observed while they are.
    """
    seen, rows = observed_counts(extract(parts, settings))
    if template is not None:
        rows = union_template(template, rows)
    partitioned_append(rows.drop("loaded"), path, loaded)
    return seen.get


def extract_to_files(parts: DataFrame, settings: Settings, path: str) -> dict[str, int]:
    """Extract and write delimited files; returns the counts as ``extract_to_table`` does."""
    seen, rows = observed_counts(extract(parts, settings))
    delimited(rows, path)
    return seen.get


def lookup_only(parts: DataFrame, settings: Settings, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mentions by sentence window with cue negation, without the result row."""
    plain = Settings(
        settings.dictionary,
        settings.concepts,
        window="sentence",
        min_span=settings.min_span,
        use_default_annotators=False,
        negation_cues=settings.negation_cues,
    )
    return annotate(parts, plain, keys)


def preprocess_only(
    parts: DataFrame, lexicon: LookupTable, closed: Sequence[str] = (), keys: Sequence[str] = KEYS
) -> DataFrame:
    """Segments, sentences, tokens and chunks as one span table."""
    clean = parts.withColumn("text", form_feed_to_space(F.col("text")))
    sentences = sentence_split(clean, keys)
    tagged = pos_tag(tokenize(sentences, keys), lexicon, closed)
    # tokens and chunks are of one grouping, so tokens are cut and tagged once
    token = lambda t: F.struct(F.lit("token").alias("kind"), t["begin"].alias("begin"), t["end"].alias("end"), t["pos"].alias("label"))
    group = lambda c: F.struct(
        F.lit("chunk").alias("kind"), c["first"]["begin"].alias("begin"), c["last"]["end"].alias("end"),
        chunk_type(c["first"], c["last"]).alias("label"),
    )
    listed = F.concat(F.transform("toks", token), F.transform("chunks", group))
    inside = chunked_sentences(tagged, keys, ["pos"]).select(*keys, listed.alias("_spans"))
    rows = [
        segment(clean, keys).select(*keys, F.lit("segment").alias("kind"), "begin", "end", F.col("seg_id").alias("label")),
        sentences.select(*keys, F.lit("sentence").alias("kind"), "begin", "end", F.col("sent_id").cast("string").alias("label")),
        inside.select(*keys, F.inline_outer("_spans")).filter(F.col("kind").isNotNull()),
    ]
    spans = rows[0]
    for more in rows[1:]:
        spans = spans.unionByName(more)
    return spans


def doc_time(
    parts: DataFrame,
    settings: Settings,
    phrases: LookupTable,
    relations: LookupTable,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Events with their relation to the time of the note.

    Words are normalised before the lookup, so terms match by variant too.
    """
    events = event_mentions(annotate(parts, settings, keys))
    words = sentence_words(sentence_split(parts, keys), keys)
    found = lexicon_phrases(words, phrases, keys)
    return doc_time_relation(events, found, relations, keys)
