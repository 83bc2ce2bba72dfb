"""Queries for dictionary lookup, context, consumers and the extraction jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from notequarry.catalog import fixtures as X
from notequarry.catalog.registry import pick, query
from notequarry.catalog.text_queries import ENVELOPE_KEY, FAILURE, SHOWN, raw_key
from notequarry.operators import consume, context, dictionary, spans, structure
from notequarry.plans import jobs
from notequarry.plans.lookup_table import LookupTable
from notequarry.sources.annotations import DOCUMENT_SCHEMA

MENTION = "doc_id part sent_id:i tok_start:i tok_end:i begin:i end:i cui"
FULL = MENTION + " tui:i pref_term sem_group scheme code concept_cui concept mention_class"


@query(
    """SELECT t.doc_id, t.part, CAST(t.sent_id AS INTEGER) AS sent_id, CAST(t.tok_idx AS INTEGER) AS tok_idx, d.cui
       FROM tokens t JOIN dictionary d ON lower(t.text) = d.rword"""
)
def rare_word_join(spark, sf):
    rows = X.words(spark, sf).select(
        "doc_id", "part", "sent_id", F.posexplode_outer("words").alias("tok_idx", "word")
    )
    pairs = dictionary.rare_word_join(rows, X.prepared(spark, sf, "dictionary"))
    return pairs.select("doc_id", "part", "sent_id", "tok_idx", "cui")


@query(pick("cui rindex:i tcount:i term rword", "dictionary"))
def rare_word_index(spark, sf):
    return X.prepared(spark, sf, "dictionary").frame


@query(pick(MENTION, "hits"))
def phrase_verify(spark, sf):
    return X.hits(spark, sf).drop("words")


PLURALS = {
    "plural_forms": "SELECT DISTINCT word || 's' AS form, word AS canonical FROM bench_words",
    "forms": """SELECT t.*, lower(text) AS w, canonical AS v FROM tokens t
        LEFT JOIN plural_forms ON form = lower(text)""",
    "form_lists": """SELECT doc_id, part, sent_id, list(w ORDER BY tok_idx) AS ws,
        list(coalesce(v, '') ORDER BY tok_idx) AS vs FROM forms GROUP BY ALL""",
    "probes": """SELECT doc_id, part, sent_id, tok_idx, w AS probe FROM forms
        UNION SELECT doc_id, part, sent_id, tok_idx, v FROM forms WHERE v IS NOT NULL""",
    "variant_hits": """
        SELECT DISTINCT f.doc_id, f.part, f.sent_id, f.tok_idx - d.rindex AS tok_start, d.tcount, d.cui
        FROM probes f JOIN dictionary d ON d.rword = f.probe
        JOIN form_lists l ON l.doc_id = f.doc_id AND l.part = f.part AND l.sent_id = f.sent_id
        WHERE length(d.term) >= 3 AND f.tok_idx >= d.rindex AND f.tok_idx - d.rindex + d.tcount <= len(l.ws)
          AND len(list_filter(string_split(d.term, ' '), lambda t, i:
              t = l.ws[f.tok_idx - d.rindex + i] OR t = l.vs[f.tok_idx - d.rindex + i])) = d.tcount""",
}


def plural_variants(spark, sf) -> LookupTable:
    """Each benchmark word with an s as a variant of the word."""
    words = X.benchmark_words(spark, sf).select(F.explode("words").alias("canonical")).distinct()
    return LookupTable.prepare(words.select(F.concat("canonical", F.lit("s")).alias("form"), "canonical"), "plurals")


@query(pick("doc_id part sent_id:i tok_start:i cui", "variant_hits"), PLURALS)
def variant_lookup(spark, sf):
    words = jobs.add_variants(X.words(spark, sf), plural_variants(spark, sf), structure.KEYS)
    found = dictionary.find_terms(
        structure.sentence_frames(words), X.prepared(spark, sf, "dictionary"), match_variants=True
    )
    return found.select("doc_id", "part", "sent_id", "tok_start", "cui").distinct()


@query(pick(FULL, "mentions"))
def concept_enrich(spark, sf):
    found = dictionary.concept_enrich(X.hits(spark, sf), X.prepared(spark, sf, "concepts"))
    return found.drop("words")


@query(pick(MENTION + " concept", "np_mentions"))
def window_lookup(spark, sf):
    columns = [c.split(":")[0] for c in MENTION.split()]
    return X.mentions(spark, sf, "np").select(*columns, "concept")


@query(pick(MENTION + " polarity:i", "mentions"))
def negation_scope(spark, sf):
    return context.negation_scope(X.hits(spark, sf), X.NEGATION_WORDS).drop("words")


@query(pick(MENTION + " polarity:i uncertainty:i", "mentions"))
def polarity_default(spark, sf):
    marked = context.negation_scope(X.hits(spark, sf), X.NEGATION_WORDS)
    return context.uncertainty_scope(marked, X.UNCERTAINTY_WORDS).drop("words")


LONGER = """NOT EXISTS (SELECT 1 FROM mentions o WHERE o.doc_id = m.doc_id AND o.part = m.part
    AND o.sem_group = m.sem_group AND o."begin" < m."end" AND o."end" > m."begin"
    AND o."end" - o."begin" > m."end" - m."begin")"""


@query(pick(MENTION + " sem_group", "mentions m", f"WHERE {LONGER}"))
def precision_consumer(spark, sf):
    columns = [c.split(":")[0] for c in MENTION.split()]
    return spans.precision_consumer(X.mentions(spark, sf)).select(*columns, "sem_group")


@query(
    pick(
        MENTION + " sem_group",
        "mentions m",
        f"""WHERE {LONGER}
        AND NOT (sem_group = 'finding' AND EXISTS (SELECT 1 FROM mentions d WHERE d.doc_id = m.doc_id
            AND d.part = m.part AND d.sem_group = 'disorder' AND d."begin" <= m."begin" AND d."end" >= m."end"))
        AND NOT (sem_group IN ('finding', 'disorder') AND EXISTS (SELECT 1 FROM mentions a
            WHERE a.doc_id = m.doc_id AND a.part = m.part AND a.sem_group = 'anatomy'
            AND a."begin" = m."begin" AND a."end" = m."end"))""",
    )
)
def semantic_cleanup(spark, sf):
    columns = [c.split(":")[0] for c in MENTION.split()]
    return spans.semantic_cleanup(X.mentions(spark, sf)).select(*columns, "sem_group")


# -------------------------------------------------------------------- consume
CODE_SETS = """(SELECT doc_id, part, "begin", "end", sem_group, list_sort(list(DISTINCT concept)) AS codes
    FROM mentions GROUP BY ALL)"""


@query(
    f"""SELECT doc_id, part, CAST("begin" AS INTEGER) AS "begin", CAST("end" AS INTEGER) AS "end", sem_group,
        array_to_string(codes, ' ') AS codes FROM {CODE_SETS}"""
)
def codes_per_mention(spark, sf):
    return consume.codes_per_mention(X.mentions(spark, sf)).withColumn("codes", F.array_join("codes", " "))


@query(
    f"""SELECT doc_id, part, CAST("begin" AS INTEGER) AS "begin", CAST("end" AS INTEGER) AS "end", sem_group,
        unnest(codes) AS code FROM {CODE_SETS}"""
)
def explode_codes(spark, sf):
    return consume.explode_codes(consume.codes_per_mention(X.mentions(spark, sf)))


def code_string(source: str, rank: str = "0", prefix: str = "''") -> str:
    return f"""SELECT doc_id, part, string_agg({prefix} || concept, ' '
        ORDER BY {rank}, "begin", "end" DESC, concept, sem_group) AS cuis
        FROM (SELECT DISTINCT doc_id, part, "begin", "end", concept, sem_group, polarity, mention_class
              FROM {source}) GROUP BY doc_id, part"""


EVENT_STRING = code_string(
    "mentions WHERE mention_class = 'event'", prefix="CASE WHEN polarity = -1 THEN 'N' ELSE '' END"
)


@query(EVENT_STRING)
def cui_string_events(spark, sf):
    return consume.cui_string_events(X.mentions(spark, sf))


@query(code_string("mentions", "CASE WHEN mention_class = 'event' THEN 0 ELSE 1 END"))
def cui_string_all(spark, sf):
    return consume.cui_string_all(X.mentions(spark, sf))


@query(code_string("mentions", prefix="CASE WHEN polarity <> 0 THEN 'n' ELSE '' END"))
def cui_sequence(spark, sf):
    return consume.cui_sequence(X.mentions(spark, sf))


@query(code_string("mentions"))
def cui_corpus(spark, sf):
    return consume.cui_corpus(X.mentions(spark, sf))


@query(f"""SELECT doc_id, part, coalesce(string_agg({SHOWN}, ' ' ORDER BY "begin"), '') AS line
           FROM part_tokens GROUP BY doc_id, part""")
def token_corpus(spark, sf):
    return consume.token_corpus(structure.tokenize_parts(X.note_parts(spark, sf)))


@query(f"""SELECT doc_id, part, CAST(sent_id AS INTEGER) AS sent_id,
           string_agg({SHOWN}, ' ' ORDER BY "begin") AS line FROM tokens GROUP BY doc_id, part, sent_id""")
def lm_corpus(spark, sf):
    return consume.lm_corpus(X.tokens(spark, sf))


@query(
    """SELECT doc_id, part, CAST("begin" AS INTEGER) AS "begin", CAST("end" AS INTEGER) AS "end",
       array_to_string(list_sort(list(DISTINCT cui)), ' ') AS cuis FROM hits GROUP BY ALL"""
)
def span_to_cuis(spark, sf):
    found = dictionary.span_to_cuis(X.hits(spark, sf))
    return found.withColumn("cuis", F.array_join(F.col("cuis").cast("array<string>"), " "))


@query("SELECT doc_id, lang || ' ' || source AS output FROM documents")
def doc_output_map(spark, sf):
    docs = X.table(spark, sf, "documents")
    return consume.doc_output(docs, "doc_id", F.concat_ws(" ", "lang", "source"))


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (f IS NULL) AS n_parsed, count(f) AS n_failed
        FROM (SELECT {FAILURE} AS f FROM documents)"""
)
def processed_counts(spark, sf):
    from notequarry.functions.keys import parse_keys

    docs = X.table(spark, sf, "documents").withColumn("key", raw_key(F.lit("7")))
    parsed = parse_keys(docs, "key", "text").select(F.col("failure").isNull().alias("parsed"))
    return consume.processed_counts(parsed)


@query(
    """SELECT doc_id, part, cui, CAST("begin" AS INTEGER) AS "begin", CAST("end" AS INTEGER) AS "end",
       coalesce("begin" < lag("begin") OVER (PARTITION BY doc_id, part ORDER BY cui, "begin", "end"), false)
       AS out_of_order FROM hits"""
)
def out_of_order_check(spark, sf):
    found = X.hits(spark, sf).select("doc_id", "part", "cui", "begin", "end")
    return spans.out_of_order_check(found, order=["cui", "begin", "end"])


@query(
    """SELECT doc_id, part, cui, CAST("begin" AS INTEGER) AS "begin", CAST("end" AS INTEGER) AS "end",
       CAST(row_number() OVER (PARTITION BY doc_id, part ORDER BY "begin", "end" DESC, cui) AS INTEGER) AS position
       FROM hits"""
)
def annotation_order(spark, sf):
    from pyspark.sql import Window as W

    order = W.partitionBy("doc_id", "part").orderBy(F.col("begin"), F.col("end").desc(), F.col("cui"))
    found = X.hits(spark, sf).select("doc_id", "part", "cui", "begin", "end")
    return found.withColumn("position", F.row_number().over(order))


# ----------------------------------------------------------------------- jobs
def settings(spark, sf, **changes) -> jobs.Settings:
    values = dict(
        dictionary=X.prepared(spark, sf, "dictionary"),
        concepts=X.prepared(spark, sf, "concepts"),
        lexicon=X.prepared(spark, sf, "lexicon"),
        negation_cues=X.NEGATION_WORDS,
        uncertainty_cues=X.UNCERTAINTY_WORDS,
    )
    values.update(changes)
    return jobs.Settings(**values)


def raw_parts(spark, sf):
    """Keyed parts of the notes, some with keys that cannot be parsed."""
    parts = X.note_parts(spark, sf).join(
        X.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id"
    )
    return parts.select(raw_key(F.col("part").cast("string")).alias("key"), F.col("text").alias("value"))


RESULT = {
    "event_strings": EVENT_STRING,
    "span_lists": """SELECT doc_id, part, string_agg(concat_ws(',', mention_class, "begin", "end", sem_group, concept,
            polarity, uncertainty), ';' ORDER BY "begin", "end" DESC, concept, sem_group) AS listed
        FROM (SELECT DISTINCT doc_id, part, mention_class, "begin", "end", coalesce(sem_group, '') AS sem_group,
              coalesce(concept, '') AS concept, polarity, uncertainty FROM mentions) GROUP BY doc_id, part""",
    "keyed": f"SELECT p.doc_id, p.part, p.text, lang, {FAILURE} AS f FROM parts p JOIN documents d USING (doc_id)".replace(
        "CASE WHEN doc_id", "CASE WHEN p.doc_id"
    ),
    "results": f"""SELECT {ENVELOPE_KEY} ELSE CAST(part AS VARCHAR) END AS part,
        f IS NULL AS parsed, CASE WHEN f IS NULL THEN text END AS text,
        coalesce(f, listed, '') AS annotations,
        CASE WHEN f IS NULL THEN coalesce(cuis, '') END AS cuis
        FROM keyed LEFT JOIN event_strings USING (doc_id, part) LEFT JOIN span_lists USING (doc_id, part)""",
}


def listed_spans(results):
    """Results with the annotation document, read back, as one line of its spans."""
    spans = F.from_xml(F.col("annotations"), DOCUMENT_SCHEMA)["span"]
    fields = ("kind", "begin", "end", "label", "concept", "polarity", "uncertainty")
    line = F.transform(
        spans, lambda s: F.concat_ws(",", *(F.coalesce(s[f].cast("string"), F.lit("")) for f in fields))
    )
    listed = F.coalesce(F.array_join(line, ";"), F.lit(""))
    return results.withColumn("annotations", F.when(F.col("parsed"), listed).otherwise(F.col("annotations")))


@query("SELECT fname, part, parsed, text, annotations, cuis FROM results", RESULT)
def extract(spark, sf):
    return listed_spans(jobs.extract(raw_parts(spark, sf), settings(spark, sf)))


@query("SELECT 'hdfs://nn/notes/' || lang || '/' || doc_id || '.txt-' || part AS key, p.text AS value "
       "FROM parts p JOIN documents d USING (doc_id)")
def pack_notes(spark, sf):
    return jobs.pack_notes(X.notes(spark, sf), X.PART_CAP)


@query(pick(FULL + " polarity:i", "mentions"))
def lookup_only(spark, sf):
    return jobs.lookup_only(X.note_parts(spark, sf), settings(spark, sf)).drop("uncertainty")


@query(
    """SELECT doc_id, part, 'segment' AS kind, 0 AS "begin", CAST(length(text) AS INTEGER) AS "end",
        'SIMPLE_SEGMENT' AS label FROM parts
       UNION ALL SELECT doc_id, part, 'sentence', CAST("begin" AS INTEGER), CAST("end" AS INTEGER),
        CAST(sent_id AS VARCHAR) FROM sentences
       UNION ALL SELECT doc_id, part, 'token', CAST("begin" AS INTEGER), CAST("end" AS INTEGER), pos FROM tagged
       UNION ALL SELECT doc_id, part, 'chunk', CAST("begin" AS INTEGER), CAST("end" AS INTEGER), chunk_type FROM chunks"""
)
def preprocess_only(spark, sf):
    return jobs.preprocess_only(X.note_parts(spark, sf), X.prepared(spark, sf, "lexicon"), X.CLOSED_WORDS)


@query(
    """SELECT doc_id, part, ' * ' || string_agg(replace(text, chr(10), ' '), chr(10) || ' * ' ORDER BY sent_id) AS shown
       FROM sentences GROUP BY doc_id, part"""
)
def sentence_list(spark, sf):
    """Stored sentences as a display list per part."""
    from notequarry.functions.text import line_break_to_space

    entry = F.struct("sent_id", line_break_to_space(F.col("text")).alias("line"))
    listed_lines = X.sentences(spark, sf).groupBy("doc_id", "part").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    return listed_lines.select("doc_id", "part", F.array_join("l.line", "\n").alias("shown"))
