"""Queries for scalar functions, filters, generators and structure tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from notequarry.catalog import fixtures as X
from notequarry.catalog.registry import pick, query
from notequarry.catalog.sql import literal
from notequarry.functions import codes, keys, text
from notequarry.operators import consume, dictionary, spans, structure, variants
from notequarry.operators.parts import parts_of_lines, split_to_parts
from notequarry.resources import CATEGORY_NAMES, EXCLUSION_WORDS, LOOKUP_EXCLUDED_TAGS, TREEBANK_TAGS
from notequarry.sources.files import note_blacklist

SENT = "doc_id part sent_id:i begin:i end:i text"
TOK = "doc_id part sent_id:i tok_idx:i begin:i end:i text token_type"
CHUNKS = "doc_id part sent_id:i chunk_idx:i tok_start:i tok_end:i begin:i end:i chunk_type"


# ----------------------------------------------------------- scalar functions
@query(
    "SELECT doc_id, regexp_replace(text || chr(1) || chr(12) || chr(128522) || chr(65534), "
    r"'[^\t\r\n\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]', '', 'g') AS text FROM documents"
)
def legal_char_scrub(spark, sf):
    marks = F.lit("\x01\x0c\U0001f60a￾")
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", text.legal_char_scrub(F.concat("text", marks)).alias("text"))


@query("SELECT doc_id, replace(text, '.', ' ') AS text FROM documents")
def form_feed_to_space(spark, sf):
    docs = X.table(spark, sf, "documents")
    fed = F.translate("text", ".", "\f")
    return docs.select("doc_id", text.form_feed_to_space(fed).alias("text"))


@query(
    r"SELECT page_id, CASE WHEN regexp_matches(url, '\.[^./]*\z') "
    r"THEN regexp_extract(url, '([^/]*)\.[^./]*\z', 1) END AS encounter_id FROM pages"
)
def encounter_id(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", keys.encounter_id(F.col("url")).alias("encounter_id"))


@query("SELECT doc_id, part, 'hdfs://nn/notes/' || doc_id || '.txt-' || part AS key FROM parts")
def part_key_compose(spark, sf):
    path = F.concat(F.lit("hdfs://nn/notes/"), F.col("doc_id"), F.lit(".txt"))
    parts = X.note_parts(spark, sf)
    return parts.select("doc_id", "part", keys.part_key_compose(path, F.col("part")).alias("key"))


@query(
    r"""SELECT page_id, CASE WHEN contains(k, '-') THEN regexp_extract(k, '(?s)^(.*)-[^-]*\z', 1) END AS path,
        CASE WHEN contains(k, '-') THEN TRY_CAST(regexp_extract(k, '-([0-9]+)\z', 1) AS INTEGER) END AS part
        FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url || '-' || page_id WHEN 1 THEN url ELSE url || '-x' END AS k
              FROM pages)"""
)
def part_key_parse(spark, sf):
    url = F.col("url")
    key = (
        F.when(F.col("page_id") % 3 == 0, F.concat_ws("-", url, F.col("page_id").cast("string")))
        .when(F.col("page_id") % 3 == 1, url)
        .otherwise(F.concat(url, F.lit("-x")))
    )
    pages = X.table(spark, sf, "pages").select("page_id", key.alias("key"))
    return pages.select(
        "page_id",
        keys.part_key_path(F.col("key")).alias("path"),
        keys.part_number(keys.part_key_number(F.col("key"))).alias("part"),
    )


RAW_KEYS = """CASE WHEN doc_id % 17 = 0 THEN 'hdfs://nn/notes/' || lang || '/' || doc_id || '.txt'
    WHEN doc_id % 19 = 0 THEN 'hdfs://nn/notes/' || lang || '/' || doc_id || '.txt-x'
    WHEN doc_id % 23 = 0 THEN 'hdfs://nn/notes/' || lang || '/' || doc_id || '-1'
    ELSE 'hdfs://nn/notes/' || lang || '/' || doc_id || '.txt-' || """
FAILURE = """CASE WHEN doc_id % 17 = 0 THEN 'KEY_WITHOUT_PART' WHEN doc_id % 19 = 0 THEN 'PART_NOT_A_NUMBER'
    WHEN doc_id % 23 = 0 THEN 'PATH_WITHOUT_EXTENSION' END"""


def raw_key(number):
    """Part keys, some of which cannot be parsed."""
    path = F.concat(F.lit("hdfs://nn/notes/"), F.col("lang"), F.lit("/"), F.col("doc_id"))
    return (
        F.when(F.col("doc_id") % 17 == 0, F.concat(path, F.lit(".txt")))
        .when(F.col("doc_id") % 19 == 0, F.concat(path, F.lit(".txt-x")))
        .when(F.col("doc_id") % 23 == 0, F.concat(path, F.lit("-1")))
        .otherwise(F.concat(path, F.lit(".txt-"), number))
    )


ENVELOPE_KEY = """CASE WHEN doc_id % 17 = 0 OR (doc_id % 19 <> 0 AND doc_id % 23 = 0) THEN NULL
    ELSE CAST(doc_id AS VARCHAR) END AS fname,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN 'x' WHEN doc_id % 23 = 0 THEN NULL"""


@query(
    f"""SELECT {ENVELOPE_KEY} ELSE '7' END AS part, f IS NULL AS parsed, CASE WHEN f IS NULL THEN text END AS text,
        coalesce(f, lang) AS annotations, CASE WHEN f IS NULL THEN source END AS cuis
        FROM (SELECT *, {FAILURE} AS f FROM documents)"""
)
def result_envelope(spark, sf):
    docs = X.table(spark, sf, "documents").withColumn("key", raw_key(F.lit("7")))
    parsed = keys.parse_keys(docs, "key", "text")
    columns = ("fname", "part", "failure", "text", "lang", "source")
    return parsed.select(*keys.result_envelope(*[F.col(c) for c in columns]))


@query("SELECT doc_id, part, ' * ' || replace(text, chr(10), ' ') AS line FROM sentences")
def line_break_to_space(spark, sf):
    return X.sentences(spark, sf).select("doc_id", "part", text.line_break_to_space(F.col("text")).alias("line"))


@query("SELECT doc_id, replace(lower(text), ' ', '_') AS text FROM documents")
def mention_text_norm(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", text.mention_text_norm(F.col("text")).alias("text"))


SHOWN = "CASE token_type WHEN 'Num' THEN 'number_token' WHEN 'Newline' THEN NULL ELSE lower(text) END"


@query(f'SELECT doc_id, part, CAST("begin" AS INTEGER) AS "begin", {SHOWN} AS shown FROM part_tokens')
def token_to_string(spark, sf):
    shown = text.token_to_string(F.col("token_type"), F.col("text"))
    return structure.tokenize_parts(X.note_parts(spark, sf)).select("doc_id", "part", "begin", shown.alias("shown"))


@query(
    """SELECT doc_id, cui, CASE WHEN polarity = -1 THEN 'N' ELSE '' END || concept AS big,
       CASE WHEN polarity <> 0 THEN 'n' ELSE '' END || concept AS small FROM mentions"""
)
def negation_prefix(spark, sf):
    concept, polarity = F.col("concept"), F.col("polarity")
    return X.mentions(spark, sf).select(
        "doc_id",
        "cui",
        codes.negation_prefix(concept, polarity, "N").alias("big"),
        codes.negation_prefix(concept, polarity, "n").alias("small"),
    )


@query("SELECT concept_id, coalesce(concept_cui, scheme || code) AS concept FROM concepts")
def concept_code(spark, sf):
    frame = X.prepared(spark, sf, "concepts").frame
    code = codes.concept_code(F.col("concept_cui"), F.col("scheme"), F.col("code"))
    return frame.select("concept_id", code.alias("concept"))


_TAGS = ", ".join(literal(TREEBANK_TAGS[n]) for n in CATEGORY_NAMES)


@query(
    f"""SELECT event_id, array_to_string(list_filter([{_TAGS}],
        lambda t, i: (event_id >> CAST(i - 1 AS INTEGER)) & 1 = 1), '+') AS tags FROM events"""
)
def category_bits_to_tags(spark, sf):
    tags = F.array_join(codes.category_tags(F.col("event_id")), "+")
    return X.table(spark, sf, "events").select("event_id", tags.alias("tags"))


@query("SELECT doc_id, lower(text) AS text FROM documents")
def lowercase_flow(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", text.lowercase_flow(F.col("text")).alias("text"))


FOLDS = {"é": "e", "è": "e", "ê": "e", "ç": "c", "à": "a", "ä": "a", "ö": "o", "ü": "u", "ñ": "n", "ß": "ss", "œ": "oe"}
_singles = {k: v for k, v in FOLDS.items() if len(v) == 1}


@query(
    f"SELECT doc_id, replace(replace(translate(text, '{''.join(_singles)}', '{''.join(_singles.values())}'), "
    "'ß', 'ss'), 'œ', 'oe') AS text FROM documents"
)
def unicode_fold(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", text.unicode_fold(F.col("text"), FOLDS).alias("text"))


@query(r"SELECT doc_id, regexp_replace(text, '([aeiou]n|t[eh])\.', '\1', 'g') AS text FROM documents")
def paren_s_removal(spark, sf):
    docs = X.table(spark, sf, "documents")
    marked = F.regexp_replace("text", r"([aeiou]n|t[eh])\.", "$1(s)")
    stems = [v + "n$" for v in "aeiou"] + ["te$", "th$"]
    return docs.select("doc_id", text.paren_s_removal(marked, stems).alias("text"))


# -------------------------------------------------------------------- filters
@query(pick("cui rindex:i tcount:i term rword", "dictionary", "WHERE length(term) >= 8"))
def min_term_length(spark, sf):
    return dictionary.min_term_length(X.prepared(spark, sf, "dictionary").frame, 8)


@query(
    """SELECT t.doc_id, t.part, CAST(t.sent_id AS INTEGER) AS sent_id, CAST(t.tok_idx AS INTEGER) AS tok_idx, d.cui
       FROM tokens t JOIN dictionary d ON lower(t.text) = d.rword
       JOIN sent_words s ON s.doc_id = t.doc_id AND s.part = t.part AND s.sent_id = t.sent_id
       WHERE t.tok_idx - d.rindex >= 0 AND t.tok_idx - d.rindex + d.tcount <= len(s.words)"""
)
def window_bounds(spark, sf):
    rows = X.words(spark, sf).select(
        "doc_id", "part", "sent_id", F.size("words").alias("n"), F.posexplode_outer("words").alias("tok_idx", "word")
    )
    pairs = dictionary.rare_word_join(rows, X.prepared(spark, sf, "dictionary"))
    inside = dictionary.within_window(F.col("tok_idx") - F.col("rindex"), F.col("tcount"), F.col("n"))
    return pairs.filter(inside).select("doc_id", "part", "sent_id", "tok_idx", "cui")


_EXCLUDED = ", ".join(literal(w) for w in EXCLUSION_WORDS)


def cased_words(spark, sf):
    docs = X.table(spark, sf, "documents")
    found = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    return docs.select(F.explode_outer(found).alias("word")).filter(F.col("word").isNotNull())


CASED = r"(SELECT unnest(regexp_extract_all(text, '\p{L}+')) AS word FROM documents)"


@query(f"SELECT DISTINCT word FROM {CASED} WHERE word NOT IN ({_EXCLUDED})")
def exclusion_words(spark, sf):
    return variants.exclusion_words(variants.distinct_words(cased_words(spark, sf), F.col("word")))


SEGMENTS = "(SELECT doc_id, part, CASE WHEN doc_id % 4 = 0 THEN 'SKIP' ELSE 'BODY' END AS seg_id, length(text) AS e FROM parts)"


def halves(spark, sf):
    """Segments of a part: its first half, named by the note."""
    seg_id = F.when(F.col("doc_id") % 4 == 0, F.lit("SKIP")).otherwise(F.lit("BODY"))
    whole = structure.segment(X.note_parts(spark, sf)).withColumn("seg_id", seg_id)
    return whole.withColumn("end", F.floor(F.col("end") / 2).cast("int"))


@query(f'SELECT doc_id, part, seg_id, 0 AS "begin", CAST(e // 2 AS INTEGER) AS "end" FROM {SEGMENTS} WHERE seg_id <> \'SKIP\'')
def segment_skip(spark, sf):
    return spans.segment_skip(halves(spark, sf), ["SKIP"])


@query(
    pick(TOK, "tokens", f'JOIN {SEGMENTS} s USING (doc_id, part) WHERE seg_id <> \'SKIP\' AND "end" <= s.e // 2')
)
def range_restrict(spark, sf):
    return spans.range_restrict(X.tokens(spark, sf), halves(spark, sf), ["SKIP"])


@query(pick(CHUNKS, "extended", "WHERE chunk_type = 'NP'"))
def np_only(spark, sf):
    return structure.np_only(structure.extend_noun_phrases(X.chunks(spark, sf)))


_LOOKUP_TAGS = ", ".join(literal(t) for t in LOOKUP_EXCLUDED_TAGS)


@query(pick(TOK + " pos", "tagged", f"WHERE pos NOT IN ({_LOOKUP_TAGS})"))
def lookup_pos_exclusion(spark, sf):
    return dictionary.lookup_pos_exclusion(X.tagged(spark, sf))


@query(f'SELECT doc_id, part, CAST("begin" AS INTEGER) AS "begin", {SHOWN} AS shown FROM part_tokens WHERE token_type <> \'Newline\'')
def drop_null_tokens(spark, sf):
    return consume.drop_null_tokens(token_to_string(spark, sf), "shown")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'src' || doc_id ELSE lang END AS word FROM documents")
def spelling_override(spark, sf):
    suggestion = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("src"), F.col("doc_id")))
        .when(F.col("doc_id") % 3 == 1, F.lit(""))
    )
    docs = X.table(spark, sf, "documents")
    return docs.select("doc_id", variants.spelling_override(F.col("lang"), suggestion).alias("word"))


@query("SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)", name="note_blacklist")
def _note_blacklist(spark, sf):
    listed = X.table(spark, sf, "labels").filter(F.col("toxic") == 1)
    return note_blacklist(X.table(spark, sf, "documents").select("doc_id", "text"), listed, "doc_id")


# ----------------------------------------------------------------- generators
@query("SELECT doc_id, part, text FROM parts", name="split_to_parts")
def _split_to_parts(spark, sf):
    return X.note_parts(spark, sf)


@query("SELECT doc_id, part, text FROM parts")
def split_lines_to_parts(spark, sf):
    """The same parts from a row per line, as files beyond the size of a row are read."""
    docs = X.table(spark, sf, "documents")
    rows = docs.select("doc_id", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line"))
    lines = rows.withColumn("block", F.floor(F.col("pos") / 8))
    return parts_of_lines(lines, X.PART_CAP, ["doc_id"])


@query("SELECT doc_id, part FROM parts", name="part_numbering")
def _part_numbering(spark, sf):
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    return split_to_parts(docs, X.PART_CAP).select("doc_id", "part")


@query('SELECT doc_id, part, \'SIMPLE_SEGMENT\' AS seg_id, 0 AS "begin", CAST(length(text) AS INTEGER) AS "end" FROM parts')
def segment(spark, sf):
    return structure.segment(X.note_parts(spark, sf))


@query(pick(SENT, "sentences"))
def sentence_split(spark, sf):
    return X.sentences(spark, sf)


@query(pick(TOK, "tokens"))
def tokenize(spark, sf):
    return X.tokens(spark, sf)


@query(
    r"""SELECT doc_id, part, CAST(sent_id AS INTEGER) AS sent_id, CAST("begin" AS INTEGER) AS "begin",
        CAST("end" AS INTEGER) AS "end", kind FROM (SELECT *, CASE
        WHEN regexp_full_match(text, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}') THEN 'date'
        WHEN regexp_full_match(text, '[0-9]{1,2}:[0-9]{2}') THEN 'time'
        WHEN regexp_full_match(text, '[0-9]+/[0-9]+') THEN 'fraction'
        WHEN regexp_full_match(text, '[0-9]+-[0-9]+') THEN 'range'
        WHEN regexp_full_match(text, '[0-9]+(?:[.,][0-9]+)+') THEN 'measurement' END AS kind FROM tokens)
        WHERE kind IS NOT NULL"""
)
def merge_context_tokens(spark, sf):
    kinds = X.tokens(spark, sf).withColumn("kind", structure.merged_token_kind(F.col("text")))
    return kinds.filter(F.col("kind").isNotNull()).select("doc_id", "part", "sent_id", "begin", "end", "kind")


@query(pick(TOK + " pos", "tagged"))
def pos_tag(spark, sf):
    return X.tagged(spark, sf)


@query(pick(CHUNKS, "chunks"))
def chunk(spark, sf):
    return X.chunks(spark, sf)


@query(pick(CHUNKS, "extended"))
def chunk_extend(spark, sf):
    return structure.extend_noun_phrases(X.chunks(spark, sf))


WINDOWS = "doc_id part sent_id:i tok_start:i tok_end:i begin:i end:i"


@query(pick(WINDOWS, "windows"))
def window_maximize(spark, sf):
    return structure.lookup_windows(X.chunks(spark, sf))


@query(
    'SELECT t.doc_id, t.part, CAST(t."begin" AS INTEGER) AS "begin", CAST(t."end" AS INTEGER) AS "end", t.text, '
    'CAST(s.sent_id AS INTEGER) AS outer_sent_id FROM part_tokens t JOIN sentences s '
    'ON s.doc_id = t.doc_id AND s.part = t.part AND t."begin" >= s."begin" AND t."end" <= s."end"'
)
def covered_by(spark, sf):
    parts = X.note_parts(spark, sf)
    tokens = structure.tokenize_parts(parts).select("doc_id", "part", "begin", "end", "text")
    return spans.covered_by(tokens, structure.sentence_split(parts), how="inner", outer_columns=["sent_id"])
