"""Queries for lexical resources, word variants and suffix rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from notequarry.catalog import fixtures as X
from notequarry.catalog.registry import query
from notequarry.catalog.sql import listed, literal
from notequarry.catalog.text_queries import CASED, cased_words
from notequarry.operators import variants
from notequarry.plans.lookup_table import LookupTable
from notequarry.resources import (
    CATEGORY_NAMES,
    EXCLUSION_WORDS,
    RULE_MAX_RESULTS,
    RULE_MIN_TERM_LENGTH,
    TREEBANK_TAGS,
)
from notequarry.sources import dictionary as dictionary_sources
from notequarry.sources import lexicon

WORD_COUNTS = f"SELECT word, count(*) AS n FROM {CASED} GROUP BY word"


def word_counts(spark, sf):
    return cased_words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def norm_lines(spark, sf):
    """Cache lines of the words of the notes: frequency, word, normal form; two per word."""
    counted = word_counts(spark, sf).select("n", "word", F.explode(F.array(F.lit(1), F.lit(2))).alias("line_no"))
    norm = F.when(F.col("line_no") == 1, F.lower("word")).otherwise(F.concat("word", F.lit("x")))
    line = F.concat(F.concat_ws("|", "n", "word", norm, F.lit("1|1|l+b|1")), F.lit("|"))
    return counted.select(F.lit("norm").alias("file"), "line_no", line.alias("line"))


@query("SELECT word AS cached_word, lower(word) AS norm FROM counted WHERE n > 20", {"counted": WORD_COUNTS})
def norm_cache_source(spark, sf):
    return lexicon.norm_cache(norm_lines(spark, sf))


@query("SELECT word AS cached_word, lower(word) AS norm FROM counted WHERE n > 5", {"counted": WORD_COUNTS})
def frequency_cutoff(spark, sf):
    return lexicon.norm_cache(norm_lines(spark, sf), cutoff=5)


_NAMES = listed(CATEGORY_NAMES)


@query(
    f"""SELECT word AS lemma_word, lower(word) AS lemma,
        CAST((1 << CAST(length(word) % 11 AS INTEGER)) | 128 AS BIGINT) AS lemma_bits FROM counted WHERE n > 20""",
    {"counted": WORD_COUNTS},
)
def lemma_cache_source(spark, sf):
    names = F.array(*[F.lit(n) for n in CATEGORY_NAMES])
    name = F.element_at(names, F.length("word") % 11 + 1)
    line = F.concat(F.concat_ws("|", "n", "word", F.lower("word"), F.concat(F.lit("<"), name, F.lit("+noun>"))))
    lines = word_counts(spark, sf).select(F.lit("lemma").alias("file"), F.lit(1).alias("line_no"), line.alias("line"))
    return lexicon.lemma_cache(lines)


@query(
    """SELECT DISTINCT word || '''s' AS if_term_lc, word || '''s' AS if_term, 128 AS term_cat, 8 AS term_infl,
       'E' || length(word) AS eui, word AS un_term, word AS un_term_lc, word AS ct_term FROM bench_words"""
)
def insert_script_source(spark, sf):
    words = X.benchmark_words(spark, sf).select(F.explode("words").alias("w")).distinct()
    line = F.format_string(
        "INSERT INTO INFLECTION VALUES('%1$s''s','%1$s''s',128,8,'E%2$d','%1$s','%1$s','%1$s')", "w", F.length("w")
    )
    other = F.format_string("INSERT INTO PROPERNOUN VALUES('%s')", "w")
    lines = words.select(F.explode(F.array(line, other)).alias("line"))
    return lexicon.insert_script(lines, "INFLECTION")


RULE_COLUMNS = "rule_id, file, in_pattern, in_cat, in_infl, out_pattern, out_cat, out_infl"


@query(
    """SELECT 'item' || item_id || ':' || lpad(CAST(pos + 1 AS VARCHAR), 5, '0') AS rule_id,
       'item' || item_id AS file, right(word, 2) || '$' AS in_pattern, 'noun' AS in_cat, 'singular' AS in_infl,
       right(word, 2) || 's$' AS out_pattern, 'noun' AS out_cat, 'plural' AS out_infl,
       word || '|' || word || 's' AS exceptions FROM bench_words"""
)
def rule_source(spark, sf):
    words = X.benchmark_words(spark, sf).select(
        F.concat(F.lit("item"), F.col("item_id")).alias("file"), F.posexplode("words").alias("pos", "w")
    )
    rule = F.format_string("RULE: %1$s$|noun|singular|%1$ss$|noun|plural", F.right("w", F.lit(2)))
    exception = F.format_string("EXCEPTION: %1$s|%1$ss;", "w")
    lines = words.select("file", (F.col("pos") * 2).alias("at"), F.posexplode(F.array(rule, exception)).alias("i", "line"))
    rules = lexicon.rule_lines(lines.select("file", (F.col("at") + F.col("i")).alias("line_no"), "line"))
    return rules.withColumn("exceptions", F.array_join("exceptions", " "))


@query("SELECT replace(text, chr(10), ' ') AS phrase, 'AFTER' AS relation FROM benchmark")
def time_lexicon_source(spark, sf):
    line = F.concat(F.translate("text", "\n", " "), F.lit(",AFTER"))
    return lexicon.time_lexicon(X.table(spark, sf, "benchmark").select(line.alias("line")))


@query("SELECT DISTINCT word AS time_word, 'Class' || length(word) AS time_class FROM bench_words")
def time_word_source(spark, sf):
    words = X.benchmark_words(spark, sf).select(F.explode("words").alias("w")).distinct()
    return lexicon.time_word_list(words.select(F.format_string("Class%d %s", F.length("w"), "w").alias("line")))


@query(
    """SELECT trim(line) AS word FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
       WHERE length(line) % 2 = 1 AND trim(line) <> ''"""
)
def word_list_source(spark, sf):
    lines = X.table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    marked = F.when(F.length("line") % 2 == 0, F.concat(F.lit("#"), "line")).otherwise(F.col("line"))
    return lexicon.word_list(lines.select(marked.alias("line")))


@query(
    """SELECT concept_id AS cui, CAST(tui AS INTEGER) AS tui, pref_term, CASE WHEN concept_cui IS NULL THEN scheme END AS scheme,
       CASE WHEN concept_cui IS NULL THEN code END AS code FROM concepts"""
)
def concept_table_source(spark, sf):
    frame = X.prepared(spark, sf, "concepts").frame.withColumnRenamed("concept_id", "cui")
    rx = frame.filter(F.col("scheme") == "RXNORM").select("cui", "code")
    return dictionary_sources.concept_tables(frame, frame, {"RXNORM": (rx, "long")})


@query(
    r"""SELECT word, min(doc_id) AS doc_id FROM
        (SELECT doc_id, unnest(regexp_extract_all(text, '\p{L}+')) AS word FROM documents) GROUP BY word"""
)
def first_occurrence(spark, sf):
    docs = X.table(spark, sf, "documents")
    found = F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))
    rows = docs.select("doc_id", F.explode(found).alias("word"))
    return lexicon.first_occurrence(rows, "word", "doc_id")


# ------------------------------------------------------------------- variants
LOWER_WORDS = r"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents"


def lower_words(spark, sf):
    docs = X.table(spark, sf, "documents")
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    return docs.select(F.explode(found).alias("word")).distinct()


def inflection(spark, sf):
    """Each benchmark word and its form with an s, under one entry."""
    words = X.benchmark_words(spark, sf).select(F.explode("words").alias("w")).distinct()
    forms = F.array(
        F.struct(F.col("w").alias("if_term_lc"), F.lit(1).alias("term_infl")),
        F.struct(F.concat("w", F.lit("s")).alias("if_term_lc"), F.lit(8).alias("term_infl")),
    )
    bits = F.call_function("shiftleft", F.lit(1), F.length("w") % 11)
    rows = words.select("w", bits.alias("term_cat"), F.inline(forms))
    return rows.select(
        "if_term_lc",
        F.col("if_term_lc").alias("if_term"),
        "term_cat",
        "term_infl",
        F.concat(F.lit("E"), "w").alias("eui"),
        F.col("w").alias("un_term"),
        F.col("w").alias("un_term_lc"),
    )


INFLECTION = {
    "lower_words": LOWER_WORDS,
    "counted": WORD_COUNTS,
    "bench_forms": "SELECT DISTINCT word AS w FROM bench_words",
    "inflection": """SELECT w AS form, w, 1 << CAST(length(w) % 11 AS INTEGER) AS lex_bits FROM bench_forms
        UNION ALL SELECT w || 's', w, 1 << CAST(length(w) % 11 AS INTEGER) FROM bench_forms""",
    "bases": "SELECT form, min(w) AS base FROM inflection GROUP BY form",
}


def _parsed_rules(text: str):
    rules, current = [], None
    for line in text.splitlines():
        kind, _, body = line.partition(": ")
        if kind == "RULE":
            fields = body.split("|")
            current = [len(rules) + 1, fields[0].rstrip("$"), fields[1], fields[3].rstrip("$"), fields[4], fields[5], []]
            rules.append(current)
        else:
            current[-1].append(body.rstrip(";"))
    return rules


#: Rules over the syllables of the invented prose; they mean nothing in any language.
INFLECTION_RULES = """
RULE: Ch$|noun|singular|Cion$|noun|plural
RULE: VC$|noun|singular|VCnd$|noun|plural
RULE: CVC$|verb|infinitive|CVSCan$|verb|past
RULE: $|noun|singular|ou$|noun|plural
EXCEPTION: th|thou;
EXCEPTION: |ou;
RULE: th$|noun|singular|tion$|noun|plural
RULE: ou$|verb|infinitive|re$|verb|past
EXCEPTION: ou|re;
RULE: CVC$|adj|positive|CVSCes$|adj|comparative
RULE: $|verb|infinitive|ti$|verb|presPart
RULE: e$|adj|positive|ere$|adj|superlative
RULE: eLC$|noun|singular|eLCaL$|noun|plural
RULE: VntV$|verb|infinitive|VVntV$|verb|past
RULE: LhL$|adj|positive|LLeL$|adj|comparative
RULE: ^CVC$|noun|singular|CVCVC$|noun|plural
RULE: BVtG$|verb|infinitive|GVtB$|verb|past
""".strip()
DERIVATION_RULES = """
RULE: tion$|noun|base|ha$|adj|base
RULE: er$|noun|base|$|verb|base
EXCEPTION: er|;
RULE: Cha$|noun|base|Cre$|adv|base
RULE: nd$|verb|base|er$|adj|base
RULE: LCe$|noun|base|CeLL$|adj|base
RULE: V$|noun|base|C$|verb|base
""".strip()

_CLASS = {"C": "[bcdfghjklmnpqrstvwxyz]", "V": "[aeiou]", "L": "[a-z]", "D": "[0-9]"}


def _class_of(symbol: str) -> str:
    return "V" if symbol in "AEIOUV" else "L" if symbol in "LS" else symbol if symbol == "D" else "C"


def rule_sql(text: str, file: str, reverse: bool) -> str:
    """One SELECT per rule over ``lower_words``: each letter of the suffix is tested by itself."""
    selects = []
    for number, in_pattern, in_cat, out_pattern, out_cat, out_infl, exceptions in _parsed_rules(text):
        match, make = (out_pattern, in_pattern) if reverse else (in_pattern, out_pattern)
        anchored, match, make = match.startswith("^"), match.lstrip("^"), make.lstrip("^")
        n = len(match)
        at = lambda j, n=n: f"word[length(word) - {n - 1 - j}]"
        tests = [f"length(word) {'=' if anchored else '>='} {n}"]
        seen: dict[str, list[int]] = {}
        for j, symbol in enumerate(match):
            if not symbol.isupper():
                tests.append(f"{at(j)} = {literal(symbol)}")
                continue
            tests.append(f"regexp_full_match({at(j)}, '{_CLASS[_class_of(symbol)]}')")
            if symbol == "S":
                tests.append(f"{at(j)} = {at(j + 1)}")
                continue
            held = seen.setdefault(symbol, [])
            if held and len(held) >= make.count(symbol) > 0:
                tests.append(f"{at(j)} = {at(held[make.count(symbol) - 1])}")
            held.append(j)
        made, met, readable = [f"left(word, length(word) - {n})"], {}, True
        for i, symbol in enumerate(make):
            if not symbol.isupper():
                made.append(literal(symbol))
                continue
            name = make[i + 1] if symbol == "S" else symbol
            nth = met.get(name, 0) + 1
            if symbol != "S":
                met[name] = nth
            readable &= name in seen
            if readable:
                made.append(at(seen[name][min(nth, len(seen[name])) - 1]))
        if not readable:
            continue
        formed = " || ".join(made)
        tests.append(f"length({formed}) > 0")
        pair = f"({formed}) || '|' || word" if reverse else f"word || '|' || ({formed})"
        if exceptions:
            tests.append(f"({pair}) NOT IN ({listed(exceptions)})")
        selects.append(
            f"SELECT word, {formed} AS made, '{file}:{number:05d}' AS rule_id, {n} AS suffix_length, "
            f"'{in_cat if reverse else out_cat}' AS category, '{out_infl}' AS inflection FROM lower_words WHERE {' AND '.join(tests)}"
        )
    return " UNION ALL ".join(selects)


BACK = {**INFLECTION, "candidates": rule_sql(INFLECTION_RULES, "inflection", True)}
BACK["by_rule"] = """SELECT word, arg_min(made, k) AS base, arg_min(rule_id, k) AS rule_id FROM (
    SELECT *, lpad(CAST(100 - suffix_length AS VARCHAR), 3, '0') || rule_id AS k FROM candidates) GROUP BY word"""


def rules(spark, text, file):
    return lexicon.rule_lines(lexicon.text_lines(spark, file, text))


@query("SELECT word, base, rule_id FROM by_rule", BACK)
def uninflect_by_rule(spark, sf):
    return variants.uninflect_by_rule(lower_words(spark, sf), rules(spark, INFLECTION_RULES, "inflection"))


@query(
    """SELECT word, made AS base, rule_id, category, CAST(suffix_length AS INTEGER) AS suffix_length,
       CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
       (PARTITION BY word ORDER BY suffix_length DESC, rule_id) AS rn FROM candidates WHERE length(word) >= 3)
       WHERE rn <= 10""",
    BACK,
)
def rule_limits(spark, sf):
    found = variants.uninflect_candidates(lower_words(spark, sf), rules(spark, INFLECTION_RULES, "inflection"))
    return variants.rule_limits(found, RULE_MIN_TERM_LENGTH, RULE_MAX_RESULTS)


@query(
    "SELECT word, made AS form, rule_id, category, inflection FROM candidates",
    {**INFLECTION, "candidates": rule_sql(INFLECTION_RULES, "inflection", False)},
)
def inflect_by_rule(spark, sf):
    return variants.inflect_by_rule(lower_words(spark, sf), rules(spark, INFLECTION_RULES, "inflection"))


@query(
    "SELECT word, made AS form, rule_id, category, inflection FROM candidates",
    {**INFLECTION, "candidates": rule_sql(DERIVATION_RULES, "derivation", False)},
)
def derive_by_rule(spark, sf):
    return variants.derive_by_rule(lower_words(spark, sf), rules(spark, DERIVATION_RULES, "derivation"))


CANONICAL = {
    **BACK,
    "lower_words": "SELECT DISTINCT lower(word) AS word FROM counted",
}


@query(
    f"""SELECT c.word, coalesce(CASE WHEN c.n > 20 THEN lower(c.word) END, b.base, r.base) AS canonical
        FROM counted c LEFT JOIN bases b ON b.form = lower(c.word) LEFT JOIN by_rule r ON r.word = lower(c.word)
        WHERE c.word NOT IN ({listed(EXCLUSION_WORDS)})""",
    CANONICAL,
)
def canonical_form(spark, sf):
    words = variants.distinct_words(cased_words(spark, sf), F.col("word"))
    bases = LookupTable.prepare(variants.base_forms(inflection(spark, sf)), "bases")
    cache = LookupTable.prepare(lexicon.norm_cache(norm_lines(spark, sf)), "norm-cache")
    return variants.canonical_form(words, bases, rules(spark, INFLECTION_RULES, "inflection"), cache)


LEMMAS = {
    **INFLECTION,
    "lemma_rows": "SELECT word, w AS lemma, unnest(["
    + ", ".join(
        f"CASE WHEN lex_bits & {1 << i} > 0 THEN {literal(TREEBANK_TAGS[n])} END" for i, n in enumerate(CATEGORY_NAMES)
    )
    + "]) AS tag FROM lower_words JOIN inflection ON form = word",
}


def lemmas(spark, sf):
    rows = inflection(spark, sf).select(
        F.col("if_term_lc").alias("lemma_word"), F.col("un_term_lc").alias("lemma"), F.col("term_cat").alias("lemma_bits")
    )
    return LookupTable.prepare(rows.distinct(), "lemmas")


@query("SELECT DISTINCT word, lemma, tag FROM lemma_rows WHERE tag IS NOT NULL", LEMMAS)
def lemma_lookup(spark, sf):
    return variants.lemma_lookup(lower_words(spark, sf), lemmas(spark, sf))


@query(
    """SELECT word, lemma, array_to_string(list_sort(list(DISTINCT tag)), ' ') AS tags FROM lemma_rows
       WHERE tag IS NOT NULL GROUP BY word, lemma""",
    LEMMAS,
)
def lemma_pos_sets(spark, sf):
    sets = variants.lemma_pos_sets(variants.lemma_lookup(lower_words(spark, sf), lemmas(spark, sf)))
    return sets.withColumn("tags", F.array_join("tags", " "))


@query(
    f"""SELECT DISTINCT l.word, v.form AS variant, ([{_NAMES}])[1 + length(v.w) % 11] AS categories
        FROM lower_words l JOIN inflection i ON i.form = l.word JOIN inflection v ON v.w = i.w""",
    INFLECTION,
)
def inflection_variants(spark, sf):
    table = LookupTable.prepare(inflection(spark, sf), "inflection")
    return variants.inflection_variants(lower_words(spark, sf), table)


@query(
    """SELECT DISTINCT l.word, 'acronym' AS relation, w AS related FROM lower_words l JOIN bench_forms ON left(w, 3) = l.word
       UNION ALL SELECT l.word, 'derivation', w || 'ly' FROM lower_words l JOIN bench_forms ON w = l.word
       UNION ALL SELECT l.word, 'nominalization', w || 'ness' FROM lower_words l JOIN bench_forms ON w = l.word
       UNION ALL SELECT l.word, 'canonical', w FROM lower_words l JOIN bench_forms ON w || 's' = l.word
       UNION ALL SELECT l.word, 'antinorm', w || 's' FROM lower_words l JOIN bench_forms ON w = l.word
       UNION ALL SELECT DISTINCT l.word, 'fruitful', w FROM lower_words l JOIN bench_forms ON left(w, 4) = l.word""",
    INFLECTION,
)
def lexicon_relations(spark, sf):
    w = F.col("w")
    forms = X.benchmark_words(spark, sf).select(F.explode("words").alias("w")).distinct()
    pairs = {
        "acronym": (F.left("w", F.lit(3)), w),
        "derivation": (w, F.concat("w", F.lit("ly"))),
        "nominalization": (w, F.concat("w", F.lit("ness"))),
        "canonical": (F.concat("w", F.lit("s")), w),
        "antinorm": (w, F.concat("w", F.lit("s"))),
        "fruitful": (F.left("w", F.lit(4)), w),
    }
    words = lower_words(spark, sf)
    found = None
    for relation, (key, value) in pairs.items():
        key_name, value_name = variants.RELATIONS[relation]
        table = LookupTable.prepare(forms.select(key.alias(key_name), value.alias(value_name)), relation)
        one = variants.lexicon_relations(words, table, relation)
        found = one if found is None else found.unionByName(one)
    return found
