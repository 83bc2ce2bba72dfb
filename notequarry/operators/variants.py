"""Word variants: caches, lexicon tables and suffix rules.

Words are normalised once each: every function takes a table of distinct words,
and the answer is joined back to the tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notequarry.functions.codes import category_names, category_tags
from notequarry.plans.lookup_table import LookupTable
from notequarry.resources import EXCLUSION_WORDS

#: Relation name to (key column, value column) of its lexicon table.
RELATIONS = {
    "acronym": ("acr_lc", "expansion"),
    "derivation": ("term1_lc", "term2"),
    "nominalization": ("nom_term1", "nom_term2"),
    "canonical": ("un_term", "can_term"),
    "antinorm": ("norm_term", "infl_term"),
    "fruitful": ("term_lc", "variant_term"),
}

_LETTERS = "aeioubcdfghjklmnpqrstvwxyz0123456789"
_SHAPES = "V" * 5 + "C" * 21 + "D" * 10


def distinct_words(tokens: DataFrame, word: Column) -> DataFrame:
    return tokens.select(word.alias("word")).filter(F.col("word").isNotNull()).distinct()


def exclusion_words(words: DataFrame, excluded: Sequence[str] = EXCLUSION_WORDS) -> DataFrame:
    """Words that are normalised at all (exact case)."""
    return words.filter(~F.col("word").isin(list(excluded)))


def spelling_override(word: Column, suggestion: Column) -> Column:
    return F.coalesce(F.nullif(suggestion, F.lit("")), word)


def base_forms(inflection: DataFrame) -> DataFrame:
    """One base per lower-cased inflected form, the first by name."""
    return inflection.groupBy(F.col("if_term_lc").alias("form")).agg(F.min("un_term_lc").alias("base"))


def canonical_form(
    words: DataFrame, bases: LookupTable, rules: DataFrame, cache: LookupTable | None = None
) -> DataFrame:
    """Normal form of each word: cache, then lexicon, then rules, else null.

    ``bases``: form, base. ``cache``: cached_word, norm. Listed words have none.
    """
    wanted = exclusion_words(words).withColumn("lower", F.lower("word"))
    if cache is None:
        cached = wanted.withColumn("norm", F.lit(None).cast("string"))
    else:
        cached = cache.join(wanted, {"word": "cached_word"}, "left").drop("cached_word")
    known = bases.join(cached, {"lower": "form"}, "left").drop("form")
    rest = known.filter(F.col("norm").isNull() & F.col("base").isNull())
    by_rule = uninflect_by_rule(rest.select(F.col("lower").alias("word")).distinct(), rules)
    ruled = known.join(
        by_rule.select(F.col("word").alias("lower"), F.col("base").alias("rule_base")), "lower", "left"
    )
    return ruled.select("word", F.coalesce("norm", "base", "rule_base").alias("canonical"))


def lemma_lookup(words: DataFrame, lemmas: LookupTable) -> DataFrame:
    """(word, lemma, tag) rows; ``lemmas``: lemma_word, lemma, lemma_bits."""
    joined = lemmas.join(words, {"word": "lemma_word"}, "inner")
    return joined.select("word", "lemma", F.explode(category_tags(F.col("lemma_bits"))).alias("tag")).distinct()


def lemma_pos_sets(lemma_rows: DataFrame) -> DataFrame:
    """Per (word, lemma) its set of tags."""
    return lemma_rows.groupBy("word", "lemma").agg(F.array_sort(F.collect_set("tag")).alias("tags"))


def inflection_variants(words: DataFrame, inflection: LookupTable) -> DataFrame:
    """All inflected forms of the entries a word belongs to, with their categories."""
    entry = inflection.frame.select(F.col("if_term_lc").alias("form"), F.col("eui").alias("entry")).distinct()
    entries = inflection.derived(entry)  # two of its columns
    found = entries.join(words, {"word": "form"}, "inner").select("word", "entry")
    forms = inflection.join(found, {"entry": "eui"}, "inner")
    names = F.array_join(category_names(F.col("term_cat")), "+")
    return forms.select("word", F.col("if_term").alias("variant"), names.alias("categories")).distinct()


def lexicon_relations(words: DataFrame, lexicon: LookupTable, relation: str) -> DataFrame:
    """Related terms of each word by one relation of the lexicon."""
    key, value = RELATIONS[relation]
    joined = lexicon.join(words, {"word": key}, "inner")
    return joined.select("word", F.lit(relation).alias("relation"), F.col(value).alias("related")).distinct()


# ----------------------------------------------------------------------- rules


#: What an upper-case letter of a pattern stands for: any vowel or letter or digit, the letter
#: that follows it once more, or, for all others, any consonant.
VOWELS, ANY, DIGIT, DOUBLE = "AEIOUV", "L", "D", "S"


def _class(symbol: Column) -> Column:
    """The class an upper-case letter of a pattern stands for; other symbols as they are."""
    vowel = F.contains(F.lit(VOWELS), symbol)
    return (
        F.when(symbol.isin(ANY, DOUBLE), F.lit(ANY))
        .when(symbol == DIGIT, F.lit(DIGIT))
        .when(vowel, F.lit("V"))
        .when(symbol.rlike(r"\A[A-Z]\z"), F.lit("C"))
        .otherwise(symbol)
    )


def _symbols(pattern: str) -> Column:
    """The symbols of a pattern without its anchors."""
    return F.regexp_extract_all(F.regexp_replace(pattern, r"\A\^|\$\z", ""), F.lit("(?s)."), F.lit(0))


def _nth(symbols: Column, i: Column) -> Column:
    """How often the symbol at ``i`` has stood there up to that place."""
    return F.size(F.filter(F.slice(symbols, F.lit(1), i + 1), lambda c: c == F.get(symbols, i)))


def _captured(symbols: Column, letter: Column, n: Column) -> Column:
    """Place of the ``n``-th of a letter among the symbols, the last one if there are fewer."""
    places = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(symbols) - 1, F.lit(0))), lambda j: F.get(symbols, j) == letter
    )
    return F.get(places, F.least(n, F.size(places)) - 1)


def expand_rules(rules: DataFrame, match: str, make: str) -> DataFrame:
    """Rules read from the pattern ``match`` to the pattern ``make``, ready to be joined to words.

    ``mask`` and ``key``: the symbols of the matched suffix with literals as points, and with
    classes for letters. ``same``: pairs of places whose letters must be equal, as a letter
    that the other side has less often is one letter. ``made``: what the suffix becomes, each
    a literal or the place of a captured letter. A rule that makes a letter it has not
    captured cannot be read in this direction.
    """
    inside = rules.select(
        "rule_id", "in_cat", "in_infl", "out_cat", "out_infl", "exceptions",
        F.startswith(F.col(match), F.lit("^")).alias("anchored"),
        _symbols(match).alias("_p"),
        _symbols(make).alias("_q"),
    )
    upper = lambda c: c.rlike(r"\A[A-Z]\z")
    places = lambda name: F.when(F.size(name) > 0, F.sequence(F.lit(0), F.size(name) - 1)).otherwise(
        F.array().cast("array<int>")
    )

    def made(i: Column) -> Column:
        # a doubled letter is the one after it
        at = F.when(F.get(F.col("_q"), i) == DOUBLE, i + 1).otherwise(i)
        letter = F.get(F.col("_q"), at)
        place = F.when(upper(letter), _captured(F.col("_p"), letter, _nth(F.col("_q"), at)))
        return F.struct(F.when(~upper(letter), letter).alias("letter"), place.alias("at"))

    def same(j: Column) -> Column:
        letter = F.get(F.col("_p"), j)
        others = F.size(F.filter("_q", lambda c: c == letter))
        first = F.when(letter == DOUBLE, j + 1).when(
            upper(letter) & (others > 0) & (_nth(F.col("_p"), j) > others), _captured(F.col("_p"), letter, others)
        )
        return F.struct(j.alias("a"), first.alias("b"))

    return (
        inside.withColumn("size", F.size("_p"))
        .withColumn("mask", F.array_join(F.transform("_p", lambda c: F.when(upper(c), _class(c)).otherwise(F.lit("."))), ""))
        .withColumn("key", F.array_join(F.transform("_p", _class), ""))
        .withColumn("same", F.filter(F.transform(places("_p"), same), lambda x: x["b"].isNotNull()))
        .withColumn("made", F.transform(places("_q"), made))
        .filter(~F.exists("made", lambda x: x["letter"].isNull() & x["at"].isNull()))
        .drop("_p", "_q")
    )


def _masked(mask: str) -> Column:
    """The end of a word as long as the mask: letters at its points, classes elsewhere."""
    pieces = []
    for place, symbol in enumerate(mask):
        back = place - len(mask)
        letter, shape = f"substring(word, {back}, 1)", f"substring(_shape, {back}, 1)"
        any_letter = f"CASE WHEN {shape} IN ('C', 'V') THEN 'L' END"
        pieces.append(letter if symbol == "." else any_letter if symbol == ANY else f"CASE WHEN {shape} = '{symbol}' THEN '{symbol}' END")
    joined = f"concat({', '.join(pieces)})" if pieces else "''"
    return F.expr(f"CASE WHEN length(word) >= {len(mask)} THEN {joined} END")


def _applied(words: DataFrame, rules: DataFrame, match: str, make: str) -> DataFrame:
    """(word, made_word, rule) for every word and rule whose suffix it has.

    Each word meets the rules by its endings, one for every mask the rules have: their
    classes stand for letters, so that the join is one of equal keys.
    """
    table = LookupTable.prepare(expand_rules(rules, match, make), "rules")
    # as many masks as there are shapes of patterns, however many words there are
    masks = sorted(r["mask"] for r in table.frame.select("mask").distinct().collect())
    endings = F.array(*(F.struct(F.lit(m).alias("mask"), _masked(m).alias("key")) for m in masks)) if masks else F.array()
    shaped = words.select("word", F.translate(F.lower("word"), _LETTERS, _SHAPES).alias("_shape"))
    if not masks:
        endings = F.array().cast("array<struct<mask:string,key:string>>")
    probes = shaped.select("word", F.explode(endings).alias("_end")).filter(F.col("_end.key").isNotNull()).select(
        "word", F.col("_end.mask").alias("_mask"), F.col("_end.key").alias("_key")
    )
    joined = table.join(probes, {"_mask": "mask", "_key": "key"}, "inner")
    before = F.length("word") - F.col("size")
    letter = lambda at: F.substring(F.col("word"), before + at + 1, F.lit(1))
    fits = F.forall("same", lambda x: letter(x["a"]) == letter(x["b"])) & (~F.col("anchored") | (before == 0))
    ending = F.array_join(F.transform("made", lambda x: F.coalesce(x["letter"], letter(x["at"]))), "")
    return joined.filter(fits).withColumn("made_word", F.concat(F.left("word", before), ending))


def uninflect_candidates(words: DataFrame, rules: DataFrame) -> DataFrame:
    """Every base a rule gives for a word, read from output to input suffix."""
    found = _applied(words, rules, "out_pattern", "in_pattern").withColumnRenamed("made_word", "base")
    allowed = (F.length("base") > 0) & ~F.array_contains("exceptions", F.concat_ws("|", "base", "word"))
    return found.filter(allowed).select(
        "word", "base", "rule_id", F.col("size").alias("suffix_length"), F.col("in_cat").alias("category")
    )


def uninflect_by_rule(words: DataFrame, rules: DataFrame) -> DataFrame:
    """The base by the longest matching suffix, ties to the first rule."""
    best = F.min(F.struct((-F.col("suffix_length")).alias("rank"), "rule_id", "base"))
    chosen = uninflect_candidates(words, rules).groupBy("word").agg(best.alias("b"))
    return chosen.select("word", F.col("b.base").alias("base"), F.col("b.rule_id").alias("rule_id"))


def inflect_by_rule(words: DataFrame, rules: DataFrame) -> DataFrame:
    """All forms the rules give for a base."""
    formed = _applied(words, rules, "in_pattern", "out_pattern").withColumnRenamed("made_word", "form")
    allowed = (F.length("form") > 0) & ~F.array_contains("exceptions", F.concat_ws("|", "word", "form"))
    return formed.filter(allowed).select(
        "word", "form", "rule_id", F.col("out_cat").alias("category"), F.col("out_infl").alias("inflection")
    )


def derive_by_rule(words: DataFrame, rules: DataFrame) -> DataFrame:
    """Derivational variants: the same application with derivation rules."""
    return inflect_by_rule(words, rules)


def rule_limits(
    candidates: DataFrame, min_length: int | None = None, most: int | None = None
) -> DataFrame:
    """Ranked candidates, longest suffix first; only of words that are long enough, and only
    the first ``most``, where such limits are given."""
    order = W.partitionBy("word").orderBy(F.col("suffix_length").desc(), "rule_id")
    long_enough = candidates if min_length is None else candidates.filter(F.length("word") >= min_length)
    ranked = long_enough.withColumn("rank", F.row_number().over(order))
    return ranked if most is None else ranked.filter(F.col("rank") <= most)
