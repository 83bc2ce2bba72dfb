"""Fixed values and small default word lists.

Term dictionaries, lexicons, time lexicons, word lists and rule files are inputs, read
with :mod:`notequarry.sources`. What stands here is either a value that results depend on,
or a short default of cue words.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Values below must be exactly these for results to be right.

#: Token types; no others exist.
TOKEN_TYPES = ("Contraction", "Newline", "Num", "Punctuation", "Symbol", "Word")

#: Words that are never normalised (exact case).
EXCLUSION_WORDS = (
    "And", "and", "By", "by", "For", "for", "In", "in", "Of", "of", "On", "on",
    "The", "the", "To", "to", "With", "with",
)

#: Word categories, one bit each, lowest bit first.
CATEGORY_NAMES = (
    "adj", "adv", "aux", "compl", "conj", "det", "modal", "noun", "prep", "pron", "verb",
)

#: Category to treebank tag.
TREEBANK_TAGS = {
    "adj": "JJ", "adv": "RB", "aux": "AUX", "compl": "CS", "conj": "CC", "det": "DT",
    "modal": "MD", "noun": "NN", "prep": "IN", "pron": "PRP", "verb": "VB",
}

#: Negation scope, in tokens to either side of a mention.
NEGATION_LEFT = 7
NEGATION_RIGHT = 7

#: Normal-form cache lines have 7 fields, lemma-cache lines 4; both cut at 20.
NORM_CACHE_FIELDS = 7
LEMMA_CACHE_FIELDS = 4
CACHE_FREQUENCY_CUTOFF = 20

#: Rule limits: shortest term, most results per word.
RULE_MIN_TERM_LENGTH = 3
RULE_MAX_RESULTS = 10

#: Stem endings after which a plural mark "(s)" is dropped.
STRIP_S_AFTER = (
    "D$", "P$", "^$", "PC$", "SC$", "^C$", "SCC$", "^CC$", "pp$", "alpha$", "beta$", "gamma$",
)

#: Month and weekday names with their short forms.
MONTHS = (
    ("january", 1), ("february", 2), ("march", 3), ("april", 4), ("may", 5), ("june", 6),
    ("july", 7), ("august", 8), ("september", 9), ("october", 10), ("november", 11),
    ("december", 12), ("jan", 1), ("feb", 2), ("mar", 3), ("apr", 4), ("jun", 6), ("jul", 7),
    ("aug", 8), ("sep", 9), ("sept", 9), ("oct", 10), ("nov", 11), ("dec", 12),
)
WEEKDAYS = (
    ("monday", 1), ("tuesday", 2), ("wednesday", 3), ("thursday", 4), ("friday", 5),
    ("saturday", 6), ("sunday", 7), ("mon", 1), ("tue", 2), ("tues", 2), ("wed", 3), ("thu", 4),
    ("thur", 4), ("thurs", 4), ("fri", 5), ("sat", 6), ("sun", 7),
)

#: Number words; tens combine with the ones below ten.
ONES = (
    ("one", 1), ("two", 2), ("three", 3), ("four", 4), ("five", 5), ("six", 6), ("seven", 7),
    ("eight", 8), ("nine", 9),
)
TEENS = (
    ("ten", 10), ("eleven", 11), ("twelve", 12), ("thirteen", 13), ("fourteen", 14),
    ("fifteen", 15), ("sixteen", 16), ("seventeen", 17), ("eighteen", 18), ("nineteen", 19),
)
TENS = (
    ("twenty", 20), ("thirty", 30), ("forty", 40), ("fifty", 50), ("sixty", 60),
    ("seventy", 70), ("eighty", 80), ("ninety", 90),
)

#: Units of time: word, name of the unit. Plurals follow by rule.
UNITS = (
    ("second", "SECONDS"), ("minute", "MINUTES"), ("hour", "HOURS"), ("day", "DAYS"),
    ("week", "WEEKS"), ("month", "MONTHS"), ("quarter", "QUARTER_YEARS"), ("year", "YEARS"),
    ("decade", "DECADES"), ("century", "CENTURIES"),
)

#: Words that stand for a recurring period.
RECURRENCES = (
    ("hourly", "HOURS"), ("daily", "DAYS"), ("weekly", "WEEKS"), ("monthly", "MONTHS"),
    ("quarterly", "QUARTER_YEARS"), ("yearly", "YEARS"), ("annually", "YEARS"),
)

# -------------------------------------------------------------------- defaults
# Short lists of our own; every operator takes another list as a parameter.

NEGATION_CUES = (
    "no", "not", "without", "denies", "denied", "negative", "never", "none", "neither", "absence",
)
NEGATION_BEFORE = ("no evidence of", "no sign of", "free of", "negative for", "ruled out for", "rather than")
NEGATION_AFTER = ("was ruled out", "were ruled out", "is absent", "not seen", "not found", "unlikely")
#: Phrases that hold a cue and negate nothing.
NO_NEGATION = ("not only", "no change in", "no increase in", "no longer than", "not necessarily")
#: Phrases past which no cue reaches.
SCOPE_STOPS = (";", "but", "however", "although", "except", "apart from", "because of")
UNCERTAINTY_CUES = ("possible", "probable", "may", "might", "suspected", "likely")

#: Tags that never start a dictionary lookup.
LOOKUP_EXCLUDED_TAGS = (
    "VB", "VBD", "VBG", "VBN", "VBP", "VBZ", "AUX", "CC", "CD", "DT", "EX", "IN", "LS", "MD",
    "PDT", "POS", "PP", "PRP", "RP", "TO", "WDT", "WP", "WRB",
)

#: Relation of a phrase to the relation of its event to the time of the note.
DOC_TIME_RELATIONS = (
    ("BEFORE", "BEFORE"), ("AFTER", "AFTER"), ("DURING", "OVERLAP"), ("STARTING", "OVERLAP"),
    ("CONTINUING", "BEFORE-OVERLAP"), ("ENDING", "BEFORE"), ("NOW", "OVERLAP"),
)

def plural_unit(word: str) -> str:
    consonant_y = word.endswith("y") and word[-2] not in "aeiou"
    return word[:-1] + "ies" if consonant_y else word + "s"


def number_words() -> list[tuple[str, int]]:
    """Number words up to ninety-nine, from the lists above; larger ones are composed of them."""
    words = list(ONES) + list(TEENS) + list(TENS)
    for tens, high in TENS:
        for ones, low in ONES:
            words.append((f"{tens} {ones}", high + low))
    return words


#: First month of each season, three months long.
SEASONS = (("spring", 3), ("summer", 6), ("fall", 9), ("autumn", 9), ("winter", 12))
#: First hour of each part of a day, times 100, and its hours.
DAY_PARTS = (("morning", 606), ("afternoon", 1206), ("evening", 1806), ("night", 2010))
#: Years of a century at which a decade begins.
DECADES = tuple((w.removesuffix("y") + "ies", n) for w, n in TENS)
#: What a word before or after a time expression says about it.
MODIFIERS = (
    ("early", "START"), ("earlier in", "START"), ("start of", "START"), ("beginning of", "START"), ("mid", "MID"),
    ("middle of", "MID"), ("late", "END"), ("later in", "END"), ("end of", "END"), ("about", "APPROX"),
    ("around", "APPROX"), ("almost", "APPROX"), ("nearly", "APPROX"), ("part of", "APPROX"),
    ("or later", "ON_OR_AFTER"), ("and beyond", "ON_OR_AFTER"), ("or earlier", "ON_OR_BEFORE"), ("and before", "ON_OR_BEFORE"),
)


def calendar_words() -> list[tuple[str, str]]:
    """(class, word) rows that follow from the calendar; all other classes are input lists."""
    rows = [("Number", word) for word, _ in (*ONES, *TEENS, *TENS)]
    rows += [("Number", word) for word in ("hundred", "thousand")]
    for word, _ in UNITS:
        rows += [("Unit", word), ("Unit", plural_unit(word))]
    rows += [("DayOfWeek", word) for word, _ in WEEKDAYS]
    rows += [("MonthOfYear", word) for word, _ in MONTHS]
    return rows
