"""Queries for time words, time values and the relation of events to the note.

The prose of the tables holds few time phrases, so phrases are made from every
row of ``events``: numbers and units from the id, dates from the timestamp.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from notequarry.catalog import fixtures as X
from notequarry.catalog.registry import pick, query
from notequarry.catalog.sql import literal, listed, statement
from notequarry.functions import intervals, times
from notequarry.operators import consume, structure, temporal
from notequarry.plans import jobs
from notequarry.plans.lookup_table import LookupTable, never_sent_whole
from notequarry.resources import (
    DOC_TIME_RELATIONS,
    MONTHS,
    RECURRENCES,
    UNITS,
    WEEKDAYS,
    calendar_words,
    number_words,
    plural_unit,
)

NUMBERS = [w for w, _ in number_words()]
VALUES = [n for _, n in number_words()]
SINGULAR = [w for w, _ in UNITS]
PLURAL = [plural_unit(w) for w in SINGULAR]
UNIT_NAMES = [u for _, u in UNITS]
WEEKDAY_NAMES = [w for w, _ in WEEKDAYS]
MONTH_NAMES = [m for m, _ in MONTHS]


def at(words, index):
    return F.element_at(F.array(*[F.lit(w) for w in words]), (index % len(words) + 1).cast("int"))


def sql_at(words, index):
    values = listed(words) if isinstance(words[0], str) else ", ".join(map(str, words))
    return f"([{values}])[({index}) % {len(words)} + 1]"


def stamped(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def shown(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def events(spark, sf):
    return X.table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )


def number():
    return F.col("event_id")


def unit_no():
    return F.floor(number() / 7)



# ---------------------------------------------------------------- D5: periods
@query(
    f"""SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN {sql_at(VALUES, 'event_id')} WHEN 1 THEN event_id % 400
        WHEN 2 THEN 1 WHEN 3 THEN 2 END AS INTEGER) AS n,
        CASE WHEN event_id % 5 < 4 THEN {sql_at(UNIT_NAMES, 'event_id // 7')} END AS unit FROM events"""
)
def period_value(spark, sf):
    phrase = (
        F.when(number() % 5 == 0, F.concat(at(NUMBERS, number()), F.lit(" "), at(PLURAL, unit_no())))
        .when(number() % 5 == 1, F.concat((number() % 400).cast("string"), F.lit(" "), at(PLURAL, unit_no())))
        .when(number() % 5 == 2, F.concat(F.lit("the "), at(SINGULAR, unit_no())))
        .when(number() % 5 == 3, F.concat(F.lit("couple of "), at(PLURAL, unit_no())))
        .otherwise(F.lit("some time"))
    )
    value = times.period_value(F.col("phrase"))
    rows = events(spark, sf).select("event_id", phrase.alias("phrase")).select("event_id", value.alias("v"))
    return rows.select("event_id", "v.n", "v.unit")


# ----------------------------------------------------------- D6: relative spans
#: Units up to the decade, with their interval in months or seconds.
STEPS = (
    ("second", "SECOND"), ("minute", "MINUTE"), ("hour", "HOUR"), ("day", "DAY"), ("week", "WEEK"),
    ("month", "MONTH"), ("quarter", "QUARTER"), ("year", "YEAR"), ("decade", "DECADE"),
)
_INTERVAL = {"QUARTER": "INTERVAL 3 MONTH", "DECADE": "INTERVAL 10 YEAR", "WEEK": "INTERVAL 7 DAY"}


def by_unit(template: str) -> str:
    whens = " ".join(
        f"WHEN {i} THEN " + template.format(unit=word, step=_INTERVAL.get(name, f"INTERVAL 1 {name}"))
        for i, (word, name) in enumerate(STEPS)
    )
    return f"CASE (event_id // 7) % {len(STEPS)} {whens} END"


RELATIVE_N = sql_at(VALUES[:9], "event_id")
SPANS = {
    "relative": f"""SELECT event_id, ts, event_id % 7 AS kind, CAST({RELATIVE_N} AS INTEGER) AS n,
        CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events""",
    "stepped": f"""SELECT *, CAST({by_unit("date_trunc('{unit}', ts)")} AS TIMESTAMP) AS start,
        {by_unit('{step}')} AS one FROM relative""",
    "relative_spans": """SELECT event_id, CAST(CASE kind WHEN 0 THEN day - INTERVAL 1 DAY WHEN 1 THEN day
            WHEN 2 THEN day + INTERVAL 1 DAY WHEN 3 THEN start - n * one WHEN 4 THEN start + one
            ELSE start - n * one END AS TIMESTAMP) AS s,
        CAST(CASE kind WHEN 0 THEN day WHEN 1 THEN day + INTERVAL 1 DAY WHEN 2 THEN day + INTERVAL 2 DAY
            WHEN 3 THEN start WHEN 4 THEN start + one + n * one WHEN 5 THEN start - n * one + one
            ELSE start END AS TIMESTAMP) AS e FROM stepped""",
}


def relative_phrase():
    amount = F.concat(at(NUMBERS[:9], number()), F.lit(" "), at(PLURAL[:9], unit_no()))
    return (
        F.when(number() % 7 == 0, F.lit("yesterday"))
        .when(number() % 7 == 1, F.lit("today"))
        .when(number() % 7 == 2, F.lit("tomorrow"))
        .when(number() % 7 == 3, F.concat(F.lit("last "), amount))
        .when(number() % 7 == 4, F.concat(F.lit("the next "), amount))
        .when(number() % 7 == 5, F.concat(amount, F.lit(" ago")))
        .otherwise(F.concat(amount, F.lit(" earlier")))
    )


def span_rows(frame, value):
    rows = frame.select("event_id", value.alias("v"))
    return rows.select("event_id", shown(F.col("v.start")).alias("start"), shown(F.col("v.end")).alias("end"))


@query(f'SELECT event_id, {stamped("s")} AS "start", {stamped("e")} AS "end" FROM relative_spans', SPANS)
def relative_span(spark, sf):
    rows = events(spark, sf).select("event_id", "ts", relative_phrase().alias("phrase"))
    return span_rows(rows, times.relative_span(F.col("phrase"), F.col("ts")))


# ----------------------------------------------------------- D7: absolute dates
ABSOLUTE = {
    "absolute": """SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('month', ts)
        WHEN 2 THEN date_trunc('quarter', ts) ELSE date_trunc('year', ts) END AS TIMESTAMP) AS s FROM events""",
}


@query(
    f"""SELECT event_id, {stamped('s')} AS "start", {stamped("CAST(s + CASE event_id % 4 WHEN 0 THEN INTERVAL 1 DAY WHEN 1 THEN INTERVAL 1 MONTH WHEN 2 THEN INTERVAL 3 MONTH ELSE INTERVAL 1 YEAR END AS TIMESTAMP)")} AS "end"
        FROM absolute""",
    ABSOLUTE,
)
def absolute_date(spark, sf):
    ts = F.col("ts")
    phrase = (
        F.when(number() % 4 == 0, F.lower(F.date_format(ts, "MMMM d, yyyy")))
        .when(number() % 4 == 1, F.lower(F.date_format(ts, "MMM yyyy")))
        .when(number() % 4 == 2, F.concat(at(["first", "second", "third", "fourth"], F.quarter(ts) - 1), F.lit(" quarter "), F.year(ts)))
        .otherwise(F.year(ts).cast("string"))
    )
    rows = events(spark, sf).select("event_id", phrase.alias("phrase"))
    return span_rows(rows, times.absolute_date(F.col("phrase")))


# ------------------------------------------------------------ D8: nearest names
NEAREST = {
    "named": f"""SELECT event_id, CAST(ts AS DATE) AS d, event_id % 2 AS kind,
        CAST({sql_at([n for _, n in WEEKDAYS], 'event_id // 2')} AS INTEGER) AS wd,
        CAST({sql_at([n for _, n in MONTHS], 'event_id // 2')} AS INTEGER) AS mo FROM events""",
    "nearest": """SELECT event_id, kind, CAST(CASE WHEN kind = 0
        THEN d - CAST((isodow(d) - wd + 7) % 7 AS INTEGER)
        ELSE make_date(year(d) - CASE WHEN mo > month(d) THEN 1 ELSE 0 END, mo, 1) END AS TIMESTAMP) AS s FROM named""",
}


@query(
    f"""SELECT event_id, {stamped('s')} AS "start", {stamped("CAST(s + CASE kind WHEN 0 THEN INTERVAL 1 DAY ELSE INTERVAL 1 MONTH END AS TIMESTAMP)")} AS "end" FROM nearest""",
    NEAREST,
)
def partial_to_nearest(spark, sf):
    half = F.floor(number() / 2)
    name = F.when(number() % 2 == 0, at(WEEKDAY_NAMES, half)).otherwise(at(MONTH_NAMES, half))
    rows = events(spark, sf).select("event_id", "ts", name.alias("name"))
    return span_rows(rows, times.partial_to_nearest(F.col("name"), F.col("ts")))


# --------------------------------------------------------------- D9: recurrences
RECURRING = [w for w, _ in RECURRENCES]


@query(
    f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'EVERY' WHEN 1 THEN 'EVERY' WHEN 2 THEN 'EACH' END AS quantifier,
        CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN {sql_at(VALUES, 'event_id')}
            WHEN 2 THEN {sql_at([n for _, n in WEEKDAYS], 'event_id')} END AS INTEGER) AS n,
        CASE event_id % 4 WHEN 0 THEN {sql_at([u for _, u in RECURRENCES], 'event_id')}
            WHEN 1 THEN {sql_at(UNIT_NAMES, 'event_id // 7')} WHEN 2 THEN 'DAY_OF_WEEK' END AS unit FROM events"""
)
def period_set(spark, sf):
    phrase = (
        F.when(number() % 4 == 0, at(RECURRING, number()))
        .when(number() % 4 == 1, F.concat(F.lit("every "), at(NUMBERS, number()), F.lit(" "), at(PLURAL, unit_no())))
        .when(number() % 4 == 2, F.concat(F.lit("each "), at(WEEKDAY_NAMES, number())))
        .otherwise(F.lit("now and then"))
    )
    rows = events(spark, sf).select("event_id", phrase.alias("phrase"))
    return rows.select("event_id", times.period_set(F.col("phrase")).alias("v")).select("event_id", "v.*")


# --------------------------------------------------------------- D10: clock times
@query(
    """SELECT event_id, CAST(CASE event_id % 4 WHEN 3 THEN 12 ELSE hour(ts) END AS INTEGER) AS hour,
       CAST(CASE event_id % 4 WHEN 0 THEN minute(ts) WHEN 1 THEN minute(ts) ELSE 0 END AS INTEGER) AS minute,
       CAST(CASE event_id % 4 WHEN 1 THEN second(ts) ELSE 0 END AS INTEGER) AS second FROM events"""
)
def time_of_day(spark, sf):
    ts = F.col("ts")
    phrase = (
        F.when(number() % 4 == 0, F.lower(F.date_format(ts, "h:mm a")))
        .when(number() % 4 == 1, F.date_format(ts, "HH:mm:ss"))
        .when(number() % 4 == 2, F.lower(F.date_format(ts, "ha")))
        .otherwise(F.lit("noon"))
    )
    rows = events(spark, sf).select("event_id", phrase.alias("phrase"))
    return rows.select("event_id", times.time_of_day(F.col("phrase")).alias("v")).select("event_id", "v.*")


# ----------------------------------------------------------------- notes of events
NOTE_PHRASES = ("soon after", "all the while", "well ahead of", "by then", "on the next day", "still ongoing")
#: What the phrases of these notes say; of two relations the first by name counts.
NOTE_RELATIONS = (
    ("soon after", "AFTER"), ("all the while", "DURING"), ("well ahead of", "BEFORE"), ("by then", "BEFORE"),
    ("on the next day", "AFTER"), ("still ongoing", "CONTINUING"), ("still ongoing", "DURING"), ("the next", "AFTER"),
    ("every week", "DURING"),
)
#: Composed expressions of these notes, one for each remainder of the event's number.
COMPOSED = (
    "the day before last Tuesday", "January last year", "the week of March 6", "early 2024", "end of March",
    "winter of 1994", "this week", "October 11", "last summer", "two weeks after yesterday",
)


def event_notes(spark, sf):
    """A short note per event, with its type, a relative phrase, a date and a clock time."""
    ts = F.col("ts")
    body = F.concat(
        F.lit("Noted "), "event_type", F.lit(" "), at(NOTE_PHRASES, number()), F.lit(" "), relative_phrase(),
        F.lit(". Seen on "), F.date_format(ts, "MMMM d, yyyy"), F.lit(" at "), F.date_format(ts, "HH:mm"),
        F.lit(" , then "), "event_type", F.lit("s every week.\nThe "), "event_type", F.lit(" has no phrase. Began "), at(COMPOSED, number()), F.lit("."),
    )
    notes = events(spark, sf).select(number().alias("doc_id"), F.lit(1).alias("part"), body.alias("text"), ts.alias("anchor"))
    return X.dealt_out(notes)


_AMOUNT = f"{sql_at(NUMBERS[:9], 'event_id')} || ' ' || {sql_at(PLURAL[:9], 'event_id // 7')}"
EVENT_NOTES = {
    "parts": f"""SELECT event_id AS doc_id, 1 AS part, 'Noted ' || event_type || ' ' || {sql_at(list(NOTE_PHRASES), 'event_id')}
        || ' ' || CASE event_id % 7 WHEN 0 THEN 'yesterday' WHEN 1 THEN 'today' WHEN 2 THEN 'tomorrow'
            WHEN 3 THEN 'last ' || {_AMOUNT} WHEN 4 THEN 'the next ' || {_AMOUNT} WHEN 5 THEN {_AMOUNT} || ' ago'
            ELSE {_AMOUNT} || ' earlier' END
        || '. Seen on ' || strftime(ts, '%B %-d, %Y') || ' at ' || strftime(ts, '%H:%M') || ' , then ' || event_type
        || 's every week.' || chr(10) || 'The ' || event_type || ' has no phrase. Began ' || {sql_at(list(COMPOSED), 'event_id')} || '.' AS text FROM events""",
}
#: Words of these notes that no calendar gives.
NOTE_WORDS = (
    ("Adjuster", "last"), ("Adjuster", "next"), ("Adjuster", "ago"), ("Frequency", "every"), ("Time", "yesterday"),
    ("Time", "today"), ("Time", "tomorrow"), ("TimeReference", "then"), ("Modifier", "early"), ("Modifier", "end"),
    ("SeasonOfYear", "winter"), ("SeasonOfYear", "summer"),
)
CLASS_OF = {w: c for c, w in (*calendar_words(), *NOTE_WORDS)}
TIME_WORDS = {
    **EVENT_NOTES,
    "time_words": "SELECT unnest([" + listed(CLASS_OF) + "]) AS time_word, unnest([" + listed(CLASS_OF.values()) + "]) AS time_class",
}


def time_word_table(spark) -> LookupTable:
    return LookupTable.fixed(spark, list(CLASS_OF.items()), "time_word string, time_class string")


TOKEN = "doc_id part sent_id:i tok_idx:i begin:i end:i text token_type time_class"


@query(pick(TOKEN, "tokens JOIN time_words ON time_word = lower(text)"), TIME_WORDS, name="time_words")
def _time_words(spark, sf):
    tokens = structure.tokenize(structure.sentence_split(event_notes(spark, sf)))
    return temporal.time_words(tokens, time_word_table(spark))


_LETTERS = " ".join(f"WHEN time_class = '{c}' THEN '{m}'" for c, m in temporal.CLASS_LETTERS.items())
TIME_RUNS = {
    **TIME_WORDS,
    "time_letters": rf"""SELECT doc_id, part, sent_id, string_agg(CASE
        WHEN regexp_full_match(text, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}') THEN 'D'
        WHEN regexp_full_match(text, '[0-9]{{1,2}}:[0-9]{{2}}') THEN 'C' WHEN text = ',' THEN ','
        WHEN lower(text) IN ('before', 'after') THEN 'b' WHEN lower(text) IN ('of', 'in') THEN 'i'
        WHEN lower(text) IN ('this', 'that', 'current') THEN 'h'
        WHEN token_type = 'Num' AND time_class IS NULL AND regexp_full_match(text, '(1[0-9]|20|21)[0-9][0-9]') THEN 'y'
        WHEN token_type = 'Num' AND time_class IS NULL THEN 'n' {_LETTERS} ELSE 'o' END, '' ORDER BY tok_idx) AS letters
        FROM tokens LEFT JOIN time_words ON time_word = lower(text) GROUP BY doc_id, part, sent_id""",
    "time_runs": f"""SELECT doc_id, part, sent_id, run,
        sum(length(run)) OVER (PARTITION BY doc_id, part, sent_id ORDER BY pos) - 1 AS tok_end
        FROM (SELECT doc_id, part, sent_id, unnest(m) AS run, generate_subscripts(m, 1) AS pos FROM
            (SELECT doc_id, part, sent_id, regexp_extract_all(letters, {literal(temporal.TIME_RUN)}) AS m FROM time_letters))""",
    "time_spans": f"""SELECT r.doc_id, r.part, r.sent_id, r.tok_end - length(run) + 1 AS tok_start, r.tok_end,
        a."begin", b."end", run, CASE WHEN run IN ('C', 't') THEN 'TIME' WHEN run LIKE 'f%' THEN 'SET'
            WHEN run SIMILAR TO '.*[behi].*' OR run IN ('mau', 'wau', 'sau') THEN 'DATE' WHEN run LIKE '%u%' THEN 'DURATION' ELSE 'DATE' END AS time_kind
        FROM time_runs r
        JOIN tokens a ON a.doc_id = r.doc_id AND a.part = r.part AND a.sent_id = r.sent_id AND a.tok_idx = r.tok_end - length(run) + 1
        JOIN tokens b ON b.doc_id = r.doc_id AND b.part = r.part AND b.sent_id = r.sent_id AND b.tok_idx = r.tok_end
        WHERE NOT (length(run) = 1 AND contains({literal(temporal.NOT_TIME)}, run))""",
}


#: The composed expressions again, as dates from the event's own time.
_TUESDAY = "(day - CAST((isodow(ts) + 4) % 7 + 1 AS INTEGER))"
_COMPOSED_SPANS = (
    (f"{_TUESDAY} - INTERVAL 1 DAY", _TUESDAY, None),
    ("date_trunc('year', ts) - INTERVAL 1 YEAR", "date_trunc('year', ts) - INTERVAL 11 MONTH", None),
    ("date_trunc('week', march_6)", "date_trunc('week', march_6) + INTERVAL 7 DAY", None),
    ("DATE '2024-01-01'", "DATE '2025-01-01'", "START"),
    ("march", "march + INTERVAL 1 MONTH", "END"),
    ("DATE '1994-12-01'", "DATE '1995-03-01'", None),
    ("date_trunc('week', ts)", "date_trunc('week', ts) + INTERVAL 7 DAY", None),
    ("october_11", "october_11 + INTERVAL 1 DAY", None),
    ("summer", "summer + INTERVAL 3 MONTH", None),
    ("week_after", "week_after + INTERVAL 14 DAY", None),
)


def composed_column(i: int) -> str:
    shown_as = (lambda x: "NULL" if x is None else literal(x)) if i == 2 else (lambda x: f"CAST({x} AS TIMESTAMP)")
    return "CASE event_id % 10 " + " ".join(f"WHEN {k} THEN {shown_as(c[i])}" for k, c in enumerate(_COMPOSED_SPANS)) + " END"


COMPOSED_VALUES = {
    "dated": """SELECT event_id, ts, CAST(date_trunc('day', ts) AS DATE) AS day,
        make_date(year(ts) - CASE WHEN month(ts) >= 3 THEN 0 ELSE 1 END, 3, 1) AS march,
        make_date(year(ts) - CASE WHEN month(ts) * 100 + day(ts) >= 306 THEN 0 ELSE 1 END, 3, 6) AS march_6,
        make_date(year(ts) - CASE WHEN month(ts) * 100 + day(ts) >= 1011 THEN 0 ELSE 1 END, 10, 11) AS october_11,
        make_date(year(ts) - CASE WHEN month(ts) >= 9 THEN 0 ELSE 1 END, 6, 1) AS summer,
        date_trunc('week', ts - INTERVAL 1 DAY) + INTERVAL 7 DAY AS week_after FROM events""",
    "composed_spans": f"""SELECT event_id, {composed_column(0)} AS s, {composed_column(1)} AS e,
        {composed_column(2)} AS modifier FROM dated""",
}


@query(
    f'SELECT event_id, {stamped("s")} AS "start", {stamped("e")} AS "end", modifier FROM composed_spans', COMPOSED_VALUES
)
def composed_span(spark, sf):
    """Expressions that move, narrow or mark the value of another."""
    phrase = F.lower(at(COMPOSED, number()))
    rows = events(spark, sf).select("event_id", "ts", phrase.alias("phrase"))
    valued = rows.select("event_id", intervals.composed_value(F.col("phrase"), F.col("ts")).alias("v"))
    return valued.select(
        "event_id", shown(F.col("v.start")).alias("start"), shown(F.col("v.end")).alias("end"), F.col("v.modifier").alias("modifier")
    )


TIME_VALUES = {
    **SPANS,
    **TIME_RUNS,
    **COMPOSED_VALUES,
    "time_values": f"""SELECT t.* EXCLUDE (run), CASE WHEN last THEN {stamped("c.s")}
            WHEN run LIKE 'm%' THEN {stamped("r.day")} WHEN run = 'au' THEN {stamped("r.day + INTERVAL 1 DAY")}
            WHEN run IN ('t', 'anu', 'nua') THEN {stamped("r.s")} END AS value_start,
        CASE WHEN last THEN {stamped("c.e")}
            WHEN run LIKE 'm%' THEN {stamped("r.day + INTERVAL 1 DAY")} WHEN run = 'au' THEN {stamped("r.day + INTERVAL 2 DAY")}
            WHEN run IN ('t', 'anu', 'nua') THEN {stamped("r.e")} END AS value_end,
        CASE WHEN last THEN c.modifier END AS value_modifier
        FROM (SELECT *, sent_id = max(sent_id) OVER (PARTITION BY doc_id) AS last FROM time_spans) t
        JOIN (SELECT s.event_id, s.s, s.e, d.day FROM relative_spans s JOIN relative d ON d.event_id = s.event_id) r
        ON r.event_id = t.doc_id JOIN composed_spans c ON c.event_id = t.doc_id""",
}


@query(
    pick("doc_id part sent_id:i tok_start:i tok_end:i begin:i end:i time_kind value_start value_end value_modifier", "time_values"),
    TIME_VALUES,
)
def time_mentions(spark, sf):
    keys = ("doc_id", "part", "anchor")
    tokens = structure.tokenize(structure.sentence_split(event_notes(spark, sf), keys), keys)
    found = temporal.time_mentions(tokens, time_word_table(spark), keys, F.col("anchor")).drop("anchor")
    return found.withColumns({c: shown(F.col(c)) for c in ("value_start", "value_end")})


# ------------------------------------------------------------ phrases and relations
PHRASES = {
    **EVENT_NOTES,
    "lexicon_rows": "SELECT unnest([" + listed(p for p, _ in NOTE_RELATIONS) + "]) AS phrase, unnest(["
    + listed(r for _, r in NOTE_RELATIONS) + "]) AS relation",
    "time_phrases": "SELECT phrase, min(relation) AS relation, len(string_split(phrase, ' ')) AS n FROM lexicon_rows GROUP BY phrase",
    "grams": """SELECT doc_id, part, sent_id, i AS tok_start, n, array_to_string(words[i + 1 : i + n], ' ') AS gram
        FROM (SELECT s.*, unnest(range(0, len(words))) AS i FROM sent_words s), (SELECT DISTINCT n FROM time_phrases)
        WHERE i + n <= len(words)""",
    "longest": """SELECT doc_id, part, sent_id, tok_start, tok_start + max(p.n) - 1 AS tok_end,
        arg_max(phrase, p.n) AS phrase, arg_max(relation, p.n) AS relation
        FROM grams g JOIN time_phrases p ON p.n = g.n AND p.phrase = g.gram GROUP BY doc_id, part, sent_id, tok_start""",
    "following": """SELECT a.*, b.tok_start AS next_start FROM longest a ASOF LEFT JOIN longest b
        ON b.doc_id = a.doc_id AND b.part = a.part AND b.sent_id = a.sent_id AND b.tok_start > a.tok_end""",
    "apart": """SELECT f.* FROM following f JOIN (SELECT doc_id, part, sent_id, min(tok_start) AS tok_start
            FROM longest GROUP BY doc_id, part, sent_id) USING (doc_id, part, sent_id, tok_start)
        UNION ALL
        SELECT f.* FROM apart w JOIN following f ON f.doc_id = w.doc_id AND f.part = w.part
            AND f.sent_id = w.sent_id AND f.tok_start = w.next_start""",
    "found_phrases": """SELECT p.doc_id, p.part, p.sent_id, p.tok_start, p.tok_end, a."begin", e."end", phrase, relation
        FROM apart p
        JOIN tokens a ON a.doc_id = p.doc_id AND a.part = p.part AND a.sent_id = p.sent_id AND a.tok_idx = p.tok_start
        JOIN tokens e ON e.doc_id = p.doc_id AND e.part = p.part AND e.sent_id = p.sent_id AND e.tok_idx = p.tok_end""",
}


def phrase_table(spark) -> LookupTable:
    rows = spark.createDataFrame(list(NOTE_RELATIONS), "phrase string, relation string")
    return LookupTable.prepare(temporal.phrase_trie(rows), "phrases")


@query(
    pick("doc_id part sent_id:i tok_start:i tok_end:i begin:i end:i phrase relation", "found_phrases"), PHRASES
)
def lexicon_phrase_join(spark, sf):
    words = structure.sentence_words(structure.sentence_split(event_notes(spark, sf)))
    return temporal.lexicon_phrases(words, phrase_table(spark))


#: Relations that runs of the benchmark items stand for, over the given notes.
RUN_RELATIONS = ("BEFORE", "AFTER", "DURING", "STARTING", "CONTINUING", "ENDING", "NOW")
RUN_PHRASES = {
    **PHRASES,
    "lexicon_rows": f"SELECT term AS phrase, {sql_at(list(RUN_RELATIONS), 'item_id')} AS relation FROM terms WHERE tcount > 1",
}
del RUN_PHRASES["parts"]


@query(
    pick("doc_id part sent_id:i tok_start:i tok_end:i begin:i end:i phrase relation", "found_phrases"), RUN_PHRASES
)
def lexicon_phrases_of_notes(spark, sf):
    runs = X.prepared(spark, sf, "terms").frame.filter("tcount > 1")
    rows = runs.select(F.col("term").alias("phrase"), at(RUN_RELATIONS, F.col("item_id")).alias("relation"))
    return temporal.lexicon_phrases(X.words(spark, sf), LookupTable.prepare(temporal.phrase_trie(rows), "run-phrases"))


EVENTS_FOUND = {
    **PHRASES,
    "event_terms": "SELECT event_type AS term, min(event_id) + 1 AS cui FROM events GROUP BY event_type",
    "note_events": """SELECT DISTINCT t.doc_id, t.part, t.sent_id, t.tok_idx AS tok_start, t."begin", t."end",
        lower(t.text) AS text, cui
        FROM tokens t JOIN event_terms ON lower(t.text) = term OR lower(t.text) = term || 's'""",
    "related": """SELECT v.*, CASE (SELECT p.relation FROM found_phrases p WHERE p.doc_id = v.doc_id AND p.part = v.part
            AND p.sent_id = v.sent_id ORDER BY abs(p.tok_start - v.tok_start), p.tok_start LIMIT 1)
        WHEN 'BEFORE' THEN 'BEFORE' WHEN 'AFTER' THEN 'AFTER' WHEN 'DURING' THEN 'OVERLAP' WHEN 'STARTING' THEN 'OVERLAP'
        WHEN 'CONTINUING' THEN 'BEFORE-OVERLAP' WHEN 'ENDING' THEN 'BEFORE' ELSE 'OVERLAP' END AS doc_time_rel
        FROM note_events v""",
}


def event_settings(spark, sf) -> jobs.Settings:
    """Event types as a dictionary of one-word terms, matched by plural too."""
    named = X.table(spark, sf, "events").groupBy(F.col("event_type").alias("term")).agg(
        (F.min("event_id") + 1).alias("cui")
    )
    dictionary = named.select("cui", F.lit(0).alias("rindex"), F.lit(1).alias("tcount"), "term", F.col("term").alias("rword"))
    concepts = named.select(
        F.col("cui").alias("concept_id"), F.lit(100).alias("tui"), F.col("term").alias("pref_term"),
        F.lit("finding").alias("sem_group"), F.lit("LOCAL").alias("scheme"), F.col("cui").cast("string").alias("code"),
        F.lit(None).cast("string").alias("concept_cui"),
    )
    plurals = named.select(F.concat("term", F.lit("s")).alias("form"), F.col("term").alias("canonical"))
    return jobs.Settings(
        LookupTable.prepare(dictionary, "event-terms"),
        LookupTable.prepare(concepts, "event-concepts"),
        variants=LookupTable.prepare(plurals, "event-plurals"),
    )


def relation_table(spark) -> LookupTable:
    return LookupTable.fixed(spark, DOC_TIME_RELATIONS, "phrase_relation string, doc_time_rel string")


@query(pick("doc_id part sent_id:i tok_start:i begin:i end:i cui doc_time_rel", "related"), EVENTS_FOUND)
def doc_time_relation(spark, sf):
    found = jobs.doc_time(event_notes(spark, sf), event_settings(spark, sf), phrase_table(spark), relation_table(spark))
    return found.select("doc_id", "part", "sent_id", "tok_start", "begin", "end", "cui", "doc_time_rel")


@query(pick("doc_id part sent_id:i tok_start:i begin:i end:i cui", "note_events"), EVENTS_FOUND)
def event_mentions(spark, sf):
    found = temporal.event_mentions(jobs.annotate(event_notes(spark, sf), event_settings(spark, sf)))
    return found.select("doc_id", "part", "sent_id", "tok_start", "begin", "end", "cui")


@query(
    """SELECT v.doc_id, v.part, CAST(t."begin" AS INTEGER) AS "begin", CAST(t."end" AS INTEGER) AS "end", t.text, v.cui AS outer_cui
       FROM note_events v JOIN tokens t ON t.doc_id = v.doc_id AND t.part = v.part AND t."begin" >= v."begin" AND t."end" <= v."end\"""",
    EVENTS_FOUND,
)
def event_properties(spark, sf):
    notes = event_notes(spark, sf)
    found = temporal.event_mentions(jobs.annotate(notes, event_settings(spark, sf)))
    tokens = structure.tokenize(structure.sentence_split(notes)).select("doc_id", "part", "begin", "end", "text")
    return temporal.copy_event_properties(tokens, found.select("doc_id", "part", "begin", "end", "cui"), ["cui"])


@query(
    """SELECT doc_id, part, string_agg(lower(text || '|' || doc_time_rel || chr(10)), ' ' ORDER BY "begin", "end" DESC) AS relations
       FROM related GROUP BY doc_id, part""",
    EVENTS_FOUND,
)
def doctime_string(spark, sf):
    notes = event_notes(spark, sf)
    found = jobs.doc_time(notes, event_settings(spark, sf), phrase_table(spark), relation_table(spark))
    text = F.expr("substring(text, begin + 1, end - begin)")
    named = found.join(never_sent_whole(notes), ["doc_id", "part"]).withColumn("text", text)
    return consume.doctime_string(named)
