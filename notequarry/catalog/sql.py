"""SQL counterparts: named subqueries and the statements built from them."""

from __future__ import annotations

import re

from notequarry.catalog.fixtures import (
    CLOSED_WORDS,
    GROUPS,
    LONG_WORD,
    NEGATION_WORDS,
    PART_CAP,
    UNCERTAINTY_WORDS,
)
from notequarry.operators.structure import CHUNK, PUNCTUATION, TOKEN_SHAPES
from notequarry.resources import CATEGORY_NAMES, TREEBANK_TAGS


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return ", ".join(literal(w) for w in words)


SPACES = r"[ \t\r\f]+"
TOKENS_FULL = "|".join([*TOKEN_SHAPES[:-1], SPACES, TOKEN_SHAPES[-1]])
SENTENCE_FULL = r"[^.!?\n]*[.!?]+|[^.!?\n]+|\n"
TAG_OF_BIT = " ".join(
    f"WHEN lex_bits & {1 << i} > 0 THEN {literal(TREEBANK_TAGS[n])}" for i, n in enumerate(CATEGORY_NAMES)
)


def token_type_sql(text: str) -> str:
    return f"""CASE WHEN regexp_matches({text}, '^[0-9]') THEN 'Num'
        WHEN {text}[1] = '''' AND length({text}) > 1 THEN 'Contraction'
        WHEN {text} = chr(10) THEN 'Newline'
        WHEN contains({literal(PUNCTUATION)}, {text}[1]) THEN 'Punctuation'
        WHEN regexp_matches({text}, '^\\p{{L}}') THEN 'Word' ELSE 'Symbol' END"""


def places(words: str, phrases) -> str:
    """Where one of the phrases begins in a list of words; no two of them share a word there."""
    runs = [f"list_slice({words}, i, i + {len(p.split(' ')) - 1}) = [{listed(p.split(' '))}]" for p in phrases]
    return f"list_filter(range(1, len({words}) + 1), lambda i: {' OR '.join(runs) or 'false'})"


def in_scope(cues) -> str:
    """Whether a cue stands before a mention, after the last stop, or after it, before the first."""
    return f"""(coalesce(list_max({places("before", [*cues.either, *cues.before])}), 0)
                > coalesce(list_max({places("before", cues.stops)}), 0)
            OR coalesce(list_min({places("after", [*cues.either, *cues.after])}), 99)
                < coalesce(list_min({places("after", cues.stops)}), 99))"""


CTES: dict[str, str] = {
    "note_lines": r"""
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS line_no
        FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '(?:\r?\n)+\z', ''), '\r?\n') AS l
              FROM documents)""",
    "walk": f"""
        SELECT doc_id, line_no, 1 AS part, length(line) AS run FROM note_lines WHERE line_no = 1
        UNION ALL
        SELECT n.doc_id, n.line_no,
               CASE WHEN w.run > {PART_CAP} THEN w.part + 1 ELSE w.part END,
               CASE WHEN w.run > {PART_CAP} THEN 0 ELSE w.run END + length(n.line)
        FROM walk w JOIN note_lines n ON n.doc_id = w.doc_id AND n.line_no = w.line_no + 1""",
    "parts": """
        SELECT doc_id, part, string_agg(line || chr(10), '' ORDER BY line_no) AS text
        FROM walk JOIN note_lines USING (doc_id, line_no)
        GROUP BY doc_id, part HAVING sum(length(line)) > 0""",
    "sent_pieces": f"""
        SELECT doc_id, part, unnest(m) AS piece, generate_subscripts(m, 1) AS pos
        FROM (SELECT doc_id, part, regexp_extract_all(text, {literal(SENTENCE_FULL)}) AS m FROM parts)""",
    "sentences": r"""
        SELECT doc_id, part,
               row_number() OVER (PARTITION BY doc_id, part ORDER BY pos) - 1 AS sent_id,
               raw_begin + length(regexp_extract(piece, '^[ \t\r\f]*')) AS "begin",
               raw_begin + length(regexp_extract(piece, '^[ \t\r\f]*')) + length(core) AS "end",
               core AS text
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, part ORDER BY pos)
                        - length(piece) AS raw_begin,
                     regexp_replace(regexp_replace(piece, '^[ \t\r\f]+', ''), '[ \t\r\f]+\z', '') AS core
              FROM sent_pieces)
        WHERE core <> '' AND core <> chr(10)""",
    "token_pieces": f"""
        SELECT doc_id, part, sent_id, sent_begin, unnest(m) AS piece, generate_subscripts(m, 1) AS pos
        FROM (SELECT doc_id, part, sent_id, "begin" AS sent_begin,
                     regexp_extract_all(text, {literal(TOKENS_FULL)}) AS m FROM sentences)""",
    "tokens": rf"""
        SELECT doc_id, part, sent_id,
               row_number() OVER (PARTITION BY doc_id, part, sent_id ORDER BY pos) - 1 AS tok_idx,
               sent_begin + piece_end - length(piece) AS "begin", sent_begin + piece_end AS "end",
               piece AS text, {token_type_sql('piece')} AS token_type
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, part, sent_id ORDER BY pos) AS piece_end
              FROM token_pieces)
        WHERE NOT regexp_full_match(piece, '[ \t\r\f]+')""",
    "part_tokens": rf"""
        SELECT doc_id, part, pos, piece_end - length(piece) AS "begin", piece_end AS "end",
               piece AS text, {token_type_sql('piece')} AS token_type
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id, part ORDER BY pos) AS piece_end
              FROM (SELECT doc_id, part, unnest(m) AS piece, generate_subscripts(m, 1) AS pos
                    FROM (SELECT doc_id, part, regexp_extract_all(text, {literal(TOKENS_FULL)}) AS m
                          FROM parts)))
        WHERE NOT regexp_full_match(piece, '[ \t\r\f]+')""",
    "bench_words": r"""
        SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos
        FROM (SELECT item_id, regexp_extract_all(lower(text), '\p{L}+') AS w FROM benchmark)""",
    "terms": f"""
        SELECT item_id, 1 AS tcount, item_id * 100000 + pos * 10 + 1 AS cui, word AS term
        FROM bench_words WHERE length(word) >= {LONG_WORD}
        UNION ALL
        SELECT a.item_id, 2, a.item_id * 100000 + a.pos * 10 + 2, a.word || ' ' || b.word
        FROM bench_words a JOIN bench_words b ON b.item_id = a.item_id AND b.pos = a.pos + 1
        UNION ALL
        SELECT a.item_id, 3, a.item_id * 100000 + a.pos * 10 + 3, a.word || ' ' || b.word || ' ' || c.word
        FROM bench_words a JOIN bench_words b ON b.item_id = a.item_id AND b.pos = a.pos + 1
        JOIN bench_words c ON c.item_id = a.item_id AND c.pos = a.pos + 2""",
    "doc_counts": r"""
        SELECT word, count(*) AS n_docs FROM (
            SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents)
        GROUP BY word""",
    "dictionary": """
        SELECT cui, rindex, tcount, term, rword FROM (
            SELECT t.cui, t.tcount, t.term, t.rword, t.rindex,
                   row_number() OVER (PARTITION BY t.cui ORDER BY coalesce(n_docs, 0), t.rindex) AS rn
            FROM (SELECT cui, tcount, term, unnest(string_split(term, ' ')) AS rword,
                         generate_subscripts(string_split(term, ' '), 1) - 1 AS rindex FROM terms) t
            LEFT JOIN doc_counts d ON d.word = t.rword)
        WHERE rn = 1""",
    "concepts": f"""
        SELECT cui AS concept_id, 100 + (item_id + 2 * tcount * (item_id % 2)) % 5 AS tui,
               term AS pref_term,
               ([{listed(GROUPS)}])[1 + (item_id + 2 * tcount * (item_id % 2)) % 5] AS sem_group,
               CASE WHEN item_id % 2 = 1 THEN 'RXNORM' ELSE 'SNOMEDCT_US' END AS scheme,
               CAST(cui AS VARCHAR) AS code,
               CASE WHEN item_id % 2 = 0 THEN 'C' || lpad(CAST(cui AS VARCHAR), 9, '0') END AS concept_cui
        FROM terms""",
    "lexicon": "SELECT DISTINCT word AS lex_word, 1 << CAST(length(word) % 11 AS INTEGER) AS lex_bits FROM bench_words",
    "sent_words": """
        SELECT doc_id, part, sent_id, list(lower(text) ORDER BY tok_idx) AS words
        FROM tokens GROUP BY ALL""",
    "raw_hits": """
        SELECT t.doc_id, t.part, t.sent_id, t.tok_idx - d.rindex AS tok_start,
               t.tok_idx - d.rindex + d.tcount - 1 AS tok_end, d.cui, s.words
        FROM tokens t JOIN dictionary d ON lower(t.text) = d.rword
        JOIN sent_words s ON s.doc_id = t.doc_id AND s.part = t.part AND s.sent_id = t.sent_id
        WHERE length(d.term) >= 3 AND t.tok_idx >= d.rindex
          AND list_slice(s.words, t.tok_idx - d.rindex + 1, t.tok_idx - d.rindex + d.tcount)
              = string_split(d.term, ' ')""",
    "hits": """
        SELECT h.*, a."begin", b."end"
        FROM raw_hits h
        JOIN tokens a ON a.doc_id = h.doc_id AND a.part = h.part AND a.sent_id = h.sent_id AND a.tok_idx = h.tok_start
        JOIN tokens b ON b.doc_id = h.doc_id AND b.part = h.part AND b.sent_id = h.sent_id AND b.tok_idx = h.tok_end""",
    "mentions": f"""
        SELECT h.doc_id, h.part, h.sent_id, h.tok_start, h.tok_end, h."begin", h."end", h.cui,
               c.tui, c.pref_term, c.sem_group, c.scheme, c.code, c.concept_cui,
               coalesce(c.concept_cui, c.scheme || c.code) AS concept,
               CASE WHEN c.sem_group = 'anatomy' THEN 'entity' ELSE 'event' END AS mention_class,
               CASE WHEN {in_scope(NEGATION_WORDS)} THEN -1 ELSE 0 END AS polarity,
               CASE WHEN {in_scope(UNCERTAINTY_WORDS)} THEN 1 ELSE 0 END AS uncertainty
        FROM (SELECT *, list_slice(words, greatest(tok_start - 6, 1), tok_start) AS before,
                     list_slice(words, tok_end + 2, tok_end + 8) AS after FROM hits) h
        LEFT JOIN concepts c ON c.concept_id = h.cui""",
    "tagged": f"""
        SELECT t.*, CASE WHEN token_type = 'Num' THEN 'CD'
            WHEN token_type = 'Punctuation' THEN text
            WHEN token_type IN ('Symbol', 'Newline') THEN 'SYM'
            WHEN lower(text) IN ('and', 'or', 'but') THEN 'CC'
            WHEN lower(text) IN ({listed(CLOSED_WORDS)}) THEN 'IN'
            {TAG_OF_BIT}
            WHEN lower(text) LIKE '%ing' THEN 'VBG' WHEN lower(text) LIKE '%ed' THEN 'VBD'
            WHEN lower(text) LIKE '%ly' THEN 'RB' WHEN lower(text) LIKE '%s' THEN 'NNS'
            ELSE 'NN' END AS pos
        FROM tokens t LEFT JOIN lexicon ON lower(text) = lex_word""",
    "letters": """
        SELECT doc_id, part, sent_id, string_agg(CASE WHEN pos = 'DT' THEN 'D'
            WHEN pos IN ('JJ', 'CD') THEN 'J' WHEN pos IN ('NN', 'NNS') THEN 'N'
            WHEN pos IN ('VB', 'VBD', 'VBG') THEN 'V' WHEN pos = 'MD' THEN 'M'
            WHEN pos = 'IN' THEN 'I' ELSE 'O' END, '' ORDER BY tok_idx) AS letters
        FROM tagged GROUP BY ALL""",
    "chunk_runs": f"""
        SELECT doc_id, part, sent_id, pos - 1 AS chunk_idx, run,
               sum(length(run)) OVER (PARTITION BY doc_id, part, sent_id ORDER BY pos) - 1 AS tok_end
        FROM (SELECT doc_id, part, sent_id, unnest(m) AS run, generate_subscripts(m, 1) AS pos
              FROM (SELECT doc_id, part, sent_id, regexp_extract_all(letters, {literal(CHUNK)}) AS m
                    FROM letters))""",
    "chunks": """
        SELECT r.doc_id, r.part, r.sent_id, r.chunk_idx, r.tok_end - length(run) + 1 AS tok_start, r.tok_end,
               a."begin", b."end",
               CASE WHEN run LIKE '%N%' THEN 'NP' WHEN run LIKE '%V%' THEN 'VP'
                    WHEN run = 'I' THEN 'PP' ELSE 'O' END AS chunk_type
        FROM chunk_runs r
        JOIN tokens a ON a.doc_id = r.doc_id AND a.part = r.part AND a.sent_id = r.sent_id
                     AND a.tok_idx = r.tok_end - length(run) + 1
        JOIN tokens b ON b.doc_id = r.doc_id AND b.part = r.part AND b.sent_id = r.sent_id AND b.tok_idx = r.tok_end""",
    "extended_once": """
        SELECT * REPLACE (CASE WHEN m THEN e ELSE "end" END AS "end", CASE WHEN m THEN te ELSE tok_end END AS tok_end)
        FROM (SELECT *, coalesce(chunk_type = 'NP' AND lead(chunk_type) OVER w = 'NP', false) AS m,
                     lead("end") OVER w AS e, lead(tok_end) OVER w AS te
              FROM chunks WINDOW w AS (PARTITION BY doc_id, part, sent_id ORDER BY chunk_idx))""",
    "extended": """
        SELECT * EXCLUDE (m, e, te) REPLACE (CASE WHEN m2 THEN e2 ELSE "end" END AS "end",
                          CASE WHEN m2 THEN te2 ELSE tok_end END AS tok_end)
        FROM (SELECT *, coalesce(chunk_type = 'NP' AND lead(chunk_type) OVER w = 'PP'
                                 AND lead(chunk_type, 2) OVER w = 'NP', false) AS m2,
                     lead("end", 2) OVER w AS e2, lead(tok_end, 2) OVER w AS te2
              FROM extended_once WINDOW w AS (PARTITION BY doc_id, part, sent_id ORDER BY chunk_idx))""",
    "phrases": "SELECT * FROM extended WHERE chunk_type = 'NP'",
    "windows": """
        SELECT b.* FROM phrases b WHERE NOT EXISTS (
            SELECT 1 FROM phrases a WHERE a.doc_id = b.doc_id AND a.part = b.part
              AND a."begin" <= b."begin" AND a."end" >= b."end"
              AND (a."begin" < b."begin" OR a."end" > b."end"
                   OR a.sent_id < b.sent_id OR a.chunk_idx < b.chunk_idx))""",
    "np_mentions": """
        SELECT m.* FROM mentions m JOIN windows w ON w.doc_id = m.doc_id AND w.part = m.part
          AND w.sent_id = m.sent_id AND m.tok_start >= w.tok_start AND m.tok_end <= w.tok_end""",
}


def _needs(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def statement(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` with every named subquery it needs put before it."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(sql: str, stack: tuple[str, ...]) -> None:
        for name in known:
            if name in stack or name in order:
                continue
            if re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", sql):
                visit(known[name], (*stack, name))
                order.append(name)

    visit(final, ())
    if not order:
        return final
    own = {n for n in order if re.search(rf"(?:FROM|JOIN)\s+{n}\b", known[n])}
    heads = ",\n".join(f"{n} AS ({known[n]})" if n in own else f"{n} AS MATERIALIZED ({known[n]})" for n in order)
    recursive = "RECURSIVE " if own else ""
    return f"WITH {recursive}{heads}\n{final}"
