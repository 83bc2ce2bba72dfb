"""The scalar functions under SQL names, as SQL functions without Python in them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from notequarry.functions.text import ILLEGAL_XML
from notequarry.resources import CATEGORY_NAMES, TREEBANK_TAGS

_NAMES = ", ".join(f"'{n}'" for n in CATEGORY_NAMES)
_TAGS = ", ".join(f"'{TREEBANK_TAGS[n]}'" for n in CATEGORY_NAMES)

#: Name, parameters, result type, body.
SQL_FUNCTIONS = (
    ("nq_legal_chars", "t STRING", "STRING", f"regexp_replace(t, r'{ILLEGAL_XML}', '')"),
    ("nq_form_feed_to_space", "t STRING", "STRING", "translate(t, chr(12), ' ')"),
    (
        "nq_encounter_id", "p STRING", "STRING",
        r"CASE WHEN p RLIKE r'\.[^./]*\z' THEN regexp_extract(p, r'([^/]*)\.[^./]*\z', 1) END",
    ),
    ("nq_part_key", "p STRING, n INT", "STRING", "concat_ws('-', p, CAST(n AS STRING))"),
    (
        "nq_key_path", "k STRING", "STRING",
        r"CASE WHEN contains(k, '-') THEN regexp_extract(k, r'(?s)\A(.*)-([^-]*)\z', 1) END",
    ),
    (
        "nq_key_part", "k STRING", "INT",
        r"try_cast(regexp_extract(k, r'-([+-]?[0-9]+)\z', 1) AS INT)",
    ),
    ("nq_display_line", "t STRING", "STRING", "concat(' * ', translate(t, chr(10), ' '))"),
    ("nq_mention_text", "t STRING", "STRING", "translate(lower(t), ' ', '_')"),
    (
        "nq_token_string", "k STRING, t STRING", "STRING",
        "CASE WHEN k = 'Num' THEN 'number_token' WHEN k = 'Newline' THEN NULL "
        "WHEN k IN ('Contraction', 'Punctuation', 'Symbol', 'Word') THEN lower(t) "
        "ELSE CAST(raise_error(concat('unknown token type: ', k)) AS STRING) END",
    ),
    (
        "nq_negated_code", "c STRING, p INT, d STRING", "STRING",
        "CASE WHEN d = 'N' AND p = -1 THEN concat('N', c) WHEN d = 'n' AND p <> 0 THEN concat('n', c) ELSE c END",
    ),
    ("nq_concept_code", "cui STRING, s STRING, c STRING", "STRING", "coalesce(cui, concat(s, c))"),
    (
        "nq_category_tags", "b BIGINT", "ARRAY<STRING>",
        f"transform(filter(sequence(0, {len(CATEGORY_NAMES) - 1}), i -> getbit(b, i) = 1), "
        f"i -> element_at(array({_TAGS}), i + 1))",
    ),
    (
        "nq_split_parts", "t STRING, m INT", "ARRAY<STRING>",
        r"""aggregate(split(regexp_replace(t, r'(?:\r?\n)+\z', ''), r'\r?\n'),
            named_struct('parts', CAST(array() AS ARRAY<STRING>), 'cur', CAST(array() AS ARRAY<STRING>), 'run', 0),
            (a, l) -> CASE WHEN a.run + length(l) > m
              THEN named_struct('parts', concat(a.parts, array(array_join(concat(a.cur, array(l)), chr(10)) || chr(10))),
                                'cur', CAST(array() AS ARRAY<STRING>), 'run', 0)
              ELSE named_struct('parts', a.parts, 'cur', concat(a.cur, array(l)), 'run', a.run + length(l)) END,
            a -> CASE WHEN a.run > 0 THEN concat(a.parts, array(array_join(a.cur, chr(10)) || chr(10))) ELSE a.parts END)""",
    ),
)


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, parameters, result, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [f[0] for f in SQL_FUNCTIONS]
