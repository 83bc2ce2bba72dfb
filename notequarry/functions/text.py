"""Scalar text functions (scrubbing, display, token strings, folding)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from notequarry.resources import STRIP_S_AFTER, TOKEN_TYPES

#: Characters XML 1.0 does not allow (fixed value).
ILLEGAL_XML = r"[^\u0009\r\n\u0020-\uD7FF\uE000-\uFFFD\x{10000}-\x{10FFFF}]"


def legal_char_scrub(text: Column) -> Column:
    """Delete the characters that are illegal in XML 1.0."""
    return F.regexp_replace(text, ILLEGAL_XML, "")


def form_feed_to_space(text: Column) -> Column:
    return F.translate(text, "\f", " ")


def line_break_to_space(text: Column) -> Column:
    """A sentence as one display line."""
    return F.concat(F.lit(" * "), F.translate(text, "\n", " "))


def mention_text_norm(text: Column) -> Column:
    return F.translate(F.lower(text), " ", "_")


def token_to_string(token_type: Column, text: Column) -> Column:
    """Corpus form of a token; null for newlines, an error for unknown types."""
    plain = [t for t in TOKEN_TYPES if t not in ("Newline", "Num")]
    return (
        F.when(token_type == "Num", F.lit("number_token"))
        .when(token_type == "Newline", F.lit(None).cast("string"))
        .when(token_type.isin(plain), F.lower(text))
        .otherwise(F.raise_error(F.concat(F.lit("unknown token type: "), token_type)).cast("string"))
    )


def lowercase_flow(text: Column) -> Column:
    return F.lower(text)


def unicode_fold(text: Column, mapping: Mapping[str, str]) -> Column:
    """Replace characters by a map: one ``translate`` for 1:1, ``replace`` for 1:n."""
    single = {k: v for k, v in mapping.items() if len(v) == 1}
    folded = F.translate(text, "".join(single), "".join(single.values())) if single else text
    for source, target in mapping.items():
        if len(target) != 1:
            folded = F.replace(folded, F.lit(source), F.lit(target))
    return folded


def paren_s_removal(text: Column, stems: Sequence[str] = STRIP_S_AFTER) -> Column:
    """Drop a plural mark ``(s)`` that follows one of the listed stem endings.

    Patterns end in ``$``; D digit, P punctuation, S space, C letter, ^ start,
    lower-case letters stand for themselves.
    """
    classes = {"D": "[0-9]", "P": r"[.,;:!?'\"()\[\]{}-]", "S": " ", "C": r"\p{L}", "^": "^"}
    branches = []
    for stem in stems:
        branches.append("".join(classes.get(c, c) for c in stem.rstrip("$")))
    return F.regexp_replace(text, "(" + "|".join(branches) + r")\(s\)", "$1")
