"""Concept codes, polarity prefixes and word-category bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notequarry.resources import CATEGORY_NAMES, TREEBANK_TAGS


def negation_prefix(code: Column, polarity: Column, dialect: str = "N") -> Column:
    """Dialect ``N`` marks polarity -1; dialect ``n`` marks anything but 0."""
    if dialect == "N":
        mark = F.when(polarity == -1, F.lit("N"))
    elif dialect == "n":
        mark = F.when(polarity != 0, F.lit("n"))
    else:
        raise ValueError(f"unknown negation dialect {dialect!r}")
    return F.concat(F.coalesce(mark, F.lit("")), code)


def concept_code(concept_cui: Column, scheme: Column, code: Column) -> Column:
    """The concept id where there is one, else scheme and code joined."""
    return F.coalesce(concept_cui, F.concat(scheme, code))


def concept_codes(concepts: Column) -> Column:
    """Distinct codes of an array of concepts; empty for null."""
    codes = F.transform(concepts, lambda c: concept_code(c["concept_cui"], c["scheme"], c["code"]))
    return F.coalesce(F.array_distinct(codes), F.array().cast("array<string>"))


def category_names(bits: Column) -> Column:
    """Names of the category bits that are set, lowest bit first."""
    names = F.array(*[F.lit(n) for n in CATEGORY_NAMES])
    flags = F.sequence(F.lit(0), F.lit(len(CATEGORY_NAMES) - 1))
    kept = F.filter(flags, lambda b: F.getbit(bits.cast("bigint"), b) == 1)
    return F.transform(kept, lambda b: F.element_at(names, b + 1))


def category_tags(bits: Column) -> Column:
    """Treebank tags of the category bits, lowest bit first, unmapped ones dropped."""
    tags = F.array(*[F.lit(TREEBANK_TAGS.get(n)) for n in CATEGORY_NAMES])
    flags = F.sequence(F.lit(0), F.lit(len(CATEGORY_NAMES) - 1))
    kept = F.filter(flags, lambda b: F.getbit(bits.cast("bigint"), b) == 1)
    return F.filter(F.transform(kept, lambda b: F.element_at(tags, b + 1)), lambda t: t.isNotNull())


def lowest_category_tag(bits: Column) -> Column:
    return F.try_element_at(category_tags(bits), F.lit(1))


def names_to_bits(names: Column) -> Column:
    """``adj+noun`` to its bit vector; unknown names count nothing."""
    listed = F.split(names, "[+]")
    values = F.create_map(*[x for i, n in enumerate(CATEGORY_NAMES) for x in (F.lit(n), F.lit(1 << i))])
    unique = F.array_distinct(listed)
    return F.aggregate(
        unique, F.lit(0), lambda acc, n: acc + F.coalesce(F.try_element_at(values, n), F.lit(0))
    ).cast("bigint")
