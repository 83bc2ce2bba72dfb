"""Ordered strings and corpora over stored mention and token tables.

Groups are parts, whose size is capped, so an ordered collect is bounded. Order
is always by begin, then falling end, then code: never the order of arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from notequarry.functions.codes import negation_prefix
from notequarry.functions.text import token_to_string
from notequarry.operators import KEYS


def codes_per_mention(mentions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct codes of a mention (a span with a semantic group)."""
    return mentions.groupBy(*keys, "begin", "end", "sem_group").agg(
        F.array_sort(F.collect_set("concept")).alias("codes")
    )


def explode_codes(mentions: DataFrame, codes: str = "codes") -> DataFrame:
    """One row per distinct code of a mention."""
    others = [c for c in mentions.columns if c != codes]
    return mentions.select(*others, F.explode(F.array_distinct(codes)).alias("code"))


def _ordered(
    mentions: DataFrame, keys: Sequence[str], rank: Column, dialect: str | None
) -> DataFrame:
    entry = F.struct(
        rank.alias("rank"),
        F.col("begin"),
        (-F.col("end")).alias("back"),
        F.col("concept").alias("code"),
        F.coalesce("sem_group", F.lit("")).alias("sem_group"),
        (F.col("polarity") if dialect else F.lit(0)).alias("polarity"),
    )
    coded = mentions.filter(F.col("concept").isNotNull())
    # a set: array_distinct compares every struct with every other
    listed = coded.groupBy(*keys).agg(F.collect_set(entry).alias("_m"))
    ordered = listed.withColumn("_m", F.sort_array("_m"))
    if dialect:
        shown = F.transform("_m", lambda m: negation_prefix(m["code"], m["polarity"], dialect))
    else:
        shown = F.col("_m.code")
    return ordered.select(*keys, F.array_join(shown, " ").alias("cuis"))


def cui_string_events(mentions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Codes of event mentions in text order, ``N`` before negated ones."""
    events = mentions.filter(F.col("mention_class") == "event")
    return _ordered(events, keys, F.lit(0), "N")


def cui_string_all(mentions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Codes of events, then of entities, without polarity."""
    rank = F.when(F.col("mention_class") == "event", F.lit(0)).otherwise(F.lit(1))
    return _ordered(mentions, keys, rank, None)


def cui_sequence(mentions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Codes of all mentions in text order, ``n`` before those with a polarity."""
    return _ordered(mentions, keys, F.lit(0), "n")


def cui_corpus(mentions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Codes of all mentions in text order without polarity, a line per part."""
    return _ordered(mentions, keys, F.lit(0), None)


def token_corpus(tokens: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Token strings of a part in order, null ones dropped."""
    shown = token_to_string(F.col("token_type"), F.col("text"))
    entry = F.struct("begin", shown.alias("shown"))
    listed = tokens.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_t"))
    line = F.array_join(F.array_compact(F.col("_t.shown")), " ")
    return listed.select(*keys, line.alias("line"))


def lm_corpus(tokens: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One line of token strings per sentence."""
    return token_corpus(tokens, [*keys, "sent_id"])


def drop_null_tokens(tokens: DataFrame, column: str) -> DataFrame:
    return tokens.filter(F.col(column).isNotNull())


def doctime_string(relations: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``text|relation`` lines of the events of a part; items joined by a space."""
    item = F.lower(
        F.concat(F.translate(F.col("text"), " ", "_"), F.lit("|"), F.col("doc_time_rel"), F.lit("\n"))
    )
    entry = F.struct("begin", (-F.col("end")).alias("back"), item.alias("item"))
    listed = relations.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_r"))
    return listed.select(*keys, F.array_join(F.col("_r.item"), " ").alias("relations"))


def doc_output(results: DataFrame, key: str, output: Column) -> DataFrame:
    """Document to output, one row per document."""
    return results.select(F.col(key), output.alias("output"))


def _counts() -> list[Column]:
    failed = F.coalesce(F.sum(F.when(F.col("parsed"), F.lit(0)).otherwise(F.lit(1))), F.lit(0))
    every = F.count(F.lit(1))
    return [every.alias("n_rows"), (every - failed).alias("n_parsed"), failed.alias("n_failed")]


def processed_counts(results: DataFrame) -> DataFrame:
    """Rows processed, parsed and failed."""
    return results.agg(*_counts())


def observed_counts(results: DataFrame) -> tuple[Observation, DataFrame]:
    """The counts of ``processed_counts``, taken while the rows pass on to whatever writes them.

    The observation has them once that action is over; the rows are not read a second time.
    """
    seen = Observation("processed counts")
    return seen, results.observe(seen, *_counts())
