"""Negation and uncertainty from cue phrases near a mention.

A mention's row carries the words of its sentence, so no join is needed and a scope cannot
leave the sentence. The phrases of a scope are read from left to right, the longest of those
that begin together, each word belonging to one phrase; a fold over them keeps the cue.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notequarry.resources import (
    NEGATION_AFTER,
    NEGATION_BEFORE,
    NEGATION_CUES,
    NEGATION_LEFT,
    NEGATION_RIGHT,
    NO_NEGATION,
    SCOPE_STOPS,
    UNCERTAINTY_CUES,
)


@dataclass(frozen=True)
class Cues:
    """Lower-cased phrases, their words one space apart.

    ``either`` may stand on both sides of a mention, ``before`` and ``after`` on theirs only.
    No scope reaches past a phrase of ``stops``. Phrases of ``plain`` are no cues, though
    they may hold one.
    """

    either: Sequence[str] = ()
    before: Sequence[str] = ()
    after: Sequence[str] = ()
    stops: Sequence[str] = ()
    plain: Sequence[str] = ()

    @property
    def pattern(self) -> str:
        every = {*self.either, *self.before, *self.after, *self.stops, *self.plain}
        longest_first = sorted(every, key=lambda p: (-len(p.split(" ")), p))
        return "(?<= )(?:" + "|".join(map(re.escape, longest_first)) + ")(?= )" if every else "(?!)"


NEGATION = Cues(NEGATION_CUES, NEGATION_BEFORE, NEGATION_AFTER, SCOPE_STOPS, NO_NEGATION)
UNCERTAINTY = Cues(UNCERTAINTY_CUES, stops=SCOPE_STOPS)


def _phrases(words: Column, cues: Cues) -> Column:
    text = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    return F.regexp_extract_all(text, F.lit(cues.pattern), F.lit(0))


def _among(phrase: Column, *listed: Sequence[str]) -> Column:
    return phrase.isin([p for one in listed for p in one])


def cue_before(words: Column, cues: Cues) -> Column:
    """The last cue of the words before a mention that no stop parts from it, or null."""

    def step(kept: Column, phrase: Column) -> Column:
        cue = F.when(_among(phrase, cues.either, cues.before), phrase).otherwise(kept)
        return F.when(_among(phrase, cues.stops), F.lit(None).cast("string")).otherwise(cue)

    return F.aggregate(_phrases(words, cues), F.lit(None).cast("string"), step)


def cue_after(words: Column, cues: Cues) -> Column:
    """The first cue of the words after a mention that stands before any stop, or null."""
    start = F.struct(F.lit(None).cast("string").alias("cue"), F.lit(False).alias("over"))

    def step(state: Column, phrase: Column) -> Column:
        first = ~state["over"] & state["cue"].isNull() & _among(phrase, cues.either, cues.after)
        return F.struct(
            F.when(first, phrase).otherwise(state["cue"]).alias("cue"),
            (state["over"] | _among(phrase, cues.stops)).alias("over"),
        )

    return F.aggregate(_phrases(words, cues), start, step)["cue"]


def deciding_cue(cues: Cues, left: int, right: int, order: Sequence[str] = ("LEFT", "RIGHT")) -> Column:
    """(cue, side) of a mention: from the first side of ``order`` that has one within its
    ``left`` or ``right`` tokens; nulls if none has."""
    start = F.greatest(F.col("tok_start"), F.lit(0))
    before = F.slice(F.col("words"), F.greatest(start - left, F.lit(0)) + 1, F.least(start, F.lit(left)))
    after = F.slice(F.col("words"), F.greatest(F.col("tok_end"), F.lit(-1)) + 2, F.lit(right))
    found = {"LEFT": cue_before(before, cues), "RIGHT": cue_after(after, cues)}
    none = F.struct(F.lit(None).cast("string").alias("cue"), F.lit(None).cast("string").alias("side"))
    for side in reversed(order):
        own = F.struct(found[side].alias("cue"), F.lit(side).alias("side"))
        none = F.when(own["cue"].isNotNull(), own).otherwise(none)
    return none


def _scoped(mentions: DataFrame, cues: Cues | Sequence[str], name: str, value: int, left: int, right: int, order, told):
    own = cues if isinstance(cues, Cues) else Cues(tuple(cues))
    found = mentions.withColumn("_cue", deciding_cue(own, left, right, order))
    marked = found.withColumn(name, F.when(F.col("_cue.cue").isNotNull(), F.lit(value)).otherwise(F.lit(0)))
    if told:
        marked = marked.withColumn(f"{name}_cue", F.col("_cue.cue")).withColumn(f"{name}_side", F.col("_cue.side"))
    return marked.drop("_cue")


def negation_scope(
    mentions: DataFrame,
    cues: Cues | Sequence[str] = NEGATION,
    left: int = NEGATION_LEFT,
    right: int = NEGATION_RIGHT,
    order: Sequence[str] = ("LEFT", "RIGHT"),
    told: bool = False,
) -> DataFrame:
    """Add ``polarity``: -1 for a negated mention, else 0.

    A plain list of cues works on both sides and without stops. With ``told``, ``polarity_cue``
    and ``polarity_side`` say which cue decided.
    """
    return _scoped(mentions, cues, "polarity", -1, left, right, order, told)


def uncertainty_scope(
    mentions: DataFrame,
    cues: Cues | Sequence[str] = UNCERTAINTY,
    left: int = NEGATION_LEFT,
    right: int = NEGATION_RIGHT,
    order: Sequence[str] = ("LEFT", "RIGHT"),
    told: bool = False,
) -> DataFrame:
    """Add ``uncertainty``: 1 for an uncertain mention, else 0; as ``negation_scope``."""
    return _scoped(mentions, cues, "uncertainty", 1, left, right, order, told)
