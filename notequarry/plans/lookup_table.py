"""Reference tables (dictionary, concepts, lexicons) joined to large fact tables.

A table is broadcast only after its stored bytes have been counted. Beyond the limit the
join is a shuffle join with the facts on the left, which adaptive execution splits where
the counted size of a partition shows a hot key, such as a word that is a third of all
tokens; no other key pays for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.functions.arrays import one_by_one
from notequarry.session import materialise

#: Widest table that is sent to every executor, in bytes of its values.
BROADCAST_LIMIT = 128 * 1024 * 1024
_ROW_OVERHEAD = 32


def value_bytes(df: DataFrame) -> int:
    """Bytes of all values of a table, counted, not estimated."""
    width = F.lit(_ROW_OVERHEAD)
    for name in df.columns:
        text = F.col(name).cast("string")
        width = width + F.lit(8) + F.coalesce(F.octet_length(text), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()["b"])


def never_sent_whole(facts: DataFrame) -> DataFrame:
    """Facts on the right of a join with facts.

    Left to itself, Spark guesses their width from the bytes of the files below them. Sentences
    and tokens are many times as wide, and were sent to every executor through the driver.
    """
    return facts.hint("merge")


def met_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The inner join of two tables of facts on ``keys``, as one grouping of the rows of both.

    A join exchanges both sides by all its keys, although both are dealt out by note; a grouping
    is content with that, so sentences stay where they are. Rows that share a key are held
    together: use it where a key has the rows of a sentence.
    """
    sides = [[c for c in side.columns if c not in keys] for side in (left, right)]

    def rows(side: DataFrame, own: str, other: str, kept: Sequence[str], kind) -> DataFrame:
        empty = F.lit(None).cast(kind).alias(other)
        return side.dropna(subset=list(keys)).select(*keys, F.struct(*kept).alias(own), empty)

    kinds = [side.select(F.struct(*kept).alias("s")).schema["s"].dataType for side, kept in zip((left, right), sides)]
    both = rows(left, "_left", "_right", sides[0], kinds[1]).unionByName(rows(right, "_right", "_left", sides[1], kinds[0]))
    met = both.groupBy(*keys).agg(F.collect_list("_left").alias("_left"), F.collect_list("_right").alias("_right"))
    pairs = met.select(*keys, "_right", F.explode_outer(one_by_one(F.col("_left"))).alias("_l")).filter(F.col("_l").isNotNull())
    pairs = pairs.select(*keys, "_l", F.explode_outer(one_by_one(F.col("_right"))).alias("_r")).filter(F.col("_r").isNotNull())
    return pairs.select(*keys, "_l.*", "_r.*")


@dataclass(frozen=True)
class LookupTable:
    """A stored reference table and whether it was small enough to broadcast."""

    frame: DataFrame
    size_bytes: int
    limit: int = BROADCAST_LIMIT

    @property
    def broadcastable(self) -> bool:
        return self.size_bytes <= self.limit

    @classmethod
    def prepare(cls, frame: DataFrame, name: str, limit: int = BROADCAST_LIMIT) -> LookupTable:
        """Store a derived table once, count its bytes and choose the strategy."""
        return cls.stored(materialise(frame, name), limit)

    @classmethod
    def stored(cls, frame: DataFrame, limit: int = BROADCAST_LIMIT) -> LookupTable:
        """Wrap a table that is already in storage."""
        return cls(frame, value_bytes(frame), limit)

    @classmethod
    def fixed(cls, spark: SparkSession, rows: Sequence[tuple], schema: str, limit: int = BROADCAST_LIMIT) -> LookupTable:
        """A table spelled out in the code; its size is that of the list."""
        frame = spark.createDataFrame(list(rows), schema)
        return cls(frame, sum(_ROW_OVERHEAD + sum(8 + len(str(v)) for v in row) for row in rows), limit)

    def derived(self, frame: DataFrame, times: int = 1) -> LookupTable:
        """A table computed from this one, at most ``times`` as wide in bytes."""
        return LookupTable(frame, self.size_bytes * times, self.limit)

    def join(self, facts: DataFrame, on: dict[str, str], how: str = "inner", residual: Column | None = None) -> DataFrame:
        """Join ``facts`` to this table, ``on`` mapping fact column to table column.

        ``how`` may be inner, left, left_semi or left_anti. Columns of both sides
        must differ in name.
        """
        condition = None
        for left, right in on.items():
            term = facts[left] == self.frame[right]
            condition = term if condition is None else condition & term
        if residual is not None:
            condition = condition & residual
        table = F.broadcast(self.frame) if self.broadcastable else self.frame.hint("merge")
        return facts.join(table, condition, how)
