"""Ordered folds over arrays that return a value for every element."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements per block. Appending copies what is there, so values are gathered in blocks, and
#: blocks in a list: an array of n elements costs n times this and a square of n / BLOCK.
BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def one_by_one(values: Column) -> Column:
    """The same array, so that a generator over it hands on a row at a time.

    Compiled, a generator makes all rows of an array before the next step sees one. Where a sentence
    goes with each of its words, that is the square of its length. An array from a lambda is not
    compiled, and neither is the generator over it.
    """
    return F.transform(values, lambda x: x)


def scan(
    values: Column,
    start: Column,
    step: Callable[[Column, Column], tuple[Column, Column]],
    kind: str,
) -> Column:
    """The outputs of ``step`` over an array, in order, each handed the state of the one before.

    ``step`` takes the state and an element and returns the next state and an output of the
    type ``kind``. A null array gives null, an empty one an empty array.
    """
    last = F.greatest(F.size(values) - 1, F.lit(0))
    every = F.sequence(F.lit(0), F.floor(last / F.lit(BLOCK)).cast("int"))
    blocks = F.transform(every, lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    none = F.array().cast(f"array<{kind}>")

    def advance(acc: Column, x: Column) -> Column:
        def moved(pair: Column) -> Column:
            return F.struct(pair["state"].alias("state"), F.array_append(acc["out"], pair["out"]).alias("out"))

        state, out = step(acc["state"], x)
        return let(F.struct(state.alias("state"), out.cast(kind).alias("out")), moved)

    def block(acc: Column, b: Column) -> Column:
        inner = F.aggregate(b, F.struct(acc["state"].alias("state"), none.alias("out")), advance)
        return let(
            inner,
            lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out")),
        )

    outer = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    found = F.flatten(F.aggregate(blocks, outer, block)["out"])
    return F.when(values.isNotNull(), found)


def running_sum(values: Column) -> Column:
    """The sums of an array of ints up to and with each element.

    An array of one block or less, as most sentences are, is one plain fold.
    """

    def add(total: Column, x: Column) -> tuple[Column, Column]:
        return total + x, total + x

    def summed(held: Column) -> Column:
        sums = F.aggregate(held, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
        short = F.slice(sums, F.lit(2), F.size(held))
        return F.when(held.isNull() | (F.size(held) <= BLOCK), short).otherwise(scan(held, F.lit(0), add, "int"))

    return let(values, summed)
