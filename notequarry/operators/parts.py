"""Cutting notes into size-capped parts on line boundaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notequarry.session import materialise


def split_to_parts(
    notes: DataFrame, max_size: int, text: str = "text", part: str = "part"
) -> DataFrame:
    """One row per part, numbered from 1, other columns kept.

    Lines are added until their summed length, line breaks left out, passes
    ``max_size``. A remainder of only blank lines gives no part.
    """
    others = [c for c in notes.columns if c != text]
    lines = F.split(F.regexp_replace(F.col(text), r"(?:\r?\n)+\z", ""), r"\r?\n")
    with_lines = notes.select(*others, lines.alias("_lines"))

    def add_line(state, line):
        run = state["run"] + F.length(line)
        line_no = state["line_no"] + 1
        full = run > F.lit(max_size)
        cuts = F.when(full, F.concat(state["cuts"], F.array(line_no))).otherwise(state["cuts"])
        return F.struct(
            cuts.alias("cuts"),
            F.when(full, F.lit(0)).otherwise(run).alias("run"),
            line_no.alias("line_no"),
        )

    def close(state):
        rest = F.concat(state["cuts"], F.array(state["line_no"]))
        return F.when(state["run"] > 0, rest).otherwise(state["cuts"])

    start = F.struct(
        F.array().cast("array<int>").alias("cuts"),
        F.lit(0).alias("run"),
        F.lit(0).alias("line_no"),
    )
    cut = with_lines.select(
        *others, "_lines", F.aggregate("_lines", start, add_line, close).alias("_cuts")
    )
    def body(cut, pos):
        before = F.coalesce(F.get(F.col("_cuts"), pos - 1), F.lit(0))
        joined = F.array_join(F.slice(F.col("_lines"), before + 1, cut - before), "\n")
        return F.struct((pos + 1).alias(part), F.concat(joined, F.lit("\n")).alias(text))

    # Parts are finished inside the row, so the lines of a note do not go with each of them. The
    # outer form keeps the generator from adding a filter that would evaluate the split again.
    made = cut.select(*others, F.transform("_cuts", body).alias("_parts"))
    return made.select(*others, F.inline_outer("_parts")).filter(F.col(text).isNotNull())


#: Prefix sums are looked up in buckets of this many caps, line numbers in buckets of this many lines.
CAPS, LINES = 16, 1024


def parts_of_lines(
    lines: DataFrame,
    max_size: int,
    keys: Sequence[str] = ("path",),
    text: str = "text",
    part: str = "part",
) -> DataFrame:
    """The parts of ``split_to_parts`` from a row per line, for notes that do not fit a row.

    ``lines`` has the key columns, ``block`` and ``pos`` (the order of the lines: by block, then
    place in it) and ``line``. No task holds more of a note than a block or a part: lengths
    are summed within blocks and over blocks; each line is given the line that would begin the
    part after one that begins with it, by a sorted search among the sums; from the first line
    of a note these pointers are followed by doubling, so a note of n parts takes log n rounds.
    """
    spark, own = lines.sparkSession, list(keys)
    held = materialise(lines.select(*own, "block", "pos", "line"), "lines")
    sizes = held.select(*own, "block", "pos", F.length("line").cast("long").alias("size"))
    blocks = sizes.groupBy(*own, "block").agg(F.sum("size").alias("n_size"), F.count("*").alias("n_lines"))
    earlier = W.partitionBy(*own).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = blocks.select(
        *own,
        "block",
        F.coalesce(F.sum("n_size").over(earlier), F.lit(0)).alias("_size"),
        F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)).alias("_lines"),
    )
    inside = W.partitionBy(*own, "block").orderBy("pos")
    counted = sizes.join(before, [*own, "block"]).select(
        *own,
        "block",
        "pos",
        "size",
        (F.col("_lines") + F.row_number().over(inside)).alias("no"),
        (F.col("_size") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))).alias("upto"),
    )
    # blank lines at the end of a note belong to no part
    last = counted.filter(F.col("size") > 0).groupBy(*own).agg(F.max("no").alias("last"))
    numbered = materialise(counted.join(last, own).filter(F.col("no") <= F.col("last")), "numbered")

    after = materialise(_next_starts(numbered, max_size, own), "pointers")
    starts, jumps, reached = [], after.select(*own, "no", "next"), numbered.filter(F.col("no") == 1).select(*own, "no")
    while True:
        reached = materialise(reached, "starts")
        starts.append(reached)
        every = starts[0]
        for more in starts[1:]:
            every = every.union(more)
        reached = every.join(jumps, [*own, "no"]).select(*own, F.col("next").alias("no"))
        if not reached.take(1):
            break
        onward = jumps.select(*own, F.col("no").alias("next"), F.col("next").alias("_next"))
        doubled = jumps.join(onward, [*own, "next"]).select(*own, "no", F.col("_next").alias("next"))
        jumps = materialise(doubled, "pointers")

    number = F.row_number().over(W.partitionBy(*own).orderBy("no"))
    ranges = every.join(after, [*own, "no"], "left").join(last, own).select(
        *own,
        number.alias(part),
        F.col("no").alias("_from"),
        F.coalesce(F.col("next") - 1, F.col("last")).alias("_to"),
    )
    bucket = lambda no: F.floor(no / F.lit(LINES)).cast("long")
    listed = ranges.withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_to")))))
    dealt = numbered.select(*own, "block", "pos", "no", bucket(F.col("no")).alias("_bucket")).join(listed, [*own, "_bucket"])
    placed = dealt.filter(F.col("no").between(F.col("_from"), F.col("_to"))).select(*own, "block", "pos", "no", part)
    joined = held.join(placed, [*own, "block", "pos"]).groupBy(*own, part).agg(
        F.sort_array(F.collect_list(F.struct("no", "line"))).alias("_lines")
    )
    return joined.select(*own, part, F.concat(F.array_join(F.col("_lines.line"), "\n"), F.lit("\n")).alias(text))


def _next_starts(numbered: DataFrame, max_size: int, keys: list[str]) -> DataFrame:
    """For every line the line after the part that begins with it: keys, no, next.

    A part ends with the first line whose sum passes the sum before it and the cap. Sums and
    what is looked for are sorted together within buckets of sums; where a bucket has no
    such line, it is the first one of the buckets after it. Lines of a last part are left out.
    """
    width = F.lit(max(1, max_size) * CAPS)
    bucket = lambda value: F.floor(value / width).cast("long")
    points = numbered.select(
        *keys, F.col("upto").alias("value"), F.lit(1).alias("point"), F.col("no").alias("at"), F.lit(None).cast("long").alias("no")
    )
    target = (F.col("upto") - F.col("size") + F.lit(max_size)).alias("value")
    asked = numbered.select(*keys, target, F.lit(0).alias("point"), F.lit(None).cast("long").alias("at"), "no")
    both = points.union(asked).withColumn("bucket", bucket(F.col("value")))
    beyond = W.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)
    firsts = both.groupBy(*keys, "bucket").agg(F.min("at").alias("first"))
    later = firsts.select(*keys, "bucket", F.min("first").over(beyond).alias("later"))
    # falling values; at the same value what is looked for comes first, as a sum must pass it
    order = W.partitionBy(*keys, "bucket").orderBy(F.desc("value"), "point")
    near = F.min("at").over(order.rowsBetween(W.unboundedPreceding, 0))
    found = both.withColumn("near", near).filter(F.col("point") == 0)
    ends = found.join(later, [*keys, "bucket"]).withColumn("next", F.coalesce("near", "later") + 1)
    last = numbered.select(*keys, "last").distinct()
    return ends.join(last, keys).filter(F.col("next") <= F.col("last")).select(*keys, "no", "next")
