"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows go from each partition to each shard is drawn first, from the number of rows in
the partitions alone: each row of the matrix is a multivariate hypergeometric draw from what
the partitions before it have left of the shards. Then every partition permutes its own rows
and sends the first of them to shard 0, the next to shard 1 and so on, as many as were drawn,
and every shard permutes what it has received. The result is a uniform random order of all
rows, cut into shards whose sizes differ by one at most, without a sort over all rows.

The matrix is drawn down a tree over the partitions, so that no task draws more than
``BRANCH`` rows of it one after another. All of it is DataFrame expressions. Partitions and
the order in them are pinned in a stored table before anything is drawn, so that a lost
executor changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notequarry.llm.common import parts
from notequarry.session import materialise

SHARDS = 24
#: Children of a node of the tree over the partitions.
BRANCH = 32
#: Rows that a shard permutes together, about; larger shards do it in random buckets.
BUCKET_ROWS = 4_000
#: Bytes of the matrix, and of the buckets' starts, up to which they are broadcast; beyond,
#: they meet the rows in an ordinary join.
BROADCAST_BYTES = 64 << 20
#: monotonically_increasing_id keeps the partition above this many bits, the place below.
PLACE_BITS = 33
#: Standard deviations, and values, on either side of the mode that a draw can reach. The
#: chance beyond them is below the last bit of a double.
REACH_SD, REACH = 9.0, 25


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(good: Column, bad: Column, draws: Column, uniform: Column) -> Column:
    """How many of ``draws`` rows drawn from ``good + bad`` are good, by inversion of ``uniform``.

    Weights relative to the mode follow from their neighbours; they are summed upwards from
    the mode and then downwards, and searched in the same order. ``draws`` must not exceed
    ``good + bad``; a draw that can only have one result has it.
    """
    real = lambda x: x.cast("double")
    every = real(good) + real(bad)
    spread = real(draws) * real(good) * real(bad) * (every - real(draws))
    sd = F.sqrt(spread / F.greatest(every * every * (every - 1.0), F.lit(1.0)))
    reach = F.ceil(sd * REACH_SD).cast("long") + REACH
    low, high = F.greatest(F.lit(0).cast("long"), draws - bad), F.least(draws, good)
    top = F.floor((real(draws) + 1.0) * (real(good) + 1.0) / (every + 2.0)).cast("long")
    mode = F.least(high, F.greatest(low, top))
    bounds = F.struct(mode.alias("mode"), low.alias("low"), high.alias("high"), reach.alias("reach"))
    up = lambda f, k: f * real(good - k) * real(draws - k) / (real(k + 1) * real(bad - draws + k + 1))
    down = lambda f, k: f * real(k) * real(bad - draws + k) / (real(good - k + 1) * real(draws - k + 1))

    def within(b: Column) -> Column:
        start, none = b["mode"], F.array().cast("array<bigint>")
        last, first = F.least(b["high"], start + b["reach"]), F.greatest(b["low"], start - b["reach"])
        above = F.when(last > start, F.sequence(start, last - 1)).otherwise(none)
        below = F.when(first < start, F.sequence(start, first + 1, F.lit(-1).cast("long"))).otherwise(none)

        def total(steps: Column, ratio, begin: float) -> Column:
            zero = F.struct(F.lit(1.0).alias("f"), F.lit(begin).alias("s"))

            def add(acc: Column, k: Column) -> Column:
                return _let(ratio(acc["f"], k), lambda f: F.struct(f.alias("f"), (acc["s"] + f).alias("s")))

            return F.aggregate(steps, zero, add)["s"]

        def steps_to(steps: Column, ratio, begin: float, target: Column) -> Column:
            zero = F.struct(F.lit(1.0).alias("f"), F.lit(begin).alias("s"), F.lit(0).cast("long").alias("n"))

            def go(acc: Column, k: Column) -> Column:
                moved = _let(
                    ratio(acc["f"], k),
                    lambda f: F.struct(f.alias("f"), (acc["s"] + f).alias("s"), (acc["n"] + 1).alias("n")),
                )
                return F.when(acc["s"] <= target, moved).otherwise(acc)

            return F.aggregate(steps, zero, go)["n"]

        sums = F.struct(total(above, up, 1.0).alias("up"), total(below, down, 0.0).alias("down"))

        def found(s: Column) -> Column:
            target = uniform * (s["up"] + s["down"])
            higher = start + steps_to(above, up, 1.0, target)
            lower = start - steps_to(below, down, 0.0, target - s["up"])
            return F.when(target < s["up"], higher).otherwise(lower)

        return _let(sums, found)

    return F.when(low == high, low).otherwise(_let(bounds, within))


def _uniform(*of: Column) -> Column:
    """A number in [0, 1) made of 53 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(2**53))


def _row(margins: Column, n: Column, tags: Sequence[Column]) -> Column:
    """A multivariate hypergeometric draw of ``n`` from ``margins``, one margin after another."""
    total = F.aggregate(margins, F.lit(0).cast("long"), lambda a, x: a + x)
    zero = F.struct(n.alias("left"), total.alias("after"), F.array().cast("array<bigint>").alias("drawn"))

    def draw(acc: Column, j: Column) -> Column:
        good = F.element_at(margins, j)
        drawn = hypergeometric(good, acc["after"] - good, acc["left"], _uniform(*tags, j))
        return _let(
            drawn,
            lambda x: F.struct(
                (acc["left"] - x).alias("left"),
                (acc["after"] - good).alias("after"),
                F.concat(acc["drawn"], F.array(x)).alias("drawn"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(1), F.size(margins)), zero, draw)["drawn"]


def communication_matrix(counts: DataFrame, sizes: Sequence[int], seed: int = 0) -> DataFrame:
    """part, drawn: how many rows of each partition go to each shard, as an array over the shards.

    ``counts`` has part (from 0) and n; the sum of n is the sum of ``sizes``. Parts without
    rows may be missing. An empty table gives an empty matrix.
    """
    counts = counts.select(F.col("part").cast("long").alias("part"), F.col("n").cast("long").alias("n"))
    last = counts.agg(F.max("part")).first()[0] or 0
    depth = 1
    while BRANCH**depth <= last:
        depth += 1
    margins = F.array(*(F.lit(int(x)).cast("long") for x in sizes))
    nodes = counts.sparkSession.range(1).select(F.col("id").alias("node"), margins.alias("margins"))
    for level in range(1, depth + 1):
        width = BRANCH ** (depth - level)
        child = F.floor(F.col("part") / F.lit(width)).cast("long")
        summed = counts.groupBy(child.alias("child")).agg(F.sum("n").alias("n"))
        parent = F.floor(F.col("child") / F.lit(BRANCH)).cast("long").alias("node")
        family = summed.groupBy(parent).agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("children"))
        nodes = nodes.join(family, "node").select(F.inline(_dealt(level, seed)))
    return nodes.select(F.col("node").alias("part"), F.col("margins").alias("drawn"))


def _dealt(level: int, seed: int) -> Column:
    """The margins of a node dealt out to its children, as an array of (node, margins)."""
    kind = "array<struct<node:bigint,margins:array<bigint>>>"
    zero = F.struct(F.col("margins").alias("rest"), F.array().cast(kind).alias("dealt"))

    def deal(acc: Column, child: Column) -> Column:
        tags = (F.lit(seed), F.lit(level), child["child"])
        return _let(
            _row(acc["rest"], child["n"], tags),
            lambda x: F.struct(
                F.zip_with(acc["rest"], x, lambda have, gone: have - gone).alias("rest"),
                F.concat(acc["dealt"], F.array(F.struct(child["child"].alias("node"), x.alias("margins")))).alias("dealt"),
            ),
        )

    return F.aggregate("children", zero, deal)["dealt"]


def shuffle_to_shards(
    rows: DataFrame, shards: int = SHARDS, seed: int = 0, keep: Sequence[str] | None = None
) -> DataFrame:
    """row (struct of the ``keep`` columns, all by default), shard (from 0), slot (from 0 in its shard).

    Every order of the rows is equally likely, up to the quality of 64-bit hashes, and shard
    sizes differ by at most one: the first ``n % shards`` shards have one row more.

    - Every row gets one place, whatever it holds: null and empty values, very long texts and
      repeated rows are rows like others, and equal rows are not kept together.
    - Other columns are not read. As rows are kept in a struct, names cannot clash.
    - With fewer rows than shards the last shards are empty; an empty table gives no rows.
    - The same seed over the same files, read in the same splits, gives the same places.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    whole = F.struct(*(rows[c].alias(c) for c in (keep or rows.columns)))
    key = F.xxhash64(F.lit(seed), F.lit("partition"), F.monotonically_increasing_id())
    # permuted in its partition: the number counts the rows of each partition after the sort
    local = rows.select(whole.alias("row"), key.alias("key")).sortWithinPartitions("key")
    held = materialise(local.select("row", F.monotonically_increasing_id().alias("at")), "permuted")

    part, place = F.shiftrightunsigned("at", PLACE_BITS), F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    counts = materialise(held.groupBy(part.alias("part")).agg(F.count("*").alias("n")), "counts")
    n, n_parts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    sizes = [n // shards + (j < n % shards) for j in range(shards)]
    matrix = materialise(communication_matrix(counts, sizes, seed), "matrix")
    empty = F.array().cast("array<bigint>")
    upto = F.aggregate(
        "drawn",
        F.struct(F.lit(0).cast("long").alias("total"), empty.alias("upto")),
        lambda acc, x: F.struct(
            (acc["total"] + x).alias("total"), F.concat(acc["upto"], F.array(acc["total"] + x)).alias("upto")
        ),
    )["upto"]
    bounds = matrix.select("part", upto.alias("upto"))
    if n_parts * (8 * shards + 16) <= BROADCAST_BYTES:
        bounds = F.broadcast(bounds)

    buckets = max(1, -(-n // (shards * BUCKET_ROWS)), -(-8 * parts(rows) // shards))
    order = F.xxhash64(F.lit(seed), F.lit("shard"), F.col("at"))
    sent = held.withColumn("part", part).join(bounds, "part").select(
        "row",
        "at",
        F.size(F.filter("upto", lambda x: x <= place)).alias("shard"),
        order.alias("order"),
        F.pmod(F.shiftrightunsigned(order, 20), F.lit(buckets)).alias("bucket"),
    )
    filled = sent.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if shards * buckets * 32 <= BROADCAST_BYTES:
        starts = F.broadcast(starts)
    received = Window.partitionBy("shard", "bucket").orderBy("order", "at")
    return sent.join(starts, ["shard", "bucket"]).select(
        "row", "shard", (F.col("start") + F.row_number().over(received) - 1).alias("slot")
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Writes the rows of ``shuffle_to_shards`` as Parquet, one folder a shard, files in order of slot."""
    ordered = placed.select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    ordered.sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)


def document_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; the law is ``rows``."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return shuffle_to_shards(docs, shards, seed, ["doc_id", "text"]).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
