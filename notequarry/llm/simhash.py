"""Near duplicates by SimHash, found with a Gray-order hierarchical index.

Distinct fingerprints are dealt out by pairs of their six bit blocks: two fingerprints
that differ in at most four bits agree in two blocks at least, so every link is met in
some bucket. A bucket of many fingerprints is dealt out once more by the remaining bits,
again without losing a link. Within a bucket fingerprints are sorted by Gray rank, so that
neighbours share most bits, and a hierarchy is built over the order: a node knows the bits
on which all fingerprints below it agree. Pairs of nodes are compared from the top: the
differences accumulated in bits that both nodes fix bound the distance of everything below,
so whole groups are pruned when the bound exceeds the limit, and whole groups are linked
at once when even the bits left open cannot exceed it. Only a spanning set of links leaves
a task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notequarry.llm.common import LOWER, batches, columns, parts, text_bytes
from notequarry.llm.components import components
from notequarry.session import materialise

SHINGLE = 4
SEED = 42
LIMIT = 4
BLOCKS = (11, 11, 11, 11, 10, 10)
#: A bucket with more fingerprints than this is dealt out again by its remaining bits.
FULL_BUCKET = 4096
FANOUT = 8
FRONTIER = 500_000


def fingerprint(text: bytes) -> int:
    """SimHash of 4-word shingles, as an unsigned 64-bit number; without words it is 0."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashed = xxhash.xxh64_intdigest
    found = np.array([hashed(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 65_536):
        bits = np.unpackbits(found[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(found), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (a signed long) of every row."""

    def hashed(rows):
        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(x) for x in text_bytes(batch.column(1))], np.uint64)
            return pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

        return batches(rows, make)

    narrow = columns(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(hashed, f"doc_id {kind}, print long")


def _spans(widths: tuple[int, ...], start: int = 0) -> list[tuple[int, int]]:
    found = []
    for width in widths:
        found.append((start, width))
        start += width
    return found


def _bits(column: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(column, start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _pair_keys(column: Column) -> Column:
    """One key for each pair of blocks: which pair, and the bits of both."""
    keys = []
    for i, ((a, n), (b, m)) in enumerate(combinations(_spans(BLOCKS), 2)):
        bits = F.shiftleft(_bits(column, a, n), m).bitwiseOR(_bits(column, b, m))
        keys.append(bits.bitwiseOR(F.lit(i << 24).cast("long")))
    return F.array(*keys)


def _open_keys(key: Column, column: Column) -> Column:
    """For a full bucket: keys of five stretches of the bits outside its two blocks.

    At most four bits differ, so two members that are near agree in one stretch at least.
    """
    spans, branches = _spans(BLOCKS), F
    chosen = None
    for i, pair in enumerate(combinations(range(len(BLOCKS)), 2)):
        rest, taken = F.lit(0).cast("long"), 0
        for k in range(len(BLOCKS)):
            if k not in pair:
                rest = rest.bitwiseOR(F.shiftleft(_bits(column, *spans[k]), taken))
                taken += spans[k][1]
        widths = tuple(taken // 5 + (j < taken % 5) for j in range(5))
        keys = F.array(
            *(
                _bits(rest, at, n).bitwiseOR(F.lit((j + 1) << 16).cast("long"))
                for j, (at, n) in enumerate(_spans(widths))
            )
        )
        which = F.shiftright(key, 24) == i
        chosen = branches.when(which, keys) if chosen is None else chosen.when(which, keys)
    return chosen


def buckets(prints: DataFrame, full: int = FULL_BUCKET) -> DataFrame:
    """(key, inner, print): each distinct print under every key it is to be compared in."""
    keyed = materialise(prints.select(F.explode(_pair_keys(F.col("print"))).alias("key"), "print"), "buckets")
    hot = keyed.groupBy("key").count().filter(F.col("count") > full).select("key", F.lit(True).alias("hot"))
    inner = F.when(F.col("hot"), _open_keys(F.col("key"), F.col("print"))).otherwise(F.array(F.lit(0).cast("long")))
    return keyed.join(hot, "key", "left").select("key", F.explode(inner).alias("inner"), "print")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected binary Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (jump := root[root]).tobytes() != root.tobytes():
            root = jump
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def near_links(group: np.ndarray, prints: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Links (print, print) that span all pairs within ``limit`` bits in the same group.

    ``group`` numbers the bucket of each print.
    """
    order = np.lexsort((gray_rank(prints), group))
    group, prints = group[order], prints[order]
    ones, anys, owner = [prints], [prints], [group]
    firsts = [np.arange(len(prints))]
    spans = [np.stack([np.arange(len(prints)), np.arange(len(prints)) + 1])]
    while len(owner[-1]) > len(np.unique(owner[-1])):
        own = owner[-1]
        new = np.concatenate([[True], own[1:] != own[:-1]])
        begins = np.flatnonzero(new)
        inside = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
        heads = np.flatnonzero(inside % FANOUT == 0)
        spans.append(np.stack([heads, np.append(heads[1:], len(own))]))
        ones.append(np.bitwise_and.reduceat(ones[-1], heads))
        anys.append(np.bitwise_or.reduceat(anys[-1], heads))
        owner.append(own[heads])
        firsts.append(firsts[-1][heads])
    top = len(owner) - 1
    links_a, links_b = [], []
    root = np.arange(len(prints))
    every = np.arange(len(owner[top]))
    stack = [(top, every, every)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        one_a, one_b, any_a, any_b = ones[level][a], ones[level][b], anys[level][a], anys[level][b]
        least = np.bitwise_count((one_a & ~any_b) | (one_b & ~any_a))
        near = least <= limit
        most = np.bitwise_count((one_a & one_b) ^ (any_a | any_b))
        whole = near & (most <= limit)
        if level == 0:
            apart = near & (a != b)
            links_a.append(a[apart])
            links_b.append(b[apart])
        else:
            # everything below the two nodes is within the limit: tie it to the first below a
            for node in (a, b):
                at, head = node[whole], firsts[level][a[whole]]
                last = np.append(firsts[level], len(prints))[at + 1]
                n = last - firsts[level][at]
                links_a.append(np.repeat(head, n))
                links_b.append(np.repeat(firsts[level][at], n) + _counted(n))
            go = near & ~whole
            a, b = a[go], b[go]
            if len(a):
                stack.append((level - 1, *_children(spans[level], a, b)))
        if sum(map(len, links_a)) > FRONTIER:
            root, links_a, links_b = _roots_on(root, links_a, links_b), [], []
    root = _roots_on(root, links_a, links_b)
    tied = np.flatnonzero(root != np.arange(len(prints)))
    return prints[tied], prints[root[tied]]


def _counted(n: np.ndarray) -> np.ndarray:
    """0 to n[i] - 1 for each i, one after another."""
    total = int(n.sum())
    return np.arange(total) - np.repeat(np.cumsum(n) - n, n)


def _roots_on(root: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Roots after more links, starting from those already known."""
    known = np.flatnonzero(root != np.arange(len(root)))
    return _roots(len(root), np.concatenate([known, *a]).astype(np.int64), np.concatenate([root[known], *b]).astype(np.int64))


def _children(span: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of the node pairs; for a node with itself each pair once."""
    n, m = span[1][a] - span[0][a], span[1][b] - span[0][b]
    both = n * m
    pair = np.repeat(np.arange(len(a)), both)
    at = _counted(both)
    left = span[0][a][pair] + at // m[pair]
    right = span[0][b][pair] + at % m[pair]
    keep = (a != b)[pair] | (left <= right)
    return left[keep], right[keep]


def _search(limit: int, chunk: int = 200_000):
    """Near links of (key, inner, print) rows that come sorted by key and inner."""

    def links(key: np.ndarray, inner: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (inner[1:] != inner[:-1])])
        u, v = near_links(np.cumsum(new), prints.view(np.uint64), limit)
        return pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in rows:
            held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
            if len(held[0]) >= chunk:
                last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
                cut = int(np.argmax(last))
                if cut:
                    yield links(*(h[:cut] for h in held))
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield links(*held)

    return search


def near_components(prints: DataFrame, limit: int = LIMIT, full: int = FULL_BUCKET) -> DataFrame:
    """(node, root) of every print (column print, long) that has another within ``limit`` bits."""
    if not 0 <= limit <= len(BLOCKS) - 2:
        raise ValueError("two of six blocks agree only up to four differing bits")
    dealt = buckets(prints.select("print").distinct(), full)
    sorted_rows = dealt.repartition(parts(prints), "key", "inner").sortWithinPartitions("key", "inner")
    return components(sorted_rows.mapInArrow(_search(limit), "u long, v long"))


def _rooted(printed: DataFrame, limit: int) -> DataFrame:
    """print, root of its component, and lowest id of the rows with this print."""
    nodes = printed.groupBy("print").agg(F.min("doc_id").alias("lowest"))
    tied = materialise(near_components(printed, limit), "components")
    return nodes.join(tied, nodes["print"] == tied["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"), "lowest"
    )


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most ``limit`` differing bits.

    - A null text is empty; texts without words have fingerprint 0 and are linked like others.
    - Rows with equal fingerprints (copies, repeated rows) are linked; they are one node of
      the search, however many they are.
    - A null id keeps its row; it is never a component_id unless no row of the component has one.
    - An empty table gives an empty result; further columns are ignored.
    """
    printed = materialise(fingerprints(docs, id_col, text_col), "prints")
    rooted = _rooted(printed, limit)
    smallest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    classes = rooted.join(smallest, "root").select("print", "component_id")
    return printed.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id.

    Rows are joined to the keepers by id and fingerprint, so an id that repeats keeps no
    row of another component. Rows without an id stay, as nothing says which to prefer.
    """
    at = docs.columns.index(text_col)

    def marked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(x) for x in text_bytes(batch.column(at))], np.uint64)
            return pa.record_batch([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, "__print"])

        return batches(rows, make)

    rooted = _rooted(materialise(fingerprints(docs, id_col, text_col), "prints"), limit)
    leader = F.min(F.struct("lowest", "print")).alias("leader")
    led = rooted.filter(F.col("lowest").isNotNull()).groupBy("root").agg(leader)
    kept = led.select(F.col("leader.lowest").alias(id_col), F.col("leader.print").alias("__print"))
    wide = docs.filter(F.col(id_col).isNotNull()).mapInArrow(marked, T.StructType([*docs.schema.fields, T.StructField("__print", T.LongType())]))
    named = wide.join(kept, [id_col, "__print"], "left_semi").dropDuplicates([id_col, "__print"]).select(*docs.columns)
    return named.union(docs.filter(F.col(id_col).isNull()))
