"""Hard negatives from a window of scores, searched exactly in a multiway hyperplane tree.

A component more makes all vectors equally long, so that a window of inner products with an
anchor is an annulus of distances around it. The tree parts the vectors by their nearest of
several split points, level by level. Every split point keeps, for each subtree beside it, the
smallest and largest distance to the vectors there; a subtree goes if for one split point
that range does not meet the distances the annulus allows. What is left in the leaves is
scored exactly, in whole numbers.

The split points come from a bounded sample; all vectors are dealt to the leaves and all
distances are in the ranges, so that nothing is missed however the sample falls. Leaves are
searched in three turns of growing size; after each turn an annulus reaches no further than
the last of the best rows found so far, so that few rows more than the answer leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notequarry.llm.common import apart, narrowed, parts, widened
from notequarry.llm.top_k import products
from notequarry.plans.lookup_table import never_sent_whole
from notequarry.session import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Shares of the positive's score, in percent, between which a negative's score lies.
LOW, HIGH = 30, 90
#: Vectors whose distances shape the tree, split points of a node, vectors of a sample's leaf.
SAMPLE, FANOUT, SMALL = 2048, 16, 8
#: Rows of a block of anchors and of a block of vectors, and blocks of a lane.
ANCHOR_BLOCK, VECTOR_BLOCK, LANE_BLOCKS = 256, 1024, 64
#: Distances this close (as a share of the largest) count as met.
SLACK = 1e-9
FAR = 2**62


@dataclass
class Node:
    points: np.ndarray
    #: node numbers, or -1 - leaf
    children: list[int] = field(default_factory=list)
    #: smallest and largest distance of each split point (row) to each subtree (column)
    least: np.ndarray | None = None
    most: np.ndarray | None = None


@dataclass
class Tree:
    """``length`` is the squared length that every vector is brought to."""

    length: float
    nodes: list[Node] = field(default_factory=list)
    #: for each leaf the (node, child) pairs from the root down
    paths: list[list[tuple[int, int]]] = field(default_factory=list)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """The vectors with one more component, all of the same length."""
        rest = np.maximum(0.0, self.length - np.einsum("ij,ij->i", vectors, vectors))
        return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each (not lifted) vector."""
        leaf = np.zeros(len(vectors), np.int64)
        if not self.nodes:
            return leaf
        lifted = self.lifted(vectors)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            number, rows = todo.pop()
            nearest = distances(lifted[rows], self.nodes[number].points).argmin(axis=1)
            for j, child in enumerate(self.nodes[number].children):
                own = rows[nearest == j]
                if child < 0:
                    leaf[own] = -1 - child
                elif len(own):
                    todo.append((child, own))
        return leaf

    def alive(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray, leaf: int) -> np.ndarray:
        """Which annuli (anchor, window) can meet the leaf. Anchors are lifted with 0."""
        kept = inner <= outer
        eps = SLACK * (1.0 + np.sqrt(self.length))
        for number, j in self.paths[leaf] if self.paths else []:
            node = self.nodes[number]
            d = distances(anchors, node.points)
            for i in range(len(node.points)):
                near, far = d[:, i, None] - outer, d[:, i, None] + outer
                low = np.maximum(near, inner - d[:, i, None])
                kept &= (node.most[i, j] >= low - eps) & (node.least[i, j] <= far + eps)
        return kept


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, squared))


def grow(sample: np.ndarray, length: float, fanout: int = FANOUT, small: int = SMALL) -> Tree:
    """The split points of a tree over the sample, each as far as can be from those before it."""
    tree = Tree(length)
    lifted = tree.lifted(sample)

    def build(rows: np.ndarray, path: list[tuple[int, int]]) -> int:
        chosen, nearest = [0], distances(lifted[rows], lifted[rows[:1]])[:, 0]
        while len(rows) > small and len(chosen) < fanout and nearest.max() > 1e-6 * np.sqrt(length):
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(lifted[rows], lifted[rows[chosen[-1:]]])[:, 0])
        if len(chosen) == 1:
            tree.paths.append(path)
            return -len(tree.paths)
        number, node = len(tree.nodes), Node(lifted[rows[chosen]])
        tree.nodes.append(node)
        own = distances(lifted[rows], node.points).argmin(axis=1)
        node.children = [build(rows[own == j], [*path, (number, j)]) for j in range(len(chosen)) if (own == j).any()]
        node.points = node.points[: len(node.children)]
        return number

    if len(sample):
        build(np.arange(len(sample)), [])
    return tree


def _dense(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors filled up with zeros to ``width``."""
    size = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(lists), width))
    made[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """row, id, label, vector of the rows that take part; row numbers are distinct."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), label.alias("label"), vectors[vector_col].alias("vector"))
    double = F.transform("vector", lambda x: x.cast("double"))
    finite = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(double, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    kept = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite)
    return kept.select(F.monotonically_increasing_id().alias("row"), "id", F.xxhash64("label").alias("label"), whole.alias("vector"))


def _routed(rows: DataFrame, tree: Tree, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves(_dense(batch.column(3), width))
            yield pa.record_batch([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    return rows.mapInArrow(run, "row long, id long, label long, vector array<double>, leaf int")


def _set_ranges(routed: DataFrame, tree: Tree, width: int) -> None:
    """Distances of every split point to the subtrees beside it, over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], list[float]] = {}
        for batch in batches:
            leaf = batch.column(1).to_numpy()
            lifted = tree.lifted(_dense(batch.column(0), width))
            for x in np.unique(leaf):
                own = lifted[leaf == x]
                for number, j in tree.paths[x]:
                    d = distances(own, tree.nodes[number].points)
                    for i, (a, b) in enumerate(zip(d.min(0).tolist(), d.max(0).tolist(), strict=True)):
                        held = found.setdefault((number, i, j), [a, b])
                        held[0], held[1] = min(held[0], a), max(held[1], b)
        if found:
            key = np.array(list(found), np.int32)
            made = np.array(list(found.values()))
            columns_of = [*(pa.array(key[:, i]) for i in range(3)), pa.array(made[:, 0]), pa.array(made[:, 1])]
            yield pa.record_batch(columns_of, ["node", "i", "j", "least", "most"])

    for node in tree.nodes:
        n = len(node.points)
        node.least, node.most = np.full((n, n), np.inf), np.full((n, n), -np.inf)
    if tree.nodes:
        seen = routed.select("vector", "leaf").mapInArrow(run, "node int, i int, j int, least double, most double")
        # as many rows as the tree has pairs of split points, whatever the table holds
        for r in seen.groupBy("node", "i", "j").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():
            tree.nodes[r.node].least[r.i, r.j], tree.nodes[r.node].most[r.i, r.j] = r.least, r.most


def _blocks(routed: DataFrame, lanes: np.ndarray, spans: np.ndarray, width: int) -> DataFrame:
    """Blocks of vectors of one leaf each, with their lane. A large leaf has several lanes."""
    listed = F.array(*(F.lit(int(x)) for x in lanes)), F.array(*(F.lit(int(x)) for x in spans))
    at = F.col("leaf") + 1
    lane = F.element_at(listed[0], at) + F.pmod(F.xxhash64("row"), F.element_at(listed[1], at)).cast("int")
    names = ["lane", "leaf", "n", "ids", "rows", "labels", "vectors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [batch.column(c).to_numpy() for c in ("lane", "leaf")]
            edges = [0, *(np.flatnonzero((np.diff(key[0]) != 0) | (np.diff(key[1]) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for at in range(a, b, VECTOR_BLOCK):
                    own = batch.slice(at, min(VECTOR_BLOCK, b - at))
                    raw = [own.column(c).to_numpy().tobytes() for c in ("id", "row", "label")]
                    made = [int(key[0][at]), int(key[1][at]), own.num_rows, *raw, narrowed(_dense(own.column("vector"), width))]
                    yield pa.record_batch([pa.array([x]) for x in made], names)

    dealt = routed.withColumn("lane", lane).repartition("lane").sortWithinPartitions("lane", "leaf", "id", "row")
    made = dealt.mapInArrow(run, "lane long, leaf long, n long, ids binary, rows binary, labels binary, vectors binary")
    return made.withColumn("block", F.monotonically_increasing_id())


def _asked(queries: DataFrame, n_anchors: int, tree: Tree, lane_of: np.ndarray, spans: np.ndarray, width: int, windows: int) -> DataFrame:
    """Blocks of anchors, once for each lane that holds a leaf their annuli can meet."""
    names = ["lane", "q_n", "q_rows", "q_labels", "q_vectors", "q_low", "q_high"]

    def bounds(lists: pa.Array, none: int) -> np.ndarray:
        made = np.full((len(lists), windows), none, np.int64)
        size = np.diff(lists.offsets.to_numpy())
        made[np.arange(windows) < size[:, None]] = lists.flatten().to_numpy()
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ANCHOR_BLOCK):
                own = batch.slice(at, ANCHOR_BLOCK)
                vectors = _dense(own.column("vector"), width)
                low, high = bounds(own.column("low"), FAR), bounds(own.column("high"), -FAR)
                annuli = _annuli(tree, vectors, low, high)
                hit = [leaf for leaf in range(len(lane_of)) if tree.alive(*annuli, leaf).any()]
                lanes = sorted({int(lane_of[x]) + s for x in hit for s in range(int(spans[x]))})
                if lanes:
                    raw = [own.column(c).to_numpy().tobytes() for c in ("row", "label")]
                    made = [own.num_rows, *raw, narrowed(vectors), low.tobytes(), high.tobytes()]
                    for lane in lanes:
                        yield pa.record_batch([pa.array([x]) for x in (lane, *made)], names)

    schema = "lane long, q_n long, q_rows binary, q_labels binary, q_vectors binary, q_low binary, q_high binary"
    # a task for every block or so, as a block is compared with all leaves
    n = max(1, min(parts(queries), n_anchors // ANCHOR_BLOCK))
    ordered = queries.select("row", "label", "vector", "low", "high", "leaf").repartitionByRange(n, "leaf").sortWithinPartitions("leaf")
    return ordered.mapInArrow(run, schema)


def _annuli(tree: Tree, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lifted anchors, and the inner and outer radius of each window; an empty window has none."""
    squared = (vectors * vectors).sum(1)[:, None] + tree.length
    radius = lambda score: np.sqrt(np.maximum(0.0, squared - 2.0 * np.clip(score, -1e300, 1e300)))
    inner, outer = radius(high.astype(float)), radius(low.astype(float))
    outer[low > high] = -1.0
    return np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1), inner, outer


def _scored(tree: Tree, width: int, windows: int, k: int, same: bool):
    """Rows of each pair of blocks that can be among the first k of a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                x = batch.slice(at, 1).to_pylist()[0]
                longs = lambda name, x=x: np.frombuffer(x[name], np.int64)
                asked, rows, ids = longs("q_rows"), longs("rows"), longs("ids")
                anchors = widened(x["q_vectors"], len(asked), width)
                low, high = longs("q_low").reshape(-1, windows), longs("q_high").reshape(-1, windows)
                alive = tree.alive(*_annuli(tree, anchors, low, high), x["leaf"])
                few = np.flatnonzero(alive.any(axis=1))
                if not len(few):
                    continue
                scores = products(anchors[few], widened(x["vectors"], len(ids), width))
                equal = longs("q_labels")[few, None] == longs("labels")[None, :]
                fits = (equal & (asked[few, None] != rows[None, :])) if same else ~equal
                for w in range(windows):
                    met = fits & alive[few, w, None] & (scores >= low[few, w, None]) & (scores <= high[few, w, None])
                    i, j = _first(scores, met, k)
                    if len(i):
                        made = [asked[few[i]], np.full(len(i), w), ids[j], rows[j], scores[i, j]]
                        yield pa.record_batch([pa.array(c.astype(np.int64)) for c in made], ["row", "w", "id", "found", "score"])

    return run


def _first(scores: np.ndarray, met: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each row's k highest scores among the met ones, ties by place; at most k ties more."""
    many = np.flatnonzero(met.sum(axis=1) > k)
    if len(many):
        own = np.where(met[many], scores[many], -(2**63))
        last = np.partition(own, own.shape[1] - k, axis=1)[:, own.shape[1] - k]
        tie = met[many] & (own == last[:, None])
        met = met.copy()
        met[many] &= (own > last[:, None]) | (tie & (np.cumsum(tie, axis=1) <= k))
    return np.nonzero(met)


@dataclass
class Index:
    """All vectors in their leaves; see ``index``."""

    rows: DataFrame
    blocks: DataFrame
    tree: Tree
    lane_of: np.ndarray
    spans: np.ndarray
    width: int
    n_blocks: int

    def search(self, queries: DataFrame, windows: int, k: int, same: bool) -> DataFrame:
        """row, w, id, found, score, nth: the first k rows of every window of every query.

        ``queries`` has row, label, vector, leaf, and arrays low and high of up to
        ``windows`` bounds. Rows with the label of the query are looked for if ``same``, but
        never the query's own row; otherwise those with another.
        """
        if not self.n_blocks:
            none = "row long, w long, id long, found long, score long, nth int"
            return queries.sparkSession.createDataFrame([], none)
        first, second = (max(1, round(self.n_blocks ** (x / 3))) for x in (1, 2))
        drawn = F.pmod(F.xxhash64("block"), F.lit(self.n_blocks))
        turn = F.when(drawn < first, 0).when(drawn < second, 1).otherwise(2)
        order = Window.partitionBy("row", "w").orderBy(F.desc("score"), "id", "found")
        best, asked, n_anchors = None, queries, queries.count()
        for number in range(3):
            sent = _asked(asked, n_anchors, self.tree, self.lane_of, self.spans, self.width, windows)
            met = apart(self.blocks.filter(turn == number)).join(never_sent_whole(apart(sent)), "lane")
            run = _scored(self.tree, self.width, windows, k, same)
            new = met.mapInArrow(run, "row long, w long, id long, found long, score long")
            every = new if best is None else best.drop("nth").union(new)
            best = materialise(every.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k), "best")
            if number < 2:
                floors = best.filter(F.col("nth") == k).groupBy("row").agg(
                    F.map_from_entries(F.collect_list(F.struct(F.col("w").cast("int"), "score"))).alias("floors")
                )
                raised = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.element_at("floors", w), x)))
                asked = queries.join(never_sent_whole(floors), "row", "left").withColumn("low", raised).drop("floors")
        return best


def index(rows: DataFrame, sample: int = SAMPLE) -> Index:
    """Index over the rows of ``whole_vectors``, which must be a stored table.

    The tree is grown over at most ``sample`` vectors, those with the smallest hashes.
    """
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    length, width, n = rows.agg(F.max(squares), F.max(F.size("vector")), F.count("*")).first()
    length, width = float(length or 0.0), max(1, width or 0)
    drawn = rows.select("vector").orderBy(F.xxhash64("id", "row"), "row").limit(sample).toArrow().combine_chunks()
    lists = drawn.column("vector").combine_chunks()
    tree = grow(_dense(lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists, width) if n else np.zeros((0, width)), length)
    routed = materialise(_routed(rows, tree, width), "routed")
    _set_ranges(routed, tree, width)
    counts = np.zeros(max(1, len(tree.paths)), np.int64)
    for r in routed.groupBy("leaf").count().collect():
        counts[r["leaf"]] = r["count"]
    share = max(1, min(LANE_BLOCKS * VECTOR_BLOCK, -(-n // parts(rows))))
    spans = np.maximum(1, -(-counts // share))
    # small leaves beside each other share a lane; a large one has lanes of its own
    before, lanes, filled = np.zeros(len(counts), np.int64), 0, 0
    for x in range(len(counts)):
        if filled and filled + counts[x] > share:
            lanes, filled = lanes + 1, 0
        before[x] = lanes
        filled += int(counts[x])
        if spans[x] > 1:
            lanes, filled = lanes + int(spans[x]), 0
    blocks = materialise(_blocks(routed, before, spans, width), "blocks")
    return Index(routed, blocks, tree, before, spans, width, blocks.count())


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    sample: int = SAMPLE,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on a column ``id``; ``label`` a column or an expression over
    ``vectors``. Scores are inner products of floor(scale * x); higher ones come first, then
    smaller ids. A positive is one of an anchor's first rows of its own label; its negatives
    are the first rows of other labels whose score is ``low`` to ``high`` percent of its own.

    - Rows with a null id, label or vector, or a null or non-finite component take no part.
      An empty vector scores 0; the shorter of two vectors counts as filled up with zeros.
    - An anchor's own row is not its positive; other rows with its id can be. Repeated rows
      are rows of their own, and an anchor given twice has its answers twice.
    - A positive with a negative score, or without rows in its window, has no answer.
    - Further columns are not read. An empty table gives no rows.
    """
    label = vectors[label] if isinstance(label, str) else label
    rows = materialise(whole_vectors(vectors, id_col, vector_col, label, scale), "vectors")
    found = index(rows, sample)
    anchors = materialise(found.rows.filter(is_anchor), "anchors")
    one = lambda x: F.array(F.lit(x).cast("long"))
    near = found.search(anchors.withColumn("low", one(-FAR)).withColumn("high", one(FAR)), 1, positives, True)
    share = lambda percent, up: f"cast((cast(score as decimal(20,0)) * {percent} + {up}) div 100 as bigint)"
    pairs = near.filter(F.col("score") >= 0).select(
        "row",
        F.col("nth").alias("p"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.expr(share(low, 99)).alias("low"),
        F.expr(share(high, 0)).alias("high"),
    )
    # windows stand in the order of the positives, which are numbered without gaps
    bounds = pairs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("p", "low", "high"))).alias("bounds"))
    asked = anchors.join(never_sent_whole(bounds), "row").select(
        *anchors.columns, F.col("bounds.low").alias("low"), F.col("bounds.high").alias("high")
    )
    far = found.search(materialise(asked, "windows"), positives, negatives, False)
    answers = far.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
    answers = answers.withColumn("p", (F.col("w") + 1).cast("int"))
    named = anchors.select("row", F.col("id").alias("anchor_id"))
    met = answers.join(never_sent_whole(pairs.drop("low", "high")), ["row", "p"])
    return met.join(never_sent_whole(named), "row").select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
