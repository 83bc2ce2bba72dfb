"""Exact top-k inner-product search by distributed histogram selection.

Every query is scored against every vector, block by block, in each of a few passes. A pass
only counts: for each query a histogram of the scores over the interval that is known to
hold its k-th best score. The counts of all blocks are summed, the bin with the k-th best
is found, and its bounds are the next pass's interval, until it is one value wide. The last
pass keeps the scores at or above that value, and ties at the value itself by smaller id.
Only counts and final rows are shuffled, never scores, and nothing is pruned by guesswork.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notequarry.llm.common import apart, columns, narrowed, parts, widened
from notequarry.plans.lookup_table import never_sent_whole
from notequarry.session import materialise

K = 10
SCALE = 1024
#: Bins of a pass; an interval shrinks by this factor each time.
BINS = 4096
#: Vectors of a block of queries and of a block of candidates.
QUERY_BLOCK, VECTOR_BLOCK = 256, 1024
#: Products are exact in doubles up to here; larger ones are summed as Python integers.
EXACT = 2**53
#: Lower bound of a query without candidates.
NOTHING = 2**62


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, vector) with floor(scale * x) of every component; unusable vectors are left out.

    Vectors that are null, empty, or hold a null or non-finite component take no part, and
    neither do rows with a null id.
    """
    rows = columns(vectors, id=id_col, vector=vector_col).filter(F.col("id").isNotNull() & (F.size("vector") > 0))
    as_double = F.transform("vector", lambda x: x.cast("double"))
    finite = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    floored = F.transform(as_double, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    return rows.filter(finite).select(F.col("id").cast("long").alias("id"), floored.alias("vector"))


def _matrix(batch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, filled up with zeros to the same length."""
    ids = np.concatenate([np.zeros(0, np.int64), *(c.to_numpy() for c in batch.column("id").chunks)])
    lists = batch.column("vector").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(ids), int(size.max()) if len(size) else 0))
    made[np.arange(made.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return ids, made


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers, as exact 64-bit integers.

    Values beyond 64 bits are held at its ends.
    """
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if top < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in a.tolist()]
    other = [[int(x) for x in row] for row in b.tolist()]
    low, high = -(2**63), 2**63 - 1
    return np.array([[max(low, min(high, sum(map(int.__mul__, x, y)))) for y in other] for x in whole], np.int64).reshape(len(a), len(b))


def _packed(rows: DataFrame, block: int, name: str) -> DataFrame:
    """Blocks of at most ``block`` vectors in one row each: ``name``, ids, vectors one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                ids, made = _matrix(pa.Table.from_batches([batch.slice(at, block)]))
                if len(ids):
                    yield pa.record_batch(
                        [pa.array([ids.tobytes()]), pa.array([made.shape[1]], pa.int32()), pa.array([narrowed(made)])],
                        ["ids", "width", "vectors"],
                    )

    return rows.mapInArrow(run, "ids binary, width int, vectors binary").withColumn(name, F.monotonically_increasing_id())


def _opened(ids: bytes, width: int, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, widened(vectors, len(found), width)


def _met(queries: DataFrame, blocks: DataFrame, lanes: int) -> DataFrame:
    """Every block of queries beside every block of vectors.

    Blocks of vectors are dealt out over ``lanes``; each block of queries is sent to every
    lane once, and meets the lane's blocks there by a merge join on its number. Spark would guess
    the width of what is sent from the queries alone, without the lanes, and broadcast it all;
    and it would put lanes of few bytes into one task, though each is a lot of work.
    """
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    sent = queries.select(*(F.col(c).alias(f"q_{c}") for c in queries.columns), lane)
    dealt = blocks.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).drop("block")
    return apart(dealt).join(never_sent_whole(apart(sent)), "lane").drop("lane")


def _scored(batches: Iterator[pa.RecordBatch]):
    """For each pair of blocks: number of the query block, query and candidate ids, the lowest
    score asked for by each query, scores, and which pairs count (its own row does not)."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            q, a = _opened(row["q_ids"], row["q_width"], row["q_vectors"])
            c, b = _opened(row["ids"], row["width"], row["vectors"])
            low = np.frombuffer(row["q_low"], np.int64)
            yield row["q_block"], q, c, low, products(a, b), q[:, None] != c[None, :]


def _histograms(k: int, width: int):
    """(block, query, start, n): counts of one pass, for bins that can hold the k-th best score.

    Of each block only the bins down to its own k-th best are sent: those below cannot hold
    the k-th best of all, as this block alone has k above them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, q, _, low, scores, valid in _scored(batches):
            off = np.minimum((scores - low[:, None]) // width, BINS)  # BINS: above the interval
            bins = np.where(valid & (scores >= low[:, None]), off, -1) + 1
            n = BINS + 2
            flat = (np.arange(len(q))[:, None] * n + bins).ravel()
            counts = np.bincount(flat, minlength=len(q) * n).reshape(len(q), n)[:, 1:]
            above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            sent = (counts > 0) & (above < k)
            i, j = np.nonzero(sent)
            if len(i):
                made = [np.full(len(i), block), q[i], low[i] + j * width, counts[sent]]
                yield pa.record_batch([pa.array(x.astype(np.int64)) for x in made], ["block", "query", "start", "n"])

    return run


def _kept(k: int):
    """(query_id, vec_id, score): scores above the k-th best, and of those equal to it each
    block's k smallest ids, which are all that can be among the final ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, q, c, low, scores, valid in _scored(batches):
            order = np.argsort(c, kind="stable")
            c, scores, valid = c[order], scores[:, order], valid[:, order]
            tie = valid & (scores == low[:, None])
            keep = (valid & (scores > low[:, None])) | (tie & (np.cumsum(tie, axis=1) <= k))
            i, j = np.nonzero(keep)
            if len(i):
                found = [pa.array(q[i]), pa.array(c[j]), pa.array(scores[keep])]
                yield pa.record_batch(found, ["query_id", "vec_id", "score"])

    return run


def _with_lows(queries: DataFrame, lows: DataFrame | None, floor: int) -> DataFrame:
    """Blocks of queries with the lower bound of each query's interval.

    A query without any candidate has no bound; it asks for nothing.
    """
    if lows is None:
        bounds = queries.withColumn("found", F.array().cast("array<struct<query:bigint,low:bigint>>"))
    else:
        packed = lows.groupBy("block").agg(F.collect_list(F.struct("query", "low")).alias("found"))
        bounds = queries.join(never_sent_whole(packed), "block", "left")
    other = floor if lows is None else NOTHING

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = []
            for ids, found in zip(batch.column("ids").to_pylist(), batch.column("found").to_pylist(), strict=True):
                own = {x["query"]: x["low"] for x in found or []}
                low.append(np.array([own.get(i, other) for i in np.frombuffer(ids, np.int64).tolist()], np.int64).tobytes())
            kept = [batch.column(c) for c in ("ids", "width", "vectors", "block")]
            yield pa.record_batch([*kept, pa.array(low, pa.binary())], ["ids", "width", "vectors", "block", "low"])

    # the last column is added in Python, as bounds must stand in the order of the ids
    return bounds.mapInArrow(put, "ids binary, width int, vectors binary, block long, low binary")


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """The k best vectors of every query row: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on a column ``id``. Scores are inner products of the scaled
    whole-number vectors; ties go to the smaller id.

    - A query's own row is no candidate; other rows with the same id are not either.
    - Rows repeating a query's id are one query, by the smallest of their vectors. A
      candidate given twice counts twice.
    - With fewer than k candidates all are returned; without any, the query has no row.
    - Vectors of different lengths are compared over the shorter one.
    """
    rows = materialise(whole_vectors(vectors, id_col, vector_col, scale), "vectors")
    asked = rows.filter(is_query).groupBy("id").agg(F.min("vector").alias("vector"))
    queries = materialise(_packed(asked, QUERY_BLOCK, "block"), "queries")
    blocks = materialise(_packed(rows, VECTOR_BLOCK, "block"), "blocks")
    lanes = parts(vectors)
    # all scores lie in what the largest component and length allow
    top = rows.agg(F.max(F.array_max(F.transform("vector", F.abs))), F.max(F.size("vector"))).first()
    reach = min(2**61, int(top[0] or 0) ** 2 * (top[1] or 0)) + 1
    width, lows = -(-2 * reach // BINS), None
    while True:
        met = _met(_with_lows(queries, lows, -reach), blocks, lanes)
        counts = met.mapInArrow(_histograms(k, width), "block long, query long, start long, n long")
        counts = counts.groupBy("block", "query", "start").agg(F.sum("n").alias("n"))
        own = Window.partitionBy("block", "query")
        upto = F.sum("n").over(own.orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, 0))
        # the bin of the k-th best; of the last there is, if there are fewer than k
        reached = counts.withColumn("upto", upto).withColumn("all", F.sum("n").over(own))
        reached = reached.filter(F.col("upto") >= F.least(F.lit(k), F.col("all")))
        lows = materialise(reached.groupBy("block", "query").agg(F.max("start").alias("low")), "lows")
        if width == 1:
            break
        width = -(-width // BINS)
    best = _met(_with_lows(queries, lows, NOTHING), blocks, lanes).mapInArrow(_kept(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
