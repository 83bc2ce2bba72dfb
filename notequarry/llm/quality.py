"""A quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

A text is cut into words, numbers and runs of signs. Its features are the hashed n-grams of
one and two tokens, and of up to three token shapes (case, digits, the sign itself, whether a
word repeats the one before, whether a space lies between). The value of a feature is its
share of the text's tokens, so long and short texts weigh alike. Weights follow the
regularised leader: per-coordinate rates and an L1 bound that keeps them sparse.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notequarry.llm.chars import DIGIT, LETTER, OTHER, Chars, slices, sums
from notequarry.llm.common import columns, id_remainder, mix, text_bytes

BITS = 18
#: Labelled rows learnt from at most, chosen by a hash of the id.
MAX_LABELLED = 20_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
SCALE = 8.0
HELD_OUT = 5
THRESHOLD = 0.3
_STEP = np.uint64(0x9E3779B97F4A7C15)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature numbers of all texts, and where each text's begin.

    Every token has the same number of features, so a text's share of a feature is its count
    divided by the number of entries.
    """
    chars = Chars(texts)
    start, size = chars.runs(chars.kind)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    kind = chars.kind[start]
    lowered = chars.lowered()
    word = chars.hashes(start, size, lowered)
    exact = chars.hashes(start, size)
    raised = lowered != chars.code
    upper = np.add.reduceat(raised.astype(np.int64), np.ravel(np.stack([start, start + size - 1], axis=1)))[::2] + raised[start + size - 1]
    case = np.where(size == 1, raised[start] * 1, np.where(upper >= size, 3, np.where(raised[start], 1, np.where(upper > 0, 2, 0))))
    glued = np.concatenate([[False], start[1:] == start[:-1] + size[:-1]])
    words = np.flatnonzero(kind == LETTER)
    repeat = np.zeros(len(start), bool)
    repeat[words[1:]] = word[words[1:]] == word[words[:-1]]
    shape = np.where(kind == LETTER, case + 4 * repeat, np.where(kind == DIGIT, 8 + np.minimum(size, 4), 16)).astype(np.uint64)
    shape = mix(shape * np.uint64(2) + glued.astype(np.uint64) + np.where(kind == OTHER, exact, np.uint64(0)))
    begins = np.searchsorted(start, chars.text_start)
    first = np.zeros(len(start) + 1, bool)
    first[begins] = True
    first = first[:-1]

    def before(values: np.ndarray) -> np.ndarray:
        """The values of the token before; 1 at the start of a text."""
        return np.where(first, np.uint64(1), np.concatenate([[np.uint64(1)], values[:-1]]))

    two = before(shape)
    rows = [
        word,
        mix(before(word) * _STEP + word),
        shape + np.uint64(3),
        mix(two * _STEP + shape),
        mix((before(two) * _STEP + two) * _STEP + shape),
    ]
    found = (mix(np.stack(rows, axis=1)) >> np.uint64(64 - BITS)).astype(np.int64)
    return found.ravel(), begins * len(rows)


class Ftrl:
    """Follow-the-regularised-leader for logistic loss over 2**BITS weights and a bias."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(weights @ values, -30, 30)))
        g = (p - label) * values
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * weights
        self.n[at] += g * g


def _examples(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, label, at, values): the distinct features of each labelled text."""
    for batch in rows:
        texts = [x.decode("utf-8", "replace") for x in text_bytes(batch.column(2))]
        for a, b in slices(texts):
            found, begins = features(texts[a:b])
            ends = np.append(begins[1:], len(found))
            at, values = [], []
            for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
                key, count = np.unique(found[i:j], return_counts=True)
                at.append(np.append(key, 1 << BITS).astype(np.int32))
                values.append(np.append(count * (SCALE * 5 / max(1, j - i)), 1.0).astype(np.float32))
            yield pa.record_batch(
                [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                ["rank", "label", "at", "values"],
            )


def _train(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights learnt from the examples of one task, in the order of their rank."""
    table = pa.Table.from_batches(list(rows)).combine_chunks() if (rows := list(rows)) else None
    model = Ftrl()
    if table is not None and table.num_rows:
        table = table.sort_by("rank").combine_chunks()
        labels = table.column("label").to_pylist()
        at, values = table.column("at").chunk(0), table.column("values").chunk(0)
        cuts = at.offsets.to_numpy()
        at, values = at.values.to_numpy(), values.values.to_numpy().astype(np.float64)
        for _ in range(EPOCHS):
            for i, label in enumerate(labels):
                own = slice(cuts[i], cuts[i + 1])
                model.learn(at[own], values[own], label)
    yield pa.record_batch([pa.array([model.weights().tolist()], pa.list_(pa.float64()))], ["weights"])


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """Weights from (doc_id, text) rows and (doc_id, label) rows with label 0 or 1.

    At most ``max_labelled`` labelled rows are learnt from; their ids, and no others, are
    broadcast, and one task goes through their features. A row with contradicting labels
    counts as 0.
    """
    known = labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    ranked = known.groupBy("doc_id").agg(F.min("label").alias("label")).withColumn("rank", F.xxhash64(F.lit("quality"), "doc_id"))
    chosen = ranked.orderBy("rank", "doc_id").limit(max_labelled)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("rank", F.col("label").cast("int").alias("label"), "text")
    made = rows.mapInArrow(_examples, "rank long, label int, at array<int>, values array<float>")
    found = made.repartition(1).mapInArrow(_train, "weights array<double>").first()
    return np.array(found["weights"]) if found else Ftrl().weights()


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row: a sparse dot product of each text with the weights.

    A null, empty or blank text has the score of the bias alone.
    """
    held = docs.sparkSession.sparkContext.broadcast(weights)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in rows:
            texts = [x.decode("utf-8", "replace") for x in text_bytes(batch.column(1))]
            for a, b in slices(texts):
                found, begins = features(texts[a:b])
                size = np.diff(np.append(begins, len(found)))
                dot = sums(own[found], begins) * (SCALE * 5 / np.maximum(size, 1)) + own[-1]
                made = 1 / (1 + np.exp(-np.clip(dot, -30, 30)))
                yield pa.record_batch([batch.column(0)[a:b], pa.array(made)], ["doc_id", "score"])

    narrow = columns(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_remainder(doc_id, HELD_OUT) == 0, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; held-out labels are not learnt from."""
    weights = fit(
        columns(docs, doc_id="doc_id", text="text"),
        columns(labels, doc_id="doc_id", label="quality").filter(~held_out(F.col("doc_id"))),
    )
    return score(docs, weights).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
