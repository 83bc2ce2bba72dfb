"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a byte-context trie of order five, trained on the training documents. A node
is a context of up to five bytes; it knows how often it was met, by which bytes it was
followed, and how often its shorter context was followed by those same bytes. A byte that
never followed a context escapes to the next shorter one (as in method D, each byte that
was seen gives a fixed part of a count to the escape). The shorter context then leaves out
the bytes the longer one would have predicted (symbol exclusion). Every byte seen after a
context was also seen after its suffixes, so what is excluded is a single sum for each node.

Counts and scores travel in blocks. A block of some 32 MB of text is reduced to its distinct
six-byte strings (context and next byte) and words, once each; those are dealt out by hash,
summed over all blocks, turned into scores with joins over the trie, and handed back to the
block, which adds them up for each of its documents. Neither the trie nor the word counts
are ever held by one task or broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from notequarry.llm.common import LOWER, columns, id_remainder, mix, parts, text_bytes
from notequarry.session import materialise

ORDER = 5
PAD = b"\n" * ORDER
BLOCK_BYTES = 32_000_000
SEGMENT_BYTES = 4_000_000
CHUNK_BYTES = 1_000_000
#: Key of the end of a text among the words; no word hashes to it but by chance.
END = np.uint64(0x0123456789ABCDEF)
GRAM, WORD = 0, 1
HELD_OUT = 10
#: Part of a count that each byte seen after a context gives to the escape from it.
ESCAPE = 0.25

PACKED = "block string, kind int, shard int, keys binary, values binary"
CHUNKS = "block string, ids array<{id}>, held array<boolean>, sizes array<long>, texts binary"


def segments(text: bytes) -> list[bytes]:
    """A text as the model codes it: words joined by one space, and an end (a line break).

    Each segment begins with the five bytes before it, which are context only.
    """
    words = text.translate(LOWER).split()
    if len(text) <= SEGMENT_BYTES:
        return [PAD + b" ".join(words) + b"\n"]
    found, tail, held, size = [], PAD, [], 0
    for word in words:
        held.append(word)
        size += len(word) + 1
        if size >= SEGMENT_BYTES:
            found.append(tail + b" ".join(held) + b" ")
            tail, held, size = found[-1][-ORDER:], [], 0
    if held or not found:
        found.append(tail + b" ".join(held) + b"\n")
    else:  # the space after the last word was none
        found[-1] = found[-1][:-1] + b"\n"
    return found


class Stream:
    """Segments of several texts in one byte array, with their strings and words as numbers."""

    def __init__(self, texts: list[bytes]):
        split = [segments(t) for t in texts]
        flat = [s for parts_ in split for s in parts_]
        self.raw = np.frombuffer(b"".join(flat), np.uint8)
        lengths = np.fromiter(map(len, flat), np.int64, len(flat))
        self.end = np.cumsum(lengths)
        self.start = self.end - lengths
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in split])])  # segments of each text

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """The string ending at each coded byte, and where each segment begins among them."""
        found = np.zeros(max(0, len(self.raw) - ORDER), np.uint64)
        for j in range(ORDER + 1):
            found <<= np.uint64(8)
            found |= self.raw[j : len(found) + j]
        inner = np.ones(len(found), bool)
        for j in range(1, ORDER + 1):  # those that reach into the next segment
            inner[self.end[:-1] - j] = False
        return found[inner], self.start - ORDER * np.arange(len(self.start))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash of every word, and where the words of each segment begin."""
        raw = self.raw
        if (self.raw[self.start] != 10).any():  # context of a later segment is no word
            raw = raw.copy()
            for j in range(ORDER):
                raw[self.start + j] = 10
        inside = (raw != 32) & (raw != 10)
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        start, size = edge[0::2], edge[1::2] - edge[0::2]
        begins = np.searchsorted(start, self.start)
        if not len(start):
            return np.zeros(0, np.uint64), begins
        at = np.flatnonzero(inside)
        powers = np.cumprod(np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64))
        values = mix(raw[at].astype(np.uint64) + np.uint64(1)) * powers[at - np.repeat(start, size)]
        return mix(np.add.reduceat(values, np.concatenate([[0], np.cumsum(size)[:-1]]))), begins


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _summed(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several (keys, counts), with their sums."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in pairs)])
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in pairs)])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(counts, heads)


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _opened(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart, which compress well."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _squeezed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _open_keys(data: bytes) -> np.ndarray:
    planes = _opened(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _runs(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _blocks(shards: int, id_kind: pa.DataType):
    """Rows of both kinds for each block: its texts in chunks, and its keys with training counts."""

    def rows_of(block, counts) -> Iterator[list]:
        for kind, pairs in counts.items():
            keys, n = _summed(pairs)
            shard = (mix(keys) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            keys, n, shard = keys[order], n[order], shard[order]
            cuts = np.searchsorted(shard, np.arange(shards + 1))
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[i], cuts[i + 1])
                yield [block, kind, i, _pack_keys(keys[part]), _squeezed(n[part]), None, None, None, None]

    def batch(rows: list[list]) -> pa.RecordBatch:
        kinds = (
            pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(),
            pa.list_(id_kind), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(),
        )
        names = ["block", "kind", "shard", "keys", "values", "ids", "held", "sizes", "texts"]
        made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.record_batch(made, names)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, counts = uuid.uuid4().hex, 0, {GRAM: [], WORD: []}
        for got in rows:
            ids, held, texts = got.column(0).to_pylist(), got.column(1).to_pylist(), text_bytes(got.column(2))
            for a, b in _runs(texts, CHUNK_BYTES):
                part, out = texts[a:b], held[a:b]
                for own, n in ((False, 1), (True, 0)):
                    chosen = [t for t, h in zip(part, out, strict=True) if h == own]
                    if not chosen:
                        continue
                    stream = Stream(chosen)
                    ends = (np.array([END]), np.array([len(chosen)]))
                    for kind, found in ((GRAM, [_counted(stream.grams()[0])]), (WORD, [_counted(stream.words()[0]), ends])):
                        counts[kind] += [(k, c * n) for k, c in found]
                for kind in counts:
                    if len(counts[kind]) > 8:
                        counts[kind] = [_summed(counts[kind])]
                yield batch([[block, None, None, None, None, ids[a:b], out, [*map(len, part)], zstandard.compress(b"".join(part), 1)]])
                size += sum(map(len, part))
                if size >= BLOCK_BYTES:
                    for row in rows_of(block, counts):
                        yield batch([row])
                    block, size, counts = uuid.uuid4().hex, 0, {GRAM: [], WORD: []}
        for row in rows_of(block, counts):
            yield batch([row])

    return run


def _totals(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over all blocks of the keys of the shards in one task."""
    held: dict[tuple[int, int], list] = {}
    for batch in rows:
        for kind, shard, keys, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs = held.setdefault((kind, shard), [])
            pairs.append((_open_keys(keys), _opened(values)))
            if len(pairs) > 32:
                held[kind, shard] = [_summed(pairs)]
    for (kind, shard), pairs in held.items():
        keys, n = _summed(pairs)
        for a in range(0, len(keys), 100_000):
            k = keys[a : a + 100_000]
            same = [pa.array(np.full(len(k), x, np.int32)) for x in (kind, shard)]
            yield pa.record_batch([*same, pa.array(k.view(np.int64)), pa.array(n[a : a + 100_000])], ["kind", "shard", "key", "n"])


def trie(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie from (key, n) rows of strings of ORDER + 1 bytes.

    Returns edges (order, gram, n): how often a context of ``order`` bytes was followed by a
    byte; and contexts (order, context, total, kinds, excluded): ``excluded`` is how often the
    next shorter context was followed by the bytes seen after this one.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("order")
    tail = F.expr("key & (shiftleft(1L, 8 * (`order` + 1)) - 1)")
    edges = grams.select("key", "n", levels).groupBy("order", tail.alias("gram")).agg(F.sum("n").alias("n"))
    edges = materialise(edges, "edges")
    shorter = edges.select((F.col("order") + 1).alias("order"), F.col("gram").alias("suffix"), F.col("n").alias("below"))
    suffix = F.expr("gram & (shiftleft(1L, 8 * `order`) - 1)")
    joined = edges.withColumn("suffix", suffix).join(shorter, ["order", "suffix"], "left")
    contexts = joined.groupBy("order", F.shiftright("gram", 8).alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum(F.coalesce("below", F.lit(0))).alias("excluded")
    )
    return edges, materialise(contexts, "contexts")


def gram_scores(grams: DataFrame) -> DataFrame:
    """log10 probability of the last byte of every string in ``grams`` (shard, key, n) after the others.

    ``n`` is the training count, 0 for strings seen only in other texts.
    """
    edges, contexts = trie(grams.filter("n > 0").select("key", "n"))
    # seen in training: answered by the longest context at once
    top = contexts.filter(F.col("order") == ORDER).select("context", "total")
    seen = grams.filter("n > 0").withColumn("context", F.shiftright("key", 8)).join(top, "context")
    seen = seen.select("shard", "key", F.log10((F.col("n") - ESCAPE) / F.col("total")).alias("score"))
    # not seen: one row for each order, then a walk from the longest context to the shortest
    asked = grams.filter("n = 0").select("shard", "key", F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("order"))
    asked = asked.withColumn("gram", F.expr("key & (shiftleft(1L, 8 * (`order` + 1)) - 1)"))
    asked = asked.withColumn("context", F.shiftright("gram", 8))
    found = asked.join(edges, ["order", "gram"], "left").join(contexts, ["order", "context"], "left")
    step = F.struct((-F.col("order")).alias("o"), "n", "total", "kinds", "excluded")
    walks = found.groupBy("shard", "key").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return seen.union(walks.select("shard", "key", _walk(F.col("steps")).alias("score")))


def _walk(steps: Column) -> Column:
    number = lambda x: F.lit(float(x))
    start = F.struct(
        number(0).alias("score"), number(0).alias("out"), number(0).alias("out_kinds"), F.lit(False).alias("done")
    )

    def go(state: Column, x: Column) -> Column:
        total, kinds = x["total"] - state["out"], x["kinds"] - state["out_kinds"]
        known = ~state["done"] & x["total"].isNotNull()
        hit = known & x["n"].isNotNull()
        escape = F.when(total > 0, F.log10(ESCAPE * kinds / total)).otherwise(number(0))
        last = F.log10(1.0 / F.greatest(number(1), 256.0 - x["kinds"]))
        missed = state["score"] + escape + F.when(x["o"] == 0, last).otherwise(number(0))
        score = F.when(hit, state["score"] + F.log10((x["n"] - ESCAPE) / total)).when(known, missed).otherwise(state["score"])
        return F.struct(
            score.alias("score"),
            F.when(known, x["excluded"].cast("double")).otherwise(state["out"]).alias("out"),
            F.when(known, x["kinds"].cast("double")).otherwise(state["out_kinds"]).alias("out_kinds"),
            (state["done"] | hit).alias("done"),
        )

    # without any training text every byte is as likely as the others
    walked = F.aggregate(steps, start, go)["score"]
    empty = ~F.exists(steps, lambda x: x["total"].isNotNull())
    return F.when(empty, F.lit(float(np.log10(1 / 256)))).otherwise(walked)


def _hand_back(key, packed: pa.Table, scored: pa.Table) -> pa.Table:
    """The values of a shard's keys, in the order in which each block packed them."""
    keys, values = scored.column("key").to_numpy().view(np.uint64), scored.column("value").to_numpy()
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    out = [_squeezed(values[np.searchsorted(keys, _open_keys(x))]) for x in packed.column("keys").to_pylist()]
    names = ["block", "kind", "shard", "keys"]
    return pa.table([*(packed.column(n) for n in names), pa.array(out, pa.binary())], names=[*names, "values"])


class Lookup:
    """Values by 64-bit key in an open-addressing table; all keys asked for must be there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.shift = np.uint64(64 - bits)
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        steps = np.arange(len(keys))
        at = np.maximum.accumulate(slot[order] - steps) + steps if len(keys) else steps
        self.keys = np.zeros((1 << bits) + len(keys) + 1, np.uint64)
        self.values = np.zeros(len(self.keys))
        self.keys[at], self.values[at] = keys[order], values[order]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        wrong = np.flatnonzero(self.keys[at] != keys)
        while len(wrong):
            at[wrong] += 1
            wrong = wrong[self.keys[at[wrong]] != keys[wrong]]
        return self.values[at]


def _add_up(id_kind: pa.DataType, tokens: int, kinds: int):
    """Scores of the documents of one block from its chunks and the values of its keys."""

    def run(key, chunks: pa.Table, valued: pa.Table) -> pa.Table:
        found = {}
        for kind in (GRAM, WORD):
            rows = [(k, v) for i, k, v in zip(*(valued.column(c).to_pylist() for c in ("kind", "keys", "values")), strict=True) if i == kind]
            keys = np.concatenate([np.zeros(0, np.uint64), *(_open_keys(k) for k, _ in rows)])
            found[kind] = Lookup(keys, np.concatenate([np.zeros(0), *(_opened(v, np.float64) for _, v in rows)]))
        ids, held, columns_ = [], [], []
        for i, h, sizes, texts in zip(*(chunks.column(c).to_pylist() for c in ("ids", "held", "sizes", "texts")), strict=True):
            raw, at, part = zstandard.decompress(texts), 0, []
            for size in sizes:
                part.append(raw[at : at + size])
                at += size
            ids += i
            held += h
            columns_.append(_score_texts(part, found, tokens, kinds))
        n_tokens, n_known, base, score = (np.concatenate(x) for x in zip(*columns_, strict=True))
        same = pa.array(np.full(len(ids), tokens, np.int64))
        made = [pa.array(ids, id_kind), pa.array(held, pa.bool_()), *map(pa.array, (n_tokens, n_known)), same, *map(pa.array, (base, score))]
        return pa.table(made, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _score_texts(texts, found, tokens, kinds):
    stream = Stream(texts)
    grams, begins = stream.grams()
    score = np.add.reduceat(found[GRAM][grams], begins)
    hashes, starts = stream.words()
    counts = np.append(found[WORD][hashes], 0.0)  # one more, for segments without words at the end
    floor = tokens + 0.1 * (kinds + 1)
    logs = np.log10((counts + 0.1) / floor)
    logs[-1] = 0
    size = np.diff(np.append(starts, len(hashes)))
    base = np.where(size > 0, np.add.reduceat(logs, starts), 0)
    known = np.where(size > 0, np.add.reduceat((counts > 0).astype(np.int64), starts), 0)
    by_text = stream.first[:-1]
    base, known, size, score = (np.add.reduceat(x, by_text) for x in (base, known, size, score))
    end = found[WORD][np.array([END])][0]
    return size + 1, known + int(end > 0), base + np.log10((end + 0.1) / floor), score


def score_documents(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` marks rows the model must not learn from; by default one in ten, by the
    checksum of the id. base_score is a unigram model over words and an end, for comparison.

    - A null or empty text is its end alone. A null id is never held out.
    - Repeated rows count as often as they occur, and each has its row.
    - Without training rows every byte costs log10(256), and base_score counts all as unknown.
    - Words are told apart by a 64-bit hash.
    """
    own = columns(docs, doc_id=id_col, text=text_col)
    if held_out is None:
        held_out = F.coalesce(id_remainder(F.col("doc_id"), HELD_OUT) == 0, F.lit(False))
    marked = own.select("doc_id", held_out.alias("held"), "text")
    id_type = own.schema["doc_id"].dataType
    id_kind = to_arrow_type(id_type)
    schema = f"{PACKED}, {CHUNKS.format(id=id_type.simpleString()).split(', ', 1)[1]}"
    table = materialise(marked.mapInArrow(_blocks(parts(docs), id_kind), schema), "blocks")
    packed = table.filter(F.col("keys").isNotNull()).select("block", "kind", "shard", "keys", "values")
    chunks = table.filter(F.col("texts").isNotNull()).select("block", "ids", "held", "sizes", "texts")

    dealt = packed.select("kind", "shard", "keys", "values").repartition(parts(docs), "shard")
    totals = materialise(dealt.mapInArrow(_totals, "kind int, shard int, key long, n long"), "totals")
    words = totals.filter(F.col("kind") == WORD)
    sums = words.agg(F.sum("n").alias("tokens"), F.sum((F.col("n") > 0).cast("long")).alias("kinds")).first()
    tokens, kinds = sums["tokens"] or 0, sums["kinds"] or 0
    scored = gram_scores(totals.filter(F.col("kind") == GRAM)).withColumn("kind", F.lit(GRAM))
    valued = scored.select("kind", "shard", "key", F.col("score").alias("value")).union(
        words.select("kind", "shard", "key", F.col("n").cast("double"))
    )
    back = (
        packed.groupBy("kind", "shard")
        .cogroup(valued.groupBy("kind", "shard"))
        .applyInArrow(_hand_back, PACKED)
    )
    made = (
        f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double"
    )
    return chunks.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_add_up(id_kind, tokens, kinds), made)
