"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Documents become pieces of at most one sequence. Partitions pack their own pieces, longest
first, each into the fullest bin with room. Bins that are nearly full leave at once; the
others go up a tree as items of their own: at every level the underfull bins of several
partitions meet and are packed into each other in the same way, and what counts as nearly
full is relaxed. A bin whose room is less than the smallest bin still open leaves too. A bin
carries its pieces along, so no join is needed and nothing but bounded bins moves. The tree
narrows only as far as a task's share of pieces stays bounded: where many bins are left that
fit no other, it ends at several nodes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notequarry.llm.common import columns
from notequarry.session import materialise

CAPACITY = 4096
END_ID = 1
#: Pieces that one partition packs in the first round, and partitions that meet in the next;
#: later rounds deal out at most the product of both to a partition.
NODE_PIECES = 20_000
BRANCHES = 8
#: A tree that can hardly narrow ends when a round merges less than this share of its bins.
LEAST_GAIN = 0.02
#: Share of the capacity from which a bin leaves, in the first, second and later rounds.
NEARLY_FULL = (0.99, 0.95, 0.85)
#: Word parts a tokenizer remembers; beyond them it starts anew.
REMEMBERED = 700_000
#: Bytes of text that are looked up together; a longer text is taken whole.
SLICE = 4 << 20
#: Words of letters that lower-casing and composition treat one by one, with signs after them.
#: The splitting pattern parts the two, and both are looked up by themselves.
PLAIN = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-įĲ-ň]+)(?P<signs>[.,!?;:*#$%&|)(\"]*)$"
MARK = "#"

_TOKENIZERS: dict[str, WordTokenizer] = {}


class WordTokenizer:
    """Ids of whole texts by the tokenizers library, with the word parts seen lately remembered.

    The vocabulary's splitting pattern drops white space and looks at no context across it,
    so the ids of a text are those of its words, one after another. Only the distinct parts
    of many texts' words are looked up; all else is arrays.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        #: number of each part, and the ids of part i at start[i] to start[i] + size[i]
        self.parts: dict[bytes, int] = {b"": 0}
        self.start, self.size, self.flat = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin and end."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        number = self._numbers(words.dictionary)[words.indices.to_numpy()].ravel()
        size = self.size[number]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.start[number] - ends + size, size)]
        # two parts a word, and as many words a text as its list is long
        last = 2 * np.cumsum(np.append(0, np.diff(split.offsets.to_numpy())))
        return ids, np.append(0, ends)[last]

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of the two parts of each word; a word that is not plain is one part."""
        plain = pc.extract_regex(words, PLAIN)
        first = pc.coalesce(pc.utf8_lower(pc.struct_field(plain, "letters")), words)
        both = pa.concat_arrays([first, pc.fill_null(pc.struct_field(plain, "signs"), "")]).dictionary_encode()
        wanted = both.dictionary.cast(pa.binary()).to_pylist()
        new = [x for x in wanted if x not in self.parts]
        if len(self.parts) + len(new) > REMEMBERED:
            self._forget()
            new = [x for x in wanted if x]
        self._learn(new)
        number = np.fromiter(map(self.parts.__getitem__, wanted), np.int64, len(wanted))
        return number[both.indices.to_numpy()].reshape(2, -1).T

    def _learn(self, new: list[bytes]) -> None:
        """Ids of parts not met before; many of them share a call, told apart by a sign between."""
        joined = [x for x in new if MARK.encode() not in x and b"<" not in x]
        lines = [b" ".join(x) for x in self._lines(joined)]
        made = self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in lines], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(x.ids for x in made), np.uint32)
        # every part is followed by the sign
        ends = np.flatnonzero(ids == self.mark)
        size = np.diff(ends, prepend=-1) - 1
        others = [x for x in new if MARK.encode() in x or b"<" in x]
        found = [np.array(self.tokenizer.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32) for x in others]
        self.parts.update(zip(joined + others, range(len(self.parts), len(self.parts) + len(new)), strict=True))
        sizes = np.concatenate([size, np.array([len(x) for x in found], np.int64)])
        starts = len(self.flat) + np.concatenate([ends - size, len(ids) + np.cumsum([0, *map(len, found)])[:-1]]).astype(np.int64)
        self.start, self.size = np.concatenate([self.start, starts]), np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, ids, *found])

    @staticmethod
    def _lines(parts: list[bytes]) -> Iterator[list[bytes]]:
        for at in range(0, len(parts), 50):
            yield [x for part in parts[at : at + 50] for x in (part, MARK.encode())]


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about SLICE bytes of text, one row at least."""
    size = np.array(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), np.int64)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(size[at:]), SLICE, "right")))
        yield batch.slice(at, n)
        at += n


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each document's pieces, in order."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(tokenizer_path)
        for batch in (x for whole in rows for x in _slices(whole)):
            found, bounds = own.encode(batch.column(1))
            ends = bounds[1:] + np.arange(1, batch.num_rows + 1)
            ids = np.full(int(ends[-1]), end_id, "<u4")
            ids[np.arange(len(found)) + np.repeat(np.arange(batch.num_rows), np.diff(bounds))] = found
            # the pieces of all documents, in order
            size = np.diff(ends, prepend=0)
            count = -(-size // capacity)
            owner = np.repeat(np.arange(batch.num_rows), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, size[owner] - start)
            first = ends[owner] - size[owner] + start
            raw = memoryview(ids).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            made = [pa.array(x, k) for x, k in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (sums, pa.int64()))]
            if with_ids:
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(length)).astype(np.int32), ids.astype(np.int64))
                made.append(lists)
            yield pa.record_batch([batch.column(0).take(pa.array(owner)), *made], names)
        # a worker goes on to other stages, which need the memory
        pa.default_memory_pool().release_unused()

    narrow = columns(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return narrow.mapInArrow(cut, made)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first, into the fullest bin that has room for it."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set if some bin has r left
    bins: list[list[int]] = []
    for item in sorted(range(len(sizes)), key=sizes.__getitem__, reverse=True):
        size = sizes[item]
        fits = open_rooms >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
            bins[at].append(item)
        else:
            left, at = capacity, len(bins)
            bins.append([item])
        left -= size
        if left:
            room[left].append(at)
            open_rooms |= 1 << left
    return bins


def _pack(capacity: int):
    """Packs the (fill, items) bins of one partition into fuller ones."""

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(rows)
        if not held:
            return
        bins = pa.Table.from_batches(held).combine_chunks()
        if not bins.num_rows:
            return
        found = best_fit(bins.column(0).to_pylist(), capacity)
        order = pa.array([i for members in found for i in members], pa.int64())
        fills = bins.column(0).to_numpy()[order.to_numpy()]
        starts = np.cumsum([0, *map(len, found)])
        items = bins.column(1).take(order).combine_chunks()
        # the items of the members of a bin, one after another: only the list offsets change
        ends = items.offsets.to_numpy()
        merged = pa.ListArray.from_arrays(pa.array(ends[starts], pa.int32()), items.values)
        yield from pa.table(
            {"fill": pa.array(np.add.reduceat(fills, starts[:-1]), pa.int64()), "items": merged}
        ).to_batches(max_chunksize=2_000)

    return pack


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY, node_pieces: int = NODE_PIECES) -> DataFrame:
    """The rows of ``cut`` (with a column length) with sequence_id and offset added.

    - Every row is placed exactly once; rows of one sequence fill it from 0 without gaps.
    - Rows with a null length are taken as length 0; lengths beyond the capacity are an error.
    - sequence_id numbers are distinct, not consecutive. An empty table gives an empty result.
    """
    whole = F.struct(*(F.col(c) for c in cut.columns))
    held = materialise(cut, "pieces")
    nodes = max(1, -(-held.count() // node_pieces))
    start = held.select(F.coalesce("length", F.lit(0)).cast("long").alias("fill"), F.array(whole).alias("items"))
    open_bins = start.repartition(nodes)
    # lists without a nullable marker keep one schema through all rounds
    schema = T.StructType([T.StructField("fill", T.LongType()), T.StructField("items", start.schema["items"].dataType)])
    full, level, before = None, 0, None
    while True:
        packed = materialise(open_bins.mapInArrow(_pack(capacity), schema), "bins")
        limit = 0
        if nodes > 1:
            limit = int(NEARLY_FULL[min(level, len(NEARLY_FULL) - 1)] * capacity)
            count, least = packed.agg(F.count("*"), F.min("fill")).first()
            limit = min(limit, capacity - least + 1)
            n_open, n_pieces = packed.filter(F.col("fill") < limit).agg(F.count("*"), F.sum(F.size("items"))).first()
            fewer = max(-(-nodes // BRANCHES), -(-(n_pieces or 0) // (BRANCHES * node_pieces)))
            stuck = before is not None and before - count < LEAST_GAIN * before and 2 * fewer > nodes
            if not n_open or stuck:
                limit = 0
        done = packed.filter(F.col("fill") >= limit)
        full = done if full is None else full.union(done)
        if not limit:
            break
        open_bins = packed.filter(F.col("fill") < limit).repartition(fewer)
        nodes, level, before = fewer, level + 1, n_open
    numbered = full.select(F.monotonically_increasing_id().alias("sequence_id"), "items")
    placed = _offsets(numbered)
    return placed.select(*(F.col("item")[c].alias(c) for c in cut.columns), "sequence_id", "offset")


def _offsets(numbered: DataFrame) -> DataFrame:
    """One row per item with the sum of the lengths before it in its bin."""
    nothing = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("starts"))
    running = F.aggregate(
        F.transform("items", lambda x: F.coalesce(x["length"], F.lit(0)).cast("long")),
        nothing,
        lambda acc, n: F.struct((acc["total"] + n).alias("total"), F.concat(acc["starts"], F.array(acc["total"])).alias("starts")),
    )["starts"]
    zipped = F.arrays_zip(F.col("items").alias("item"), running.alias("offset"))
    return numbered.select("sequence_id", F.inline(zipped))


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    - A null or empty text is one piece of the end id alone.
    - Only documents longer than ``capacity`` are cut; the last piece may be shorter.
    - Repeated rows are packed as often as they occur; null ids are carried along.
    """
    return pack_pieces(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), capacity)
