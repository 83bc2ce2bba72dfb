"""Exact duplicates, found with cuckoo-filter indexes over content digests.

Every text is reduced to the SHA-256 of its normalised bytes. An index of live digests
is a cuckoo filter (16-bit fingerprints, four slots a bucket) beside the digests
themselves, kept by bucket: a miss in the filter says that a digest is new; a hit is
verified against the digests stored in the two buckets, so false positives cost a
comparison and never an answer. When an insertion finds no room the filter is rebuilt at
twice the size from the stored digests.

Each scan task thins its own rows with an index first, so copies of one text leave a task
as one row; the survivors are dealt out by digest to shards, each with an index of its own.
No text is shuffled and no shard holds more than its share of the distinct digests.
"""

from __future__ import annotations

import hashlib
import random
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notequarry.llm.common import LOWER, batches, columns, parts, text_bytes
from notequarry.session import materialise

SLOTS = 4
MAX_KICKS = 500
KEY = ("__kept_id", "__kept_digest")
LIVE = "digest binary, keep_id long, members long"


class CuckooIndex:
    """Live digests with the largest id and the number of rows of each.

    >>> index = CuckooIndex()
    >>> index.insert(b"d" * 32, 7), index.insert(b"d" * 32, 9), index.delete(b"d" * 32)
    (True, False, True)
    """

    def __init__(self, buckets: int = 64):
        self.random = random.Random(buckets)
        self.resizes = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.filter = array("H", bytes(2 * SLOTS * buckets))
        self.content: list[list[list]] = [[] for _ in range(buckets)]

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint and the two buckets; either follows from the other and the fingerprint."""
        mark = int.from_bytes(digest[:2], "big") or 1
        one = int.from_bytes(digest[8:16], "big") & self.mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _slot(self, bucket: int, mark: int) -> int:
        at = bucket * SLOTS
        for i in range(at, at + SLOTS):
            if self.filter[i] == mark:
                return i
        return -1

    def find(self, digest: bytes) -> list | None:
        """The live entry [digest, keep_id, members], or None."""
        mark, one, two = self._place(digest)
        if self._slot(one, mark) < 0 and self._slot(two, mark) < 0:
            return None
        return next((entry for entry in self.content[one] if entry[0] == digest), None)

    def insert(self, digest: bytes, keep_id: int | None, members: int = 1) -> bool:
        """Adds rows of a digest; True if the digest was not live before."""
        entry = self.find(digest)
        if entry is not None:
            if entry[1] is None or (keep_id is not None and keep_id > entry[1]):
                entry[1] = keep_id
            entry[2] += members
            return False
        self._store([digest, keep_id, members])
        return True

    def delete(self, digest: bytes) -> bool:
        """Takes a digest out; True if it was live."""
        entry = self.find(digest)
        if entry is None:
            return False
        mark, one, two = self._place(digest)
        slot = self._slot(one, mark)
        self.filter[slot if slot >= 0 else self._slot(two, mark)] = 0
        self.content[one].remove(entry)
        return True

    def _store(self, entry: list) -> None:
        mark, one, two = self._place(entry[0])
        self.content[one].append(entry)
        if not self._mark(mark, one, two):
            self._resize()

    def _mark(self, mark: int, one: int, two: int) -> bool:
        for bucket in (one, two):
            if (slot := self._slot(bucket, 0)) >= 0:
                self.filter[slot] = mark
                return True
        bucket = self.random.choice((one, two))
        for _ in range(MAX_KICKS):
            slot = bucket * SLOTS + self.random.randrange(SLOTS)
            mark, self.filter[slot] = self.filter[slot], mark
            bucket = self._other(bucket, mark)
            if (free := self._slot(bucket, 0)) >= 0:
                self.filter[free] = mark
                return True
        return False

    def _resize(self) -> None:
        """Twice the buckets, filled from the stored digests; again if that overflows too."""
        entries = list(self)
        buckets, full = self.mask + 1, True
        while full:
            buckets *= 2
            self.resizes += 1
            self._empty(buckets)
            full = False
            for entry in entries:
                mark, one, two = self._place(entry[0])
                self.content[one].append(entry)
                if not self._mark(mark, one, two):
                    full = True
                    break

    def __iter__(self) -> Iterator[list]:
        return (entry for bucket in self.content for entry in bucket)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, digest (SHA-256 of the text with A-Z lower-cased)."""

    def hashed(rows):
        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [hashlib.sha256(x.translate(LOWER)).digest() for x in text_bytes(batch.column(1))]
            return pa.record_batch([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "digest"])

        return batches(rows, make)

    narrow = columns(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(hashed, f"doc_id {kind}, digest binary")


def _thin(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The live digests of one task's (digest, keep_id, members) rows; members <= 0 deletes."""
    index, gone = CuckooIndex(), []
    for batch in rows:
        for digest, keep_id, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if members > 0:
                index.insert(digest, keep_id, members)
            else:
                gone.append(digest)
    for digest in gone:
        index.delete(digest)
    live = list(index)
    for at in range(0, len(live), 50_000):
        part = list(zip(*live[at : at + 50_000], strict=True))
        kinds = (pa.binary(), pa.int64(), pa.int64())
        yield pa.record_batch(
            [pa.array(x, k) for x, k in zip(part, kinds, strict=True)], ["digest", "keep_id", "members"]
        )


def live_index(digested: DataFrame) -> DataFrame:
    """Live digests of (doc_id, digest) rows: digest, keep_id (largest id), members."""
    one = digested.select("digest", F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("members"))
    return _sharded(one.mapInArrow(_thin, LIVE))


def _sharded(changes: DataFrame) -> DataFrame:
    return changes.repartition(parts(changes), "digest").mapInArrow(_thin, LIVE)


def update_index(index: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """The index after new (doc_id, digest) rows came in and ``removed`` digests were taken down.

    Removal wins over an addition of the same digest in the same call.
    """
    gone = removed.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("members"))
    return _sharded(index.select("digest", "keep_id", "members").union(live_index(added)).union(gone.distinct()))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    - A null text is an empty one; empty texts are equal to each other.
    - The row with the largest id of a group is kept; null ids are smaller than all others,
      and are kept (keep_id null) only in a group without any id.
    - Rows that repeat id and text are one document given twice: all carry the same mark
      and each counts in group_size.
    - An empty table gives an empty result; further columns are ignored.

    The join back is by digest; a digest that a third of all rows share is one row on the
    index side, so Spark's skew join splits the other side freely.
    """
    digested = materialise(digests(docs, id_col, text_col), "digests")
    index = live_index(digested)
    return digested.join(index, "digest").select(
        "doc_id",
        "keep_id",
        F.col("members").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a row given twice stays once.

    Rows are joined to the keepers by id and digest, which no two documents share, so a
    large group of copies does not meet in one task.
    """
    at = docs.columns.index(text_col)

    def marked(rows):
        def make(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [hashlib.sha256(x.translate(LOWER)).digest() for x in text_bytes(batch.column(at))]
            return pa.record_batch([*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, KEY[1]])

        return batches(rows, make)

    live = live_index(materialise(digests(docs, id_col, text_col), "digests"))
    live = live.select(_filled("keep_id").alias(KEY[0]), F.col("digest").alias(KEY[1]))
    wide = docs.mapInArrow(marked, T.StructType([*docs.schema.fields, T.StructField(KEY[1], T.BinaryType())]))
    same = wide.withColumn(KEY[0], _filled(id_col)).join(live, [*KEY], "left_semi")
    return same.dropDuplicates([*KEY]).select(*docs.columns)


def _filled(column: str):
    return F.coalesce(F.col(column).cast("long"), F.lit(-(2**63)))
