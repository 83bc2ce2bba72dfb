"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lower-cases the 26 letters A-Z of UTF-8 bytes and leaves every other byte alone.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **renamed: str) -> DataFrame:
    """Only the named columns of ``df``, under the operator's own names.

    Further columns, whatever they are called, are left behind here, so they cannot clash.
    """
    return df.select(*(df[old].alias(new) for new, old in renamed.items()))


def parts(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def apart(rows: DataFrame) -> DataFrame:
    """Rows dealt out by ``lane`` to as many tasks as the session has partitions, however few bytes they are."""
    return rows.repartition(parts(rows), "lane")


def narrowed(whole: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold them all; what is beyond 32 bits stays in doubles."""
    top = np.abs(whole).max(initial=0)
    kind = next((k for k in (np.int8, np.int16, np.int32) if top <= np.iinfo(k).max), np.float64)
    return whole.astype(kind).tobytes()


def widened(data: bytes, rows: int, width: int) -> np.ndarray:
    """What ``narrowed`` made, as doubles, a row for each vector."""
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}[len(data) // max(1, rows * width) or 8]
    return np.frombuffer(data, kind).astype(np.float64).reshape(rows, width)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written in decimal, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def batches(
    rows: Iterator[pa.RecordBatch], make: Callable[[pa.RecordBatch], pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        if batch.num_rows:
            yield make(batch)


class Words:
    """The words of many texts as flat arrays: bytes, starts, lengths and the text each is in.

    A word is a longest run of bytes other than 0x20 and 0x09-0x0D, after A-Z are
    lower-cased. Nothing is kept per word but numbers, so that millions of words take
    little memory.
    """

    def __init__(self, texts: list[bytes]):
        raw = b" ".join(texts).translate(LOWER)
        self.raw = np.frombuffer(raw, np.uint8)
        space = np.ones(len(self.raw) + 2, bool)
        space[1:-1] = (self.raw == 32) | ((self.raw >= 9) & (self.raw <= 13))
        edge = np.flatnonzero(space[1:] != space[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths + 1)
        #: the words of text i are those from first[i] to first[i + 1]
        self.first = np.concatenate([[0], np.searchsorted(self.start, self.ends)])

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
        """A 64-bit polynomial hash of every word."""
        if not len(self):
            return np.zeros(0, np.uint64)
        longest = int((self.end - self.start).max())
        inside = np.repeat(self.start, self.end - self.start)
        at = np.flatnonzero(~self._space())
        powers = np.cumprod(np.full(longest, 0x100000001B3, np.uint64))
        values = (self.raw[at].astype(np.uint64) + np.uint64(seed & 0xFFFF)) * powers[at - inside]
        starts = np.concatenate([[0], np.cumsum(self.end - self.start)[:-1]])
        return mix(np.add.reduceat(values, starts) + np.uint64(seed))

    def _space(self) -> np.ndarray:
        return (self.raw == 32) | ((self.raw >= 9) & (self.raw <= 13))

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes()


def mix(h: np.ndarray) -> np.ndarray:
    """Finishes 64-bit hashes so that every bit depends on all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
