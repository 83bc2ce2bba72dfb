"""Collocations per language, counted in depth-truncated suffix subtrees.

All suffixes of all pieces, cut off after four words, are divided by their prefixes: a prefix
with more suffixes than a share of the memory budget is extended by one word, as long as that
is so, and the lighter ones are dealt into groups that fit the budget. Each group is built
into its own subtree without the others: its suffixes are sorted, equal ones are a leaf with
their total, and the count of every phrase is the sum of the leaves below it. Scores, and
which phrases lie in others, are ordinary joins of the counted phrases.

Words are told apart by 64-bit hashes, which are checked for collisions over all words of all
languages; if two meet, all is hashed anew. Words that are rarer than a phrase must be end a
suffix, as no phrase can hold them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notequarry.llm.common import LOWER, columns, mix, text_bytes
from notequarry.session import materialise

LEAST = 30
LONGEST = 4
TOP = 2000
NO_LANGUAGE = "und"
#: A candidate goes if a longer phrase around it has this share of its count (in percent).
COVERED = 80
SCALE = 2_000_000
#: Suffixes that one group holds, about; a prefix with over a quarter of that is extended.
BUDGET = 2_000_000
#: Bytes of text that are split and hashed at a time (a longer piece is taken whole), and that
#: are joined to be cut into such stretches (a longer text is taken whole).
CHUNK, JOINED = 1 << 20, 4 << 20
#: Frequent words up to which tasks are sent their list; with more, rare words are not cut off.
VOCABULARY = 4_000_000
#: Characters that end a piece, and that part words.
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"

KEY = [f"s{i}" for i in range(LONGEST)]
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(BLANKS)], _CLASS[list(BREAKS)] = 1, 2
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number, and of its inverse modulo 2**64."""
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    return made[0], made[1]


class Split:
    """The words of a stretch of text: start, end, number of breaks before, and hash."""

    def __init__(self, raw: np.ndarray, seed: int):
        kind = _CLASS[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = kind == 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.raw, self.start, self.end = raw, edges[0::2], edges[1::2]
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start] if len(self.start) else self.start
        # sums of value * base**place, so that a word's hash is a difference moved to place 0
        size = 1 << max((CHUNK + CHUNK // 8).bit_length(), len(raw).bit_length())
        power, inverse = _powers(size)
        value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value[raw] * power[: len(raw)], out=total[1:])
        found = (total[self.end] - total[self.start]) * inverse[self.start]
        self.hash = mix(found + (self.end - self.start).astype(np.uint64) * np.uint64(_BASE))


def _language_hash(language: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {language}".encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about JOINED bytes of text, one row at least."""
    size = np.array(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False), np.int64)
    at = 0
    while at < batch.num_rows:
        n = max(1, int(np.searchsorted(np.cumsum(size[at:]), JOINED, "right")))
        yield batch.slice(at, n)
        at += n


def _stretches(batch: pa.RecordBatch, seed: int) -> Iterator[tuple[Split, np.ndarray, np.ndarray, list[str]]]:
    """Words of a few texts in stretches of about CHUNK bytes that end where a piece ends.

    With each: the symbol of every word (its hash and its language's), the number of its
    language, and the languages.
    """
    texts = text_bytes(batch.column(0))
    named = pa.array(["" if x is None else x for x in batch.column(1).to_pylist()]).dictionary_encode()
    languages = named.dictionary.to_pylist()
    salt = np.array([_language_hash(x, seed) for x in languages], np.uint64)
    of_text = named.indices.to_numpy()
    raw = np.frombuffer(b"\n".join(texts).translate(LOWER), np.uint8)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    at = 0
    while at < len(raw):
        end = min(at + CHUNK, len(raw))
        while end < len(raw):
            # the next break at or after the end, looked for in steps
            breaks = np.flatnonzero(_CLASS[raw[end : end + CHUNK]] == 2)
            if len(breaks):
                end += int(breaks[0]) + 1
                break
            end = min(end + CHUNK, len(raw))
        split = Split(raw[at:end], seed)
        if len(split.start):
            language = of_text[np.searchsorted(begin, split.start + at, "right") - 1]
            # odd, so that 0 is free for no word
            symbol = (mix(split.hash ^ salt[language]) | np.uint64(1)).view(np.int64)
            yield split, symbol, language, languages
        at = end


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (x for batch in batches if batch.num_rows for x in _slices(batch)):
            found: list[tuple[np.ndarray, ...]] = []
            for split, symbol, language, languages in _stretches(rows, seed):
                distinct, first, n = np.unique(symbol, return_index=True, return_counts=True)
                size = (split.end - split.start)[first]
                ends = np.cumsum(size)
                inside = np.arange(ends[-1]) + np.repeat(split.start[first] - ends + size, size)
                found.append((distinct, n, size, language[first], split.raw[inside]))
            if not found:
                continue
            # a word of several stretches is one row
            symbol, n, size, language, raw = (np.concatenate(x) for x in zip(*found, strict=True))
            distinct, first, number = np.unique(symbol, return_index=True, return_inverse=True)
            total = np.bincount(number, weights=n).astype(np.int64)
            ends = np.append(0, np.cumsum(size)).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(symbol), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
            own = pa.array(languages).take(pa.array(language[first]))
            yield pa.record_batch(
                [pa.array(distinct), own, words.take(pa.array(first)), pa.array(total)], ["symbol", "lang", "word", "n"]
            )

    return run


def counted_words(docs: DataFrame, seed: int = 0) -> DataFrame | None:
    """symbol, lang, word, n of every word of every language, or None if two words share a symbol."""
    made = docs.mapInArrow(_count_words(seed), "symbol long, lang string, word binary, n long")
    summed = made.groupBy("symbol", "lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))
    held = materialise(summed, "words")
    if held.groupBy("symbol").agg(F.count("*").alias("words")).filter(F.col("words") > 1).limit(1).count():
        return None
    return held


def _block(split: Split, symbol: np.ndarray, listed: np.ndarray | None) -> np.ndarray:
    """The symbols of a stretch, with 0 where a piece or a run of frequent words ends."""
    ends = np.append(split.piece[1:] != split.piece[:-1], True)
    known, kind = np.ones(len(symbol), bool), np.int64
    if listed is not None:
        place = np.minimum(np.searchsorted(listed, symbol), max(0, len(listed) - 1))
        known = listed[place] == symbol if len(listed) else ~known
        symbol, kind = place + 1, np.uint32
        ends |= ~known
        ends[:-1] |= ~known[1:]
    # a word of its own makes no phrase
    kept = known & ~(ends & np.append(True, ends[:-1]))
    symbol, ends = symbol[kept], ends[kept]
    block = np.zeros(len(symbol) + int(ends.sum()), kind)
    block[np.arange(len(symbol)) + np.cumsum(ends) - ends] = symbol
    return block


def _symbols(seed: int, frequent):
    """Blocks of symbols of a few texts each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = frequent.value if frequent is not None else None
        for rows in (x for batch in batches if batch.num_rows for x in _slices(batch)):
            made = [_block(split, symbol, listed).tobytes() for split, symbol, _, _ in _stretches(rows, seed)]
            if any(made):
                yield pa.record_batch([pa.array([b"".join(made)], pa.binary())], ["block"])

    return run


def _suffixes(block: np.ndarray) -> list[np.ndarray]:
    """Columns of the suffixes of at least two words; 0 after the last word."""
    columns_of, alive = [], np.ones(len(block), bool)
    for i in range(LONGEST):
        moved = np.zeros(len(block), block.dtype)
        moved[: len(block) - i] = block[i:]
        alive &= moved != 0
        columns_of.append(np.where(alive, moved, 0).astype(block.dtype))
    long_enough = columns_of[1] != 0
    return [c[long_enough] for c in columns_of]


def _packed(cols: list[np.ndarray]) -> list[np.ndarray]:
    """The same columns as few 64-bit sort keys, first column first."""
    if cols[0].dtype != np.uint32:
        return cols
    cols = [*cols, *([np.zeros(len(cols[0]), np.uint32)] if len(cols) % 2 else [])]
    return [(a.astype(np.uint64) << np.uint64(32)) | b for a, b in zip(cols[0::2], cols[1::2], strict=True)]


def _leaves(cols: list[np.ndarray], n: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of the columns, sorted, and the total of each."""
    if not len(cols[0]):
        return cols, np.zeros(0, np.int64)
    keys = _packed(cols)
    order = np.lexsort(keys[::-1])
    fresh = np.ones(len(order), bool)
    fresh[1:] = False
    for k in keys:
        k = k[order]
        fresh[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(fresh)
    totals = np.diff(np.append(first, len(order))) if n is None else np.add.reduceat(n[order], first)
    return [c[order[first]] for c in cols], totals.astype(np.int64)


class Prefixes:
    """The division of all suffixes: heavy prefixes of 0 to 3 words, each with its groups.

    The suffixes below a heavy prefix are dealt over its groups by a hash of the next word,
    but for those below a longer heavy prefix, which has groups of its own.
    """

    def __init__(self, budget: int):
        self.budget, self.groups = budget, 0
        #: for each number of words: heavy prefixes as rows of symbols, first group, groups
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, prefixes: np.ndarray, light: np.ndarray) -> None:
        """``light``: suffixes below each prefix that are not below a longer heavy one."""
        dealt = np.maximum(1, -(-2 * np.maximum(light, 0) // self.budget))
        first = self.groups + np.cumsum(dealt) - dealt
        self.groups += int(dealt.sum())
        self.levels.append((prefixes, first, dealt))

    @staticmethod
    def find(prefixes: np.ndarray, cols: list[np.ndarray]) -> np.ndarray:
        """Number of each row's prefix, or -1. The prefixes are few, so codes of them are looked up."""
        width = prefixes.shape[1]
        if not width:
            return np.zeros(len(cols[0]), np.int64)
        # column by column: the row's code so far and its next symbol, among those of the prefixes
        own, code = np.zeros(len(prefixes), np.int64), np.zeros(len(cols[0]), np.int64)
        for i in range(width):
            values = np.unique(prefixes[:, i])
            place = np.minimum(np.searchsorted(values, cols[i].astype(np.int64)), max(0, len(values) - 1))
            known = (code >= 0) & (values[place] == cols[i].astype(np.int64)) if len(values) else np.zeros(len(code), bool)
            mine = own * len(values) + np.searchsorted(values, prefixes[:, i])
            seen, own = np.unique(mine, return_inverse=True)
            pair = code * len(values) + place
            at = np.minimum(np.searchsorted(seen, pair), max(0, len(seen) - 1))
            code = np.where(known & (seen[at] == pair if len(seen) else False), at, -1)
        number = np.full(len(prefixes) + 1, -1, np.int64)
        number[own] = np.arange(len(prefixes))
        return number[code]

    def of(self, cols: list[np.ndarray]) -> np.ndarray:
        """The group of each suffix."""
        group = np.zeros(len(cols[0]), np.int64)
        for depth, (prefixes, first, count) in enumerate(self.levels):
            at = self.find(prefixes, cols)
            rows = np.flatnonzero(at >= 0)
            spread = mix(cols[depth][rows].astype(np.uint64) + np.uint64(_BASE)) % count[at[rows]].astype(np.uint64)
            group[rows] = first[at[rows]] + spread.astype(np.int64)
        return group


def _prefix_counts(kind: str, prefixes: np.ndarray, share: float):
    """Counts of the prefixes one word longer than the given ones, where they are frequent.

    A block leaves out those below ``share`` of its suffixes. The blocks that do so hold less
    than that share of all suffixes that begin with one, so that the sums of a prefix with
    twice the share are more than half of its count, and a block has few rows.
    """
    depth = prefixes.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                cols = _suffixes(np.frombuffer(raw, kind))
                least = share * len(cols[0])
                chosen = (Prefixes.find(prefixes, cols) >= 0) & (cols[depth - 1] != 0)
                found, n = _leaves([c[chosen] for c in cols[:depth]], None)
                made = [*(c[n >= least].astype(np.int64) for c in found), n[n >= least]]
                yield pa.record_batch([pa.array(x) for x in made], [*KEY[:depth], "n"])

    return run


def _divide(blocks: DataFrame, kind: str, words: DataFrame, listed: np.ndarray | None, budget: int) -> Prefixes:
    """Heavy prefixes of growing length: all with over a quarter of the budget, and none below an eighth."""
    made = Prefixes(budget)
    counted = words if listed is None else words.filter(F.col("n") >= LEAST)
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    above, counts = np.zeros((1, 0), np.int64), np.array([total], np.int64)
    found = words.filter(F.col("n") > budget // 4).select("symbol", "n").toArrow()
    rows, n = found.column("symbol").to_numpy().reshape(-1, 1), found.column("n").to_numpy()
    if listed is not None:
        rows = np.searchsorted(listed, rows) + 1
    for depth in range(1, LONGEST):
        light = counts.copy()
        if len(rows):
            np.subtract.at(light, Prefixes.find(above, list(rows.T)), n)
        made.add(above, light)
        above, counts = rows, n
        if not len(rows) or depth == LONGEST - 1:
            break
        names = KEY[: depth + 1]
        run = _prefix_counts(kind, above, budget / 8 / max(1, total))
        longer = blocks.mapInArrow(run, ", ".join(f"{k} long" for k in [*names, "n"]))
        kept = longer.groupBy(*names).agg(F.sum("n").alias("n")).filter(F.col("n") > budget // 8).toArrow()
        rows = np.array([kept.column(k).to_numpy() for k in names], np.int64).reshape(depth + 1, -1).T
        n = kept.column("n").to_numpy()
    if len(above):
        made.add(above, counts)
    return made


def _to_groups(kind: str, prefixes: Prefixes):
    """Each block's distinct suffixes with their counts, one row a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                cols, n = _leaves(_suffixes(np.frombuffer(raw, kind)), None)
                group = prefixes.of(cols)
                order = np.argsort(group, kind="stable")
                cols, n, group = [c[order] for c in cols], n[order].astype(np.uint32), group[order]
                edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, int)
                for a, b in zip(edges, np.append(edges[1:], len(group)), strict=True):
                    held = [pa.array([c[a:b].tobytes()], pa.binary()) for c in [*cols, n]]
                    yield pa.record_batch([pa.array([int(group[a])]), *held], ["group", *KEY, "n"])

    return run


def _subtree(kind: str, prefixes: Prefixes, least: int):
    """Phrases of one group: nodes of two to four words whose leaves' total reaches ``least``, and heavy prefixes."""

    def run(table: pa.Table) -> pa.Table:
        joined = lambda name, k: np.frombuffer(b"".join(table.column(name).to_pylist()), k)
        cols, totals = _leaves([joined(k, kind) for k in KEY], joined("n", np.uint32).astype(np.int64))
        out: list[list[np.ndarray]] = [[] for _ in range(LONGEST + 2)]
        fresh = np.zeros(len(totals), bool)
        fresh[:1] = True
        for depth in range(1, LONGEST + 1):
            column = cols[depth - 1]
            fresh[1:] |= column[1:] != column[:-1]
            if depth == 1 or not len(totals):
                continue
            first = np.flatnonzero(fresh)
            n = np.add.reduceat(totals, first)
            kept = n >= least
            if depth < len(prefixes.levels):
                # a heavy prefix lies in several groups, whose counts are summed later
                kept |= Prefixes.find(prefixes.levels[depth][0], [c[first] for c in cols]) >= 0
            kept &= column[first] != 0
            first, n = first[kept], n[kept]
            for i in range(LONGEST):
                out[i].append(cols[i][first].astype(np.int64) if i < depth else np.zeros(len(first), np.int64))
            out[LONGEST].append(np.full(len(first), depth, np.int32))
            out[LONGEST + 1].append(n)
        kinds = [np.int64] * LONGEST + [np.int32, np.int64]
        made = [np.concatenate([np.zeros(0, k), *x]).astype(k) for x, k in zip(out, kinds, strict=True)]
        return pa.table([pa.array(x) for x in made], names=[*KEY, "depth", "f"])

    return run


def _named(listed):
    """Phrases with the symbols of their words for the numbers in the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.concatenate([[0], listed.value])
        for batch in batches:
            made = [pa.array(every[batch.column(i).to_numpy()]) for i in range(LONGEST)]
            yield pa.record_batch([*made, *batch.columns[LONGEST:]], batch.schema.names)

    return run


def counted_phrases(docs: DataFrame, least: int = LEAST, budget: int = BUDGET, vocabulary: int = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """(words, phrases) of ``docs`` with columns text and lang.

    words: symbol, lang, word, n of every word. phrases: s0 to s3 (symbols, 0 after the
    last), depth, f of every phrase of 1 to 4 words that occurs at least ``least`` times.
    """
    spark = docs.sparkSession
    words, seed = None, 0
    while words is None:
        words, seed = counted_words(docs, seed), seed + 1
    seed -= 1
    common = words.filter(F.col("n") >= least).select("symbol", "n")
    listed, shared, kind = None, None, "<i8"
    if common.count() <= vocabulary:
        listed, kind = np.sort(common.toArrow().column("symbol").to_numpy()), "<u4"
        shared = spark.sparkContext.broadcast(listed)
    blocks = materialise(docs.mapInArrow(_symbols(seed, shared), "block binary"), "symbols")
    prefixes = _divide(blocks, kind, words, listed, budget)
    dealt = blocks.mapInArrow(_to_groups(kind, prefixes), "group long, " + ", ".join(f"{k} binary" for k in [*KEY, "n"]))
    schema = ", ".join(f"{k} long" for k in KEY) + ", depth int, f long"
    counted = dealt.groupBy("group").applyInArrow(_subtree(kind, prefixes, least), schema)
    counted = counted.groupBy(*KEY, "depth").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    if listed is not None:
        counted = counted.mapInArrow(_named(shared), schema)
    single = common.select(F.col("symbol").alias("s0"), *(F.lit(0).cast("long").alias(k) for k in KEY[1:]), F.lit(1).alias("depth"), F.col("n").alias("f"))
    return words, materialise(single.union(counted), "phrases")


def _join(left: DataFrame, counts: DataFrame, key: list[Column], name: str) -> DataFrame:
    """``left`` with the count of the phrase ``key`` as ``name``."""
    named = counts.select(*(F.col(k).alias(f"_{k}") for k in KEY), F.col("f").alias(name))
    met = [a == F.col(f"_{k}") for a, k in zip(key, KEY, strict=True)]
    return left.join(named, met).drop(*(f"_{k}" for k in KEY))


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    budget: int = BUDGET,
    vocabulary: int = VOCABULARY,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of 2 to 4 words.

    A phrase occurs ``a`` times, its parts before and after the worst cut ``l`` and ``r``
    times, and its language has ``n`` words. Phrases that lie in a longer one of nearly the
    same count are left out.

    - A-Z are lower-cased and every other byte is as it is; a phrase never spans a piece.
    - A null or empty text has no words; a null language is ``und``. Repeated rows count
      as often as they occur. Texts of any length are taken whole.
    - Ties go by count, then by the bytes of the phrase. An empty table gives no rows.
    - Other columns are not read.
    """
    own = columns(docs, text=text_col, lang=lang_col)
    words, phrases = counted_phrases(own.select("text", F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang")), least, budget, vocabulary)
    zero = F.lit(0).cast("long")
    shifted = F.array(*KEY, *[zero] * LONGEST)

    # the longest count of the phrases that are one word longer: a still longer one is no more frequent
    inner = [
        F.struct(*(F.when(F.col("depth") - 1 > i, F.col(k)).otherwise(zero).alias(k) for i, k in enumerate(KEY))),
        F.struct(*(shifted[i + 1].alias(k) for i, k in enumerate(KEY))),
    ]
    longer = phrases.filter(F.col("depth") > 2).select(F.explode(F.array(*inner)).alias("in"), "f")
    around = longer.groupBy(*(F.col(f"in.{k}").alias(k) for k in KEY)).agg(F.max("f").alias("around"))
    wide = "decimal(20,0)"
    covered = F.col("around").cast(wide) * 100 >= F.col("f").cast(wide) * COVERED
    kept = phrases.filter(F.col("depth") > 1).join(around, KEY, "left").filter(F.col("around").isNull() | ~covered)

    cuts = kept.select(*KEY, F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("depth") - 1)).alias("k"))
    head = [F.when(F.col("k") > i, F.col(s)).otherwise(zero) for i, s in enumerate(KEY)]
    tail = [F.element_at(shifted, F.col("k") + (i + 1)) for i in range(LONGEST)]
    met = _join(_join(cuts, phrases, head, "l"), phrases, tail, "r")
    score = F.expr(f"(cast(a as {wide}) * {SCALE}) div (cast(l as {wide}) + cast(r as {wide}))").alias("score")
    worst = F.min(F.struct(score, "k", "l", "r")).alias("worst")
    scored = met.groupBy(*KEY).agg(F.first("a").alias("a"), worst)
    scored = scored.select(*KEY, "a", "worst.l", "worst.r", "worst.score")

    first = words.select(F.col("symbol").alias("s0"), "lang", F.col("word").alias("w0"))
    named = materialise(scored.join(first, "s0"), "scored")
    # the score and count of a language's last row are settled before words are looked up
    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    last = named.withColumn("at", F.row_number().over(best_first)).filter(F.col("at") <= top)
    last = last.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    found = named.join(last, "lang").filter(F.struct("score", "a") >= F.col("last"))
    for i in range(1, LONGEST):
        further = words.select(F.col("symbol").alias(f"s{i}"), F.col("word").alias(f"w{i}"))
        found = found.join(further, f"s{i}", "left")
    found = found.withColumn("phrase", F.concat_ws(" ", *(f"w{i}" for i in range(LONGEST))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
