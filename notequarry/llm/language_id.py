"""Language identification by words first, and by ever shorter character n-grams for the rest.

The model holds, for each language, frequencies of words and of character n-grams of one to
five characters. A word that was seen in training scores each language by its log frequency
there. An unseen word is judged by its five-character strings, those that were seen in
training; if there are none, by its four-character strings, and so on down to single
characters. A text takes the language with the largest sum over its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notequarry.llm.chars import LETTER, SPACE, Chars, slices, sums, window_hashes
from notequarry.llm.common import columns, id_remainder, text_bytes

LONGEST = 5
#: Training documents taken for each language, about; all of them if there are fewer.
SAMPLE = 4_000
#: Words and n-grams met less often in the sample are left out of the model.
LEAST = 2
SMOOTHING = 0.5
#: The certainty stated for a text grows with its words up to this number.
EVIDENCE = 24
HELD_OUT = 3
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Log frequencies by language: ``tables[n]`` are (keys, rows of scores); 0 holds words."""

    languages: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    def find(self, n: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, scores = self.tables[n]
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros((len(keys), len(self.languages)))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, scores[at]

    def word_scores(self, chars: Chars, start: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """One row of scores for each of the distinct words."""
        hit, scores = self.find(0, keys)
        scores = np.where(hit[:, None], scores, 0.0)
        open_ = np.flatnonzero(~hit)
        for n in range(LONGEST, 0, -1):
            if not len(open_):
                break
            code, owner = bounded(chars.code, start[open_], size[open_])
            windows = window_hashes(code, n)
            own = np.flatnonzero(owner[: len(windows)] == owner[n - 1 :][: len(windows)])
            seen, found = self.find(n, windows[own])
            of = owner[own][seen]
            total = np.zeros((len(open_), len(self.languages)))
            np.add.at(total, of, found[seen])
            count = np.bincount(of, minlength=len(open_))
            done = count > 0
            scores[open_[done]] = total[done] / count[done, None]
            open_ = open_[~done]
        return scores

    def judge(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and certainty of each text."""
        chars = Chars([t.lower() for t in texts])
        start, size = words_of(chars)
        keys = chars.hashes(start, size)
        distinct, first, where = np.unique(keys, return_index=True, return_inverse=True)
        scores = self.word_scores(chars, start[first], size[first], distinct)[where]
        begins = np.searchsorted(start, chars.text_start)
        total = sums(scores, begins)
        words = np.diff(np.append(begins, len(start)))
        best = total.argmax(axis=1)
        scaled = total * (np.minimum(words, EVIDENCE) / np.maximum(words, 1))[:, None]
        odds = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        sure = odds[np.arange(len(texts)), best] / odds.sum(axis=1)
        return [self.languages[i] for i in best.tolist()], sure.tolist()


def words_of(chars: Chars) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of letters."""
    return chars.runs(np.where(chars.kind == LETTER, LETTER, SPACE))


def bounded(code: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with a mark (0) on both sides, one after another, and which word each place is of."""
    wide = size + 2
    total = np.cumsum(wide)
    owner = np.repeat(np.arange(len(size)), wide)
    inside = np.arange(total[-1] if len(total) else 0) - np.repeat(total - wide, wide)
    at = np.clip(np.repeat(start, wide) + inside - 1, 0, len(code) - 1)
    edge = (inside == 0) | (inside == np.repeat(wide, wide) - 1)
    return np.where(edge, 0, code[at]), owner


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n, key, count) of the words and n-grams of (lang, text) rows."""
    for batch in rows:
        langs, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts, strict=True):
            by_lang.setdefault(lang, []).append(text.decode("utf-8", "replace").lower())
        for lang, own in by_lang.items():
            for a, b in slices(own):
                chars = Chars(own[a:b])
                start, size = words_of(chars)
                code, owner = bounded(chars.code, start, size)
                for n in range(LONGEST + 1):
                    if n:
                        keys = window_hashes(code, n)
                        keys = keys[owner[: len(keys)] == owner[n - 1 :][: len(keys)]]
                    else:
                        keys = chars.hashes(start, size)
                    keys, count = np.unique(keys, return_counts=True)
                    yield pa.record_batch(
                        [
                            pa.array([lang] * len(keys), pa.string()),
                            pa.array(np.full(len(keys), n, np.int32)),
                            pa.array(keys.view(np.int64)),
                            pa.array(count.astype(np.int64)),
                        ],
                        ["lang", "n", "key", "count"],
                    )


def fit(labelled: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> LanguageModel:
    """A model from (doc_id, text, lang) rows; rows without a language are left out.

    About ``sample`` documents of each language are learnt from, chosen by a hash of the id,
    with their whole texts; so the model does not grow with the corpus.
    """
    rows = labelled.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    share = rows.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    taken = rows.join(F.broadcast(share), "lang").filter(draw < F.col("share")).select("lang", "text")
    counted = taken.mapInArrow(_count, "lang string, n int, key long, count long")
    counted = counted.groupBy("lang", "n", "key").agg(F.sum("count").alias("count")).filter(F.col("count") >= least)
    found = counted.toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    languages = sorted(set(langs.tolist()))
    column = np.searchsorted(languages, langs) if languages else np.zeros(0, np.int64)
    n, key, count = (found.column(c).to_numpy() for c in ("n", "key", "count"))
    tables = {}
    for order in range(LONGEST + 1):
        own = n == order
        keys, row = np.unique(key[own].view(np.uint64), return_inverse=True)
        counts = np.full((len(keys), len(languages)), SMOOTHING)
        np.add.at(counts, (row, column[own]), count[own])
        tables[order] = keys, np.log(counts / counts.sum(axis=0)) if len(keys) else counts
    return LanguageModel(languages, tables)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs``.

    - A null text, and one without a letter, is ``und`` with score 0.
    - With a model that learnt no language every text is ``und``.
    - Ties go to the language that comes first in the alphabet.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in rows:
            texts = [x.decode("utf-8", "replace") for x in text_bytes(batch.column(1))]
            for a, b in slices(texts):
                lang, score = named(own, texts[a:b])
                yield pa.record_batch(
                    [batch.column(0)[a:b], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    narrow = columns(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang", least: float = 0.0
) -> DataFrame:
    """The rows of ``docs`` whose text is in a language, with ``lang_col`` as predicted.

    - Rows whose prediction is ``und`` go: null and empty texts, texts without a letter, and
      all rows if the model has no language. So do those whose certainty is below ``least``.
    - Repeated rows are judged alike; all other columns are kept as they are, whatever their
      names. An empty table gives no rows.
    """
    at, own_lang = docs.columns.index(text_col), docs.columns.index(lang_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in rows:
            texts = [x.decode("utf-8", "replace") for x in text_bytes(batch.column(at))]
            lang, score = [], []
            for a, b in slices(texts):
                names, sure = named(own, texts[a:b])
                lang += names
                score += sure
            kept = [x != UNKNOWN and s >= least for x, s in zip(lang, score, strict=True)]
            made = [pa.array(lang, pa.string()) if i == own_lang else c for i, c in enumerate(batch.columns)]
            yield pa.record_batch(made, batch.schema.names).filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def named(model: LanguageModel, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and certainty of each text; ``und`` and 0 where there is no letter."""
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    lang, score = model.judge(texts)
    for i, text in enumerate(texts):
        if next(filter(str.isalpha, text), None) is None:
            lang[i], score[i] = UNKNOWN, 0.0
    return lang, score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(id_remainder(doc_id, HELD_OUT) == 1, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """The (doc_id, text, lang) rows that a model may learn from."""
    return columns(docs, doc_id="doc_id", text="text", lang="lang").filter(~held_out(F.col("doc_id")))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``, learnt from the rows not held out."""
    found = identify(docs, fit(learnable(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
