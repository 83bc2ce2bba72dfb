"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

Many distinct words are encoded at once. Their characters lie in one flat symbol array;
in every round the best-scored pair of neighbours of each word is found by a segmented
minimum, merged wherever that is certain to be the library's own order, and the array is
compacted, until no word has a pair that the vocabulary joins.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from notequarry.llm.common import columns, text_bytes

SPACE = "\u2581"
GROUP = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NONE = np.int64(2**62)
#: Letters with signs after them; many words differ by the signs alone.
TRAILED = re.compile(r"([^\W\d_]+)([.,!?;:*#$%&|)(\"]+)")
#: Words whose ids a worker remembers, and half the parts; beyond it starts anew, so its
#: memory is bounded.
REMEMBERED = 250_000


class PieceModel:
    """Vocabulary and merge table of a BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.end_id = model.eos_id()
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        #: what decoding puts for each id
        self.shown = [b""] * size
        for i in plain:
            self.shown[i] = pieces[i].replace(SPACE, " ").encode()
        for byte, i in enumerate(self.byte_ids):
            self.shown[i] = bytes([byte])
        self.written = [str(i).encode() for i in range(size)]
        # symbols: the plain pieces, and characters that occur only inside pieces
        symbol = {pieces[i]: i for i in plain}
        for i in plain:
            for char in pieces[i]:
                symbol.setdefault(char, size + len(symbol))
        self.chars = {ord(x): i for x, i in symbol.items() if len(x) == 1}
        self.size = size
        ranks = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        merges, joins = {}, set()
        for i in plain:
            piece = pieces[i]
            rank = ranks[model.get_score(i)]
            for cut in range(1, len(piece)):
                joins.add((ord(piece[cut - 1]), ord(piece[cut])))
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    merges[(left << 24) | right] = (rank, i)
        self.pair = np.array(sorted(merges), np.int64)
        found = np.array([merges[x] for x in self.pair.tolist()], np.int64).reshape(-1, 2)
        self.rank, self.joined = found[:, 0], found[:, 1]
        #: neighbouring characters that no piece holds side by side can be cut apart
        self.join = np.array(sorted((a << 32) | b for a, b in joins), np.int64)
        self.joins = joins

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined symbol of each pair; NONE where the vocabulary has no such piece."""
        key = (left << 24) | right
        at = np.minimum(np.searchsorted(self.pair, key), max(0, len(self.pair) - 1))
        hit = self.pair[at] == key
        return np.where(hit, self.rank[at], NONE), self.joined[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, merged together round by round, and where each word's begin and end."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        distinct, where = np.unique(points, return_inverse=True)
        # a character outside the vocabulary is a symbol of its own that joins nothing
        known = np.array([self.chars.get(int(p), -1) for p in distinct], np.int64)
        symbols = np.where(known[where] >= 0, known[where], (1 << 22) + where)
        seams = (points[:-1] << 32) | points[1:]
        at = np.minimum(np.searchsorted(self.join, seams), len(self.join) - 1)
        cut = np.concatenate([[True], (owner[1:] != owner[:-1]) | (self.join[at] != seams)])
        run = np.cumsum(cut) - 1
        symbols, run, owner = self._merge_rounds(symbols, run, owner)
        return self._ids(symbols, owner, len(words), distinct)

    def _merge_rounds(self, symbols, run, owner):
        done_s, done_r, done_o = [], [], []
        rank, joined = self._pairs(symbols, run, np.arange(len(symbols)))
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            sizes = np.diff(np.append(heads, len(symbols)))
            best = np.minimum.reduceat(rank, heads)
            live = np.repeat(best < NONE, sizes)
            if not live.all():  # finished runs leave the arrays
                done_s.append(symbols[~live])
                done_r.append(run[~live])
                done_o.append(owner[~live])
                symbols, run, owner, rank, joined = (x[live] for x in (symbols, run, owner, rank, joined))
                continue
            wanted = np.flatnonzero(rank == np.repeat(best, sizes))
            wanted = self._certain(symbols, run, rank, joined, wanted)
            symbols = symbols.copy()
            symbols[wanted] = joined[wanted]
            keep = np.ones(len(symbols), bool)
            keep[wanted + 1] = False
            now = (np.cumsum(keep) - 1)[wanted]
            symbols, run, owner, rank, joined = (x[keep] for x in (symbols, run, owner, rank, joined))
            # only the pairs of a merged symbol and its neighbours have changed
            changed = np.concatenate([now, np.maximum(now - 1, 0)])
            rank[changed], joined[changed] = self._pairs(symbols, run, changed)
        symbols, run, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_s, done_r, done_o))
        order = np.argsort(run, kind="stable")
        return symbols[order], run[order], owner[order]

    def _pairs(self, symbols, run, at):
        """Rank and joined symbol of the pairs that begin at ``at``; NONE across the end of a run."""
        after = np.minimum(at + 1, len(symbols) - 1)
        inside = (run[at] == run[after]) & (after > at)
        rank, joined = np.full(len(at), NONE), np.zeros(len(at), np.int64)
        rank[inside], joined[inside] = self._ranks(symbols[at[inside]], symbols[after[inside]])
        return rank, joined

    def _certain(self, symbols, run, rank, joined, wanted):
        """Those of the best pairs that can be merged at once, from the left of each run.

        Of overlapping pairs the left one goes. A merge may make a new pair that is as good
        as the current one or better; it would go before those further right, so these wait.
        """
        if len(wanted) < 2:
            return wanted
        near = np.concatenate([[False], (wanted[1:] - wanted[:-1] == 1)])
        # in a chain of overlapping pairs every second one is taken
        starts = np.flatnonzero(~near)
        place = np.arange(len(wanted)) - np.repeat(starts, np.diff(np.append(starts, len(wanted))))
        wanted = wanted[place % 2 == 0]
        first = np.concatenate([[True], run[wanted[1:]] != run[wanted[:-1]]])
        if first.all():
            return wanted
        new, old = joined[wanted], rank[wanted]
        last = len(symbols) - 1
        before, after = np.maximum(wanted - 1, 0), np.minimum(wanted + 2, last)
        left = np.where((wanted > 0) & (run[before] == run[wanted]), self._ranks(symbols[before], new)[0], NONE)
        # the left neighbour may itself be the result of a merge of this round
        merged = np.concatenate([[False], wanted[1:] - wanted[:-1] == 2])
        left = np.where(merged, np.minimum(left, self._ranks(np.concatenate([[0], new[:-1]]), new)[0]), left)
        right = np.where((wanted + 2 <= last) & (run[after] == run[wanted]), self._ranks(new, symbols[after])[0], NONE)
        stop = (left <= old) | (right <= old)
        count = np.cumsum(stop) - stop  # stops before each, over all runs
        base = np.repeat(count[first], np.diff(np.append(np.flatnonzero(first), len(wanted))))
        return wanted[count == base]

    def _ids(self, symbols, owner, n, distinct):
        """Symbols as ids; a character that is no piece is spelled out in the ids of its bytes."""
        plain = symbols < self.size
        size = np.ones(len(symbols), np.int64)
        others, where = np.unique(symbols[~plain], return_inverse=True)
        spelled = [self.byte_ids[list(bytes_of(point))] for _, point in self._spelled(others, distinct)]
        if len(others):
            size[~plain] = np.array([len(x) for x in spelled])[where]
        ids = np.repeat(symbols, size)
        if len(others):
            ids[np.repeat(~plain, size)] = np.concatenate([spelled[i] for i in where.tolist()])
        return ids, np.searchsorted(np.repeat(owner, size), np.arange(n + 1))

    def _spelled(self, symbols, distinct):
        inner = {i: point for point, i in self.chars.items() if i >= self.size}
        for i in np.unique(symbols).tolist():
            yield i, inner[i] if i in inner else int(distinct[i - (1 << 22)])

    def decode(self, ids: list[int]) -> bytes:
        """The text of the ids; the space put before the text is taken off again."""
        shown = self.shown
        text = b"".join([shown[i] for i in ids])
        return text[1:] if text.startswith(b" ") else text


def bytes_of(point: int) -> bytes:
    return chr(point).encode()


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


class Encoder:
    """Encodes texts word by word and remembers a bounded number of words."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"": b""}

    def groups(self, text: str) -> list[str]:
        """The words of a text, each with the spaces before it; pieces never cross their seams."""
        if "  " not in text and text[-1] != " " and text[0] != " " and SPACE not in text:
            return text.split(" ")
        # a word keeps its first space mark out, as above, so both ways share what is known
        return [x[1:] for x in GROUP.findall(SPACE + text.replace(" ", SPACE))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the end id; an empty text has the end id alone."""
        split = [self.groups(t) if t else [] for t in texts]
        fresh = set().union(*split).difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known = {}
            fresh = set().union(*split)
        halves = {word: self._halves(word) for word in fresh}
        self._learn({x for both in halves.values() for x in both})
        parts = self.parts
        for word, (one, two) in halves.items():
            self.known[word] = parts[one] + parts[two]
        end = np.int32(self.model.end_id).tobytes()
        known = self.known
        return [np.frombuffer(b"".join([known[w] for w in words]) + end, np.int32) for words in split]


    def _halves(self, word: str) -> tuple[str, str]:
        """A word with its space mark, and the signs at its end where no piece spans the seam."""
        found = TRAILED.fullmatch(word)
        if found and (ord(found[1][-1]), ord(found[2][0])) not in self.model.joins:
            return SPACE + found[1], found[2]
        return SPACE + word, ""

    def _learn(self, wanted: set[str]) -> None:
        new = [x for x in wanted if x not in self.parts]
        if len(self.parts) + len(new) > 2 * REMEMBERED:
            self.parts = {"": b""}
            new = [x for x in wanted if x]
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            ids, cuts = self.model.encode_words(part)
            raw, cuts = ids.astype(np.int32).tobytes(), (4 * cuts).tolist()
            for word, a, b in zip(part, cuts[:-1], cuts[1:], strict=True):
                self.parts[word] = raw[a:b]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker for a model file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(load(path))
    return _ENCODERS[path]


def _slices(texts: list[bytes], limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of a bounded number of bytes, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int, with the end id), text (decoded from the ids) of every row.

    ``model_path`` is a file that every executor has at the same place.

    - A null or empty text has the end id alone and decodes to an empty text.
    - Bytes that are not UTF-8 count as replacement characters.
    - Repeated rows give repeated rows; an empty table an empty one; other columns are ignored.
    """
    return _mapped(docs, model_path, id_col, text_col, _whole, "ids array<int>, text string")


def encode_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, but n_tokens, ids_sha256 and decoded_sha256 in place of ids and text."""
    return _mapped(
        docs, model_path, id_col, text_col, _digests, "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _whole(model: PieceModel, ids: list[np.ndarray]) -> list[pa.Array]:
    texts = [model.decode(x.tolist()).decode("utf-8", "replace") for x in ids]
    return [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]


def _digests(model: PieceModel, ids: list[np.ndarray]) -> list[pa.Array]:
    lists = [x.tolist() for x in ids]
    written = model.written
    return [
        pa.array([len(x) for x in lists], pa.int64()),
        pa.array([hashlib.sha256(b" ".join([written[i] for i in x])).hexdigest() for x in lists]),
        pa.array([hashlib.sha256(model.decode(x)).hexdigest() for x in lists]),
    ]


def _mapped(docs, model_path, id_col, text_col, make, made) -> DataFrame:
    names = ["doc_id", *(x.split()[0] for x in made.split(", "))]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model_path)
        for batch in rows:
            texts = text_bytes(batch.column(1))
            for a, b in _slices(texts):
                ids = own.encode([x.decode("utf-8", "replace") for x in texts[a:b]])
                yield pa.record_batch([batch.column(0)[a:b], *make(own.model, ids)], names)

    narrow = columns(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, {made}")
