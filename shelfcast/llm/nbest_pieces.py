"""Encoding into pieces of a sentencepiece vocabulary with the N best segmentations, and decoding.

A forward Viterbi pass over the lattice of pieces gives, for every place of a text, the score of the best way
to reach it. A search backwards from the end takes these scores as its estimate of what is left; as they are
exact, A* pops complete segmentations in the order of their scores. Its entries are ordered by what they lose
against the best and hold a link to the entry before them, so a text of any length needs memory for its
places, not for copies of paths.

No piece holds a space behind another character, so a text's lattice falls apart before such spaces. The best
segmentation of a text is that of its chunks in a row, and its N best differ from it only in the N - 1 chunks
with the smallest gap between their best and second score; only those are searched.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import resident, text_slices
from shelfcast.llm.language_id import WORD_START, Pieces

#: Chunks kept by a worker; all are let go when there are more, or longer ones.
KEPT_CHUNKS, KEPT_LENGTH = 300_000, 64
#: Characters of chunks that one lattice holds.
LATTICE_CHARS = 40_000
_BOUNDARY = re.compile(r"(?<=[^ ])(?= )")
#: Stands for a literal start mark, which is no piece.
_LITERAL = chr(0x10FFFF)


@dataclass
class Vocabulary:
    """Pieces of the model at ``path`` with spaces in place of start marks.

    A file of merges has ranks instead of probabilities; a piece of rank r then scores -ln(r + 2). A character
    that is no piece is spelled by its bytes, each scoring as the last rank.
    """

    path: str
    scores: dict[str, float] = field(default_factory=dict)
    ids: dict[str, int] = field(default_factory=dict)
    text_of: dict[int, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=self.path)
        size = model.get_piece_size()
        given = [model.get_score(i) for i in range(size)]
        ranked = sum(x == math.floor(x) for x in given) > size // 2
        self.byte_ids = {}
        rank = 0
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.text_of[i] = bytes([int(name[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = name.replace(WORD_START, " ")
                self.ids[plain], self.text_of[i] = i, plain.encode()
                self.scores[plain] = -math.log(rank + 2) if ranked else given[i]
                rank += 1
        if len(self.byte_ids) < 256:
            raise ValueError("the vocabulary must be able to spell bytes")
        self.bytes_of = np.array([self.text_of.get(i) for i in range(size)], dtype=object)
        self.byte_score = min(self.scores.values(), default=-1.0)
        self.longest = max(map(len, self.scores), default=1)
        self.splits = not any(re.search("[^ ] ", x) for x in self.scores)
        self.lookup = Pieces(self.path)
        own = [x.replace(WORD_START, " ") for x in self.lookup.names]
        self.column = np.array([self.scores[x] for x in own] + [0.0, -np.inf])
        self.column_ids = np.array([self.ids[x] for x in own], dtype=np.int64)

    def spelled(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode("utf-8", "surrogatepass")]

    def chunks(self, text: str) -> list[str]:
        """The text behind a space, as the vocabulary's words begin, cut where no piece can cross."""
        if not self.splits:
            return [f" {text}"]
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return _BOUNDARY.split(f" {text}")
        return [f" {x}" for x in text.split(" ")]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def edge_score(v: Vocabulary, part: str) -> float | None:
    found = v.scores.get(part)
    return v.byte_score * len(v.spelled(part)) if found is None and len(part) == 1 else found


def edge_ids(v: Vocabulary, part: str) -> list[int]:
    found = v.ids.get(part)
    return v.spelled(part) if found is None else [found]


def n_best(v: Vocabulary, text: str, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations of a text, best first; of equal scores the one with the longer last pieces."""
    size, known = len(text), v.scores.get
    best = [0.0] + [-math.inf] * size
    into: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
    for end in range(1, size + 1):
        for start in range(max(0, end - v.longest), end):
            score = known(text[start:end])
            if score is None and start == end - 1:
                score = edge_score(v, text[start:end])
            if score is not None:
                into[end].append((start, score))
                best[end] = max(best[end], best[start] + score)
    # of entries that lose the same the last one pushed goes on, so ties are not all followed side by side
    found, heap, pushed = [], [(0.0, 0, size, 0.0, None)], 1
    while heap and len(found) < n:
        lost, _, place, behind, path = heapq.heappop(heap)
        if not place:
            ids = []
            while path:
                start, end, path = path
                ids += edge_ids(v, text[start:end])
            found.append((behind, ids))
            continue
        for start, score in reversed(into[place]):
            loss = lost + (best[place] - (best[start] + score))
            heapq.heappush(heap, (loss, -pushed, start, behind + score, (start, place, path)))
            pushed += 1
    return found


@dataclass
class Segmented:
    """Chunks, one after the other: the ids of the best segmentation, its score and how far the second best is behind.

    Those of chunk i are ``ids[starts[i] : starts[i + 1]]``.
    """

    ids: np.ndarray
    starts: np.ndarray
    scores: np.ndarray
    gaps: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Segmented:
        """From (ids, how many for each chunk, scores, gaps)."""
        if not parts:
            return cls(np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64), np.zeros(0), np.zeros(0))
        ids, sizes, scores, gaps = (np.concatenate(x) for x in zip(*parts))
        return cls(ids, np.concatenate([[0], np.cumsum(sizes)]), scores, gaps)

    def with_others(self, other: Segmented) -> Segmented:
        return Segmented.of([(x.ids, np.diff(x.starts), x.scores, x.gaps) for x in (self, other)])

    def first(self, count: int) -> Segmented:
        return Segmented(self.ids[: self.starts[count]].copy(), self.starts[: count + 1].copy(), self.scores[:count].copy(), self.gaps[:count].copy())

    def take(self, at: np.ndarray) -> Segmented:
        sizes = np.diff(self.starts)[at]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        index = np.repeat(self.starts[at] - starts[:-1], sizes) + np.arange(starts[-1])
        return Segmented(self.ids[index], starts, self.scores[at], self.gaps[at])


def best_and_gap(v: Vocabulary, chunks: list[str]) -> Segmented:
    """The best segmentation of each chunk. ``chunks`` go by length, those of one length are worked on together.

    The second best uses an edge that the best does not; through each edge the best score is forward + edge +
    backward, so the largest of these is the second score. Arrays are (place, chunk), so that a step of all chunks is
    a row.
    """
    found, begin = [], 0
    while begin < len(chunks):
        n = len(chunks[begin])
        end = min(bisect.bisect_right(chunks, n, lo=begin, key=len), begin + max(1, LATTICE_CHARS // n))
        found.append(_of_one_length(v, "".join(chunks[begin:end]), n))
        begin = end
    return Segmented.of(found)


def _of_one_length(v: Vocabulary, joined: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    edges = v.lookup.edges(joined.replace(WORD_START, _LITERAL).replace(" ", WORD_START), n)
    scores = [v.column[e] for e in edges]
    words = edges[0].shape[1]
    start, word = np.nonzero(edges[0] == v.lookup.size)
    if len(start):
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")[word * n + start]
        scores[0][start, word] = v.byte_score * (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))
    ahead, back = np.full((n + 1, words), -np.inf), np.zeros((n + 1, words), dtype=np.int16)
    ahead[0] = 0
    for end in range(1, n + 1):
        for length in range(1, min(len(edges), end) + 1):
            total = ahead[end - length] + scores[length - 1][end - length]
            np.putmask(back[end], total >= ahead[end], length)
            np.maximum(ahead[end], total, out=ahead[end])
    behind = np.full((n + 1, words), -np.inf)
    behind[n] = 0
    for start in range(n - 1, -1, -1):
        for length in range(1, min(len(edges), n - start) + 1):
            np.maximum(behind[start], scores[length - 1][start] + behind[start + length], out=behind[start])
    through = [ahead[: n + 1 - k] + s + behind[k:] for k, s in enumerate(scores, 1)]
    chosen, at = np.full((words, n), -1), np.full(words, n)
    while (live := np.flatnonzero(at > 0)).size:
        length = back[at[live], live].astype(np.int64)
        start = at[live] - length
        for k in np.unique(length):
            some = length == k
            chosen[live[some], start[some]] = edges[k - 1][start[some], live[some]]
            through[k - 1][start[some], live[some]] = -np.inf
        at[live] = start
    second = np.max([x.max(axis=0) for x in through], axis=0)
    word, start = np.nonzero(chosen >= 0)
    piece = chosen[word, start]
    ids = v.column_ids[np.minimum(piece, v.lookup.size - 1)].astype("<u4")
    if (spelled := np.flatnonzero(piece == v.lookup.size)).size:
        parts = [v.spelled(joined[i]) for i in (word[spelled] * n + start[spelled]).tolist()]
        sizes = np.ones(len(piece), dtype=np.int64)
        sizes[spelled] = [len(x) for x in parts]
        of_bytes = np.repeat(piece == v.lookup.size, sizes)
        ids, word = np.repeat(ids, sizes), np.repeat(word, sizes)
        ids[of_bytes] = [x for part in parts for x in part]
    return ids, np.bincount(word, minlength=words), ahead[n], ahead[n] - second


def _found(path: str, chunk: str, n: int) -> tuple[tuple[float, tuple[int, ...]], ...]:
    return tuple((score, tuple(ids)) for score, ids in n_best(vocabulary(path), chunk, n))


_kept_search = lru_cache(maxsize=20_000)(_found)


def _searched(path: str, chunk: str, n: int) -> tuple[tuple[float, tuple[int, ...]], ...]:
    return (_kept_search if len(chunk) <= KEPT_LENGTH else _found)(path, chunk, n)


class Encoder:
    """N-best encoding of texts, with the chunks that come again kept."""

    def __init__(self, path: str, n: int):
        self.v, self.path, self.n = vocabulary(path), path, n
        self.rows: dict[str, int] = {}
        self.kept = Segmented.of([])

    def encode(self, texts: list[str]) -> list[tuple[bytes, float, list[dict]]]:
        """For each text the ids of the best segmentation, its score, and the others as changes to it."""
        parts, rows = [self.v.chunks(t) if t else [] for t in texts], self.rows
        chunks = list(chain.from_iterable(parts))
        at = np.fromiter(map(rows.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(at < 0)
        unknown = [chunks[i] for i in missing.tolist()]
        fresh = sorted(set(unknown), key=len)
        if fresh:
            rows.update(zip(fresh, range(len(rows), len(rows) + len(fresh))))
            at[missing] = [rows[c] for c in unknown]
            self.kept = self.kept.with_others(best_and_gap(self.v, fresh))
        best = self.kept.take(at)
        if len(rows) > KEPT_CHUNKS:
            rows.clear()
            self.kept = Segmented.of([])
        elif fresh and len(fresh[-1]) > KEPT_LENGTH:  # the longest come last
            for chunk in fresh[bisect.bisect_right(fresh, KEPT_LENGTH, key=len) :]:
                del rows[chunk]
            self.kept = self.kept.first(len(rows))
        ends = np.cumsum([len(own) for own in parts], dtype=np.int64).tolist()
        return [self._joined(own, best, end - len(own), end) for own, end in zip(parts, ends)]

    def _joined(self, chunks: list[str], best: Segmented, begin: int, end: int) -> tuple[bytes, float, list[dict]]:
        """``best`` from ``begin`` to ``end`` is that of ``chunks``."""
        if not chunks:
            return b"", 0.0, []
        sizes, gaps = best.starts[begin : end + 1], best.gaps[begin:end]
        ids, score = best.ids[sizes[0] : sizes[-1]].tobytes(), math.fsum(best.scores[begin:end].tolist())
        nearest = np.argpartition(gaps, self.n - 2)[: self.n - 1] if 1 < self.n <= len(gaps) else np.arange(len(gaps) if self.n > 1 else 0)
        open_chunks = sorted(i for i in nearest.tolist() if gaps[i] < math.inf)
        choices = [_searched(self.path, chunks[i], self.n) for i in open_chunks]
        places = {i: (int(sizes[i] - sizes[0]), int(sizes[i + 1] - sizes[i])) for i in open_chunks}
        others = []
        heap, seen = [(0.0, (0,) * len(choices))], {(0,) * len(choices)}
        while heap and len(others) < self.n:
            loss, picked = heapq.heappop(heap)
            changes = [
                {"start": places[i][0], "length": places[i][1], "ids": list(choice[k][1])}
                for i, choice, k in zip(open_chunks, choices, picked) if k
            ]
            others.append({"score": score - loss, "changes": changes})
            for j, choice in enumerate(choices):
                following = (*picked[:j], picked[j] + 1, *picked[j + 1 :])
                if following[j] < len(choice) and following not in seen:
                    seen.add(following)
                    lost = sum(c[0][0] - c[k][0] for c, k in zip(choices, following))
                    heapq.heappush(heap, (lost, following))
        return ids, score, others[1:]


def encoder(path: str, n: int) -> Encoder:
    """One encoder for each worker process, vocabulary and number of segmentations."""
    return resident(("pieces", path, n), lambda: Encoder(path, n))


def decoded(v: Vocabulary, ids: np.ndarray) -> str:
    """The text of a segmentation: its pieces in a row without the space put before the text."""
    text = b"".join(v.bytes_of[ids].tolist()).decode("utf-8", "surrogatepass")
    return text[1:] if text[:1] == " " else text


_CHANGE = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
_OTHER = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("changes", T.ArrayType(_CHANGE))])
_BEST = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("score", T.DoubleType()), T.StructField("others", T.ArrayType(_OTHER)), T.StructField("exact", T.BooleanType())])


def encode(docs: DataFrame, path: str, n: int = 3, column: str = "pieces") -> DataFrame:
    """The rows and columns of ``docs`` with a struct (ids, score, others, exact) of whole texts' N best segmentations.

    ``ids`` are little-endian unsigned 32-bit integers of the best one; ``others`` are the next up to n - 1, each by its
    score and the stretches of ``ids`` that it replaces; ``exact`` says whether decoding ``ids`` gives the text. Null and empty texts have no ids and a score of 0. One
    pass without a shuffle; a column of the added name is replaced.
    """
    @F.pandas_udf(_BEST)
    def best(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path, n)
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string())], names=["text"])
            rows = [
                (*r, decoded(own.v, np.frombuffer(r[0], dtype="<u4")) == t)
                for _, part in text_slices([batch]) for t, r in zip(part, own.encode(part))
            ]
            yield pd.DataFrame(rows, columns=["ids", "score", "others", "exact"])

    return docs.withColumn(column, best("text"))


def decode(ids: Column, path: str) -> Column:
    """The text behind a column of ids, as ``encode`` writes them."""
    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        v = vocabulary(path)
        return column.map(lambda x: None if x is None else decoded(v, np.frombuffer(x, dtype="<u4")))

    return text(ids)
