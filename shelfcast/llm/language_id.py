"""Language identification by unigram pieces, marginalised over all segmentations.

Every language has a probability for each piece of one fixed public vocabulary. The probability of a word
is the sum over all ways to cut it into pieces of the product of their probabilities; a forward pass adds
them up without listing them. A text is judged by the sum of the log probabilities of all its words.

Words are runs of letters in lower case, with the vocabulary's mark for a word's start before them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import release, resident, stored, text_slices

WORD_START = "▁"
NOTHING = "und"
#: Longer runs of letters are cut into blocks of so many letters, each judged as a word.
BLOCK = 48
#: Words kept by a worker; all are let go when there are more.
KEPT_WORDS = 200_000
#: Probability of a letter that is no piece of the vocabulary, the same in every language.
UNKNOWN = 1e-9
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX, _SLOT_BITS = np.uint64(0xD6E8FEB86659FD93), 19


def words_of(text: str) -> list[str]:
    found = _LETTERS.findall(text.lower())
    if any(len(w) > BLOCK for w in found):
        found = [w[i : i + BLOCK] for w in found for i in range(0, len(w), BLOCK)]
    return found


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * _MIX >> np.uint64(64 - _SLOT_BITS)).astype(np.intp)


class Pieces:
    """The vocabulary of a sentencepiece model, looked up by hashes of whole columns of substrings."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.names = sorted(set(names))
        self.size, self.longest = len(self.names), max(map(len, self.names), default=1)
        keys = np.array([self._key(n) for n in self.names], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order.astype(np.int64)
        self.slots = np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        self.slots[_slot(self.keys)] = np.arange(self.size)

    @staticmethod
    def _key(name: str) -> int:
        key = 0
        for c in name:
            key = (key * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return key

    def lattice(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length: per piece length l an array (word, start) of ids.

        ``size`` stands for a letter that is no piece, ``size + 1`` for no edge.
        """
        return [e.T for e in self.edges("".join(words), len(words[0]))]

    def edges(self, joined: str, n: int) -> list[np.ndarray]:
        """The same as arrays (start, word), for words of ``n`` letters in a row.

        Most substrings are no pieces; their slots in a table of places are empty. Pieces that share one are searched for.
        """
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(-1, n).T.astype(np.uint64, order="C")
        key, edges = np.zeros_like(codes), []
        for length in range(1, min(n, self.longest) + 1):
            key = key[: n - length + 1] * _BASE + codes[length - 1 :] + np.uint64(1)
            found = np.full(key.shape, self.size if length == 1 else self.size + 1)
            at = self.slots[_slot(key)].ravel()
            asked = np.flatnonzero(at >= 0)
            keys, at = key.ravel()[asked], at[asked]
            other = np.flatnonzero(self.keys[at] != keys)
            at[other] = np.minimum(np.searchsorted(self.keys, keys[other]), self.size - 1)
            known = self.keys[at] == keys
            found.ravel()[asked[known]] = self.ids[at[known]]
            edges.append(found)
        return edges


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def with_fixed_rows(probabilities: np.ndarray) -> np.ndarray:
    """A row for unknown letters and one for no edge after those of the pieces."""
    columns = probabilities.shape[1]
    return np.vstack([probabilities, np.full((1, columns), UNKNOWN), np.zeros((1, columns))])


def forward(edges: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Probability of each prefix, (word, end, language), summed over all segmentations."""
    words, n = edges[0].shape
    alpha = np.zeros((words, n + 1, rows.shape[1]))
    alpha[:, 0] = 1
    for end in range(1, n + 1):
        for length in range(1, min(len(edges), end) + 1):
            alpha[:, end] += alpha[:, end - length] * rows[edges[length - 1][:, end - length]]
    return alpha


def by_length(words: list[str], chars: int = 40_000) -> Iterator[list[int]]:
    """Positions of words of one length, about so many characters at a time."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for length, group in groups.items():
        at_once = max(1, chars // max(1, length))
        for i in range(0, len(group), at_once):
            yield group[i : i + at_once]


def log_probabilities(words: list[str], vocabulary: Pieces, rows: np.ndarray) -> np.ndarray:
    """Natural logarithm of each word's marginal probability in each language."""
    out = np.zeros((len(words), rows.shape[1]))
    for own in by_length(words):
        alpha = forward(vocabulary.lattice([WORD_START + words[i] for i in own]), rows)
        out[own] = np.log(np.maximum(alpha[:, -1], 1e-300))
    return out


def expected_counts(words: list[str], weights: np.ndarray, vocabulary: Pieces, rows: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the weighted words, over all segmentations, for one language."""
    counts = np.zeros(len(rows))
    for own in by_length(words):
        edges = vocabulary.lattice([WORD_START + words[i] for i in own])
        alpha = forward(edges, rows)[:, :, 0]
        n = alpha.shape[1] - 1
        beta = np.zeros_like(alpha)
        beta[:, n] = 1
        for start in range(n - 1, -1, -1):
            for length in range(1, min(len(edges), n - start) + 1):
                beta[:, start] += rows[edges[length - 1][:, start], 0] * beta[:, start + length]
        scale = weights[own] / np.maximum(alpha[:, n], 1e-300)
        for length, ids in enumerate(edges, 1):
            share = alpha[:, : n + 1 - length] * rows[ids, 0] * beta[:, length:] * scale[:, None]
            counts += np.bincount(ids.ravel(), weights=share.ravel(), minlength=len(rows))
    return counts


@dataclass(frozen=True)
class LanguageModel:
    """``probabilities`` has a row for each piece of the vocabulary at ``vocabulary`` and a column per language."""

    languages: list[str]
    probabilities: np.ndarray
    vocabulary: str


def fit(
    labelled: DataFrame, vocabulary: str, docs_per_language: int = 1_000, rounds: int = 3, smoothing: float = 0.1
) -> LanguageModel:
    """Learn from rows (text, lang) by expectation maximisation over the piece lattice.

    Of each language about ``docs_per_language`` whole texts are used, chosen by a hash of the text; this bounds
    the work of fitting. Rows with a null text or lang are passed over. Word counts stay in a stored table;
    the driver sees one expected count for each language and piece.
    """
    known = labelled.select("text", "lang").where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    own = pieces(vocabulary)
    probabilities = np.full((own.size, len(languages)), 1 / own.size)
    if not languages:
        return LanguageModel([], probabilities, vocabulary)
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(docs_per_language / sizes[k]))])
    # 2**20 hash values, so the chosen share follows the ratio closely
    chosen = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    split = F.pandas_udf(lambda texts: texts.map(words_of), "array<string>")
    words = stored(
        chosen.select("lang", F.explode(split("text")).alias("word")).groupBy("lang", "word")
        .agg(F.count("*").alias("n")), "language-words",
    )
    for _ in range(rounds):
        rows = with_fixed_rows(probabilities)

        def expect(batches: Iterator[pd.DataFrame], rows: np.ndarray = rows) -> Iterator[pd.DataFrame]:
            vocabulary_of_task = pieces(vocabulary)
            for batch in batches:
                for lang, part in batch.groupby("lang"):
                    column = rows[:, [languages.index(lang)]]
                    counts = expected_counts(
                        part["word"].tolist(), part["n"].to_numpy(dtype=float), vocabulary_of_task, column
                    )[: vocabulary_of_task.size]
                    at = np.flatnonzero(counts)
                    yield pd.DataFrame({"lang": lang, "piece": at, "n": counts[at]})

        found = words.mapInPandas(expect, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        counts = np.full_like(probabilities, smoothing)
        for lang, part in found.toPandas().groupby("lang"):
            counts[part["piece"].to_numpy(), languages.index(lang)] += part["n"].to_numpy()
        probabilities = counts / counts.sum(axis=0)
    return LanguageModel(languages, probabilities, vocabulary)


class _Scorer:
    """Log probabilities of words by a model, kept for the words that come again."""

    def __init__(self, model: LanguageModel):
        self.model, self.vocabulary = model, pieces(model.vocabulary)
        self.rows = with_fixed_rows(model.probabilities)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, self.rows.shape[1]))

    def totals(self, texts: list[str]) -> np.ndarray:
        """Sum of the log probabilities of all words of each text."""
        words = [words_of(t) for t in texts]
        if len(self.index) > KEPT_WORDS:
            self._clear()
        index = self.index
        fresh = sorted({w for own in words for w in own if w not in index})
        first = len(index)
        index.update((w, first + i) for i, w in enumerate(fresh))
        if len(index) > len(self.table):
            self.table = np.vstack([self.table, np.zeros((len(index), self.rows.shape[1]))])
        self.table[first : first + len(fresh)] = log_probabilities(fresh, self.vocabulary, self.rows)
        out = np.zeros((len(texts), self.rows.shape[1]))
        for i, own in enumerate(words):
            if own:
                out[i] = self.table[np.fromiter(map(index.__getitem__, own), dtype=np.int64, count=len(own))].sum(axis=0)
        return out


def identify(docs: DataFrame, model: LanguageModel, key: str = "language") -> DataFrame:
    """The rows and columns of ``docs`` with ``<key>_pred`` and ``<key>_score`` added.

    The prediction is the language of the highest likelihood (of equals the first by name) and the score its
    posterior under equal priors, 0 to 1. A text that is null or has no letter, and every text under a model
    without languages, gets ``und`` and 0. Only ``text`` is looked at, whole; a column of the added names is
    replaced. One pass without a shuffle, so ties, copies and hot sources make no difference.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # pieces x languages, whatever the corpus
    name = f"{abs(hash((tuple(model.languages), model.probabilities.tobytes(), model.vocabulary)))}"

    @F.pandas_udf("pred string, score double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = resident(("words", name), lambda: _Scorer(shared.value))
        languages = np.array([*scorer.model.languages, NOTHING], dtype=object)
        for series in texts:
            batch = pa.RecordBatch.from_arrays([pa.array(series, pa.string())], names=["text"])
            pred, score = [], []
            for _, own in text_slices([batch]):
                letters = np.array([has_letter(t) for t in own], dtype=bool)
                if len(languages) == 1:
                    letters[:] = False
                    best, share = np.zeros(len(own), dtype=int), np.zeros(len(own))
                else:
                    totals = scorer.totals(own)
                    best = totals.argmax(axis=1)
                    share = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
                pred += languages[np.where(letters, best, len(languages) - 1)].tolist()
                score += np.where(letters, share, 0.0).tolist()
            yield pd.DataFrame({"pred": pred, "score": score})
        release()

    return (
        docs.withColumn(f"{key}_pred", judged("text"))
        .withColumn(f"{key}_score", F.col(f"{key}_pred.score"))
        .withColumn(f"{key}_pred", F.col(f"{key}_pred.pred"))
    )
