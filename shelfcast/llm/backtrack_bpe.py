"""Byte-level BPE encoding by backtracking over longest matches, and decoding.

An automaton over all tokens (bytes read as Latin-1 characters) finds the longest token that starts at each byte of
a word. The encoder goes ahead with longest tokens and takes a shorter one, or goes back by a token, where two
neighbours could not stand side by side after merging. Whether they can is read off the last merges of both tokens
and remembered. A byte that turned out to be a dead end is never tried again, so a word of any length takes linear
time, and what comes out are the tokens that merging by ranks gives.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import release, resident, text_slices
from shelfcast.llm.words import WordEncoder, WordSplitter

#: Fixed value: the pattern whose matches are encoded one by one.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Neighbours whose compatibility a worker remembers; all are let go when there are more.
KEPT_PAIRS = 200_000


class Merges:
    """The tokens of a file of ranks, how each came about, and which may be neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold every byte")
        self.ids = ranks
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.size = {i: len(token) for token, i in ranks.items()}
        self.kept: dict[tuple[int, int], bool] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in sorted(ranks.items(), key=lambda item: item[1]):
            self._add(token, i)
        # a token that its own merges do not lead to is only ever a whole word
        reached = self.halves.keys()
        for token, i in ranks.items():
            self.shorter[i] = next((p for p in self._prefixes(token) if p in reached), None)
            if i in reached:
                self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()

    def _prefixes(self, token: bytes) -> Iterator[int]:
        """Tokens that a token begins with, longest first, without itself."""
        for n in range(len(token) - 1, 0, -1):
            found = self.ids.get(token[:n])
            if found is not None:
                yield found

    def _add(self, token: bytes, i: int) -> None:
        """Find the two tokens of lower rank whose merge makes a token: the only ones that may stand side by side."""
        if len(token) == 1:
            self.halves[i] = None
            return
        for left in self._prefixes(token):
            right = self.ids.get(token[self.size[left] :])
            if right is None or left not in self.halves or right not in self.halves:
                continue
            if self._side_by_side(left, right):
                self.halves[i] = (left, right)
                self.joined[left, right] = i
                return

    def _side_by_side(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both in a row leaves the two tokens.

        Their merges are undone step by step, the latest first. At each step the two tokens at the seam must
        not have a merge of their own that comes before the one undone last, or it would have joined them.
        """
        left_limit = right_limit = None
        while True:
            merge = self.joined.get((left, right))
            if merge is not None and not (
                (left_limit is not None and left_limit <= merge) or (right_limit is not None and right_limit < merge)
            ):
                return False
            left_parts, right_parts = self.halves[left], self.halves[right]
            if left_parts is None and right_parts is None:
                return True
            # of two merges the one of the higher rank was made later; of one rank the left one was made first
            if right_parts is None or (left_parts is not None and left > right):
                left_limit, right_limit, left = left, None, left_parts[1]
            else:
                left_limit, right_limit, right = None, right, right_parts[0]

    def neighbours(self, left: int, right: int) -> bool:
        found = self.kept.get((left, right))
        if found is None:
            if len(self.kept) >= KEPT_PAIRS:
                self.kept.clear()
            found = self.kept[left, right] = self._side_by_side(left, right)
        return found

    def word(self, data: bytes) -> list[int]:
        """The ids of one word."""
        whole = self.ids.get(data)
        if whole is not None or not data:
            return [] if whole is None else [whole]
        size, shorter, n, known = self.size, self.shorter, len(data), self.kept.get
        longest = [0] * n
        for last, token in self.automaton.iter(data.decode("latin-1")):
            longest[last + 1 - size[token]] = token  # ends come in order, so the longest token stays
        usable = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + size[token]
            if usable[end] and (not out or known((out[-1], token)) or self.neighbours(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else 0
            elif shorter[token] is not None:
                token = shorter[token]
            else:
                usable[at] = 0
                token = out.pop()
                at -= size[token]
        return out


class Encoder(WordEncoder):
    """Encodes texts: each word of the pattern by itself, words that come again are kept."""

    def __init__(self, path: str):
        self.merges = merges(path)
        super().__init__(WordSplitter(one_word), lambda words: list(map(self.merges.word, words)))


def one_word(texts: list[str]) -> list[bool]:
    """Whether tiktoken takes each text as one word: then it is one token if the text is in the vocabulary.

    Libraries know different versions of Unicode, so kinds of characters are asked from the one to be equal to.
    """
    ranks = {bytes([b]): b for b in range(256)}
    for text in texts:
        ranks.setdefault(text.encode(), len(ranks))
    probe = tiktoken.Encoding("probe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [len(probe.encode_ordinary(t)) == 1 for t in texts]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks out of a file with one token a line: its bytes in base 64, a space, its rank."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


@cache
def merges(path: str) -> Merges:
    return Merges(read_ranks(path))


@cache
def token_bytes(path: str) -> dict[int, bytes]:
    return {i: token for token, i in read_ranks(path).items()}


def decoded(of: dict[int, bytes], ids: bytes) -> bytes:
    return b"".join(map(of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return resident(("backtrack", path), lambda: Encoder(path))


def encode(docs: DataFrame, path: str, column: str = "tokens") -> DataFrame:
    """The rows and columns of ``docs`` with a struct (ids, decoded) of each whole ``text``.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` the bytes that they stand for, read back from
    them in the same pass. A null or empty text has no ids (an empty binary). Rows that repeat, or have no doc_id,
    are encoded like all others; a column of the added name is replaced. One pass without a shuffle; an empty table
    gives an empty table. A text of one endless word takes memory for its bytes and time in proportion.
    """

    @F.arrow_udf("ids binary, decoded binary")
    def tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path)
        for array in texts:
            batch = pa.RecordBatch.from_arrays([array], names=["text"])
            ids, back = [], []
            for _, part in text_slices(iter([batch])):
                found = own.encode(part)
                ids.append(pa.array(found, pa.binary()))
                back.append(pa.array([decoded(own.merges.bytes_of, x) for x in found], pa.binary()))
            yield pa.StructArray.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(back)], names=["ids", "decoded"])
        release()  # at the end of a task, not of a batch

    return docs.withColumn(column, tokens(F.col("text")))


def decode(ids: Column, path: str) -> Column:
    """The bytes behind a column of ids, as ``encode`` writes them; null for null. An unknown id is an error."""

    @F.arrow_udf("binary")
    def whole(column: pa.Array) -> pa.Array:
        of = token_bytes(path)
        return pa.array([None if x is None else decoded(of, x) for x in column.to_pylist()], pa.binary())

    return whole(ids)
