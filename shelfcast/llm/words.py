"""Splits texts into the words of the byte-level pattern by array operations, and encodes each distinct word once.

A byte-level tokenizer first splits a text into words by one fixed pattern and then encodes each word by itself.
Words repeat far more often than texts, so a slice of texts is split by array operations over its characters, its
distinct words are found by Arrow, and only words that are not known yet are encoded. Ids of whole texts are
gathered from those of their words in one step.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain
from typing import Protocol

import numpy as np
import pyarrow as pa

#: Words kept by a worker in each of two generations, so its memory stays bounded.
KEPT_WORDS = 300_000
#: Longer words (in bytes) are encoded each time.
KEPT_LENGTH = 64
#: Kinds of characters; the edge stands before and after each text.
_LETTER, _NUMBER, _OTHER, _SPACE, _EDGE = range(5)
EDGE_CODE = 0x110000
#: Fixed values of the pattern: what follows an apostrophe in a word of its own.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def as_bytes(values: pa.BinaryArray) -> list[bytes]:
    """The values cut out of their buffer, which is faster than one scalar each."""
    _, offsets, data = values.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int32)[values.offset : values.offset + len(values) + 1].tolist()
    whole = data.to_pybytes() if data is not None else b""
    return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


class _Generations:
    """A bounded dictionary: what was not asked for while the younger half filled up is let go."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def again(self, key: bytes) -> bytes | None:
        """The value of a key that the younger half lacks; it moves there."""
        value = self.old.get(key)
        if value is not None:
            self.young[key] = value
        return value

    def add(self, found: dict[bytes, bytes]) -> None:
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        self.young.update(found)


#: What stands before a character to see whether it goes on: it joins the run of its own kind only.
PROBES = (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER))


class WordSplitter:
    """Finds the words of the pattern in arrays of characters.

    ``one_word`` says of short texts whether each is a single word; kinds of characters are asked from it once, so
    they are those of the library that it stands for.
    """

    def __init__(self, one_word: Callable[[list[str]], list[bool]]):
        self.one_word = one_word
        self.kinds = np.full(EDGE_CODE + 1, -1, dtype=np.int8)
        self.kinds[EDGE_CODE] = _EDGE

    def _learn(self, codes: list[int]) -> None:
        self.kinds[codes] = _SPACE  # what joins no run is white space
        for before, kind in PROBES:
            joins = self.one_word([before + chr(c) for c in codes])
            self.kinds[[c for c, yes in zip(codes, joins) if yes]] = kind

    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character; an edge is a word of its own."""
        kinds = self.kinds[codes]
        if (kinds < 0).any():
            self._learn(np.unique(codes[kinds < 0]).tolist())
            kinds = self.kinds[codes]
        before, after = np.roll(kinds, 1), np.roll(kinds, -1)
        starts = kinds != before
        # a space goes with what follows; of a run of white space all but the last go together, unless the text ends
        spaced = np.roll(codes, 1) == 0x20
        starts &= ~(spaced & (kinds < _SPACE))
        starts |= (kinds == _SPACE) & (before == _SPACE) & (after < _SPACE)
        own = np.flatnonzero((codes == 0x27) & (before != _OTHER) & ~spaced)
        if own.size:
            # the edge at the end keeps every look ahead inside: it matches no ending
            first, second = codes[own + 1], codes[np.minimum(own + 2, len(codes) - 1)]
            for ending in _ENDINGS:
                hit = own[(first == ord(ending[0])) & ((second == ord(ending[-1])) if len(ending) == 2 else True)]
                starts[hit + 1] = False
                starts[hit + 1 + len(ending)] |= kinds[hit + 1 + len(ending)] < _SPACE
                if len(ending) == 2:
                    starts[hit + 2] = False
        starts[kinds == _EDGE] = True
        return starts


class Splitter(Protocol):
    def starts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character of texts with an edge before, between and after them."""


class WordEncoder:
    """Ids of texts from those of their words, which ``fresh`` gives for distinct words that are not kept."""

    def __init__(self, splitter: Splitter, fresh: Callable[[list[bytes]], list[list[int]]], kept: int = KEPT_WORDS):
        self.splitter, self.encode_words = splitter, fresh
        self.kept = _Generations(kept)

    def fresh(self, words: list[bytes]) -> list[bytes]:
        found = self.encode_words(words)
        data = np.fromiter(chain.from_iterable(found), dtype="<u4").tobytes()
        cuts = np.cumsum([0, *map(len, found)]).tolist()
        return [data[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, by the tokenizer where they are not kept."""
        found = list(map(self.kept.young.get, words))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = self.kept.again(words[i])
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh = self.fresh([words[i] for i in missing])
        for i, ids in zip(missing, fresh):
            found[i] = ids
        self.kept.add({words[i]: ids for i, ids in zip(missing, fresh) if len(words[i]) <= KEPT_LENGTH})
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if not any(texts):
            return [b""] * len(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        codes = np.full(int(lengths.sum()) + len(texts) + 1, EDGE_CODE, dtype=np.uint32)
        inside = np.ones(len(codes), dtype=bool)
        edges = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside[edges] = False
        data = "".join(texts)
        codes[inside] = np.frombuffer(data.encode("utf-32-le"), dtype="<u4")
        starts = self.splitter.starts(codes)
        # edges hold no bytes, so the words between them lie next to each other in the bytes of all texts
        sizes = inside.astype(np.int8) + (inside & (codes >= 0x80)) + (inside & (codes >= 0x800)) + (inside & (codes >= 0x10000))
        begins = np.cumsum(sizes, dtype=np.int32) - sizes
        at = starts & inside
        places = begins[at]
        offsets = np.append(places, begins[-1]).astype(np.int32)
        words = pa.Array.from_buffers(
            pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(data.encode())]
        ).dictionary_encode()
        known = self._ids(as_bytes(words.dictionary))
        which = words.indices.to_numpy()
        counts = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        table = np.frombuffer(b"".join(known), dtype="<u4")
        first, n = (np.cumsum(counts) - counts)[which], counts[which]
        ends = np.cumsum(n)
        ids = table[np.arange(int(ends[-1])) + np.repeat(first - (ends - n), n)].tobytes()
        words_before = np.cumsum(at)[edges]
        cuts = np.concatenate([[0], ends])[words_before].tolist()
        return [ids[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]
