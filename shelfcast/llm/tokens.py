"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from shelfcast.llm.common import resident
from shelfcast.llm.words import KEPT_WORDS, WordEncoder, WordSplitter


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class TextEncoder:
    """Encodes texts with the byte-level tokenizer file at ``path``, without special tokens being added.

    The strings of special tokens in a text are special tokens, or plain text if ``plain``. A tokenizer that does
    not split by the pattern encodes texts as a whole.
    """

    def __init__(self, path: str, plain: bool = False, kept: int = KEPT_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.specials = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        splitter = self.tokenizer.pre_tokenizer
        byte_level = isinstance(splitter, pre_tokenizers.ByteLevel) and splitter.use_regex and not splitter.add_prefix_space
        self.by_words = byte_level and self.tokenizer.normalizer is None
        self.characters = {b: c for b, c in enumerate(byte_characters())}
        self.words = WordEncoder(WordSplitter(self._one_word), self._merged, kept)

    def _one_word(self, texts: list[str]) -> list[bool]:
        return [len(self.tokenizer.pre_tokenizer.pre_tokenize_str(t)) == 1 for t in texts]

    def _merged(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words by the tokenizer's merges; the words are already what its pattern gives."""
        mapped, tokenize = b"".join(words).decode("latin-1").translate(self.characters), self.tokenizer.model.tokenize
        ends = np.cumsum([0, *map(len, words)]).tolist()
        return [[t.id for t in tokenize(mapped[a:b])] for a, b in zip(ends, ends[1:])]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if not self.by_words:
            return list(map(self._whole, texts))
        special = {i: self._whole(t) for i, t in enumerate(texts) if any(s in t for s in self.specials)}
        found = self.words.encode(["" if i in special else t for i, t in enumerate(texts)])
        return [special.get(i, ids) for i, ids in enumerate(found)]


def encoder(path: str, plain: bool = False) -> TextEncoder:
    """One encoder for each worker process and file."""
    return resident(("words", path, plain), lambda: TextEncoder(path, plain))
