import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import messy_rows
from pyspark.sql import functions as F

from shelfcast.llm import backtrack_bpe, queries
from shelfcast.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    ranks = backtrack_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(data):
    return np.frombuffer(data, dtype="<u4").tolist()


def test_the_pattern_is_the_published_one():
    assert backtrack_bpe.PATTERN == public_tokenizers.PATTERN


def merged(ranks, data):
    """Merging by ranks as it is defined: the lowest rank first, of equal ones the leftmost."""
    parts = [bytes([b]) for b in data]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(30))
def test_small_vocabularies_equal_merging_by_ranks(seed):
    """Vocabularies grown by merges of random pairs, with runs of one letter, where ties and dead ends are frequent."""
    rng = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    tokens = [b"a", b"b", b"c"]
    while len(ranks) < 256 + 25:
        pair = merged(ranks, b"".join(rng.choice(tokens) for _ in range(6)))
        by_id = {i: t for t, i in ranks.items()}
        if len(pair) > 1:
            i = rng.randrange(len(pair) - 1)
            token = by_id[pair[i]] + by_id[pair[i + 1]]
            ranks[token] = len(ranks)
            tokens.append(token)
    merges = backtrack_bpe.Merges(ranks)
    for _ in range(400):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 24)))
        assert merges.word(word) == ([ranks[word]] if word in ranks else merged(ranks, word))


def test_tokens_that_merges_do_not_reach_are_whole_words_only():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"xyz": 258, b"bcd": 259}
    merges = backtrack_bpe.Merges(ranks)
    assert merges.word(b"xyz") == [258] and merges.word(b"bcd") == [259]
    for word in (b"xyzx", b"axyz", b"abcd", b"bcda", b"ab", b"abc", b"aabcbcd"):
        assert merges.word(word) == ([ranks[word]] if word in ranks else merged(ranks, word))


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    ranks = backtrack_bpe.merges(RANKS).ids
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ids_of(backtrack_bpe.encoder(RANKS).encode([text])[0]) == library.encode_ordinary(text)


def test_every_character_is_split_as_the_library_does(library):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1 {c}!{c}'s{c}" for c in characters[::5]]
    for text, ids in zip(texts, backtrack_bpe.Encoder(RANKS).encode(texts)):
        assert ids_of(ids) == library.encode_ordinary(text)


@pytest.mark.parametrize("word", ["a" * 100_000, "日本語" * 30_000, "ab" * 50_000, "the" * 40_000, "=-" * 50_000])
def test_long_words(library, word):
    found = ids_of(backtrack_bpe.Encoder(RANKS).encode([word])[0])
    assert b"".join(map(library.decode_single_token_bytes, found)) == word.encode()
    short = word[:6_000]
    assert ids_of(backtrack_bpe.Encoder(RANKS).encode([short])[0]) == library.encode_ordinary(short)


def test_messy_rows_keep_their_columns_and_go_back(messy, nothing, library):
    rows = backtrack_bpe.encode(messy, RANKS, column="kept").withColumn("back", backtrack_bpe.decode(F.col("kept.ids"), RANKS))
    found = rows.collect()
    assert rows.columns == [*messy.columns, "back"] and len(found) == len(messy_rows())
    for row in found:
        assert ids_of(row["kept"]["ids"]) == library.encode_ordinary(row["text"] or "")
        assert row["back"] == row["kept"]["decoded"] == (row["text"] or "").encode()
    assert backtrack_bpe.encode(nothing, RANKS).collect() == []
    assert messy.limit(1).select(backtrack_bpe.decode(F.lit(None).cast("binary"), RANKS)).first()[0] is None


def test_a_vocabulary_without_a_byte_is_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(255)))
    with pytest.raises(ValueError, match="every byte"):
        backtrack_bpe.merges(str(path))


def test_the_registered_query_equals_the_library(spark, library):
    expected = {}
    for row in table(spark, SMALLEST, "documents").collect():
        text = row["text"] or ""
        ids = np.array(library.encode_ordinary(text), dtype="<u4")
        expected[row["doc_id"]] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    found = queries.op13_backtrack_bpe(spark, SMALLEST)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r["doc_id"]: tuple(r)[1:] for r in found.collect()} == expected
