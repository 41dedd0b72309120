import random
import zlib
from math import ceil

import numpy as np
import public_tokenizers
import pytest
from llm_rows import messy_rows
from tokenizers import Tokenizer

from shelfcast.llm import binary_records, slack_packing
from shelfcast.llm.tokens import TextEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(BPE)


def ids_of(text, end):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [end]


def test_words_give_the_ids_of_whole_texts():
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "\n\n", ".", ",", "'s", "1", "²", "½", "é", "日本", "|", "\t", "<|endoftext|>", "_", "-", "'ll", "\r", "😀", "ª", "Ⅷ", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4_000)]
    own = TextEncoder(BPE)
    found = own.encode(texts[:2_000]) + own.encode(texts[2_000:])
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in found] == [ids_of(t, 0)[:-1] for t in texts]


@pytest.mark.parametrize("seed", range(20))
def test_fullest_combination_matches_brute_force(seed):
    rng = random.Random(seed)
    capacity = rng.randint(1, 40)
    counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    chosen = slack_packing.fullest(counts, capacity)
    assert all(n <= counts[k] for k, n in chosen.items())
    assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= capacity)


def least_bins(counts, capacity):
    """A lower bound: pieces over half a bin stand alone, the smaller ones fill what those leave."""
    bounds = []
    for k in range(capacity // 2 + 1):
        huge = sum(n for x, n in counts.items() if x > capacity - k)
        large = [(x, n) for x, n in counts.items() if capacity / 2 < x <= capacity - k]
        small = sum(x * n for x, n in counts.items() if k <= x <= capacity / 2)
        room = sum((capacity - x) * n for x, n in large)
        bounds.append(huge + sum(n for _, n in large) + max(0, ceil((small - room) / capacity)))
    return max(bounds)


def test_plan_places_every_piece_once_without_gaps():
    rng = random.Random(2)
    counts = {rng.randint(1, 64): rng.randint(1, 500) for _ in range(40)}
    slots = slack_packing.plan_bins(counts, 64)
    bins = {}
    for length, n in counts.items():
        for s, o in zip(*slots.place(np.full(n, length), np.arange(n))):
            bins.setdefault(int(s), []).append((int(o), length))
    assert sum(map(len, bins.values())) == sum(counts.values()) and len(bins) == slots.sequences
    for own in bins.values():
        at = 0
        for o, length in sorted(own):
            assert o == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.02 * least_bins(counts, 64)


def test_packed_documents(messy):
    rows = slack_packing.pack(messy, BPE, capacity=64, end_id=2).collect()
    expected = []
    for doc_id, text, *_ in messy_rows():
        ids = ids_of(text, 2)
        cuts = [0, *range((len(ids) - 1) % 64 + 1, len(ids) + 1, 64)]
        expected += [(doc_id, k, a, tuple(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    found = [(r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], dtype="<u4").tolist())) for r in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    sequences = slack_packing.sequences(slack_packing.pack(messy, BPE, capacity=64, end_id=2)).collect()
    assert sum(len(r["ids"]) for r in sequences) == 4 * sum(len(x[3]) for x in expected)
    assert max(len(r["ids"]) for r in sequences) <= 4 * 64


def test_nothing_to_pack(nothing):
    assert slack_packing.pack(nothing, BPE).collect() == []


def test_checksums():
    # known values of CRC-32C
    assert binary_records.crc32c([b"123456789", b"", b"\0" * 32]).tolist() == [0xE3069283, 0, 0x8A9136AA]
    records = [bytes(range(n % 251)) * (n // 50 + 1) for n in range(600)]
    assert binary_records.unframed(binary_records.framed(records)) == records
    broken = binary_records.framed([b"abcdef"])[0]
    for i in range(len(broken)):
        with pytest.raises(ValueError):
            binary_records.unframed([broken[:i] + bytes([broken[i] ^ 1]) + broken[i + 1 :]])


def test_records_round_trip(spark, messy, tmp_path):
    directory = f"file://{tmp_path}/records"
    binary_records.write_records(messy, directory, BPE, end_id=0)
    rows = sorted(binary_records.read_records(spark, directory).collect(), key=lambda r: r["start"])
    ordered = sorted(messy_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (doc_id, text, *_) in zip(rows, ordered, strict=True):
        ids = ids_of(text, 0)
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc_id, start, len(ids))
        assert zlib.crc32(r["ids"]) == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_no_records(spark, nothing, tmp_path):
    directory = f"file://{tmp_path}/records"
    binary_records.write_records(nothing, directory, BPE)
    assert binary_records.read_records(spark, directory).collect() == []
