import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_rows import messy_rows
from tokenizers import Tokenizer

from shelfcast.llm import queries, token_alignment
from shelfcast.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALLEST = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def pair():
    return token_alignment.Pair(A, B)


def both_ids(libraries, text):
    """Ids of both libraries, none where the pieces do not spell the text."""
    a, b = libraries
    if not text:
        return [], []
    found = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    return found if spelled(b, found[1]) == (" " + text).encode() else ([], [])


def spelled(model, ids):
    names = [(model.is_byte(i), model.id_to_piece(i)) for i in ids]
    return b"".join(bytes([int(n[3:5], 16)]) if byte else n.replace("▁", " ").encode() for byte, n in names)


def plain_groups(libraries, text):
    """Two pointers over byte offsets, one token at a time."""
    a, b = both_ids(libraries, text)
    model = libraries[1]
    known = {i: token for token, i in libraries[0].get_vocab().items()}
    groups, i, j, at_a, at_b, left, right = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            left.append(a[i])
            at_a += len(known[a[i]])
            i += 1
        else:
            right.append(b[j])
            at_b += len(spelled(model, [b[j]]))
            j += 1
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    return groups


def brute(libraries, rows):
    """The query's columns by counting everything in dictionaries."""
    groups = [plain_groups(libraries, text) for _, text in rows]
    links = [[(x, y) for left, right in own for x in left for y in right] for own in groups]
    counts = Counter(p for own in links for p in set(own))
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (doc_id, _), own, pairs in zip(rows, groups, links):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in own)
        out.append((
            doc_id, sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own), len(pairs),
            sum(counts[p] == highest[p[0]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


def test_odd_texts_have_the_ids_of_the_libraries(libraries, pair):
    rng = random.Random(7)
    parts = ["a", "the", "ing", " ", "  ", "\n", "'s", "1", "é", "日本", "▁", "😀", "!", "\t", "<s>", "<|endoftext|>", "<0x41>", " <unk>", "\x00", "́", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3_000)] + [" ", "  ", "x ", " x", "▁"]
    found = zip(*pair.encode(texts))
    for text, (a, b) in zip(texts, found):
        assert (np.frombuffer(a, "<u4").tolist(), np.frombuffer(b, "<u4").tolist()) == tuple(both_ids(libraries, text)), text


@pytest.mark.parametrize("seed", range(20))
def test_lockstep_equals_sets_of_ends(seed):
    """Random tokens of random sizes: cuts are the common ends, links all pairs between two cuts."""
    rng = np.random.default_rng(seed)
    total = np.cumsum(rng.integers(1, 4000, rng.integers(1, 12)))
    ends = [np.unique(np.concatenate([total, rng.integers(1, total[-1] + 1, int(total[-1] * share))])) for share in rng.uniform(0.2, 1.5, 2)]
    at = [np.searchsorted(e, total, side="right") for e in ends]
    texts = np.stack([np.append(0, at[0][:-1]), at[0], np.append(0, at[1][:-1]), at[1]], axis=1)
    lanes = token_alignment.stretches(*ends, texts)
    assert (lanes[1:, 0] == lanes[:-1, 1]).all() and (lanes[1:, 2] == lanes[:-1, 3]).all()
    assert set(texts[:, 0]) <= set(lanes[:, 0].tolist())
    groups, (x, y) = token_alignment.lockstep(*ends, lanes)
    common = np.intersect1d(*ends)
    assert ends[0][groups[:, 1] - 1].tolist() == ends[1][groups[:, 3] - 1].tolist() == common.tolist()
    group_of = [np.searchsorted(common, e) for e in ends]
    wanted = sorted((i, j) for g in range(len(common)) for i in np.flatnonzero(group_of[0] == g).tolist() for j in np.flatnonzero(group_of[1] == g).tolist())
    assert sorted(zip(x.tolist(), y.tolist())) == wanted


def test_messy_rows_equal_brute_force(messy, libraries):
    rows = [(r[0], r[1]) for r in messy_rows()]
    got = [
        (r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"],
         hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")
        for r in token_alignment.align(messy, A, B).collect()
    ]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(brute(libraries, rows), key=key)


def test_an_empty_table_and_one_without_tokens(nothing, messy):
    assert token_alignment.align(nothing, A, B).collect() == []
    blank = token_alignment.align(messy.where("text is null or text = ''"), A, B).collect()
    assert len(blank) == 3 and all(r["n_groups"] == r["n_links"] == r["n_best"] == r["count_sum"] == 0 for r in blank)


def test_units_of_one_text_give_the_same_sums(spark, messy, libraries, monkeypatch):
    rows = [(r[0], r[1]) for r in messy_rows() if r[1] and len(r[1]) < 2_000]
    monkeypatch.setattr(token_alignment, "UNIT_ROWS", 0)
    units = token_alignment.aligned_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), A, B)
    assert units.select("unit").distinct().count() >= 8
    found = token_alignment.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), A, B)
    got = sorted((r["doc_id"] or -99, r["n_best"], r["count_sum"]) for r in found.collect())
    assert got == sorted((r[0] or -99, r[5], r[6]) for r in brute(libraries, rows))


def test_the_registered_query_equals_brute_force(spark, libraries):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMALLEST, "documents").collect()]
    found = queries.op12_lockstep_alignment(spark, SMALLEST)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(brute(libraries, rows))
