import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from llm_rows import SCHEMA, messy_rows, prose
from test_deduplication import brute_duplicates
from tokenizers import Tokenizer

from shelfcast.llm import pseudonyms
from shelfcast.llm.language_id import has_letter

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_unlike_texts_of_one_doc_id_are_documents_of_their_own(spark):
    rng = random.Random(3)
    a, b, c, d = (prose(rng, "en", 60) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, d), (None, d), (None, b), (4, d)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row string")
    found = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert found.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (4, d)], key=str)


def test_stages_match_brute_force(spark, messy, tmp_path):
    docs, rows = messy, [r for r in messy_rows()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "repeated_passages", "personal_data", "packing"]

    found = stages["language"](spark, docs, "")
    assert found.columns == docs.columns
    kept = [tuple(r) for r in found.collect()]
    assert all(has_letter(r[1]) for r in kept)
    assert {r[1] for r in rows if r[1] and r[2] and len(r[1]) > 100 and "日" not in r[1] and "aaaa" not in r[1]} <= {r[1] for r in kept}

    docs = spark.createDataFrame(kept, SCHEMA)
    one = [tuple(r) for r in stages["near_duplicates"](spark, docs, "").collect()]
    expected = {i for i, _, _, k in brute_duplicates(kept, 5) if k and i is not None}
    assert sorted(r[0] for r in one if r[0] is not None) == sorted(expected)
    copies = {r[1] for r in kept if r[0] is not None}
    assert sorted(r[1] for r in one if r[0] is None) == sorted({r[1] for r in kept if r[0] is None} - copies)

    docs = spark.createDataFrame(one, SCHEMA)
    cut = {r["doc_id"]: r for r in stages["repeated_passages"](spark, docs, "").collect()}
    texts = [r[1].encode() for r in one]
    counts = {}
    for t in texts:
        for i in range(len(t) - 399):
            counts[t[i : i + 400]] = counts.get(t[i : i + 400], 0) + 1
    for r, t in zip(one, texts):
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 399):
            if counts[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        if r[0] is not None:
            left = bytes(np.frombuffer(t, dtype=np.uint8)[~gone]).decode("utf-8", "ignore")
            assert (cut[r[0]]["text"], cut[r[0]]["n_chars"], cut[r[0]]["source"]) == (left, len(left), r[3])

    rest = [tuple(r) for r in cut.values()]
    docs = spark.createDataFrame(rest, SCHEMA)
    hidden = [tuple(r) for r in stages["personal_data"](spark, docs, "").collect()]
    own = pseudonyms.Pseudonymizer(corpus_pipeline.KEY)
    assert sorted((r[0], r[1]) for r in hidden if r[0] is not None) == sorted(
        (r[0], own.replace(r[1])[0]) for r in rest if r[0] is not None
    )

    packed = stages["packing"](spark, spark.createDataFrame(hidden, SCHEMA), "").collect()
    ids = {}
    for p in sorted(packed, key=lambda p: p["piece"]):
        ids.setdefault(p["doc_id"], []).extend(np.frombuffer(p["ids"], dtype="<u4").tolist())
    for r in hidden:
        assert ids[r[0]] == WHOLE.encode(r[1], add_special_tokens=False).ids + [2]


def test_passages_of_more_than_50_words_go(spark):
    rng = random.Random(21)
    short = [chr(97 + k) + chr(97 + m) for k in range(26) for m in range(26)]
    of_51, of_50 = (rng.sample(short, n) for n in (51, 50))
    rows = [(i, prose(rng, "en", 90)) for i in range(8)]
    parts = [" ".join(of_51), "\n ".join(of_51), " ".join(of_50), " ".join(of_50)]
    assert len(parts[0].encode()) < 400
    docs = [(i, f"{t} start{i} {parts[i % 4]} end{i} {t[::-1]}" if i < 4 else t) for i, t in rows]
    schema = "doc_id long, text string"
    found = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["repeated_passages"](spark, spark.createDataFrame(docs, schema), "").collect()}
    assert found == {i: t.replace(parts[i % 4], "") if i in (0, 1) else t for i, t in docs}


def test_an_empty_corpus_goes_through(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []
