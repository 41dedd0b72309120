import random
import re
from collections import Counter

import duckdb
import pytest
from llm_rows import WORDS, messy_rows
from pyspark.sql import functions as F

from shelfcast.llm import phrase_mining, queries
from shelfcast.llm.phrase_mining import PhraseConfig

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
FOLDER = "/root/testdata/sf0.001"


def brute(rows, config):
    """Everything in dictionaries: rows (lang, text) to the columns of the query."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i : i + m]) for m in range(1, config.words + 1) for i in range(len(words) - m + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= config.least}
    covered = set()
    for (lang, *p), longer in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inner = (lang, *p[i : i + m])
                if 100 * longer >= config.share * candidates.get(inner, 1 << 60):
                    covered.add(inner)
    found = {}
    for (lang, *p), a in candidates.items():
        if (lang, *p) not in covered:
            cuts = [(k, counts[(lang, *p[:k])], counts[(lang, *p[k:])]) for k in range(1, len(p))]
            score, _, left, right = min((1000 * a * totals[lang] // (x * y), k, x, y) for k, x, y in cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    out = []
    for lang, own in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[: config.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()))


def few_words(seed, lines=120):
    """Texts of few words, so that phrases of all lengths repeat, with pieces of every kind between them."""
    rng = random.Random(seed)
    words = rng.sample(WORDS["en"], 4) + ["É", "é", "x y", "THE", "ß\x1f"]
    weights = [2.0 ** -i for i in range(len(words))]
    out = []
    for i in range(lines):
        text = "".join(rng.choices(words, weights)[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]) for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "en", "en", "fr", None, "a\nb"]), None if i % 17 == 0 else text))
    passage = " ".join(f"w{i}" for i in range(7))
    return out + [("en", f"{passage} {i}. {passage}") for i in range(30)] + [("fr", "one two " * 400)] * 3


@pytest.mark.parametrize("seed, budget, share, top", [(1, 10**6, 100, 2000), (2, 300, 100, 2000), (3, 60, 80, 50), (4, 20, 100, 7), (5, 21, 30, 2000)])
def test_any_partition_gives_the_counts_of_brute_force(spark, seed, budget, share, top):
    config = PhraseConfig(least=10, share=share, top=top, budget=budget)
    rows = few_words(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert rows_of(phrase_mining.collocations(docs, config)) == brute(rows, config)


def test_prefixes_over_the_budget_are_extended(spark):
    docs = spark.createDataFrame([("en", "a a a b a a c " * 200)], "lang string, text string")
    words = phrase_mining.word_counts(docs)
    partition, known = phrase_mining.partition_prefixes(docs, words, PhraseConfig(least=10), 300)
    assert {b"en\na", b"en\na a"} <= partition.extended and len(partition.bounds) > 3
    assert {r["phrase"]: r["a"] for frame in known for r in frame.collect()} == {"a a": 600 - 0}
    assert partition.frequent.passes("en", [b"a", b"b", b"c", b"d"]).tolist() == [True, True, True, False]


def test_products_pass_64_bits(spark):
    """Counts are made large by hand: the score is exact beyond 64 bits."""
    a, n, left, right = 3_000_000_007, 900_000_000_000_011, 3_000_000_019, 4_000_000_007
    frame = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert frame.select(F.expr(phrase_mining.SCORE).alias("score")).first()["score"] == 1000 * a * n // (left * right)


def test_messy_rows(messy, nothing):
    config = PhraseConfig(least=3)
    assert rows_of(phrase_mining.collocations(messy, config)) == brute([(r[2], r[1]) for r in messy_rows()], config)
    assert phrase_mining.collocations(nothing, config).collect() == []
    assert phrase_mining.collocations(messy.where("text is null"), config).collect() == []


def test_the_registered_query_equals_its_sql_and_brute_force(spark):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    found = rows_of(queries.op11_vertical_phrases(spark, FOLDER))
    assert found == sorted(database.execute(queries.ORACLES["op11_vertical_phrases"]).fetchall()) and found
    texts = database.execute("SELECT lang, text FROM documents").fetchall()
    assert found == brute(texts, PhraseConfig())
