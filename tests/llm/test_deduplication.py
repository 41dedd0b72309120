import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_rows import SCHEMA, messy_rows, prose

from shelfcast.llm import embedding_pivots, minmax_dedup, prefix_free
from shelfcast.llm.common import components
from shelfcast.llm.queries import op9_prefix_free


def roots(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 250)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    assert found == roots({x for link in links for x in link}, links)
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


def shingle_set(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_duplicates(rows, size):
    sets = [(i, shingle_set(t, size)) for i, t, *_ in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    links = [
        (a, b) for k, (a, s) in enumerate(known) for b, t in known[k + 1 :] if 100 * len(s & t) >= 80 * len(s | t)
    ]
    component = roots({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), component.get(i), i is None or component[i] == i) for i, s in sets), key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_match_all_pairs(messy, size):
    found = minmax_dedup.near_duplicates(messy, minmax_dedup.MinMaxConfig(words=size))
    assert sorted(map(tuple, found.collect()), key=str) == brute_duplicates(messy_rows(), size)


def test_a_chain_of_edits_and_unlike_texts_of_one_passage(spark):
    rng = random.Random(8)
    words = prose(rng, "en", 300).split(" ")
    rows = []
    for i in range(30):  # neighbours are alike, the ends are not
        rows.append((i, " ".join(words)))
        for k in rng.sample(range(len(words)), 5):
            words[k] = f"edit{i}x{k}"
    passage = prose(rng, "fr", 100)
    rows += [(100 + i, f"{passage} {prose(rng, 'fr', 60)}") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = minmax_dedup.near_duplicates(frame, minmax_dedup.MinMaxConfig(words=4))
    assert sorted(map(tuple, found.collect()), key=str) == brute_duplicates(rows, 4)


def test_no_documents(nothing):
    assert minmax_dedup.near_duplicates(nothing).collect() == []
    assert prefix_free.remove_repeats(nothing).collect() == []


def brute_cut(texts, match):
    """What is left of each text, and how many stretches went."""
    counts = Counter(t[i : i + match] for t in texts for i in range(len(t) - match + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - match + 1):
            if counts[t[i : i + match]] > 1:
                gone[i : i + match] = True
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~gone[:-1]])
        out.append((len(t), int(np.diff(gone.astype(int), prepend=0).clip(0).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("match", "window"), [(400, 128), (100, 50)])
def test_repeats_match_all_strings(messy, match, window):
    rows = messy_rows()
    found = [
        (r["rest"]["doc_id"], r["n_bytes"], len(r["spans"]), hashlib.sha256(r["kept"] or b"").hexdigest())
        for r in prefix_free.remove_repeats(messy, match, window).collect()
    ]
    expected = brute_cut([(t or "").encode() for _, t, *_ in rows], match)
    assert sorted(found, key=str) == sorted(((r[0], *e) for r, e in zip(rows, expected)), key=str)


def test_texts_without_a_doc_id_are_told_apart(spark):
    """Thousands of them; some are equal, some share a passage, some repeat within themselves."""
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(60))
    texts = []
    for i in range(3_000):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(50, 140)))
        texts.append(own + (passage if i % 7 == 0 else "") + (own if i % 11 == 0 else ""))
    texts += texts[:200] + [None, "", ""]
    frame = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(6)
    found = sorted(
        (r["n_bytes"], len(r["spans"]), hashlib.sha256(r["kept"] or b"").hexdigest()) for r in prefix_free.remove_repeats(frame, 40, 16).collect()
    )
    assert found == sorted(tuple(e) for e in brute_cut([(t or "").encode() for t in texts], 40))


def test_columns_pass_through_the_cut(messy):
    row = prefix_free.remove_repeats(messy).where("rest.doc_id = 73").first()
    assert row["rest"].asDict() == {**dict(zip([c.split()[0] for c in SCHEMA.replace("`a b.c`", "abc").split(", ")], messy_rows()[0])), **row["rest"].asDict()} or row["rest"]["kept"] == "k"
    assert (row["n_bytes"], row["spans"], bytes(row["kept"])) == (0, [], b"")


def test_random_texts_of_few_letters(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 300)))) for i in range(40)]
    rows += [(100 + i, ("ab" * 200)[i:]) for i in range(5)] + [(200, rows[0][1] * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["rest"]["doc_id"]: hashlib.sha256(r["kept"]).hexdigest() for r in prefix_free.remove_repeats(frame, 40, 20).collect()}
    assert [found[i] for i, _ in rows] == [e[2] for e in brute_cut([t.encode() for _, t in rows], 40)]


@pytest.mark.parametrize("words", [3, 6, 51])
def test_runs_of_words_match_all_runs(spark, words):
    rng = random.Random(words)
    rows = [(i, " ".join(rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(0, 3 * words)))) for i in range(40)]
    rows += [(100 + i, "  x ".join(rows[i][1].split(" "))) for i in range(5)] + [(200, rows[0][1].replace(" ", "\n\t") + " é"), (201, " ab" * 2 * words), (202, None), (203, "")]
    rows += [(300 + i, t + f" own{i}") for i, t in rows[:10]]
    counts, expected = Counter(), {}
    split = {i: (t or "").encode().split() for i, t in rows}
    for w in split.values():
        counts.update(tuple(w[k : k + words]) for k in range(len(w) - words + 1))
    for i, w in split.items():
        gone = {k + m for k in range(len(w) - words + 1) if counts[tuple(w[k : k + words])] > 1 for m in range(words)}
        expected[i] = [x for k, x in enumerate(w) if k not in gone]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = prefix_free.remove_repeats(frame, 100_000, words=words).collect()
    assert {r["rest"]["doc_id"]: (r["kept"] or b"").split() for r in found} == expected


def test_only_runs_that_may_repeat_are_stored(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.getrandbits(40):x}" for _ in range(300)) for _ in range(30)]
    passage = " ".join(texts[0].split(" ")[100:160])
    texts[1] += f" {passage}"
    sizes, stored = {}, prefix_free.stored

    def counted(df, name, *more):
        out = stored(df, name, *more)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(prefix_free, "stored", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["rest"]["doc_id"]: r["kept"] for r in prefix_free.remove_repeats(frame, as_text=True, words=51).collect()}
    assert {i: t.split() for i, t in found.items()} == {i: (t.replace(passage, "") if i < 2 else t).split() for i, t in enumerate(texts)}
    keyed = frame.withColumnRenamed("doc_id", "id")
    names = sorted(r["parse"] for r in prefix_free.text_runs(keyed, 400, 128, 51).collect())
    assert 0 < sizes["candidate-runs"] and sum(sizes.values()) < len(names) / 10
    assert names == sorted(r["parse"] for r in prefix_free.text_runs(keyed, 400, 128, 51, parse_only=True).collect())


def vectors():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 16))
    near = base[:60] + 0.15 * rng.normal(size=(60, 16))
    hot = base[7] + 0.05 * rng.normal(size=(150, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near, hot]))]
    rows += [(1000, rows[3][1]), (1001, rows[3][1]), (1002, None), (1003, []), (1004, [0.0] * 16), (1005, [float("nan")] * 16)]
    rows += [(1006, [None] * 16), (1007, [float("inf")] * 16), (None, rows[3][1]), (1008, rows[2][1][:8]), (1009, [-x for x in rows[3][1]])]
    return rows


def brute_links(rows, least):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, counts = [], Counter()
    for k, (a, x) in enumerate(good):
        for b, y in good[k + 1 :]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links.append((a, b))
                counts.update((a, b))
    component = roots({i for i, _ in rows if i is not None}, links)
    return {i: (counts[i], component[i]) for i, _ in rows if i is not None}


def test_linked_vectors_match_all_pairs(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, kept string")
    config = embedding_pivots.PivotConfig(pivots=64, sample=256, nearest=8, shared=2, block=50)
    found = embedding_pivots.linked_vectors(frame, config).collect()
    expected = brute_links(rows, config.cosine)
    assert len(found) == len(rows)
    recall = sum(r["n_links"] for r in found if r["vec_id"] is not None) / sum(n for n, _ in expected.values())
    assert 0.97 <= recall <= 1
    assert all(r["n_links"] <= expected[r["vec_id"]][0] for r in found if r["vec_id"] is not None)
    assert np.mean([r["component_id"] == expected[r["vec_id"]][1] for r in found if r["vec_id"] is not None]) > 0.97
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in found if r["vec_id"] is None] == [(0, None, True)]
    assert embedding_pivots.linked_vectors(frame.where("false")).collect() == []


def test_components_of_any_size_are_compared(spark):
    """Squares of such components leave the range of doubles."""
    rows = [(0, [1e200, 1e200]), (1, [2e200, 2e200]), (2, [1e-200, 1e-200]), (3, [1.0, 0.1]), (4, [0.1, 1.0]), (5, [5e-324, 5e-324]), (6, [1e308, -1e308]), (7, [0.0, 0.0])]
    found = embedding_pivots.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()}
    assert links == {0: (3, 0), 1: (3, 0), 2: (3, 0), 5: (3, 0), 3: (0, 3), 4: (0, 4), 6: (0, 6), 7: (0, 7)}


def test_few_reference_points_lose_no_links(spark):
    """The default settings on vectors of one cone, of which one is a reference point, and on two and three vectors."""
    rng = np.random.default_rng(9)
    cone = np.hstack([np.full((300, 1), 4.0), rng.normal(size=(300, 12)) * rng.choice([0.2, 0.5], size=(300, 1))])
    units = embedding_pivots.unit(cone)
    cone = cone[(units @ units[0] >= 0.75) & (units[:, 0] >= 0.93)]
    two = [[1.0, 0.0], [0.95, (1 - 0.95**2) ** 0.5]]
    three = [[1.0, 0.0, 0.0], [0.95, (1 - 0.95**2) ** 0.5, 0.0], [0.0, 0.0, 1.0]]
    rows = list(enumerate([*cone.tolist(), *two, *three]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = embedding_pivots.linked_vectors(frame).collect()
    expected = brute_links(rows, embedding_pivots.PivotConfig().cosine)
    assert 0 < sum(n for n, _ in expected.values()) < len(cone) ** 2
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == expected


def test_recall_at_the_threshold():
    """Pairs at a cosine of just 0.9 in 64 dimensions: shares of reference points find nearly all."""
    rng = np.random.default_rng(3)
    config = embedding_pivots.PivotConfig()
    pivots = embedding_pivots.unit(rng.normal(size=(config.pivots, 64)))
    a = embedding_pivots.unit(rng.normal(size=(2000, 64)))
    noise = rng.normal(size=a.shape)
    noise -= (noise * a).sum(1, keepdims=True) * a
    b = 0.9001 * a + np.sqrt(1 - 0.9001**2) * embedding_pivots.unit(noise)
    x, y = (embedding_pivots.permutations(v, pivots, config.nearest) for v in (a, b))
    shared = np.array([len(set(p) & set(q)) for p, q in zip(x.tolist(), y.tolist())])
    assert (shared >= config.shared).mean() >= 0.9


def test_the_query_tells_of_passages_of_more_than_50_words(spark, tmp_path):
    """Beside the 400 bytes, which short words do not reach, and without a change to what these remove."""
    rng = random.Random(34)
    short = [chr(97 + k) + chr(97 + m) for k in range(26) for m in range(26)]
    of_51, of_50, long = (" ".join(rng.sample(short, n)) for n in (51, 50, 140))
    parts = [of_51, of_51.replace(" ", "\n "), of_50, of_50, long, f"{long[:-3]}é", of_51 + f" {of_50}x", ""]
    assert len(parts[1].encode()) < 400 < len(long)
    rows = [(i, f"{prose(rng, 'en', 40)} start{i} {part} end{i} {prose(rng, 'de', 40)}") for i, part in enumerate(parts)]
    rows += [(None, rows[0][1].replace("start0", "other")), (9, None), (10, ""), (11, " ".join([of_51] * 2))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(op9_prefix_free(spark, str(tmp_path)).collect(), key=str)
    split, counts = [(t or "").split() for _, t in rows], Counter()
    for w in split:
        counts.update(tuple(w[k : k + 51]) for k in range(len(w) - 50))
    assert len(found) == len(rows)
    for (i, text), w, (n_bytes, n_spans, digest) in zip(rows, split, brute_cut([(t or "").encode() for _, t in rows], 400)):
        (r,) = [r for r in found if r["doc_id"] == i]
        assert (r["n_bytes"], r["n_spans"], r["kept_sha256"]) == (n_bytes, n_spans, digest)
        starts = [k for k in range(len(w) - 50) if counts[tuple(w[k : k + 51])] > 1]
        assert r["n_passages"] == sum(b - a > 50 for a, b in zip([-51, *starts], starts))
        gone = {k + m for k in starts for m in range(51)}
        if n_spans == 0:
            left = None if text is None else [x for k, x in enumerate(w) if k not in gone]
            assert (r["text_without_passages"] if text is None else r["text_without_passages"].split()) == left
    of = {r["doc_id"]: r for r in found}
    assert [of[i]["n_passages"] for i in (0, 1, 2, 3, 4, 5, 6, 7)] == [1, 1, 0, 0, 1, 1, 1, 0]
    assert [of[i]["n_removed"] for i in (1, 2, 3, 6, 7)] == [0] * 5 and of[4]["n_removed"] >= 400
