"""Near-duplicate documents by min-max hashing of word shingles.

Each permutation of the shingles gives two values of the signature, its smallest and its largest hash, so
half the hash evaluations give a signature of the same length whose estimate varies less. Bands of the
signature find candidates, and every link is confirmed on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import components, stored, text_slices


@dataclass(frozen=True)
class MinMaxConfig:
    """``words`` per shingle; documents link at ``percent`` of common shingles or more.

    ``permutations`` give two values each, cut into bands of ``rows`` values. With 126 and 6, two documents at
    exactly 80 % meet in none of the 42 bands with a probability of 3e-6, and at 33 % in any with 5 %.
    """

    words: int = 5
    percent: int = 80
    permutations: int = 126
    rows: int = 6

    @property
    def bands(self) -> int:
        return 2 * self.permutations // self.rows


#: Rows of a bucket that are compared at once with as many others.
BLOCK = 512
#: Values of shingle sets that a task keeps while it confirms pairs.
SET_VALUES = 4_000_000
_SEEDS = np.random.default_rng(20240229)
_MULTIPLIERS = _SEEDS.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _SEEDS.integers(0, 1 << 63, 4096, dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """The distinct shingles, sorted, as 64-bit hashes; a shorter sequence is one shingle as a whole."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=size)], dtype=np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total = _mixed(total + hashes[k : k + len(total)] + np.uint64(k + 1))
    return np.unique(total)


def signature(values: np.ndarray, permutations: int) -> np.ndarray:
    """Smallest and largest hash of a set under each permutation, in turn."""
    low = np.full(permutations, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(permutations, dtype=np.uint64)
    factor, shift = _MULTIPLIERS[:permutations, None], _SHIFTS[:permutations, None]
    for i in range(0, len(values), 1_024):
        moved = values[i : i + 1_024] * factor
        moved += shift
        np.minimum(low, moved.min(axis=1), out=low)
        np.maximum(high, moved.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_keys(signed: np.ndarray, config: MinMaxConfig) -> np.ndarray:
    """One 64-bit key per band of a signature."""
    sig = signed.reshape(config.bands, config.rows)
    keys = np.arange(1, config.bands + 1, dtype=np.uint64)
    for k in range(config.rows):
        keys = _mixed(keys + sig[:, k])
    return keys.view(np.int64)


def described(docs: DataFrame, config: MinMaxConfig) -> DataFrame:
    """Rows (doc_id, words_key, n_shingles, bands, sketch): one per document; the last two are null without words.

    ``sketch`` holds the last byte of each value of the signature.

    Equal word sequences have equal keys (128 bits), and their signature is worked out once in a slice.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            known: dict[bytes, tuple[int, np.ndarray | None, bytes | None]] = {}
            keys = []
            for text in texts:
                words = words_of(text)
                key = xxhash.xxh3_128_digest(b" ".join(words))
                keys.append(key)
                if key not in known:
                    values = shingles(words, config.words)
                    known[key] = (0, None, None)
                    if len(values):
                        signed = signature(values, config.permutations)
                        known[key] = (len(values), band_keys(signed, config), signed.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array([known[k][0] for k in keys], pa.int64()),
                    pa.array([known[k][1] for k in keys], pa.list_(pa.int64())), pa.array([known[k][2] for k in keys], pa.binary()),
                ],
                names=["doc_id", "words_key", "n_shingles", "bands", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        describe, "doc_id long, words_key binary, n_shingles long, bands array<long>, sketch binary"
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, config: MinMaxConfig) -> DataFrame:
    """The pairs (a, b) whose full sets of shingles are alike enough. ``texts`` has (id, text)."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        size = 0

        def set_of(text: str) -> np.ndarray:
            nonlocal size
            key = xxhash.xxh3_128_intdigest(text.encode())
            if key not in sets:
                if size > SET_VALUES:
                    sets.clear()
                    size = 0
                sets[key] = shingles(words_of(text), config.words)
                size += len(sets[key])
            return sets[key]

        for batch in batches:
            kept = []
            for i, texts_of_pair in enumerate(zip(batch.column("text"), batch.column("other"))):
                first, second = (set_of(x.as_py()) for x in texts_of_pair)
                common = len(np.intersect1d(first, second, assume_unique=True))
                if 100 * common >= config.percent * (len(first) + len(second) - common):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(kept, pa.int64())) for c in ("a", "b")], names=["a", "b"]
            )

    first = pairs.join(texts.withColumnRenamed("id", "a"), "a")
    both = first.join(texts.select(F.col("id").alias("b"), F.col("text").alias("other")), "b")
    return both.select("a", "b", "text", "other").mapInArrow(confirm, "a long, b long")


def _blocked(rows: DataFrame, size: str) -> DataFrame:
    """Rows of buckets with (own, i, j): each block of a bucket meets each other block once, and itself."""
    count = F.ceil(F.col(size) / BLOCK)
    return (
        rows.withColumn("own", F.pmod(F.xxhash64("id"), count))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")
    )


def _sides(table: pa.Table, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    own = table.column("own").to_numpy()
    return np.flatnonzero(own == i), np.flatnonzero(own == j)


def _promising(rows: DataFrame, config: MinMaxConfig) -> DataFrame:
    """Of two blocks of a bucket the rows (bucket, i, j, own, id, component) that still need a comparison.

    A row stays if the signature does not speak against a link with a row of another component, and this is
    the first bucket that both share. The bucket's first document has been compared with all others before.
    """
    values = 2 * config.permutations
    share = config.percent / 100
    least = values * share - 6 * np.sqrt(values * share * (1 - share))  # six standard deviations below the limit

    def sift(key: tuple, table: pa.Table) -> pa.Table:
        bucket, i, j = (k.as_py() for k in key)
        left, right = _sides(table, i, j)
        n, component = table.column("n").to_numpy(), table.column("component").to_numpy()
        sketch = np.array([np.frombuffer(x, dtype=np.uint8) for x in table.column("sketch").to_pylist()])
        bands = np.array(table.column("bands").to_pylist(), dtype=np.int64)
        small = np.minimum(n[left][:, None], n[right][None, :])
        open_pairs = (100 * small >= config.percent * np.maximum(n[left][:, None], n[right][None, :])) & (
            component[left][:, None] != component[right][None, :]
        )
        a, b = np.nonzero(open_pairs)
        keep = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), 50_000):
            x, y = left[a[at : at + 50_000]], right[b[at : at + 50_000]]
            alike = (sketch[x] == sketch[y]).sum(axis=1) >= least
            shared = bands[x] == bands[y]
            keep[at : at + 50_000] = alike & (bands[x, shared.argmax(axis=1)] == bucket)
        stay = np.unique(np.concatenate([left[a[keep]], right[b[keep]]]))
        return table.select(["bucket", "i", "j", "own", "id", "component"]).take(pa.array(stay, pa.int64()))

    schema = "bucket long, i long, j long, own long, id long, component long"
    return rows.groupBy("bucket", "i", "j").applyInArrow(sift, schema)


def _block_links(rows: DataFrame, texts: DataFrame, config: MinMaxConfig) -> DataFrame:
    """Links (a, b) between components, compared on full sets, as many as connect what is linked in two blocks."""

    def link(key: tuple, table: pa.Table) -> pa.Table:
        left, right = _sides(table, key[1].as_py(), key[2].as_py())
        ids, component = table.column("id").to_numpy(), table.column("component").to_numpy().copy()
        sets = [shingles(words_of(t), config.words) for t in table.column("text").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        values = np.concatenate([sets[k] for k in right])
        owners = np.repeat(np.arange(len(right)), sizes[right])
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        edges = []
        for k in left:
            begin, end = np.searchsorted(values, sets[k], "left"), np.searchsorted(values, sets[k], "right")
            found = [owners[x:y] for x, y in zip(begin[end > begin], end[end > begin])]
            if not found:
                continue
            common = np.bincount(np.concatenate(found), minlength=len(right))
            linked = 100 * common >= config.percent * (sizes[k] + sizes[right] - common)
            for m in right[linked]:
                if component[m] != component[k]:
                    edges.append((ids[k], ids[m]))
                    component[component == component[m]] = component[k]
        return pa.table({c: pa.array([e[x] for e in edges], pa.int64()) for x, c in enumerate("ab")})

    return rows.join(texts, "id").groupBy("bucket", "i", "j").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, config: MinMaxConfig = MinMaxConfig()) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links lead to, the document itself included; it is kept if that
    is its own. Texts that are null or without words have no shingles and link with nothing. Rows of a repeated
    doc_id are each returned; rows without a doc_id stand alone, kept, with a null component.

    1. Documents of equal words become one class, represented by its smallest doc_id.
    2. In each bucket of a band every class is compared with the bucket's smallest, one pair a class.
    3. Components of the confirmed links. In buckets whose classes still belong to several components, pairs
       across components are compared too, blocks of rows with blocks of rows inside tasks: first by size and
       signature, then what is left by full sets. Only links that connect components leave a task, never pairs.
       So no pair that shares a bucket goes unseen unless both are already in one component.
    """
    rows = stored(described(docs, config), "signatures")
    known = rows.where("doc_id is not null and bands is not null")
    classes = stored(
        known.groupBy("words_key").agg(F.min("doc_id").alias("id")), "word-classes"
    )
    # a repeated doc_id with another text is a class of its own under the same id: links of either count for both
    heads = stored(
        known.join(classes.withColumnRenamed("words_key", "k"), (F.col("words_key") == F.col("k")) & (F.col("doc_id") == F.col("id")))
        .select("id", "words_key", "n_shingles", "bands", "sketch").dropDuplicates(["id", "words_key"]), "heads",
    )
    buckets = heads.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    firsts = buckets.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("size")).where("size > 1")
    members = stored(
        buckets.join(firsts.select("bucket", "first"), "bucket")
        .select("bucket", "id", "n", F.col("first.id").alias("first"), F.col("first.n").alias("first_n")), "buckets",
    )
    fits = F.least("n", "first_n") * 100 >= F.greatest("n", "first_n") * config.percent
    stars = members.where((F.col("id") != F.col("first")) & fits).select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    involved = members.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null and text is not null")
    texts = stored(texts.join(involved, "id", "left_semi").dropDuplicates(), "candidate-texts", "zstd")
    links = stored(_confirmed(stars, texts, config), "links")
    placed = stored(components(links, "components"), "first-components")
    spread = members.join(placed, "id", "left").select("bucket", "id", "n", "first", F.coalesce("component", "id").alias("component"))
    mixed = spread.groupBy("bucket").agg(F.count("*").alias("size"), (F.min("component") != F.max("component")).alias("mixed"))
    mixed = stored(mixed.where("mixed and size > 2").select("bucket", "size"), "open-buckets")
    signed = heads.select("id", "bands", "sketch")
    open_rows = spread.where("id <> first").join(mixed, "bucket").join(signed, "id")
    rest = stored(_promising(_blocked(open_rows, "size"), config), "promising")
    links = stored(links.union(_block_links(rest, texts, config)), "links")
    final = stored(components(links, "components"), "components")
    of_class = stored(
        classes.join(final, "id", "left").select("words_key", F.coalesce("component", "id").alias("component")), "class-components"
    )
    return rows.withColumn("k", F.when(F.col("bands").isNotNull(), F.col("words_key"))).join(
        of_class.withColumnRenamed("words_key", "k"), "k", "left"
    ).select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.coalesce("component", "doc_id") == F.col("doc_id"))).alias("kept"),
    )
