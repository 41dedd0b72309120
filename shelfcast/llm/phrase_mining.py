"""Phrases whose words stand together more often than by chance, from exact counts of all phrases up to a length.

Every place of the corpus begins a suffix: its next few words within a piece of text. Counts of all phrases are those
of the prefixes of suffixes, so they can be read off a tree of suffixes, cut at the greatest length. The tree is built
in parts that fit into memory: word prefixes are counted, a prefix with more suffixes than the budget is extended by a
word (again and again), and prefixes in order form groups within the budget. Suffixes go to the group of their prefix;
each group sorts its own, which lays out its subtrees, and reads counts from the totals of the leaves.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stored, text_slices, union_all
from shelfcast.llm.words import as_bytes

#: What ends a piece and what ends a word.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Bits of the filter of frequent words, one bit a word; more words only make it let more through.
FILTER_BITS = 1 << 27
_FILTER_PART = 1 << 16  # bytes of the filter in a row
#: Groups of prefixes at most, so their bounds (and the prefixes over the budget) stay small enough for each task.
MOST_GROUPS = 500_000
#: Shares of a language's phrases that are ranked by themselves first.
SHARES = 256
#: Characters of one language's texts that a task works on at once, and of all texts that wait for that.
UNIT_CHARS, WAITING_CHARS = 4_000_000, 24_000_000

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(WORD_ENDS)], _KIND[list(PIECE_ENDS)] = 1, 2
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class PhraseConfig:
    """``share``: a phrase goes if a longer one has at least so many hundredths of its count.

    ``budget``: suffixes of a group, about 100 bytes each while it is worked on.
    """

    words: int = 5
    least: int = 100
    top: int = 2000
    share: int = 100
    budget: int = 1_000_000

    def __post_init__(self) -> None:
        if not 2 <= self.words <= 15 or self.least < 1:
            raise ValueError("phrases have 2 to 15 words and are counted at least once")


@dataclass
class Words:
    """Words of some texts in a row: their distinct ones, which each is, and the piece that it stands in."""

    distinct: list[bytes]
    ids: np.ndarray
    piece: np.ndarray


def split_words(texts: list[str]) -> Words:
    data = np.frombuffer("\n".join(texts).encode().translate(_LOWER), dtype=np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    places = np.flatnonzero(starts)
    letters = data[inside].tobytes()
    offsets = np.append(np.flatnonzero(starts[inside]), len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    return Words(as_bytes(words.dictionary), words.indices.to_numpy(), np.cumsum(kind == 2)[places])


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Texts of one language, about ``UNIT_CHARS`` at a time."""
    waiting: dict[str, list[str]] = {}
    chars: dict[str, int] = {}

    def taken(lang: str) -> Iterator[tuple[str, Words]]:
        del chars[lang]
        found = split_words(waiting.pop(lang))
        if found.distinct:
            yield lang, found

    for batch, texts in text_slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            if text:
                waiting.setdefault(lang, []).append(text)
                chars[lang] = chars.get(lang, 0) + len(text)
                if chars[lang] >= UNIT_CHARS:
                    yield from taken(lang)
        while sum(chars.values()) > WAITING_CHARS:
            yield from taken(max(chars, key=chars.__getitem__))
    for lang in list(chars):
        yield from taken(lang)


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, phrase, a) of single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in by_language(batches):
            n = np.bincount(found.ids, minlength=len(found.distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n)), pa.array(found.distinct, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                names=["lang", "phrase", "a"],
            )

    return docs.mapInArrow(run, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


class PhraseFilter:
    """Lets all phrases of a table through, and few others: one bit for the hash of each. Its size is fixed."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def place(lang: str, words: list[bytes]) -> np.ndarray:
        seed = zlib.crc32(lang.encode())
        return np.fromiter((zlib.crc32(w, seed) for w in words), dtype=np.int64, count=len(words)) % FILTER_BITS

    def passes(self, lang: str, words: list[bytes]) -> np.ndarray:
        place = self.place(lang, words)
        return (self.bits[place >> 3] >> (place & 7) & 1).astype(bool)

    @classmethod
    def of(cls, frequent: DataFrame) -> PhraseFilter:
        """Parts of the filter are put together by Spark; as many bytes as it has come to the driver."""

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, langs = batch.column("phrase").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()
                found = [int(cls.place(lang, [word])[0]) for lang, word in zip(langs, words)]
                yield pa.RecordBatch.from_arrays([pa.array([x // (8 * _FILTER_PART) for x in found], pa.int32()), pa.array(found, pa.int64())], names=["part", "place"])

        def joined(key: tuple, table: pa.Table) -> pa.Table:
            bits = np.zeros(8 * _FILTER_PART, dtype=np.uint8)
            bits[table.column("place").to_numpy() % (8 * _FILTER_PART)] = 1
            return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})

        rows = frequent.mapInArrow(places, "part int, place long").distinct()
        whole = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
        for row in rows.groupBy("part").applyInArrow(joined, "part int, bits binary").collect():
            whole[row["part"] * _FILTER_PART : (row["part"] + 1) * _FILTER_PART] = np.frombuffer(row["bits"], dtype=np.uint8)
        return cls(whole)


def suffixes(found: Words, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of at least two words as sorted rows of word ids plus 1 (0: ended), and their numbers.

    ``first`` says of each distinct word whether suffixes that begin with it are wanted.
    """
    goes_on = found.piece[:-1] == found.piece[1:]
    own = np.flatnonzero(goes_on & first[found.ids[:-1]])
    rows = np.zeros((len(own), length), dtype=np.int32)
    rows[:, 0] = found.ids[own] + 1
    live = np.ones(len(own), dtype=bool)
    last = len(goes_on) - 1
    for k in range(1, length):
        live &= goes_on[np.minimum(own + k - 1, last)] & (own + k - 1 <= last)
        rows[live, k] = found.ids[own[live] + k] + 1
    return merged(rows, np.ones(len(own), dtype=np.int64))


def merged(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order, equal ones as one with the sum of their numbers."""
    if not len(rows):
        return rows, n
    # two ids below 2^31 make one key
    keys = [rows[:, k].astype(np.int64) << 31 | rows[:, k + 1] if k + 1 < rows.shape[1] else rows[:, k] for k in range(0, rows.shape[1], 2)]
    order = np.lexsort(keys[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[first], np.add.reduceat(n[order], first)


def phrase_key(lang: str, words: list[bytes]) -> bytes:
    return lang.encode() + b"\n" + b" ".join(words)


@dataclass
class Partition:
    """The first prefix of each group, the prefixes that are too frequent for one and therefore extended, and a filter
    of all that are frequent."""

    bounds: list[bytes]
    extended: set[bytes]
    frequent: PhraseFilter

    def groups(self, lang: str, distinct: list[bytes], rows: np.ndarray) -> np.ndarray:
        """The group of each suffix of sorted ``rows``.

        It is -1 for one that has no frequent prefix, or is no longer than an extended one: neither holds a frequent
        phrase that is not counted yet.
        """
        out = np.full(len(rows), -1, dtype=np.int64)
        open_rows, head = np.arange(len(rows)), lang.encode() + b"\n"
        prefix = [head] * len(rows)
        for depth in range(rows.shape[1]):
            if not open_rows.size:
                break
            own = rows[open_rows, : depth + 1]
            first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]).any(axis=1)]))
            sizes = np.diff(np.append(first, len(open_rows)))
            keys = [prefix[i] + distinct[w - 1] for i, w in zip(open_rows[first].tolist(), own[first, depth].tolist())]
            longer = np.array([k in self.extended for k in keys], dtype=bool)
            group = np.array([bisect_right(self.bounds, k) - 1 for k in keys], dtype=np.int64)
            again = np.repeat(longer, sizes)
            group = np.maximum(group, 0)
            group[~self.frequent.passes(lang, [k[len(head) :] for k in keys])] = -1
            out[open_rows[~again]] = np.repeat(group, sizes)[~again]
            if depth + 1 == rows.shape[1]:
                break
            again &= rows[open_rows, depth + 1] > 0
            which = np.repeat(np.arange(len(keys)), sizes)
            for i, k in zip(open_rows[again].tolist(), which[again].tolist()):
                prefix[i] = keys[k] + b" "
            open_rows = open_rows[again]
        return out


def prefix_counts(docs: DataFrame, extended: set[bytes], depth: int) -> DataFrame:
    """Rows (lang, phrase, a) of all phrases of ``depth`` words that go on from an extended prefix by one word."""
    extended_ = docs.sparkSession.sparkContext.broadcast(extended)
    heads_ = docs.sparkSession.sparkContext.broadcast({key.split(b" ", 1)[0] for key in extended})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in by_language(batches):
            heads = np.array([phrase_key(lang, [w]) in heads_.value for w in found.distinct], dtype=bool)
            rows, n = suffixes(found, heads, depth)
            own = rows[:, -1] > 0
            rows, n = rows[own], n[own]
            phrases, counts = [], []
            for row, a in zip(rows.tolist(), n.tolist()):
                words = [found.distinct[w - 1] for w in row]
                if phrase_key(lang, words[:-1]) in extended_.value:
                    phrases.append(b" ".join(words))
                    counts.append(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                names=["lang", "phrase", "a"],
            )

    return docs.mapInArrow(run, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _key() -> Column:
    return F.concat("lang", F.lit("\n"), "phrase")


def partition_prefixes(docs: DataFrame, words: DataFrame, config: PhraseConfig, budget: int) -> tuple[Partition, list[DataFrame]]:
    """Groups of prefixes within the budget, and the tables of counts of extended prefixes with more than one word."""
    extended: set[bytes] = set()
    whole, known, longer, level = [], [], [], words
    for depth in range(1, config.words + 1):
        whole.append(level.where(F.col("a") <= budget) if depth < config.words else level)
        over = level.where(F.col("a") > budget) if depth < config.words else None
        fresh = {row[0].encode() for row in over.select(_key()).collect()} if over is not None else set()
        if not fresh:
            break
        if depth > 1:
            known.append(over)
        extended |= fresh
        level = stored(prefix_counts(docs, fresh, depth + 1).where(F.col("a") >= config.least), "prefixes")
        longer.append(level)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group begins with a task and wherever the next prefix would pass the budget."""
        size = None
        for batch in batches:
            first = []
            for key, a in zip(batch.column("key").to_pylist(), batch.column("a").to_pylist()):
                if size is None or size + a > budget:
                    first.append(key)
                    size = 0
                size += a
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.string())], names=["key"])

    prefixes = union_all(whole).select(_key().alias("key"), "a")
    rows = prefixes.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(bounds, "key string")
    frequent = PhraseFilter.of(union_all([words, *longer]))
    return Partition(sorted(row["key"].encode() for row in rows.collect()), extended, frequent), known


_BLOCK = "group long, lang string, words binary, width int, heads binary, tails binary, n binary"


def suffix_blocks(docs: DataFrame, partition: Partition, length: int) -> DataFrame:
    """Rows (group, lang, words, width, heads, tails, n): the suffixes of some texts that belong to one group.

    They are in order, and each is written as what it changes of the one before: a byte of ``heads`` holds how many
    words it shares with that (4 bits) and how many it has; ``tails`` holds the others, places in ``words`` (one a line) as
    numbers of ``width`` bytes. ``n`` holds how often each suffix comes, in 32-bit numbers.
    """
    partition_ = docs.sparkSession.sparkContext.broadcast(partition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in by_language(batches):
            rows, n = suffixes(found, partition_.value.frequent.passes(lang, found.distinct), length)
            group = partition_.value.groups(lang, found.distinct, rows)
            order = np.argsort(group, kind="stable")
            order = order[np.searchsorted(group[order], 0) :]
            if order.size:
                yield _blocks(lang, found.distinct, rows[order], n[order], group[order])

    return docs.mapInArrow(run, _BLOCK)


def _blocks(lang: str, distinct: list[bytes], rows: np.ndarray, n: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
    """One row for each group, all made together: words are numbered anew within each group."""
    first = np.flatnonzero(np.diff(group, prepend=-1))
    which = np.cumsum(np.diff(group, prepend=-1) != 0) - 1
    used, place = np.unique(which[:, None] << 32 | rows, return_inverse=True)
    word, of = used & (1 << 32) - 1, used >> 32
    real = np.flatnonzero(word)
    # numbers count from 0 in each group, without the mark of an ended suffix
    local = np.zeros(len(used), dtype=np.int64)
    word_ends = np.searchsorted(of[real], np.arange(len(first) + 1))
    local[real] = np.arange(len(real)) - word_ends[of[real]]
    lists = pa.ListArray.from_arrays(pa.array(word_ends, pa.int32()), pa.array(distinct, pa.binary()).take(pa.array(word[real] - 1)))
    words = pc.binary_join(lists, b"\n")  # as one value: each element of an array would take 16 bytes more
    sizes = (rows > 0).sum(axis=1)
    shared = np.zeros(len(rows), dtype=np.int64)
    shared[1:] = np.cumprod(rows[1:] == rows[:-1], axis=1).sum(axis=1)
    shared[first] = 0
    shared = np.minimum(shared, sizes)
    column = np.arange(rows.shape[1])
    written = (column >= shared[:, None]) & (column < sizes[:, None])
    tails = local[place.reshape(rows.shape)[written]]
    width = 2 if not len(tails) or tails.max() < 1 << 16 else 4
    bounds = np.append(first, len(rows))
    tail_bounds = np.concatenate([[0], np.cumsum(sizes - shared)])[bounds]

    def cut(data: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer((ends * data.itemsize).astype(np.int32)), pa.py_buffer(data.tobytes())]
        )

    return pa.RecordBatch.from_arrays(
        [
            pa.array(group[first]), pa.array([lang] * len(first)), words, pa.array([width] * len(first), pa.int32()),
            cut((shared << 4 | sizes).astype(np.uint8), bounds), cut(tails.astype(f"<u{width}"), tail_bounds), cut(n.astype("<u4"), bounds),
        ],
        names=["group", "lang", "words", "width", "heads", "tails", "n"],
    )


def block_rows(heads: bytes, tails: bytes, width: int, numbers: np.ndarray, length: int) -> np.ndarray:
    """The suffixes of a block as rows of ``numbers``, one for each of its words; 0 behind their ends."""
    heads_ = np.frombuffer(heads, dtype=np.uint8)
    shared, sizes = heads_ >> 4, heads_ & 15
    column = np.arange(length)
    written = (column >= shared[:, None]) & (column < sizes[:, None])
    rows = np.zeros((len(heads_), length), dtype=np.int32)
    rows[written] = numbers[np.frombuffer(tails, dtype=f"<u{width}")]
    # a shared word is the last one written in its column
    last = np.maximum.accumulate(np.where(written, np.arange(len(rows), dtype=np.int32)[:, None], 0), axis=0)
    return np.where(column < sizes[:, None], rows[last, column], 0)


def subtree_counts(blocks: pa.Table, length: int, least: int) -> list[tuple[str, bytes, int]]:
    """The frequent phrases of a group, (lang, phrase, count), from its sorted suffixes."""
    out = []
    for lang in blocks.column("lang").unique().to_pylist():
        own = blocks.filter(pc.equal(blocks.column("lang"), lang))
        lists = pc.split_pattern(own.column("words").combine_chunks(), "\n")
        coded = lists.flatten().dictionary_encode()
        words, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        begins = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        encoded = zip(*(own.column(c).to_pylist() for c in ("heads", "tails", "width")))
        rows = np.concatenate([
            block_rows(*x, numbers[b:c] + 1, length) for x, b, c in zip(encoded, begins, begins[1:])
        ])
        n = np.concatenate([np.frombuffer(x, dtype="<u4") for x in own.column("n").to_pylist()]).astype(np.int64)
        rows, n = merged(rows, n)
        same = np.ones(len(rows), dtype=bool)
        same[0] = False
        for depth in range(length):
            same[1:] &= rows[1:, depth] == rows[:-1, depth]
            if not depth:
                continue
            new = np.flatnonzero(~same)
            total = np.add.reduceat(n, new)
            some = np.flatnonzero((total >= least) & (rows[new, depth] > 0))
            for row, a in zip(rows[new[some], : depth + 1].tolist(), total[some].tolist()):
                out.append((lang, b" ".join([words[w - 1] for w in row]), a))
    return out


def phrase_counts(docs: DataFrame, config: PhraseConfig) -> tuple[DataFrame, DataFrame]:
    """Rows (lang, phrase, a) of all phrases with a count of at least ``least``, and rows (lang, n) with all words."""
    words = stored(word_counts(docs), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("a").alias("n")), "word-totals")
    most = words.agg(F.coalesce(F.sum("a"), F.lit(0))).first()[0]
    budget = max(config.budget, most // MOST_GROUPS)
    frequent_words = words.where(F.col("a") >= config.least)
    partition, known = partition_prefixes(docs, frequent_words, config, budget)
    length, least, extended = config.words, config.least, docs.sparkSession.sparkContext.broadcast(partition.extended)

    def subtrees(key: tuple, blocks: pa.Table) -> pa.Table:
        found = [x for x in subtree_counts(blocks, length, least) if phrase_key(x[0], [x[1]]) not in extended.value]
        langs, phrases, counts = zip(*found) if found else ((), (), ())
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()), "a": pa.array(counts, pa.int64())})

    blocks = suffix_blocks(docs, partition, length)
    longer = blocks.groupBy("group").applyInArrow(subtrees, "lang string, phrase string, a long")
    return stored(union_all([frequent_words, longer, *known]), "phrases"), totals


def _part(first: Column | int, number: Column | int) -> Column:
    return F.array_join(F.slice("words", first, number), " ")


#: 1000 a n / (l r) rounded down; decimals of 38 digits hold both products.
SCORE = (
    "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(16,0)))"
    " div (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))"
)


def collocations(docs: DataFrame, config: PhraseConfig = PhraseConfig()) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``words`` words.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and those into words at spaces and tabs;
    a null text is empty, a null lang ``und``. ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut with the
    lowest score (of equal ones the first), ``n`` all words; the score is 1000 a n / (l r) rounded down, in exact
    decimals of 38 digits. Phrases inside a longer one with at least ``share`` hundredths of their count are left out.
    Ranks go by score, then count (both falling), then phrase. Only ``lang`` and ``text`` are looked at; repeated
    rows count each time. An empty table gives no rows.

    A hot phrase is one suffix for each slice of texts, and its group is cut further by the budget; counts of words
    are combined before they are shuffled.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    phrases, totals = phrase_counts(docs, config)
    numbered = phrases.withColumn("words", F.split("phrase", " ", -1)).withColumn("m", F.size("words"))
    candidates = numbered.where("m > 1")
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("count"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1))).select(
        "lang", "phrase", "a", "k", _part(1, F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("m") - F.col("k")).alias("right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        own = counts.select("lang", F.col("part").alias(side), F.col("count").alias(name))
        cuts = cuts.join(own, ["lang", side])
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(SCORE))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("m") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("m") - size + 1), lambda at: _part(at, size)),
    ))
    covered = (
        candidates.where("m > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    hidden = F.col("longer").isNotNull() & (F.col("longer") * 100 >= F.col("a") * config.share)
    open_ones = lowest.join(covered, ["lang", "phrase"], "left").where(~hidden).select("lang", "phrase", "a", "n", "cut.*")
    # the first of each share of a language's phrases, then the first of those: no task sorts a whole language
    order = (F.desc("score"), F.desc("a"), "phrase")
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))).orderBy(*order)
    first = open_ones.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= config.top).drop("rank")
    number = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = first.withColumn("rank", number).where(F.col("rank") <= config.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
