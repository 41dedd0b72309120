"""Alignment of the tokens of two tokenizers over the same bytes, by merging all texts of a batch in lockstep.

Both tokenizers cut the same bytes. Places where tokens of both end cut a text into groups, and the tokens of a group
are linked with each other. The merge that finds these places runs for all texts of a batch at once: one vector holds
the place of every text in tokenizer A's tokens and one in B's. Each step compares where the current tokens end, moves
the one that ends first (or both), and gives out the cuts and links that it meets; finished texts leave the vectors.
A long text takes part as several stretches between places where both tokenizers are known to end, so that a step
always moves many.

How often a pair of ids is linked is known only over the whole corpus. Texts are dealt to units of bounded size, each
unit counts its pairs, these counts are summed up by pair, and the sums go back to the units that hold the pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm.common import release, resident, stored, text_slices
from shelfcast.llm.tokens import TextEncoder, byte_characters
from shelfcast.llm.words import EDGE_CODE, WordEncoder

WORD_START = "▁"
#: Characters and rows of the texts that share a table of pair counts.
UNIT_CHARS, UNIT_ROWS = 3_000_000, 20_000
#: Characters of the texts that are merged side by side.
LOCKSTEP_CHARS = 1_000_000
#: Words that a worker keeps of each tokenizer, in each of two generations.
KEPT_WORDS = 150_000
#: Tokens of A after which a text goes on in a stretch of its own, and how many ends are tried for that.
STRETCH, TRIED = 256, 16
#: Bits of an id in a pair's number, and of a text's place in a unit.
_BITS = 21

_ALIGNED = "doc_id long, unit long, a_ids binary, b_ids binary, a_in_group binary, b_in_group binary, pairs binary, texts binary"
_COUNTED = "doc_id long, groups string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


class SpaceSplitter:
    """Chunks that begin at a space behind anything but a space: no piece of the vocabulary reaches over one."""

    def starts(self, codes: np.ndarray) -> np.ndarray:
        before = np.roll(codes, 1)
        starts = (codes == 0x20) & (before != 0x20)
        edge = codes == EDGE_CODE
        return starts | edge | np.roll(edge, 1)


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """The bytes of each piece; a byte stands for itself and a start mark for a space."""
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace(WORD_START, " ").encode() for i, n in enumerate(names)]


def byte_level_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each token of a byte-level vocabulary; an added token stands for its string."""
    byte = {c: b for b, c in enumerate(byte_characters())}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    of = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        of[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return of


@lru_cache(maxsize=1)
def same_bytes(a_path: str, b_path: str) -> np.ndarray:
    """For each id of A the id of B with the same bytes, -1 if there is none."""
    model = sentencepiece.SentencePieceProcessor(model_file=b_path)
    ids = {data: i for i, data in enumerate(piece_bytes(model)) if not (model.is_control(i) or model.is_unknown(i))}
    return np.array([ids.get(data, -1) for data in byte_level_bytes(Tokenizer.from_file(a_path))], dtype=np.int64)


class PieceEncoder:
    """Encodes texts with the sentencepiece model at ``path``, which puts a space before each text.

    Where the model neither rewrites texts nor has a piece with a space behind another character, distinct chunks
    between spaces are encoded once; otherwise texts as a whole.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        special = [self.model.is_control(i) or self.model.is_unknown(i) for i in range(size)]
        self.bytes_of = piece_bytes(self.model)
        kept_as_is = self.model.normalize(" a  ﬁ ") == " a  ﬁ ".replace(" ", WORD_START).join((WORD_START, ""))
        crossing = any(WORD_START in name.lstrip(WORD_START) for name, no in zip(names, special) if not no)
        self.start = self.model.piece_to_id(WORD_START)
        self.by_chunks = kept_as_is and not crossing and not special[self.start]
        self.chunks = WordEncoder(SpaceSplitter(), self._fresh, KEPT_WORDS)

    def _fresh(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of chunks; the model puts a start mark before anything but an empty text."""
        found = self.model.encode([c[1:].decode() for c in chunks], num_threads=1)
        return [ids or [self.start] for ids in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if self.by_chunks:
            return self.chunks.encode([f" {t}" if t else "" for t in texts])
        return [np.array(ids, dtype="<u4").tobytes() for ids in self.model.encode(texts, num_threads=1)]


class Pair:
    """Both tokenizers of a worker process."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = TextEncoder(a_path, plain=True, kept=KEPT_WORDS), PieceEncoder(b_path)
        self.a_bytes, self.b_bytes = TokenBytes(byte_level_bytes(self.a.tokenizer)), TokenBytes(self.b.bytes_of)
        self.same = same_bytes(a_path, b_path)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The ids of both; none for a text whose bytes one of them does not give back."""
        a, b = self.a.encode([f" {t}" if t else "" for t in texts]), self.b.encode(texts)
        wanted = [f" {t}".encode() if t else b"" for t in texts]
        for i in np.flatnonzero(~(self.a_bytes.same(a, wanted) & self.b_bytes.same(b, wanted))).tolist():
            a[i] = b[i] = b""
        return a, b


class TokenBytes:
    """The bytes of each id of a vocabulary."""

    def __init__(self, of: list[bytes]):
        self.size = np.array(list(map(len, of)), dtype=np.int64)
        self.data = np.frombuffer(b"".join(of), dtype=np.uint8)
        self.first = np.cumsum(self.size) - self.size

    def same(self, ids: list[bytes], wanted: list[bytes]) -> np.ndarray:
        """Whether the bytes of each text's ids are the wanted ones."""
        flat, cuts = _ids(ids), _cuts([len(x) // 4 for x in ids])
        sizes = self.size[flat]
        ends = _cuts(sizes)
        found = self.data[np.arange(ends[-1]) + np.repeat(self.first[flat] - ends[:-1], sizes)].tobytes()
        own = ends[cuts].tolist()
        return np.array([found[c:d] == x for c, d, x in zip(own, own[1:], wanted)], dtype=bool)


def stretches(ends_a: np.ndarray, ends_b: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Rows (a from, a to, b from, b to): texts, the long ones cut where tokens of both end.

    Only a few ends are tried after every ``STRETCH`` tokens; if none is common, the stretch goes on.
    """
    begin, end = texts[:, 0], texts[:, 1]
    times = np.maximum((end - begin - 1) // STRETCH, 0)
    if not times.any():
        return texts
    text = np.repeat(np.arange(len(texts)), times)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(times) - times, times) + 1
    tried = (begin[text] + nth * STRETCH - 1)[:, None] + np.arange(TRIED)
    inside = tried < (end[text] - 1)[:, None]
    value = ends_a[np.minimum(tried, len(ends_a) - 1)]
    place = np.minimum(np.searchsorted(ends_b, value), len(ends_b) - 1)
    common = inside & (ends_b[place] == value)
    own = np.flatnonzero(common.any(axis=1))
    first = common[own].argmax(axis=1)
    a_cut, b_cut = tried[own, first] + 1, place[own, first] + 1
    a_from, b_from = np.append(begin, a_cut), np.append(texts[:, 2], b_cut)
    order = np.argsort(a_from, kind="stable")
    a_from, b_from = a_from[order], b_from[order]
    # stretches follow each other without gaps, as texts without tokens are not among them
    return np.stack([a_from, np.append(a_from[1:], end[-1]), b_from, np.append(b_from[1:], texts[-1, 3])], axis=1)


def products(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every token of A with every token of B for each group: ``n_a`` tokens from ``a`` on, ``n_b`` from ``b`` on."""
    n = n_a * n_b
    if (n == 1).all():
        return a, b
    group = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    return a[group] + place // n_b[group], b[group] + place % n_b[group]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Rows (a from, a to, b from, b to) of groups in order, and the places in A and B of linked tokens.

    ``lanes`` are stretches of tokens whose last ones end together; all are merged side by side.
    """
    a, a_end, b = lanes[:, 0].copy(), lanes[:, 1].copy(), lanes[:, 2].copy()
    a_from, b_from = a.copy(), b.copy()
    groups, links = [], []
    while a.size:
        at_a, at_b = ends_a[a], ends_b[b]
        cut = np.flatnonzero(at_a == at_b)
        a += at_a <= at_b
        b += at_b <= at_a
        # both have moved on at a cut; elsewhere the one that ended first has
        if cut.size:
            first_a, past_a, first_b, past_b = a_from[cut], a[cut], b_from[cut], b[cut]
            groups.append((first_a, past_a, first_b, past_b))
            links.append(products(first_a, past_a - first_a, first_b, past_b - first_b))
            a_from[cut], b_from[cut] = past_a, past_b
            live = a < a_end
            if not live.all():
                a, a_end, b, a_from, b_from = a[live], a_end[live], b[live], a_from[live], b_from[live]
    found = np.stack([np.concatenate(x) for x in zip(*groups)], axis=1)
    x, y = (np.concatenate(z) for z in zip(*links))
    return found[np.argsort(found[:, 0])], (x, y)


def _cuts(lengths: list[int] | np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(lengths, dtype=np.int64))])


def _ids(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype="<u4").astype(np.int64)


def single_pairs(in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in A and B of groups with one token of each, which have the same bytes."""
    single = np.flatnonzero((in_a == 1) & (in_b == 1))
    return (np.cumsum(in_a) - in_a)[single], (np.cumsum(in_b) - in_b)[single]


def with_marks(columns: list[list[bytes]], same: np.ndarray) -> list[bytes]:
    """B's ids plus 1, but 0 in a group with one token of each where B's id is that of A's bytes: most are 0."""
    a, b, in_a, in_b = map(_ids, columns)
    at_a, at_b = single_pairs(in_a, in_b)
    told = at_b[same[a[at_a]] == b[at_b]]
    marked = b + 1
    marked[told] = 0
    return _cut(marked, columns[1])


def without_marks(columns: list[list[bytes]], same: np.ndarray) -> list[bytes]:
    a, marked, in_a, in_b = map(_ids, columns)
    at_a, at_b = single_pairs(in_a, in_b)
    b = marked - 1
    told = marked[at_b] == 0
    b[at_b[told]] = same[a[at_a[told]]]
    return _cut(b, columns[1])


def _cut(values: np.ndarray, like: list[bytes]) -> list[bytes]:
    """Numbers of many texts as those of each, which have as many as ``like``."""
    data, cuts = values.astype("<u4").tobytes(), _cuts(list(map(len, like))).tolist()
    return [data[c:d] for c, d in zip(cuts, cuts[1:])]


@cache
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


def packed(values: bytes) -> bytes:
    """32-bit numbers in as many bytes each as the largest needs, compressed: the form in which they are stored and moved."""
    numbers = np.frombuffer(values, dtype="<u4")
    if not numbers.size:
        return b""
    width = next(w for w in (1, 2, 4) if w == 4 or numbers.max() < 1 << 8 * w)
    return bytes([width]) + _compressor().compress(numbers.astype(f"<u{width}").tobytes())


def unpacked(data: bytes) -> bytes:
    return np.frombuffer(zstandard.decompress(data[1:]), dtype=f"<u{data[0]}").astype("<u4").tobytes() if data else b""


def align_texts(pair: Pair, texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The texts' ids of A and B and, group by group, how many tokens of each; then linked pairs and in how many texts."""
    a, b = pair.encode(texts)
    a_cuts, b_cuts = _cuts([len(x) // 4 for x in a]), _cuts([len(x) // 4 for x in b])
    a_ids, b_ids = _ids(a), _ids(b)
    own = np.flatnonzero(np.diff(a_cuts))
    if not own.size:
        return [[b""] * len(texts) for _ in range(4)], np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    ends_a, ends_b = np.cumsum(pair.a_bytes.size[a_ids]), np.cumsum(pair.b_bytes.size[b_ids])
    whole = np.stack([a_cuts[own], a_cuts[own + 1], b_cuts[own], b_cuts[own + 1]], axis=1)
    groups, (x, y) = lockstep(ends_a, ends_b, stretches(ends_a, ends_b, whole))
    text = np.repeat(np.arange(len(texts)), np.diff(a_cuts))[x]
    _, pairs, _ = distinct_pairs(text, a_ids[x], b_ids[y])
    n_a, n_b = ((groups[:, i + 1] - groups[:, i]).astype("<u4").tobytes() for i in (0, 2))
    cuts = (4 * np.searchsorted(groups[:, 0], a_cuts)).tolist()
    in_a, in_b = ([n[c:d] for c, d in zip(cuts, cuts[1:])] for n in (n_a, n_b))
    return [a, b, in_a, in_b], *np.unique(pairs, return_counts=True)


def distinct_pairs(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of links of ids ``a`` and ``b``, text by text: place of the text, number of the pair, how often it is linked there.

    A pair's number is A's id times 2^21 plus B's.
    """
    if a.size and max(a.max(), b.max()) >> _BITS:
        raise ValueError(f"ids must be below 2^{_BITS}")
    found, times = np.unique(text << 2 * _BITS | a << _BITS | b, return_counts=True)
    return found >> 2 * _BITS, found & (1 << 2 * _BITS) - 1, times


def grouped_pairs(a: list[bytes], b: list[bytes], n_a: list[bytes], n_b: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``distinct_pairs`` of texts that are already aligned."""
    a_ids, b_ids, in_a, in_b = map(_ids, (a, b, n_a, n_b))
    x, y = products(np.cumsum(in_a) - in_a, in_a, np.cumsum(in_b) - in_b, in_b)
    return distinct_pairs(np.repeat(np.arange(len(a)), [len(i) // 4 for i in a])[x], a_ids[x], b_ids[y])


_ARRAYS = ("a_ids", "b_ids", "a_in_group", "b_in_group")


def aligned_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows (doc_id, unit, a_ids, b_ids, a_in_group, b_in_group, pairs, texts), one for each row of ``docs``; all packed, B's ids with marks.

    The first row of a slice of texts has the slice's linked pairs and in how many of its texts each is linked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = resident(("alignment", a_path, b_path), lambda: Pair(a_path, b_path))
        unit = TaskContext.get().partitionId() << 32
        chars = rows = 0
        for batch, texts in text_slices(batches, most=LOCKSTEP_CHARS):
            # a slice is no larger than a unit, but for a single text
            more = sum(map(len, texts))
            if rows and (chars + more > UNIT_CHARS or rows + len(texts) > UNIT_ROWS):
                unit, chars, rows = unit + 1, 0, 0
            chars, rows = chars + more, rows + len(texts)
            columns, *pairs = align_texts(pair, texts)
            columns[1] = with_marks(columns, pair.same)
            columns = [list(map(packed, c)) for c in columns]
            columns += [[x.astype("<i8").tobytes()] + [None] * (len(texts) - 1) for x in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([unit] * len(texts), pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
                names=[c.split()[0] for c in _ALIGNED.split(", ")],
            )
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ALIGNED)


def _unit_pairs(aligned: DataFrame) -> DataFrame:
    """Rows (unit, a, b, n): in how many texts of a unit a pair is linked; a unit's pair may come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column("unit").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(units)) + 1).tolist(), len(units)]
            columns = [batch.column(c).to_pylist() for c in ("pairs", "texts")]
            for start, end in zip(bounds, bounds[1:]):
                pairs, texts = (np.frombuffer(b"".join(c[start:end]), dtype="<i8") for c in columns)
                order = np.argsort(pairs, kind="stable")
                first = np.flatnonzero(np.diff(pairs[order], prepend=-1))
                if first.size:
                    own = pairs[order][first]
                    found = (np.full(len(own), units[start]), (own >> _BITS).astype(np.int32), (own & (1 << _BITS) - 1).astype(np.int32), np.add.reduceat(texts[order], first))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["unit", "a", "b", "n"])

    return aligned.where("pairs is not null").select("unit", "pairs", "texts").mapInArrow(run, "unit long, a int, b int, n long")


def pair_counts(unit_pairs: DataFrame) -> DataFrame:
    """Rows (a, b, count, best): texts of the corpus that link a pair, and whether no pair of ``a`` is in more."""
    counts = unit_pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    return counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows (doc_id, groups, n_a, n_b, n_groups, n_links, n_best, count_sum), one for each row of ``docs``.

    ``a_path`` is a byte-level tokenizer file, which encodes a space and the text, ``b_path`` a sentencepiece model,
    which puts that space itself; strings of special tokens are plain text. ``groups`` holds the ids of A and B group
    by group, as ``a1,a2|b1;a3|b2,b3``. A link is a token of A and one of B in one group. The count of a pair of ids
    is the number of rows that link it; ``n_best`` are links whose count is the highest of their A id, ``count_sum``
    adds up the counts of all links.

    A text that is null, empty, or not given back by the bytes of either tokenizer has no tokens, groups and links.
    Rows that repeat, or have no doc_id, are documents of their own; other columns of ``docs`` are not looked at. An
    empty table gives no rows. A frequent pair is one row for each unit of texts, not for each text, and a unit
    gathers its own texts only.
    """
    aligned = stored(aligned_tokens(docs, a_path, b_path), "aligned", "zstd")
    pairs = stored(_unit_pairs(aligned), "unit-pairs", "zstd")
    counts = stored(pair_counts(pairs), "pair-counts", "zstd")
    known = pairs.select("unit", "a", "b").join(counts, ["a", "b"])

    def sum_up(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        columns = [list(map(unpacked, texts.column(c).to_pylist())) for c in _ARRAYS]
        columns[1] = without_marks(columns, same_bytes(a_path, b_path))
        place, pair, times = grouped_pairs(*columns)
        key = pairs.column("a").to_numpy().astype(np.int64) << _BITS | pairs.column("b").to_numpy()
        order = np.argsort(key)
        at = order[np.searchsorted(key, pair, sorter=order)] if len(key) else order
        count, best = pairs.column("count").to_numpy()[at], pairs.column("best").to_numpy()[at]
        bounds = np.searchsorted(place, np.arange(len(texts) + 1))

        def total(values: np.ndarray) -> np.ndarray:
            sums = _cuts(values)
            return sums[bounds[1:]] - sums[bounds[:-1]]

        sums = {
            "n_a": [len(x) // 4 for x in columns[0]], "n_b": [len(x) // 4 for x in columns[1]],
            "n_groups": [len(x) // 4 for x in columns[2]], "n_links": total(times),
            "n_best": total(times * best), "count_sum": total(times * count),
        }
        numbers = {name: pa.array(values, pa.int64()) for name, values in sums.items()}
        return pa.table({"doc_id": texts.column("doc_id"), "groups": pa.array(_texts(*columns), pa.string()), **numbers})

    texts = aligned.drop("pairs", "texts")
    return texts.groupBy("unit").cogroup(known.groupBy("unit")).applyInArrow(sum_up, _COUNTED)


@lru_cache(maxsize=8)
def _written(size: int, last: str) -> list[str]:
    """Each id with a comma behind it, and with what closes a group's side."""
    return [f"{i}{mark}" for i in range(size) for mark in (",", last)]


def _power(largest: int) -> int:
    return 1 << int(largest).bit_length()


def _texts(a: list[bytes], b: list[bytes], n_a: list[bytes], n_b: list[bytes]) -> list[str]:
    a_ids, b_ids, in_a, in_b = map(_ids, (a, b, n_a, n_b))
    if not a_ids.size:
        return [""] * len(a)
    to_a, to_b = np.cumsum(in_a), np.cumsum(in_b)
    last_a, last_b = np.zeros(len(a_ids), dtype=np.int64), np.zeros(len(b_ids), dtype=np.int64)
    last_a[to_a - 1] = last_b[to_b - 1] = 1
    sizes = _power(a_ids.max()), _power(b_ids.max())
    table = _written(sizes[0], "|") + _written(sizes[1], ";")
    written = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
    written[np.arange(len(a_ids)) + np.repeat(to_b - in_b, in_a)] = 2 * a_ids + last_a
    written[np.arange(len(b_ids)) + np.repeat(to_a, in_b)] = 2 * (sizes[0] + b_ids) + last_b
    parts = list(map(table.__getitem__, written.tolist()))
    cuts = _cuts([(len(x) + len(y)) // 4 for x, y in zip(a, b)]).tolist()
    return ["".join(parts[c:d])[:-1] for c, d in zip(cuts, cuts[1:])]
