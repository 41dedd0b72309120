"""Removal of repeated passages by prefix-free parsing.

A rolling hash over 8 bytes triggers phrase borders: the smallest hash among ``window`` neighbouring positions
is a trigger, so every string of ``match`` bytes holds one, at a place that only the string itself decides.
A text position is then described by the end of its phrase (up to the trigger) and by the parse that
follows the trigger, and two positions start equal strings only if both parts agree. The order in which
neighbours are compared is that of names instead of letters: an equal string has an equal name (a hash), and
equal names are neighbours, which is all that repeats need.

1. All positions of one phrase that share a trigger form a run. It has a name for the parse just behind the
   trigger (the part that all its positions contain) and one for everything that its positions contain.
2. Runs whose parse name occurs once hold no repeat. Runs whose full name occurs twice are repeats as a whole.
3. Of the rest, one run for each full name is taken apart into its positions. These are sorted by parse name
   and name of the whole string, and a position is a repeat if a neighbour in that order is equal.

Runs of words are found in the same steps: a text is then the row of its words' hashes, eight bytes each, and
positions, windows and matches are counted in words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import stored, text_slices

WINDOW = 128
#: Of runs of words, in words; shorter for short runs.
WORD_WINDOW = 32
_WORD_BYTES = 8
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Words of more bytes are hashed one by one.
_LONG_WORD = 64
#: A parse name with more full names than this is dealt to several groups, by the names of whole strings.
LARGE_CLASS = 256
_GROUPS = 64
_OUTPUT_BYTES = 4_000_000

# A run as one number: 24 bits of the text's hash, 31 bits of its first position, a bit that says whether positions
# are words, 7 bits of its last less its first.


def tag_of(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) & 0xFFFFFF


def packed(tag: np.ndarray, low: np.ndarray, high: np.ndarray, of_words: bool) -> np.ndarray:
    return tag << 39 | low << 8 | of_words << 7 | high - low


def unpacked(place: int) -> tuple[int, int, int, bool]:
    low = place >> 8 & 0x7FFFFFFF
    return place >> 39, low, low + (place & 0x7F), bool(place & 0x80)


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The first bytes of a text's words and those behind their last."""
    inside = np.concatenate([[False], ~_IS_SPACE[np.frombuffer(data, dtype=np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_names(data: bytes, bounds: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The hashes of a text's words, in a row: eight bytes of all words at a time, long words by themselves."""
    begin, end = bounds
    eights = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    size = end - begin
    names, rest = _mixed(size.astype(np.uint64)), np.flatnonzero(size <= _LONG_WORD)
    for done in range(0, _LONG_WORD, 8):
        left = size[rest] - done
        symbols = eights[begin[rest] + done] & _LOW_BYTES[np.minimum(left, 8)]
        names[rest] = _mixed(names[rest] * np.uint64(0xC2B2AE3D27D4EB4F) + symbols)
        rest = rest[left > 8]
        if not len(rest):
            break
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        names[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]])
    return names


def _mixed(key: np.ndarray) -> np.ndarray:
    """One to one; every bit depends on all."""
    key = (key ^ key >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    key = (key ^ key >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return key ^ key >> np.uint64(31)


def word_window(words: int) -> int:
    return min(WORD_WINDOW, 2 * words // 3)


def triggers(data: bytes, window: int = WINDOW) -> np.ndarray:
    """For each position the first place of the smallest hash among ``window`` positions from it on."""
    n = len(data)
    if n < window:
        return np.zeros(0, dtype=np.int64)
    padded, key = data + bytes(8), np.empty(n, dtype=np.uint64)
    for i in range(8):
        own = key[i::8]
        own[:] = np.frombuffer(padded, dtype="<u8", offset=i, count=len(own))
    return _smallest(key, window)


def word_triggers(names: np.ndarray, window: int) -> np.ndarray:
    """The same for positions of words, by the hashes of two words in a row."""
    key = names.astype(np.uint64)
    if len(key) < window:
        return np.zeros(0, dtype=np.int64)
    key[:-1] += key[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return _smallest(key, window)


def _smallest(key: np.ndarray, window: int) -> np.ndarray:
    n = len(key)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    bits = np.uint64(max(24, n.bit_length()))  # low bits: the position, so that the first of equals is smallest
    key = key >> bits << bits | np.arange(n, dtype=np.uint64)
    have = 1
    while 2 * have <= window:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < window:
        key = np.minimum(key[: have - window], key[window - have :])
    return (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def runs(
    data: bytes, at: np.ndarray, ends: np.ndarray, match: int, window: int, width: int = 1, whole_names: bool = True
) -> tuple[np.ndarray, ...]:
    """Text, first and last position in it, parse name and full name of each run of the texts that ``data`` joins.

    ``at``: the triggers of all positions, ``ends``: where the texts end. A position has ``width`` bytes. Full names
    are left out unless ``whole_names``.
    """
    begins = np.concatenate([[0], ends[:-1]])
    for a, b in zip(begins.tolist(), ends.tolist()):
        at[max(a, b - match + 1) : b] = -1  # no string of a text starts here
    lows = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1]) if len(at) else at
    highs = np.concatenate([lows[1:], [len(at)]])[: len(lows)] - 1
    own = at[lows] >= 0
    lows, highs = lows[own], highs[own]
    t, text = at[lows], np.searchsorted(ends, lows, side="right")
    shared, name = (match - window + 1) * width, xxhash.xxh3_64_digest
    found = text, lows - begins[text], highs - begins[text], _numbers([name(data[x : x + shared]) for x in (t * width).tolist()])
    if not whole_names:
        return found
    whole = [
        name(data[a:b], seed) for a, b, seed in zip((lows * width).tolist(), ((highs + match) * width).tolist(), (t - lows).tolist())
    ]
    return *found, _numbers(whole)


def _numbers(digests: list[bytes]) -> np.ndarray:
    """63 bits of each."""
    return (np.frombuffer(b"".join(digests), dtype=">u8") >> np.uint64(1)).astype(np.int64)


def text_runs(docs: DataFrame, match: int, window: int, words: int | None = None, parse_only: bool = False) -> DataFrame:
    """Rows (id, place, parse, whole) for all runs of all texts, with ``words`` also for those of words.

    With ``parse_only`` rows (parse), for the same runs.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            parts = [t.encode() for t in texts]
            ids, tags = batch.column("id").to_numpy(), np.array([tag_of(data) for data in parts], dtype=np.int64)
            data, ends = b"".join(parts), np.cumsum([len(data) for data in parts])
            yield as_batch(ids, tags, False, *runs(data, triggers(data, window), ends, match, window, 1, not parse_only))
            if words:
                data = b" ".join(parts)
                bounds, span = word_bounds(data), word_window(words)
                names, ends = word_names(data, bounds), np.searchsorted(bounds[0], ends + np.arange(len(ends)))
                at = word_triggers(names, span)
                yield as_batch(ids, tags, True, *runs(names.tobytes(), at, ends, words, span, _WORD_BYTES, not parse_only))

    def as_batch(ids, tags, of_words, text, low, high, parse, whole=None) -> pa.RecordBatch:  # noqa: ANN001
        if parse_only:
            return pa.RecordBatch.from_arrays([pa.array(parse, pa.int64())], names=["parse"])
        columns = [ids[text], packed(tags[text], low, high, of_words), parse, whole]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["id", "place", "parse", "whole"])

    schema = "parse long" if parse_only else "id long, place long, parse long, whole long"
    return docs.select("id", "text").mapInArrow(find, schema)


def _bodies(docs: DataFrame) -> DataFrame:
    """Rows (id, rest, body): compressed texts, which is what joins have to move; null texts stay null."""
    narrow = docs.select("id", "rest", "text")
    schema = T.StructType([*narrow.schema.fields[:2], T.StructField("body", T.BinaryType())])

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            body = [None if t is None else compress(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(body, pa.binary())], names=["id", "rest", "body"])

    return narrow.mapInArrow(press, schema)


def _positions(bodies: DataFrame, taken_apart: DataFrame, match: int, words: int | None) -> DataFrame:
    """Rows (parse, whole, deal, name, bit): each position of the runs in ``taken_apart`` (id, runs)."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, plain = xxhash.xxh3_64_digest, zstandard.ZstdDecompressor()
        for batch in batches:
            found, sizes, strings = [], [], []
            for body, own in zip(batch.column("body"), batch.column("runs")):
                if body.as_py() is None:
                    continue
                data = plain.decompress(body.as_py()) if len(body.as_py()) else b""
                tag, names = tag_of(data), None
                for r in own.as_py():
                    of, low, high, of_words = unpacked(r["place"])
                    if of == tag:
                        if of_words and names is None:
                            names = word_names(data, word_bounds(data)).tobytes()
                        symbols, width, size = (names, _WORD_BYTES, words * _WORD_BYTES) if of_words else (data, 1, match)
                        found.append((r["parse"], r["whole"], r["members"]))
                        sizes.append(high - low + 1)
                        strings += [name(symbols[i : i + size]) for i in range(low * width, (high + 1) * width, width)]
                if len(strings) > 200_000:
                    yield as_batch(found, sizes, strings)
                    found, sizes, strings = [], [], []
            if found:
                yield as_batch(found, sizes, strings)

    def as_batch(found: list[tuple], sizes: list[int], strings: list[bytes]) -> pa.RecordBatch:
        parse, whole, members = np.repeat(np.array(found, dtype=np.int64), sizes, axis=0).T
        name = _numbers(strings)
        bit = np.arange(len(name)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        columns = [parse, whole, np.where(members > LARGE_CLASS, name % _GROUPS, 0), name, bit]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["parse", "whole", "deal", "name", "bit"])

    return bodies.select("id", "body").join(taken_apart, "id").dropDuplicates(["id"]).mapInArrow(
        expand, "parse long, whole long, deal long, name long, bit long"
    )


def repeated_runs(docs: DataFrame, match: int, window: int, words: int | None = None) -> DataFrame:
    """Rows (id, place, low, high): for each run with repeats the bits of its repeated positions, two words.

    Runs are found twice, once to count parse names and once to keep those of shared ones: a table of them all would
    take as much disk as the texts.
    """
    parses = text_runs(docs, match, window, words, parse_only=True)
    shared = stored(parses.groupBy("parse").agg(F.count("*").alias("n")).where("n > 1").select("parse"), "shared-parses")
    candidates = stored(text_runs(docs, match, window, words).join(shared, "parse"), "candidate-runs")
    names = stored(
        candidates.groupBy("parse", "whole").agg(F.count("*").alias("n"), F.min(F.struct("id", "place")).alias("one")), "run-names"
    )
    mixed = stored(names.groupBy("parse").agg(F.count("*").alias("members")).where("members > 1"), "mixed-parses")
    one = names.join(mixed, "parse").select("one.id", F.struct("one.place", "parse", "whole", "members").alias("run"))
    taken_apart = stored(one.groupBy("id").agg(F.collect_list("run").alias("runs")), "runs-apart")  # a document's own runs
    order = Window.partitionBy("parse", "deal").orderBy("name")
    same = (F.lag("name").over(order) == F.col("name")) | (F.lead("name").over(order) == F.col("name"))
    bit = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    bits = (
        _positions(_bodies(docs), taken_apart, match, words).withColumn("same", same).where("same").groupBy("parse", "whole")
        .agg(F.bit_or(F.when(F.col("bit") < 64, bit).otherwise(0)).alias("low"), F.bit_or(F.when(F.col("bit") >= 64, bit).otherwise(0)).alias("high"))
    )
    everything = F.lit(-1).cast("long")
    masks = stored(
        names.where("n > 1").select("parse", "whole", everything.alias("low"), everything.alias("high"))
        .unionByName(bits.join(names.where("n > 1"), ["parse", "whole"], "left_anti").select("parse", "whole", "low", "high")), "masks",
    )
    return candidates.join(masks, ["parse", "whole"]).select("id", "place", "low", "high")


def repeated_spans(places: list[tuple[int, int, int]], data: bytes, match: int, words: int | None = None) -> tuple[list, list]:
    """Stretches (start, end) of a text that its runs (place, low, high) of bytes and those of words mark."""
    strings, passages, tag, bounds = [], [], tag_of(data), None
    for place, low, high in places:
        of, first, last, of_words = unpacked(place)
        if of != tag:
            continue
        mask = (low & 0xFFFFFFFFFFFFFFFF) | (high & 0xFFFFFFFFFFFFFFFF) << 64
        mask &= (1 << (last - first + 1)) - 1
        while mask:
            start = (mask & -mask).bit_length() - 1
            length = (~(mask >> start) & (mask >> start) + 1).bit_length() - 1
            begin, size = first + start, length - 1 + (words if of_words else match)
            if of_words:
                bounds = bounds or word_bounds(data)
                passages.append((int(bounds[0][begin]), int(bounds[1][begin + size - 1])))
            else:
                strings.append((begin, begin + size))
            mask = mask >> (start + length) << (start + length)
    return strings, passages


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(data)]
    return b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])])


def remove_repeats(
    docs: DataFrame, match: int = 400, window: int = WINDOW, as_text: bool = False, words: int | None = None, apart: bool = False
) -> DataFrame:
    """Rows (rest, n_bytes, spans, kept): each row of ``docs`` without the bytes of repeated strings.

    A byte goes if a string of ``match`` bytes covers it that starts anywhere else too, in the same text or
    another; strings are judged on the input and never cross texts. ``rest`` is a struct of the columns of
    ``docs`` other than ``text``, ``spans`` the maximal removed stretches (start, end), ``kept`` the remaining bytes, null
    for a null text (0 bytes). With ``as_text`` they are a string, without the rest of characters that a cut
    divides. With ``words`` a byte also goes if it is in a run of so many words (what stands between ASCII white
    space) that starts anywhere else too, whatever space is between the words. Texts shorter than either stay
    whole; repeated rows are repeats of each other. An empty table gives no rows.

    With ``apart`` runs of words leave ``spans`` and ``kept`` alone and make two further columns: ``passages``, their
    own maximal stretches, and ``clean``, the text without both, as a string like that of ``as_text``.

    Texts move twice, compressed, once for the runs that are taken apart and once for the cut. Between, only
    names and numbers of runs do, and after the first count only those whose parse name occurs twice.
    """
    if not 8 < window <= 128 or match < window + 8:
        raise ValueError("the window must be over 8, at most 128 and at least 8 less than the match")
    if words is not None and words < 3:
        raise ValueError("a run has 3 words at least")
    if apart and words is None:
        raise ValueError("there are no runs of words to set apart")
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    # a text is known by a hash of itself and its doc_id, with the tag of a run 88 bits; only equal rows share it, and
    # their equal runs become one, so what is gathered is bounded by one text
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("id"), rest.alias("rest"), "text")
    places = repeated_runs(keyed, match, window, words).groupBy("id").agg(F.collect_set(F.struct("place", "low", "high")).alias("places"))
    joined = _bodies(keyed).join(places, "id", "left").select("rest", "body", "places")
    stretches = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([
        joined.schema["rest"], T.StructField("n_bytes", T.LongType()), T.StructField("spans", stretches),
        T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        *([T.StructField("passages", stretches), T.StructField("clean", T.StringType())] if apart else []),
    ])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), span_type, pa.string() if as_text else pa.binary(), span_type, pa.string()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            found = batch.column("places")
            runs_of = list(zip(*[c.to_pylist() for c in found.flatten().flatten()]))
            counts = found.value_lengths().fill_null(0).to_pylist()
            start, first, rows, volume = 0, 0, [], 0
            for i, (body, n) in enumerate(zip(batch.column("body"), counts)):
                body = body.as_py()
                data = plain.decompress(body) if body else b""
                strings, passages = repeated_spans(runs_of[first : first + n], data, match, words) if n else ([], [])
                first += n
                spans = merged(strings if apart else strings + passages)
                left = without(data, spans)
                text = left.decode("utf-8", "ignore") if as_text else left
                row = [len(data), as_structs(spans), None if body is None else text]
                if apart:
                    passages = merged(passages)
                    clean = without(data, merged(spans + passages)) if passages else left
                    row += [as_structs(passages), None if body is None else clean.decode("utf-8", "ignore")]
                    volume += len(clean)
                rows.append(row)
                volume += len(left)
                if volume > _OUTPUT_BYTES or i == batch.num_rows - 1:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays([batch.column("rest").slice(start, len(rows)), *columns], names=schema.names)
                    start, rows, volume = i + 1, [], 0

    def as_structs(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
        return [{"start": a, "end": b} for a, b in spans]

    return joined.mapInArrow(cut, schema)
