"""Best-fit packing of token sequences by minimum bin slack.

The fullest feasible combination of the lengths at hand is found for one bin, that bin is taken away, and
so on until nothing is left. Lengths are at most the capacity, so all that the search needs is how many
pieces of each length remain: a table bounded by the capacity whatever the corpus. A combination is applied
as often as the remaining pieces allow, so the number of searches does not follow the corpus either.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import release, stored, text_slices
from shelfcast.llm.tokens import encoder

#: Rows of the table of first ranks (one for each task and length) that are still broadcast, 24 bytes each.
BROADCAST_ROWS = 1_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, rank_in_part long"


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The lengths (with how often each) whose sum comes closest to ``capacity`` without passing it.

    Bit s of a step's set says that the lengths up to that step can sum to s. Copies of a length enter in
    powers of two, larger lengths first; of equally full bins that one with the longest pieces is taken.
    """
    if not capacity or not counts:
        return {}
    steps, reach, mask = [], 1, (1 << (capacity + 1)) - 1
    for length in sorted(counts):
        left, size = min(counts[length], capacity // length), 1
        while left > 0:
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= (reach << (length * size)) & mask
            left -= size
            size *= 2
    total, chosen = reach.bit_length() - 1, {}
    for length, size, before in reversed(steps):
        rest = total - length * size
        if rest >= 0 and before >> rest & 1:
            chosen[length] = chosen.get(length, 0) + size
            total = rest
    return chosen


@dataclass(frozen=True)
class Slots:
    """For each length: pieces of rank ``first[i]`` and on go to sequence ``sequence[i]`` and on, at ``offset[i]``."""

    first: dict[int, np.ndarray]
    sequence: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for x in np.unique(length):
            own = length == x
            i = np.searchsorted(self.first[x], rank[own], side="right") - 1
            sequence[own] = self.sequence[x][i] + rank[own] - self.first[x][i]
            offset[own] = self.offset[x][i]
        return sequence, offset


def plan_bins(counts: dict[int, int], capacity: int) -> Slots:
    """Minimum bin slack over a table of lengths. Each bin is opened with the longest piece that is left."""
    left = {int(k): int(n) for k, n in counts.items() if n > 0}
    used = dict.fromkeys(left, 0)
    rows: dict[int, list[tuple[int, int, int]]] = {k: [] for k in left}
    sequences = 0
    while left:
        seed = max(left)
        rest = left | {seed: left[seed] - 1}
        chosen = fullest({k: n for k, n in rest.items() if n and k <= capacity - seed}, capacity - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        offset = 0
        for k in sorted(chosen, reverse=True):
            for _ in range(chosen[k]):
                rows[k].append((used[k], sequences, offset))
                used[k] += times
                left[k] -= times
                offset += k
            if not left[k]:
                del left[k]
        sequences += times
    columns = {k: np.array(v, dtype=np.int64).T for k, v in rows.items()}
    return Slots(*({k: c[i] for k, c in columns.items()} for i in range(3)), sequences)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Each document's ids with ``end_id`` after them, cut into pieces of ``capacity``; only the first may be shorter.

    ``ids`` holds little-endian unsigned 32-bit integers. ``part`` and ``rank_in_part`` number the pieces of
    one length within a task, so that no later step has to sort or gather them.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch, texts in text_slices(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    rank = seen.get(b - a, 0)
                    seen[b - a] = rank + 1
                    rows.append((doc_id, piece, a, b - a, ids[4 * a : 4 * b], part, rank))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "rank_in_part"],
                )
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids, sequence_id, offset): all documents in sequences of ``capacity``.

    A null or empty text is the end id alone. Rows with a null or repeated doc_id are documents of their own.
    An empty table gives no rows. Other columns of ``docs`` are not looked at.

    The pieces are written once with the task that made them. Counts of each length and task are summed up
    to first ranks, the histogram of lengths (at most ``capacity`` rows) goes to the driver and comes back
    as slots, and each piece finds its slot by its rank among the pieces of its length: no sort, no window
    over documents, and no task holds more than its own pieces.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id), "pieces", "zstd")
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_bins(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_rank"))
    if counts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = slots.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return (
        pieces.join(firsts, ["length", "part"])
        .withColumn("place", placed("length", F.col("rank_in_part") + F.col("first_rank")))
        .select("doc_id", "piece", "start", "length", "ids", "place.sequence_id", "place.offset")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids): the packed sequences themselves; a group has at most ``capacity`` ids."""
    piece = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.aggregate(F.sort_array(F.collect_list(piece)), F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )
