"""Near-duplicate embeddings through a pivot-permutation index.

A bounded sample of the vectors serves as reference points. Every vector is described by its nearest
reference points in order, and stands in the inverted list of each of them. Vectors that share lists are
candidates; those that share enough reference points are verified by their cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import components, stored


@dataclass(frozen=True)
class PivotConfig:
    """At most ``pivots`` reference points, the ``nearest`` of which describe a vector. They are taken from a sample
    of ``sample`` vectors, any two of them at a cosine under ``apart``: alike ones would only repeat each other.

    Candidates share at least ``shared`` of them, or all if fewer were found; where no more than ``nearest`` were, all
    vectors share them, so that all pairs are verified. ``block`` rows of a list are compared with ``block`` others at a time.
    """

    pivots: int = 256
    sample: int = 1024
    apart: float = 0.7
    nearest: int = 8
    shared: int = 3
    block: int = 1024
    cosine: float = 0.9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; they are scaled first, as squares of very large or small components leave the range."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(vector: np.ndarray | None) -> bool:
    if vector is None or len(vector) == 0:
        return False
    v = np.asarray(vector, dtype=np.float64)
    return bool(np.isfinite(v).all() and v.any())


def reference_points(vectors: DataFrame, config: PivotConfig) -> dict[int, np.ndarray]:
    """By dimension at most ``pivots`` unit vectors, in the order of their hashes those that are apart from all before."""
    dimensions = [r[0] for r in vectors.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = {}
    for n in dimensions:
        sample = vectors.where(F.size("v") == n).select("v").orderBy(F.xxhash64("v"), "v").limit(config.sample)
        chosen = np.zeros((0, n))
        for v in unit(np.array([r["v"] for r in sample.collect()], dtype=np.float64)):
            if len(chosen) < config.pivots and (chosen @ v < config.apart).all():
                chosen = np.vstack([chosen, v])
        found[n] = chosen
    return found


def permutations(units: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Numbers of the nearest reference points, nearest first."""
    order = np.argsort(-(units @ pivots.T), axis=1, kind="stable")
    return order[:, :nearest]


def _membership(lists: np.ndarray, pivots: int) -> np.ndarray:
    member = np.zeros((len(lists), pivots), dtype=np.float32)
    np.put_along_axis(member, lists, 1, axis=1)
    return member


def compared(left: pd.DataFrame, right: pd.DataFrame, same: bool, pivot: int, config: PivotConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between two blocks of the list of ``pivot``: numbers of links on each side, and links enough to connect them.

    A pair is counted in the list of the first reference point that both share, so once overall.
    """
    a, b = (unit(np.vstack(x["v"].to_list()).astype(np.float64)) for x in (left, right))
    lists = [np.vstack(x["lists"].to_list()) for x in (left, right)]
    size = max(int(x.max()) for x in lists) + 1
    m, n = (_membership(x, size) for x in lists)
    shared = min(config.shared, *(x.shape[1] for x in lists))
    link = (m @ n.T >= shared) & (m[:, :pivot] @ n[:, :pivot].T == 0)
    link &= a @ b.T >= config.cosine
    if same:
        link &= np.triu(np.ones_like(link), 1)
    weights_a, weights_b = left["copies"].to_numpy(), right["copies"].to_numpy()
    of_left = link @ weights_b
    of_right = link.T @ weights_a
    # each row of a connected stretch hangs on its first partner, and rows of one partner on each other through it
    rows, first = np.flatnonzero(link.any(axis=1)), link.argmax(axis=1)
    columns, first_back = np.flatnonzero(link.any(axis=0)), link.argmax(axis=0)
    x, y = left["id"].to_numpy(), right["id"].to_numpy()
    edges = np.concatenate([np.stack([x[rows], y[first[rows]]], 1), np.stack([x[first_back[columns]], y[columns]], 1)])
    return of_left, of_right, _forest(link, x, y, edges)


def _forest(link: np.ndarray, x: np.ndarray, y: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Few links that connect all that ``link`` connects: a spanning forest of the block."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for p, q in edges.tolist():
        if root(p) != root(q):
            parent[root(p)] = root(q)
            kept.append((p, q))
    # what is still apart though linked: compare roots over all links
    roots_x = np.array([root(i) for i in x.tolist()])
    roots_y = np.array([root(i) for i in y.tolist()])
    for i, j in np.argwhere(link & (roots_x[:, None] != roots_y[None, :])):
        p, q = int(x[i]), int(y[j])
        if root(p) != root(q):
            parent[root(p)] = root(q)
            kept.append((p, q))
    return np.array(kept, dtype=np.int64).reshape(-1, 2)


def linked_vectors(embeddings: DataFrame, config: PivotConfig = PivotConfig()) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding).

    ``n_links`` counts other vectors at a cosine of ``config.cosine`` or more that the index retrieves,
    ``component_id`` is the smallest vec_id that links lead to. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Equal vectors are one entry of the index with a number of copies,
    all linked with each other. Vectors of different dimensions are never compared. Rows without a vec_id are
    returned with a null component, kept, and without links. Different vectors of a repeated vec_id are entries of
    their own, whose links are counted together. An empty table gives no rows.

    A list is cut into blocks, and pairs of blocks are shared out, so a list of any length needs no more
    memory than two blocks. Only counts and the links of a spanning forest leave a pair of blocks.
    """
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ) & F.exists("v", lambda x: x != 0)
    good = rows.where(F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull())
    # 0.0 in place of -0.0, so that equal vectors are equal bits
    good = good.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    entries = stored(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "entries")
    pivots = reference_points(entries, config)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, part in batch.groupby(batch["v"].map(len)):
                order = permutations(unit(np.vstack(part["v"].to_list())), pivots[n], config.nearest)
                yield part.assign(dimension=n, lists=list(order.astype(np.int32)))

    schema = "v array<double>, id long, copies long, dimension int, lists array<int>"
    indexed = stored(entries.mapInPandas(index, schema), "pivot-index")
    entry = F.struct("id", "copies", "v", "lists")
    posted = indexed.select("dimension", F.explode("lists").alias("pivot"), entry.alias("entry"))
    sizes = {(r["dimension"], r["pivot"]): r["n"] for r in posted.groupBy("dimension", "pivot").agg(F.count("*").alias("n")).collect()}
    blocks = F.create_map(*[x for (d, p), n in sizes.items() for x in (F.lit(f"{d}/{p}"), F.lit(-(-n // config.block)))]) if sizes else None
    if blocks is None:
        pairs = None
    else:
        count = blocks[F.concat_ws("/", "dimension", "pivot")]
        own = F.pmod(F.xxhash64("entry.id"), count)
        # a block meets every other one once: its entries go to the pairs (own, other) in either order
        partners = F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))
        pairs = (
            posted.withColumn("own", own).withColumn("other", partners)
            .select("dimension", "pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "entry.*")
        )

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, pivot, i, j = key
        left = group[group["own"] == i].reset_index(drop=True)
        right = left if i == j else group[group["own"] == j].reset_index(drop=True)
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []})
        of_left, of_right, edges = compared(left, right, i == j, int(pivot), config)
        counts = pd.concat([pd.DataFrame({"a": left["id"], "n": of_left}), pd.DataFrame({"a": right["id"], "n": of_right})])
        counts = counts[counts["n"] > 0].assign(b=None)
        return pd.concat([counts, pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1], "n": 0})])[["a", "b", "n"]]

    if pairs is None:
        found = entries.sparkSession.createDataFrame([], "a long, b long, n long")
    else:
        found = stored(pairs.groupBy("dimension", "pivot", "i", "j").applyInPandas(compare, "a long, b long, n long"), "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    placed = components(found.where("b is not null").select("a", "b"), "vector-components")
    result = stored(
        entries.join(counts, entries["id"] == counts["a"], "left").drop("a")
        .join(placed.withColumnRenamed("id", "p"), F.col("id") == F.col("p"), "left")
        .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")),
        "linked-entries",
    )
    found = good.join(result, "v").select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where(~(F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull())).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
