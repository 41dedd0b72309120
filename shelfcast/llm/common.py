"""What several operators share: stored intermediate tables, batches of bounded size, components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from functools import reduce
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.saved import scratch_path

T = TypeVar("T")
#: Characters of text that one step inside a task handles at once.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a table into the shared scratch folder and read it: lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Record batches cut into slices of about ``most`` characters, with their texts (null: empty)."""
    for batch in batches:
        texts = [text or "" for text in batch.column(column).to_pylist()]
        start, chars = 0, 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= most:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, chars = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]


_resident: dict[object, object] = {}


def resident(key: object, make: Callable[[], T]) -> T:
    """What a worker process keeps from batch to batch, one thing at a time."""
    if key not in _resident:
        release()
        _resident[key] = make()
    return _resident[key]


def release() -> None:
    """Let go of it at the end of a task: idle workers of an earlier stage would hold it beside those of the next."""
    _resident.clear()
    gc.collect()  # an encoder and its parts refer to each other
    pa.default_memory_pool().release_unused()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Rows (id, component): for each id in ``edges`` (a, b) the smallest id that links lead to.

    Alternates two steps until nothing changes: each id's larger neighbours are tied to its smallest
    neighbour, then its smaller neighbours and itself are. Both only group and join links, the number of
    links never grows, and a chain of n links takes a logarithmic number of rounds. Each round ends in a
    stored table. An id with very many links is one group only for a minimum, which is combined before
    the shuffle; its rows are dealt by join, which adaptive execution can split.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    before = None
    while True:
        total = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total == before or not total[0]:
            break
        before = total
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        links = stored(
            large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(smallest.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct(),
            name,
        )
    roots = links.groupBy("a").agg(F.min("b").alias("component"))
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    return ids.join(roots, ids["id"] == roots["a"], "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
