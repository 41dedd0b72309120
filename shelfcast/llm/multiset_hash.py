"""Homomorphic multiset hash of documents: wide vectors hashed from paragraphs, added up modulo powers of two.

A paragraph is a line. Its vector has ``EXACT`` lanes of 32 bits from a cryptographic hash of the line, and
``LIKENESS`` lanes from its word pairs: each pair adds one hashed bit to every lane. Lanes are added modulo
2**32, so the fingerprint of a text does not depend on the order of its paragraphs, and the fingerprint of a
changed text follows from the old one by adding or taking away the vectors of the changed paragraphs.

Everything here is DataFrame operations; the sums are ordinary aggregates, combined before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stored

EXACT, LIKENESS = 8, 64
#: Consecutive doc_ids share a group of at most 2**GROUP_BITS different ids.
GROUP_BITS = 10
#: So many rows of integers are sorted by one task.
ONE_WINDOW = 100_000
_LANE = 0xFFFFFFFF
_SUMS = [f"exact_{i}" for i in range(EXACT)] + [f"pair_{i}" for i in range(LIKENESS)] + ["pairs"]


def _paragraph_rows(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, is_line, hex, bits) for each paragraph and each word pair of each text."""
    lines = texts.select(*keys, F.explode(F.split("text", "\n", -1)).alias("line"))
    words = F.filter(F.split("line", r"[\x09-\x0d ]+"), lambda w: w != "")
    pairs = F.when(
        F.size("words") > 1,
        F.transform(
            F.arrays_zip(F.slice("words", 1, F.size("words") - 1).alias("a"), F.slice("words", 2, F.size("words") - 1).alias("b")),
            lambda x: F.xxhash64(x["a"], x["b"]),
        ),
    ).otherwise(F.transform("words", lambda w: F.xxhash64(w)))
    rows = lines.withColumn("words", words).select(*keys, F.sha2("line", 256).alias("hex"), pairs.alias("bits"))
    return rows.select(*keys, "hex", F.explode_outer(F.concat(F.array(F.lit(None).cast("long")), "bits")).alias("bits"))


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of lane sums per key. A row without bits is the paragraph itself."""
    is_line = F.col("bits").isNull()
    exact = [
        F.sum(F.when(is_line, F.conv(F.substring("hex", 8 * i + 1, 8), 16, 10).cast("long")).otherwise(0)).alias(f"exact_{i}")
        for i in range(EXACT)
    ]
    # two lanes share a sum: bit i and bit i + 32 of a pair, which never carry into each other below 2**31 pairs
    halves = [
        F.sum(F.shiftright(F.coalesce("bits", F.lit(0)), i).bitwiseAND(F.lit(0x0000000100000001))).alias(f"half_{i}")
        for i in range(LIKENESS // 2)
    ]
    summed = rows.groupBy(*keys).agg(*exact, *halves, F.count("bits").alias("pairs"))
    return summed.select(
        *keys,
        *[F.col(f"exact_{i}").bitwiseAND(F.lit(_LANE)).alias(f"exact_{i}") for i in range(EXACT)],
        *[F.col(f"half_{i}").bitwiseAND(F.lit(_LANE)).alias(f"pair_{i}") for i in range(LIKENESS // 2)],
        *[F.shiftrightunsigned(f"half_{i}", 32).alias(f"pair_{i + LIKENESS // 2}") for i in range(LIKENESS // 2)],
        F.col("pairs").bitwiseAND(F.lit(_LANE)).alias("pairs"),
    )


def fingerprint_lanes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, lanes): the fingerprint of each key's ``text`` as an array of 32-bit values.

    A null text counts as empty; an empty text has one empty paragraph. Rows of the same keys are added up.
    """
    filled = texts.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    return _summed(_paragraph_rows(filled, keys), keys).select(*keys, F.array(*_SUMS).alias("lanes"))


def added(lanes: Column, others: Column) -> Column:
    """The fingerprint after the paragraphs behind ``others`` were inserted."""
    return F.zip_with(lanes, others, lambda a, b: (a + b).bitwiseAND(F.lit(_LANE)))


def removed(lanes: Column, others: Column) -> Column:
    """The fingerprint after the paragraphs behind ``others`` were deleted."""
    return F.zip_with(lanes, others, lambda a, b: (a - b).bitwiseAND(F.lit(_LANE)))


def written(lanes: Column) -> Column:
    """The fingerprint as hexadecimal text, eight digits a lane."""
    return F.concat_ws("", F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")))


def likeness(lanes: Column, others: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the cosine of the signed word-pair counts, at least 0.

    Each likeness lane counts the pairs whose bit is set; twice that less all pairs is a sum of random signs, and
    the product of two such sums is, on average over lanes, the number of common pairs.
    """
    def signed(x: Column) -> Column:
        total = F.element_at(x, -1)
        return F.transform(F.slice(x, EXACT + 1, LIKENESS), lambda v: (v * 2 - total).cast("double"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)

    a, b = signed(lanes), signed(others)
    size = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(size > 0, dot(a, b) / size).otherwise(0.0)
    return F.when(lanes == others, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def _previous(keys: DataFrame) -> DataFrame:
    """Rows (k, previous) of distinct integers: the next smaller one, null for the smallest.

    Up to ``ONE_WINDOW`` rows are sorted at once; more are sorted within blocks of 2**``GROUP_BITS`` values, whose
    last rows are found by the same step over the blocks.
    """
    if keys.limit(ONE_WINDOW + 1).count() <= ONE_WINDOW:
        return keys.select("k", F.lag("k").over(Window.orderBy("k")).alias("previous"))
    blocked = keys.withColumn("block", F.shiftright("k", GROUP_BITS))
    lasts = blocked.groupBy("block").agg(F.max("k").alias("last"))
    before = _previous(lasts.select(F.col("block").alias("k"))).join(
        lasts.withColumnRenamed("block", "previous"), "previous"
    )
    within = F.lag("k").over(Window.partitionBy("block").orderBy("k"))
    return (
        blocked.withColumn("within", within)
        .join(before.select(F.col("k").alias("block"), "last"), "block", "left")
        .select("k", F.coalesce("within", "last").alias("previous"))
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (group, place, doc_id, text, next_text, is_copy): each document and the one after it by ascending doc_id.

    Null ids come first, equal ids follow each other by their text, and after the last comes the first; a
    single document is followed by itself. Ids fall into groups of neighbours by their value, and each group
    gets a copy of the next group's first document (``is_copy``): a sort within groups is then enough, and only
    first documents are moved between groups.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "group", F.shiftright(F.coalesce("doc_id", F.lit(-(1 << 62))), GROUP_BITS)
    )
    first = own.groupBy("group").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    order = stored(_previous(own.select(F.col("group").alias("k")).distinct()), "groups")
    last = order.agg(F.max("k")).first()[0]
    copies = first.join(order, first["group"] == order["k"]).select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("text"),
        F.coalesce("previous", F.lit(last).cast("long")).alias("group"), F.lit(True).alias("is_copy"),
    )
    rows = own.withColumn("is_copy", F.lit(False)).unionByName(copies)
    order = Window.partitionBy("group").orderBy("is_copy", "doc_id", "text")
    return rows.select(
        "group", F.row_number().over(order).alias("place"), "doc_id", "text", "is_copy",
        F.lead("text").over(order).alias("next_text"),
    )


def fingerprint_documents(docs: DataFrame, edit: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, lanes, edited_lanes, next_lanes) for every row of ``docs``.

    ``edit`` makes the edited text of a text and the next document's. Texts are shuffled once, by groups of
    neighbouring ids; paragraphs, sums and the step to the next row all stay within those partitions.
    """
    keys = ["group", "place", "doc_id", "n_chars", "edited_sha256", "is_copy"]
    placed = with_next(docs).withColumn("edited", F.coalesce(edit(F.col("text"), F.col("next_text")), F.lit("")))
    both = placed.select(
        "group", "place", "doc_id", F.length("text").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "is_copy", F.posexplode(F.array("text", "edited")).alias("variant", "text"),
    )
    lanes = fingerprint_lanes(both.where("not is_copy or variant = 0"), [*keys, "variant"])
    order = Window.partitionBy("group").orderBy("place", "variant")
    return (
        lanes.select(*keys, "variant", "lanes", F.lead("lanes", 1).over(order).alias("one"), F.lead("lanes", 2).over(order).alias("two"))
        .where("variant = 0 and not is_copy")
        .select("doc_id", "n_chars", "edited_sha256", "lanes", F.col("one").alias("edited_lanes"), F.col("two").alias("next_lanes"))
    )


def last_quarter_replaced(text: Column, following: Column) -> Column:
    """The last floor(n / 4) code points replaced by the first as many (or all) of the next document."""
    n = F.length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(following, F.lit(1), k))
