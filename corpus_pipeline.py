"""A training corpus from documents: language, near duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``. All but the last return the columns
of the documents table (``n_chars`` follows the text); the last returns packed pieces.

Rows with nulls: a null text has no language and goes in the first stage. A null doc_id is a document of its
own. Extra columns pass through the first four stages. An empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import language_id, minmax_dedup, prefix_free, pseudonyms, slack_packing
from shelfcast.llm.common import stored, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: An example; whoever runs the pipeline sets a key of their own and keeps it secret.
KEY = b"pseudonyms of the corpus pipeline"
#: A language must be likelier than all others together.
LEAST_SCORE = 0.5


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def _free_name(docs: DataFrame, name: str) -> str:
    """A column name that nothing in ``docs`` begins with."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the labels of ``docs`` know; texts without letters or clear language go."""
    model = language_id.fit(docs, PIECES)
    key = _free_name(docs, "judged")
    judged = language_id.identify(docs, model, key)
    clear = (F.col(f"{key}_pred") != language_id.NOTHING) & (F.col(f"{key}_score") >= LEAST_SCORE)
    return judged.where(clear).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id, and one of equal rows.

    Rows without a doc_id, and unlike texts of one doc_id, are documents of their own: they are compared and kept by
    a hash of doc_id and text.
    """
    key, text = _free_name(docs, "row"), F.xxhash64("text")
    unlike = docs.groupBy("doc_id").agg(F.min(text).alias("least"), F.max(text).alias("most")).where("doc_id is not null and least <> most")
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))  # above the numbers of documents
    marked = docs.join(unlike.select("doc_id", F.lit(True).alias(f"{key}_unlike")), "doc_id", "left")
    whole = F.col("doc_id").isNotNull() & F.col(f"{key}_unlike").isNull()
    keyed = marked.withColumn(key, F.when(whole, F.col("doc_id").cast("long")).otherwise(own))
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    found = minmax_dedup.near_duplicates(rows, minmax_dedup.MinMaxConfig(words=5, percent=80))
    kept = found.where("kept").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of more than 50 words, or strings of 400 bytes (text without spaces), that start twice.

    A character that a cut divides goes too.
    """
    found = prefix_free.remove_repeats(docs, match=400, as_text=True, words=51)
    cut = found.select("rest.*", F.col("kept").alias("text"))
    return _measured(cut.select(*[F.col(f"`{c}`") for c in docs.columns]))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return _measured(pseudonyms.pseudonymize(docs, KEY))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids, sequence_id, offset) of sequences of 1024 tokens."""
    return slack_packing.pack(docs, TOKENIZER, capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Segmentations, components, byte strings and packing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
