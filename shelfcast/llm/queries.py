"""The operators applied to the given tables with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import backtrack_bpe, binary_records, embedding_pivots, language_id, minmax_dedup, multiset_hash, nbest_pieces, path_templates, phrase_mining, prefix_free, pseudonyms, slack_packing, token_alignment
from shelfcast.llm.common import table
from shelfcast.sources.saved import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_embedding_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_pivots.linked_vectors(table(spark, sf_dir, "embeddings"))


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), minmax_dedup.MinMaxConfig(words=4))


#: The key of the registered queries; a user gives one of their own and keeps it secret.
QUERY_KEY = b"pseudonyms of the registered queries"


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, QUERY_KEY, spans="spans")


#: Rules that go before the path tree.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def op4_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's html carries the text of the document whose number ends its path; that document's labels are the page's."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    _, path = path_templates.host_and_path(F.col("url"))
    numbered = pages.select("page_id", F.regexp_extract(path, r"/(\d{1,18})(?:\.\w+)?/?$", 1).try_cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    labels = numbered.join(labels, "doc_id").select("page_id", "bad")
    return path_templates.filter_urls(pages, labels, URL_RULES)


def op5_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = slack_packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, capacity=1024, end_id=2)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op6_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory = scratch_path(spark, "records")
    binary_records.write_records(table(spark, sf_dir, "documents"), directory, BYTE_BPE, end_id=0)
    found = binary_records.read_records(spark, directory)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = multiset_hash.fingerprint_documents(docs, multiset_hash.last_quarter_replaced)
    return found.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        multiset_hash.written(F.col("lanes")).alias("fingerprint"),
        multiset_hash.written(F.col("edited_lanes")).alias("edited_fingerprint"),
        multiset_hash.likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        multiset_hash.likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )


def op8_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = nbest_pieces.encode(docs, PIECES, n=3)
    return found.select(
        "doc_id", (F.length("pieces.ids") / 4).cast("long").alias("n_pieces"), F.crc32("pieces.ids").alias("ids_crc32"),
        "pieces.score", "pieces.others", F.col("pieces.exact").alias("decoded_equal"),
    )


def op9_prefix_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes; the last two columns also tell of repeated passages of over 50 words, often shorter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = prefix_free.remove_repeats(docs, match=400, words=51, apart=True)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "rest.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
        F.size("passages").cast("long").alias("n_passages"), F.col("clean").alias("text_without_passages"),
    )


def held_out() -> Column:
    """Documents that the language model must not learn from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~held_out()), PIECES)
    found = language_id.identify(docs.drop("lang"), model, "lang")
    return found.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op11_vertical_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )


def op13_backtrack_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = backtrack_bpe.encode(docs, RANKS)
    return found.select(
        "doc_id", (F.length("tokens.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("tokens.ids", 256).alias("ids_sha256"), F.sha2("tokens.decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_pivots": op1_embedding_pivots,
    "op2_minmax_dedup": op2_minmax_dedup,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_path_templates": op4_path_templates,
    "op5_slack_packing": op5_slack_packing,
    "op6_binary_records": op6_binary_records,
    "op7_multiset_hash": op7_multiset_hash,
    "op8_nbest_pieces": op8_nbest_pieces,
    "op9_prefix_free": op9_prefix_free,
    "op10_language_id": op10_language_id,
    "op11_vertical_phrases": op11_vertical_phrases,
    "op12_lockstep_alignment": op12_lockstep_alignment,
    "op13_backtrack_bpe": op13_backtrack_bpe,
}
#: Phrases are lists of words here; every count is taken from one table of all phrases up to five words.
_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
counted AS (
  SELECT lang, w[i:i + m - 1] AS p, count(*) AS a
  FROM places, range(1, 6) AS sizes(m) WHERE i + m - 1 <= len(w) GROUP BY ALL
),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counted WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE len(p) > 1 AND a >= 100),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN counted y ON y.lang = c.lang AND y.p = c.p[k + 1:]
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT b.lang, b.p[i:i + m - 1] AS p, b.a AS longer
  FROM candidates b, range(2, 5) AS sizes(m), range(1, 5) AS starts(i) WHERE m < len(b.p) AND i + m - 1 <= len(b.p)
),
open_ones AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM lowest c
  WHERE NOT EXISTS (SELECT 1 FROM inside d WHERE d.lang = c.lang AND d.p = c.p AND 100 * d.longer >= 100 * c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM open_ones QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {"op11_vertical_phrases": _PHRASES_SQL}
