"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import (
    bpe,
    compression_quality,
    licenses,
    line_dedup,
    near_dups,
    packing,
    prefix_trie,
    quality,
    suffixes,
    token_files,
    vector_codes,
    warc,
    winnowing,
)
from seriesmill.session import ship_package

# The tokenizer files, by what they are used for.
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def _decimals() -> list[bytes]:
    return [str(i).encode() for i in range(1 << 16)]


def _token_digests(ids: list[int], decoded: bytes) -> tuple[int, str, str]:
    spelled = b" ".join(map(_decimals().__getitem__, ids))
    return len(ids), hashlib.sha256(spelled).hexdigest(), hashlib.sha256(decoded).hexdigest()


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return bpe.with_decoded(
        ids,
        BYTE_RANKS,
        _token_digests,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "row.doc_id",
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licenses", " ").alias("licenses"),
        "unmatched",
    )


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents")).drop("tkey")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_JSON)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), BYTE_JSON)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def _cut(own: bytes, covered) -> tuple[int, int, int, str]:
    kept = suffixes.kept_bytes(own, covered)
    spans = int(covered[:1].sum()) + int((covered[1:] & ~covered[:-1]).sum())
    return len(own), len(own) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    cut = suffixes.without_repeats(table(spark, sf_dir, "documents"), _cut, schema, ["doc_id"])
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("row.doc_id", *quality.COUNTS, "base_failed", "kept", "log_perplexity")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        winnowing.spelled(F.col("chosen")).alias("fingerprint"),
        winnowing.spelled(F.col("edited_chosen")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "row.doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


def op11_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"))
    return compression_quality.scored(docs, model, ["doc_id"]).select(
        "row.doc_id", compression_quality.held_out("row.doc_id").alias("held_out"), "score", "predicted"
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebook = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    return coded.select(
        "vec_id",
        vector_codes.spelled("codes").alias("code"),
        "error",
        "label_error",
        F.lit(codebook.digest()).alias("codebooks_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_license_scan,
        op3_minhash_dedup,
        op4_packing,
        op5_token_files,
        op6_warc,
        op7_suffix_dedup,
        op8_quality,
        op9_winnowing,
        op10_line_dedup,
        op11_compression_quality,
        op12_vector_codes,
        op13_conversation_trie,
    )
}

# Nearest entries of all parts; equal distances go to the lower number.
_NEAR_SQL = """
near{n} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(x) AS x, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d FROM (
    SELECT vec_id, label, k.p, x, e,
      list_sum(list_transform(range(1, 5), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
    FROM parts k JOIN book{n} b ON k.p = b.p)
  GROUP BY vec_id, label, p)"""
# Entries as floored means; an unused one stays.
_BOOK_SQL = """
book{n} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{old} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT p, e, i, sum(x[i + 1]) AS s, count(*) AS n FROM near{old} CROSS JOIN range(4) t(i) GROUP BY p, e, i)
    GROUP BY p, e) m ON b.p = m.p AND b.e = m.e)"""

#: Vectors of 64 numbers with ids that do not repeat, as in the given tables.
_CODES_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * 4 + 1 : p * 4 + 4] AS x FROM kept CROSS JOIN range(16) t(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64),
{_NEAR_SQL.format(n=0)},
{_BOOK_SQL.format(n=1, old=0)},
{_NEAR_SQL.format(n=1)},
{_BOOK_SQL.format(n=2, old=1)},
{_NEAR_SQL.format(n=2)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error
  FROM near2 GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded CROSS JOIN digest"""

_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(c::VARCHAR) + 1),"
    " lambda i: ascii((c::VARCHAR)[i])::UBIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b),"
    " list_transform(range(8), lambda k: k::UBIGINT)), lambda r, k: CASE WHEN (r & 1) = 1"
    " THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)), 4294967295::UBIGINT)"
)

_TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    length(coalesce(text, '')) AS size,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT c, c - c % 100 AS t, CAST({_CRC32} % 6 AS BIGINT) AS h FROM turns),
given AS (SELECT c AS t, count(*) AS given FROM turns WHERE pos < 6 GROUP BY c),
rebuilt AS (
  SELECT v.c, w.pos AS d, w.k, w.size FROM convs v JOIN turns w ON w.c = v.t AND w.pos <= v.h
  UNION ALL
  SELECT v.c, least(v.h, coalesce(g.given, 0)) + w.pos - v.h, w.k, w.size
  FROM convs v JOIN turns w ON w.c = v.c AND w.pos > v.h LEFT JOIN given g ON g.t = v.t),
walks AS (
  SELECT c, 0 AS d, '' AS k, 0 AS size FROM convs
  UNION ALL
  SELECT c, d, string_agg(k, '') OVER (PARTITION BY c ORDER BY d), size FROM rebuilt),
nodes AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n, any_value(size) AS size FROM walks GROUP BY d, k),
members AS (SELECT w.c, w.d, n.conv_id AS node FROM walks w JOIN nodes n ON n.d = w.d AND n.k = w.k),
ends AS (
  SELECT m.d, m.node, sha256(string_agg(m.c::VARCHAR, ',' ORDER BY m.c)) AS ends_sha256
  FROM members m JOIN (SELECT c, max(d) AS d FROM walks GROUP BY c) l ON l.c = m.c AND l.d = m.d
  GROUP BY m.d, m.node),
family AS (
  SELECT n.*, m.node AS parent FROM nodes n LEFT JOIN members m ON m.c = n.conv_id AND m.d = n.d - 1),
children AS (SELECT d - 1 AS d, parent AS node, count(*) AS n FROM family WHERE d > 0 GROUP BY 1, 2),
sums AS (
  SELECT m.d, m.node, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((f.n - 1) * f.size) AS saved
  FROM family f LEFT JOIN children k ON k.d = f.d AND k.node = f.conv_id
    JOIN members m ON m.c = f.conv_id AND m.d <= f.d
  GROUP BY m.d, m.node)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, f.parent AS parent_conv_id, f.n AS n_convs,
  coalesce(k.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
  coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM family f JOIN sums s ON s.d = f.d AND s.node = f.conv_id
  LEFT JOIN children k ON k.d = f.d AND k.node = f.conv_id
  LEFT JOIN ends e ON e.d = f.d AND e.node = f.conv_id"""

ORACLE_SQL: dict[str, str] = {"op12_vector_codes": _CODES_SQL, "op13_conversation_trie": _TRIE_SQL}
