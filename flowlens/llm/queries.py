"""The registered queries of this subpackage and their DuckDB statements."""
from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (alignment, byte_bpe, decontaminate, exact_dedup, html_template, kneser_ney, language_id, minhash, packing, prefix_trie,
                          sharding, suffix_dedup, token_store)
from flowlens.llm.common import id_crc, reach_workers, table

#: Where the public vocabularies are; a parameter of the queries that read one.
TOKENIZERS = os.path.dirname(public_tokenizers.path("any"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_crc() % 4 == 2, F.lit(False))
    model = language_id.train(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index holds the digests of the documents whose id has an even crc32;
    the others arrive later and are looked up."""
    rows = exact_dedup.digested(table(spark, sf_dir, "documents"))
    out = exact_dedup.exact_dedup(rows, id_crc() % 2 == 0)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(id_crc() % 7 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    return kneser_ney.train_and_score(docs, ~F.col("held_out"), order=3)


def op5_simple8b_tokens(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    folder = token_store.token_folder(spark)
    manifest = token_store.write_tokens(table(spark, sf_dir, "documents"), folder,
                                        f"{tokenizers}/byte_bpe_50k.json", end_id=0, special=True)
    return token_store.read_tokens(manifest, folder)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_main_text(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return out.drop("tid")


def op9_byte_bpe(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    ranks = f"{tokenizers}/byte_bpe_multi_50k.tiktoken"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = byte_bpe.encode_documents(docs, ranks, byte_bpe.PATTERN).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), byte_bpe.ids_sha256().alias("ids_sha256"))
    return byte_bpe.decode_documents(ids, ranks, byte_bpe.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=16)


#: SHA-256 of no id at all.
NO_ENDS = hashlib.sha256(b"").hexdigest()


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    path = public_tokenizers.path
    out, _ = alignment.align_tokenizers(table(spark, sf_dir, "documents"), a or path("byte_bpe_50k.json"), b or path("piece_bpe_32k.model"))
    return out


def op13_best_fit(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"),
                                  capacity=4096, end_id=1)


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id ASC NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY cp DESC, doc_id ASC NULLS LAST) AS kept,
       text_sha256
FROM d
"""

OP10_SQL = """
WITH RECURSIVE
tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
d AS (
  SELECT doc_id, coalesce(doc_id, 0) AS key, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (
  SELECT doc_id, key, CAST(length(h) // 2 + 1 AS BIGINT) AS size,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(range(length(h) // 2), lambda i: CAST(('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT))),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d, tab),
walk AS (
  SELECT DISTINCT key, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j,
         (CAST(key AS HUGEINT) + 18446744073709551616::HUGEINT) % 18446744073709551616::HUGEINT AS k FROM c
  UNION ALL
  SELECT key, j, CAST(floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE
              / (nk // 8589934592::HUGEINT + 1)::DOUBLE)) AS BIGINT), nk
  FROM (SELECT key, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS nk
        FROM walk WHERE j < 16)),
done AS (SELECT key, b, j FROM walk WHERE j >= 16)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(b AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY b ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(CASE WHEN j = 16 THEN 16 ELSE b END AS INTEGER) AS grown_shard
FROM c JOIN done USING (key)
"""

OP11_SQL = """
WITH tab AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), tab),
heads AS (SELECT conv_id AS base, count(*) AS n FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT i.conv_id, place AS depth, role, text FROM ids i JOIN turns t ON t.conv_id = i.base AND place <= h
  UNION ALL
  SELECT i.conv_id, place - h + least(h, coalesce(n, 0)), role, text
  FROM turns t JOIN ids i ON t.conv_id = i.conv_id LEFT JOIN heads b ON b.base = i.base WHERE place > h),
whole AS (
  SELECT i.conv_id, coalesce(list({'r': role, 't': text} ORDER BY depth) FILTER (depth IS NOT NULL), []) AS s
  FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY i.conv_id),
prefix AS (SELECT conv_id, s[1:d] AS k, d, d = len(s) AS done FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM whole)),
node AS (
  SELECT k, max(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(length(max(k)[-1].t), 0) AS own,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (done), '')) AS ends_sha256
  FROM prefix GROUP BY k),
child AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
sub AS (
  SELECT x.k[1:d] AS k, sum(own) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT n.k, own, n_children, unnest(range(depth + 1)) AS d FROM node n LEFT JOIN child c ON c.k = n.k) x GROUP BY 1)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN sub s ON s.k = n.k LEFT JOIN child c ON c.k = n.k
LEFT JOIN node p ON n.depth > 0 AND p.k = n.k[1:n.depth - 1]
"""

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_minhash": op2_minhash,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_simple8b_tokens": op5_simple8b_tokens,
    "op6_decontaminate": op6_decontaminate,
    "op7_html_template": op7_html_template,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_jump_sharding": op10_jump_sharding,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_alignment": op12_alignment,
    "op13_best_fit": op13_best_fit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op10_jump_sharding": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
}


def _with_workers(f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return f(spark, sf_dir)
    run.__doc__ = f.__doc__
    return run


QUERIES = {name: _with_workers(f) for name, f in _QUERIES.items()}
