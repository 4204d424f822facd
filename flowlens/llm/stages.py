"""Stages of the corpus pipeline: each keeps or drops whole documents by one
operator and returns the columns it was given (the last one adds its own).

A document is a row; its doc_id names it.  Rows that repeat an id and its
text are one document, of which exact dedup keeps one row.  Rows that share
an id but not the text stay or go together in near-dedup.  Rows without an id
are documents of their own: near-dedup links them with nothing.
"""
from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import byte_bpe, decontaminate, exact_dedup, language_id, minhash
from flowlens.llm.common import by_id, free, id_crc, table, written

RANKS = path("byte_bpe_multi_50k.tiktoken")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; those of several languages stay, however
    even their parts, and so do all where no row is labelled to learn from.

    Only the rejected rows leave the workers, as (id, hash of the text)."""
    model = language_id.train(docs, F.lit(True))
    if not model.languages:
        return docs
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    gone = language_id.predict(rows, model).where(F.col("lang_pred") == language_id.UND).select("doc_id", "h").distinct()
    return by_id(docs, written(gone, "no-language"), "left_anti", text_hash="h")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays (most code points, then the smallest id)."""
    rows = written(exact_dedup.exact_dedup(exact_dedup.digested(docs), id_crc() % 2 == 0), "winners")
    ids = written(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")), "ids")
    # ids of one row: the decision is the id's
    once = by_id(docs, written(ids.where("n > 1 OR NOT kept"), "not-plain"), "left_anti")
    # ids of several rows: the decision is the text's, and one row of it stays
    some = by_id(docs, written(ids.where("n > 1 AND kept"), "repeated"), "left_semi")
    digest, points, id_, won_digest, won_points = free(docs, "digest", "points", "id_", "won_digest", "won_points")
    some = some.withColumn(digest, exact_dedup.digest(F.col("text"))).withColumn(
        points, F.char_length(F.coalesce("text", F.lit(""))).cast("long"))
    won = rows.where("kept").select(F.col("doc_id").alias(id_), F.col("digest").alias(won_digest), F.col("cp").alias(won_points)).distinct()
    longest = won.groupBy(id_, won_digest).agg(F.max(won_points).alias(won_points))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(digest) == F.col(won_digest)) & (F.col(points) == F.col(won_points))
    again = some.join(longest, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)
    return once.unionByName(again)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the smallest id."""
    out = minhash.near_duplicates(docs, shingle=5, percent=80)
    gone = out.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept").select("doc_id")
    return by_id(docs, written(gone, "near"), "left_anti")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, ranks: str = RANKS) -> DataFrame:
    """Every document with token_ids, n_tokens and decoded_ok (the ids decode to
    its bytes); columns of these names that it had are replaced."""
    raw, = free(docs, "raw")
    out = byte_bpe.encode_documents(docs, ranks, byte_bpe.PATTERN, out="token_ids", decoded=raw)
    same = F.col(raw) == F.coalesce("text", F.lit("")).cast("binary")
    return out.withColumn("n_tokens", F.size("token_ids").cast("long")).withColumn("decoded_ok", same).drop(raw)
