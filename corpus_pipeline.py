"""The corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns the columns of ``documents``.  Between stages the rows are
written as Parquet to the shared folder and read again.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import stages
from flowlens.llm.common import reach_workers, table, written

STAGES = [
    ("language_id", stages.language_stage),
    ("exact_dedup", stages.exact_dedup_stage),
    ("near_dedup", stages.near_dedup_stage),
    ("decontaminate", stages.decontaminate_stage),
    ("byte_bpe", stages.byte_bpe_stage),
]

#: Row groups of the stage tables: two writers hold one each beside the workers.
BLOCK_MB = 32

#: SQL cannot express the stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}", block_mb=BLOCK_MB)
    return docs
