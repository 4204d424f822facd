"""Sharding by jump consistent hashing (law ``key``), native columns only.

A row's shard depends on its key and the number of shards alone, there is no
ring table, and one more shard takes rows only into itself: 1/(n+1) of them.

Cases: a null key hashes as 0; a null or empty text has size 1 and crc32 0;
rows with one key share a shard and get slots of their own; an empty table
gives an empty result.  Columns of the input besides the key and the text are
not read, so names cannot clash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm.common import written

# Fixed values of the published jump hash.
MULTIPLIER = "2862933555777941757"
WORD = "18446744073709551616"  # 2^64
HIGH = "8589934592"  # 2^33
SPAN = 2147483648.0  # 2^31


def _jump_state(key: Column, n: int) -> Column:
    """struct(b, j): the last jump below ``n`` and the first one not below it.

    The recurrence needs a 64-bit product that wraps; decimals hold it whole
    (below 2^126), so ANSI overflow checks stay on.
    """
    word = F.lit(WORD).cast("decimal(20,0)")
    unsigned = F.pmod(key.cast("decimal(38,0)"), word).cast("decimal(20,0)")
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), unsigned.alias("k"))

    def step(acc: Column, _: Column) -> Column:
        product = (acc["k"] * F.lit(MULTIPLIER).cast("decimal(19,0)")).cast("decimal(38,0)") + F.lit(1).cast("decimal(1,0)")
        k = F.pmod(product.cast("decimal(38,0)"), word).cast("decimal(20,0)")
        high = F.floor(k / F.lit(HIGH).cast("decimal(10,0)")).cast("long") + F.lit(1)
        nxt = F.floor((acc["j"] + 1).cast("double") * (F.lit(SPAN) / high.cast("double"))).cast("long")
        jumped = F.struct(acc["j"].alias("b"), nxt.alias("j"), k.alias("k"))
        return F.when(acc["j"] < n, jumped).otherwise(acc)

    # j rises by at least one each time, so n steps always reach the end.
    return F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, step)


def jump_shard(key: Column, n: int) -> Column:
    """Shard 0..n-1 of a bigint key."""
    return _jump_state(key, n)["b"].cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, size, text_crc32, law, shard, slot and
    grown_shard (the shard if there were one more).

    ``slot`` numbers the rows of a shard from 0 without gaps in the order of
    (key, text_crc32, size).  It is counted per range of keys and shard, and
    the ranges' offsets are added, so no task holds a whole shard.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    state = _jump_state(F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")), shards)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       (F.octet_length(body).cast("long") + 1).alias("size"),
                       F.crc32(body).alias("text_crc32"), state.alias("s"))
    rows = rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"),
                       F.col("s.b").cast("int").alias("shard"),
                       # the same walk with one more shard ends a jump later only if it lands on it
                       F.when(F.col("s.j") == shards, F.lit(shards)).otherwise(F.col("s.b")).cast("int").alias("grown_shard"))
    order = ["doc_id", "text_crc32", "size"]
    ranged = rows.repartitionByRange(*order).withColumn("piece", F.spark_partition_id())
    rows = written(ranged, "shards")  # range bounds are sampled: keep one outcome
    counts = rows.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "piece").orderBy(*order)
    return (rows.withColumn("at", F.row_number().over(within) - 1)
            .join(offsets, ["shard", "piece"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("start") + F.col("at")).cast("long").alias("slot"), "grown_shard"))
