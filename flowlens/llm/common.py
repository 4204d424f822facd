"""What the operators share: the scratch folder, row ids and narrow tables."""
from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import checkpoint_dir

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Rows of an Arrow batch, at most: texts are long, and two workers share an executor.
BATCH_ROWS = 1_000
#: Bytes of an Arrow batch, about: the JVM and the worker hold one each.
BATCH_BYTES = 8 << 20


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started,
    and get their rows in batches of a size that suits whole texts."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if REPO not in paths:
        env["PYTHONPATH"] = os.pathsep.join([REPO, *paths])


#: What a worker remembers from task to task: its owner, and how to forget it.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembers(owner: str, forget: Callable[[], None]) -> None:
    _REMEMBERED[owner] = forget


def forget_others(owner: str) -> None:
    """Drop what the tasks of other owners left in this worker."""
    for name, forget in _REMEMBERED.items():
        if name != owner:
            forget()


def lean(run: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """``run`` for a worker that begins without what other operators remember and
    gives freed memory back when a task ends: workers are used again, and what
    they keep adds up beside the executor's own heap."""
    def wrapped(batches: Iterator) -> Iterator:
        forget_others(owner)
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: list[str] | None = None, block_mb: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut and the
    rows survive a lost executor.  ``block_mb``: size of a row group, which a
    writer holds in memory (whole texts)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    out = df.write
    if by:
        out = out.partitionBy(*by)
    if block_mb:
        out = out.option("parquet.block.size", block_mb << 20)
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id as text (unsigned)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


#: Ids that a broadcast may hold; beyond that the join is a shuffle.
BROADCAST_IDS = 500_000


def free(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores after those that ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def by_id(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id", text_hash: str | None = None) -> DataFrame:
    """``docs`` semi- or anti-joined with written, distinct ids (null is an id),
    and with ``text_hash``, a column of ``ids``, by xxhash64 of the text too.

    Few ids are broadcast and the documents stay where they are; the size is
    counted first, and beyond the bound both sides are shuffled.
    """
    id_, hash_ = free(docs, "id_", "hash_")
    right = ids.select(F.col(key).alias(id_), *([F.col(text_hash).alias(hash_)] if text_hash else []))
    if right.count() <= BROADCAST_IDS:
        right = F.broadcast(right)
    same = docs[key].eqNullSafe(F.col(id_))
    if text_hash:
        same &= F.xxhash64(docs["text"]) == F.col(hash_)
    return docs.join(right, same, how)
