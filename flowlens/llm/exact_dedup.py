"""Exact dedup with a minimal perfect hash over historical distinct digests.

The index is a table of buckets (a digest's leading bits).  A bucket holds a
minimal perfect hash as levels of bits: a key takes the first level on which
no other key shares its bit, and the rank of the bit is its slot.  Slots hold
the full digest and the locator of the winning row (code points, id, number
of rows).  A lookup compares all 32 bytes of the digest in the slot, so
digests that are not in the history never match by chance; they are grouped
separately.

Texts are equal when identical after deleting space, tab, LF, VT, FF and CR;
null counts as empty.  Of equal texts the row with the most code points stays,
then the smallest id (a null id counts as the largest).  Rows that repeat an
id and its text are one document and are kept alike.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import reach_workers, written

WHITE = " \t\n\x0b\x0c\r"
#: Digests in a bucket, on average: the size of one task's work.
BUCKET_KEYS = 50_000
#: Bits of a level for each key that is left.
GAMMA = 2.0

_INDEX = "bucket int, sizes binary, bits binary, digests binary, ids binary, no_id binary, cps binary, counts binary"
_RESULT = "digest binary, keep_id long, cp long, n long, known boolean"


def digest(text: Column) -> Column:
    """32 bytes: SHA-256 of the text without white space, in UTF-8."""
    bare = F.translate(F.coalesce(text, F.lit("")), WHITE, "")
    return F.unhex(F.sha2(bare.cast("binary"), 256))


# --- the perfect hash of one bucket -----------------------------------------

def _words(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of each 32-byte digest (rows of uint8)."""
    w = np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)
    return w[:, 1], w[:, 2] | np.uint64(1)


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a + b * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_mph(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(level sizes, bits of all levels) for distinct rows of 32 bytes."""
    a, b = _words(digests)
    sizes, bits, level = [], [], 0
    while len(a):
        size = max(8, math.ceil(GAMMA * len(a)))
        at = _place(a, b, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = ~alone[at]
        a, b, level = a[left], b[left], level + 1
    return np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool)


def mph_slots(digests: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where every level says no."""
    a, b = _words(digests)
    rank = np.cumsum(bits) - 1
    slots = np.full(len(a), -1, np.int64)
    open_ = np.arange(len(a))
    base = 0
    for level, size in enumerate(sizes.tolist()):
        if not len(open_):
            break
        at = base + _place(a[open_], b[open_], level, size)
        hit = bits[at]
        slots[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + size
    return slots


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8).reshape(-1, 32)


def _build_bucket(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    rows = _matrix(pdf["digest"])
    sizes, bits = build_mph(rows)
    slot = mph_slots(rows, sizes, bits)
    order = np.argsort(slot)
    absent = pdf["doc_id"].isna().to_numpy()[order]
    return pd.DataFrame([{
        "bucket": key[0], "sizes": sizes.tobytes(), "bits": np.packbits(bits).tobytes(),
        "digests": rows[order].tobytes(),
        "ids": pdf["doc_id"].fillna(0).to_numpy(np.int64)[order].tobytes(), "no_id": absent.tobytes(),
        "cps": pdf["cp"].to_numpy(np.int64)[order].tobytes(),
        "counts": pdf["n"].to_numpy(np.int64)[order].tobytes()}])


def _look_up(key: tuple, index: pd.DataFrame, incoming: pd.DataFrame) -> pd.DataFrame:
    """All digests of a bucket: history merged with incoming, and those unknown."""
    if len(index):
        r = index.iloc[0]
        sizes = np.frombuffer(r["sizes"], np.int64)
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
        held = np.frombuffer(r["digests"], np.uint8).reshape(-1, 32)
        ids, cps = np.frombuffer(r["ids"], np.int64).copy(), np.frombuffer(r["cps"], np.int64).copy()
        gone, n = np.frombuffer(r["no_id"], bool).copy(), np.frombuffer(r["counts"], np.int64).copy()
    else:
        sizes, bits = np.zeros(0, np.int64), np.zeros(0, bool)
        held, gone = np.zeros((0, 32), np.uint8), np.zeros(0, bool)
        ids, cps, n = (np.zeros(0, np.int64) for _ in range(3))
    rows = _matrix(incoming["digest"]) if len(incoming) else np.zeros((0, 32), np.uint8)
    slot = mph_slots(rows, sizes, bits)
    known = slot >= 0
    known[known] = (held[slot[known]] == rows[known]).all(axis=1)
    new_gone = incoming["doc_id"].isna().to_numpy(bool)
    new_ids = incoming["doc_id"].fillna(0).to_numpy(np.int64)
    new_cp, new_n = incoming["cp"].to_numpy(np.int64), incoming["n"].to_numpy(np.int64)
    s = slot[known]  # distinct: incoming digests are distinct
    better = (new_cp[known] > cps[s]) | ((new_cp[known] == cps[s]) & (
        (gone[s] & ~new_gone[known]) | ((gone[s] == new_gone[known]) & (new_ids[known] < ids[s]))))
    n[s] += new_n[known]
    ids[s] = np.where(better, new_ids[known], ids[s])
    gone[s] = np.where(better, new_gone[known], gone[s])
    cps[s] = np.maximum(new_cp[known], cps[s])
    out_ids = pd.array(np.concatenate([ids, new_ids[~known]]), dtype="Int64")
    out_ids[np.concatenate([gone, new_gone[~known]]).astype(bool)] = pd.NA
    return pd.DataFrame({
        "digest": [x.tobytes() for x in held] + [x.tobytes() for x in rows[~known]],
        "keep_id": out_ids, "cp": np.concatenate([cps, new_cp[~known]]),
        "n": np.concatenate([n, new_n[~known]]),
        "known": np.concatenate([np.ones(len(held), bool), np.zeros(int((~known).sum()), bool)])})


# --- the operator ---------------------------------------------------------------

def digested(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, digest, cp (code points of the original text) of every row."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), digest(F.col(text)).alias("digest"),
                       F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("cp"))


def _per_digest(rows: DataFrame) -> DataFrame:
    """The winner of each digest; combined before the shuffle, so a digest that
    holds a third of all rows sends one row a task."""
    best = F.min(F.struct((-F.col("cp")).alias("c"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("d")))
    return (rows.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("n"))
            .select("digest", F.col("b.d").alias("doc_id"), (-F.col("b.c")).alias("cp"), "n"))


def _buckets(n: int) -> int:
    return max(1, math.ceil(n / BUCKET_KEYS))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int").alias("bucket")


def build_index(rows: DataFrame, buckets: int) -> DataFrame:
    """The index over ``digested`` rows, written to the shared folder."""
    reach_workers(rows.sparkSession)
    per = _per_digest(rows).select(_bucket(buckets), "*")
    return written(per.groupBy("bucket").applyInPandas(_build_bucket, _INDEX), "mph")


def look_up(index: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """digest, keep_id, cp, n, known for every digest of the index or of ``rows``."""
    per = _per_digest(rows).select(_bucket(buckets), "*")
    return index.groupBy("bucket").cogroup(per.groupBy("bucket")).applyInPandas(_look_up, _RESULT)


def exact_dedup(rows: DataFrame, is_history: Column) -> DataFrame:
    """``digested`` rows with keep_id, group_size, kept, known.

    ``is_history`` says which rows the index is built over; the others are
    looked up in it.  The result does not depend on the split.
    """
    rows = written(rows.withColumn("history", F.coalesce(is_history, F.lit(False))), "digests")
    buckets = _buckets(rows.count())  # distinct digests of either side are at most that many
    index = build_index(rows.where("history"), buckets)
    winners = look_up(index, rows.where("NOT history"), buckets).select(
        "digest", "keep_id", F.col("n").alias("group_size"), "known")
    return (rows.join(winners, "digest")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))

