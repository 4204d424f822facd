"""Best-fit-decreasing packing of tokenised documents into sequences.

Longer documents are cut into pieces of the capacity; pieces are placed from
the longest to the shortest, each into the open sequence that it leaves the
least room in.  A segment tree over the remaining capacities finds that
sequence in logarithmic time.  Pieces of one length are interchangeable and so
are sequences with one remaining capacity, so a leaf of the tree holds runs of
sequences and one query places a run of pieces: the plan of the whole corpus
follows from the number of pieces of each length (at most ``capacity`` rows),
and is the same as if all pieces had been placed one by one.

Spark encodes, cuts and numbers the pieces where the documents lie, and each
task looks its pieces up in the plan by (length, number within the length).  A
length that a third of all pieces share is numbered by task and offset, so it
is no group in one task.  Texts are not shuffled.

The plan's size: a length opens or splits off at most four runs, and a sequence
holds fewer than sqrt(2 * capacity) different lengths, so there are at most
4 * capacity * sqrt(2 * capacity) steps (1.5 million at 4096), whatever the
input; thousands are usual.

Cases: a null or empty text is its end id alone; a document of any length is
encoded part by part; repeated rows and ids are pieces of their own; a null id
is carried; an empty table gives no row.  Only the id and text columns are
read, so other names cannot clash.  Which of several equally long pieces goes
into which of several equal sequences is arbitrary but fixed once written.
"""
from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm import chunks
from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import reach_workers, written

#: Words that a worker remembers.
MEMO_WORDS = 2_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, at long"


# --- the plan -------------------------------------------------------------------

class CapacityTree:
    """Which remaining capacities 0..top have open sequences."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.open = bytearray(2 * self.size)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # capacity -> (first sequence, how many)

    def push(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.runs[room].append((first, n))
            i = room + self.size
            while i and not self.open[i]:
                self.open[i] = 1
                i >>= 1

    def pop(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        i = room + self.size
        if not self.runs[room]:
            self.open[i] = 0
            while i > 1 and not self.open[i ^ 1]:
                i >>= 1
                self.open[i] = 0
        return run

    def tightest(self, need: int) -> int:
        """The least open capacity of ``need`` or more, -1 if there is none."""
        i = need + self.size
        while not self.open[i]:
            while i & 1:  # a right child: its subtree ends where the parent's does
                i >>= 1
            if not i:
                return -1
            i += 1  # the neighbour to the right
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first piece, first sequence, pieces a sequence, offset), by
    length and first piece: piece ``first + i`` of a length goes into sequence
    ``sequence + i // each`` at ``offset + i % each * length``."""
    tree, steps, sequences = CapacityTree(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        done, total = 0, histogram[length]
        while done < total:
            room = tree.tightest(length)
            if room < 0:  # nothing fits: open what the rest needs
                room, each = capacity, capacity // length
                first, n = sequences, -(-(total - done) // each)
                sequences += n
            else:
                first, n = tree.pop(room)
                each = room // length
            whole = min(n, (total - done) // each)
            if whole:
                steps.append((length, done, first, each, capacity - room))
                tree.push(room - each * length, first, whole)
                done += whole * each
            if whole < n:
                rest = total - done  # fewer than ``each``
                if rest:
                    steps.append((length, done, first + whole, rest, capacity - room))
                    tree.push(room - rest * length, first + whole, 1)
                    done, whole = total, whole + 1
                tree.push(room, first + whole, n - whole)
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def place(steps: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces of these lengths and numbers within the length."""
    at = np.searchsorted(steps[:, 0] << 44 | steps[:, 1], lengths << 44 | numbers, side="right") - 1
    _, first, sequence, each, offset = steps[at].T
    i = numbers - first
    return sequence + i // each, offset + i % each * lengths


# --- pieces of documents -----------------------------------------------------------

def _same_for_words() -> bytes:
    """Bytes that a tokenizer that lower-cases and drops white space cannot tell apart."""
    return bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")


@lru_cache(maxsize=1)
def _encoder(path: str) -> chunks.ChunkEncoder:
    return chunks.ChunkEncoder(path, chunks.word_breaks(), special=True, same=_same_for_words(), memo=MEMO_WORDS)


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, key: str = "doc_id", text: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their number ``at`` among the pieces of
    that length in their task ``part``; written, so the numbers stay."""
    reach_workers(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in _slices(whole, "text"):
                found = encode(batch.column("text").to_pylist())
                found = [np.append(f, np.uint32(end_id)).astype("<u4") for f in found]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                cuts = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(found)), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                crc = [zlib.crc32(found[d][a:a + n]) for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist())]
                # number among the pieces of its length: earlier batches, then earlier ones here
                order = np.argsort(length, kind="stable")
                sorted_ = length[order]
                first = np.searchsorted(sorted_, sorted_, side="left")
                at = np.empty(len(doc), np.int64)
                at[order] = seen[sorted_] + np.arange(len(doc)) - first
                seen += np.bincount(length, minlength=capacity + 1)
                out = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                       pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(at)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "at"]
                if keep_ids:
                    ids = pa.array(np.concatenate(found).astype(np.int32)) if found else pa.array([], pa.int32())
                    out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), ids))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    return written(rows.mapInArrow(run, _PIECES + (", ids array<int>" if keep_ids else "")), "pieces")


# --- the operator -----------------------------------------------------------------

def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, key: str = "doc_id",
                   text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and its ids with ``keep_ids``."""
    pieces = cut_documents(docs, tokenizer, capacity, end_id, key, text, keep_ids)
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    offsets = written(counts.select("part", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "offsets")
    # at most ``capacity`` rows, however many documents
    total = offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()
    steps = docs.sparkSession.sparkContext.broadcast(plan({r["length"]: r["n"] for r in total}, capacity))
    numbered = pieces.join(offsets.drop("n").hint("merge"), ["part", "length"]).withColumn("number", F.col("at") + F.col("before"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = place(steps.value, batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)],
                                             names=[*kept, "sequence_id", "offset"])

    return numbered.select(*kept, "number").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, " + ("ids array<int>, " if keep_ids else "")
        + "sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, ends of rows packed with ``keep_ids``: the
    sequences themselves; a group is at most ``capacity`` ids."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                       F.transform("p", lambda x: x["offset"] + x["length"]).alias("ends"))
