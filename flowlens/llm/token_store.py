"""Token ids in files of Simple-8b words.

A file holds documents in ascending id order.  Its ids are cut into blocks of
``BLOCK``; a block is packed into 64-bit words, each a 4-bit selector and 60
payload bits that hold as many ids as fit at one width.  An id of more than 60
bits is escaped: a word of selector 15, then the id in a word of its own.
Per-block word offsets let a reader decode any block alone, and both
directions run over all blocks at once in numpy.

Layout (little endian): magic, version, documents, ids, blocks, words (six
uint64); document ids, id-is-null flags, ids per document; block offsets;
words.

Cases: a null or empty text is written as the end id alone; a null document id
sorts first; repeated ids stay apart, ordered by their text's hash; an empty
table writes no file and reads back no row.  Only the id and text columns are
read.
"""
from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlens.llm import chunks
from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import reach_workers, scratch, written

MAGIC = 0x38424C50494D5353
BLOCK = 512
#: Ids of a file, about: what a task holds in memory.
FILE_IDS = 2_000_000
#: Chunks that a worker remembers.
MEMO_CHUNKS = 1_200_000
# Fixed values of the Simple-8b word: ids a word, bits an id, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15


# --- the code ----------------------------------------------------------------

_BITS = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each value; from 2^53 on one more where the value rounds up."""
    if len(values) and int(values.max()) < len(_BITS):
        return _BITS[values]
    return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    kind = np.uint64 if int(ids.max()) >> 32 else np.uint32
    grid = np.zeros((blocks, BLOCK + 60), kind)
    flat = np.zeros(blocks * BLOCK, kind)
    flat[:n] = ids
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    size = np.full(blocks, BLOCK)
    size[-1] = n - (blocks - 1) * BLOCK
    bits = _bit_lengths(grid.ravel()).reshape(grid.shape)
    # widest[i]: bits of the widest of the next `count` ids, for growing counts
    fits = np.zeros((blocks, BLOCK), np.uint8)
    window, span = bits, 1
    for s in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[s])
        while 2 * span <= count:
            window = np.maximum(window[:, :-span], window[:, span:])
            span *= 2
        shift = count - span
        widest = np.maximum(window[:, :BLOCK], window[:, shift:shift + BLOCK])
        fit = widest <= WIDTHS[s]
        if not fit.any():
            break
        fits += fit  # what fits at one count fits at all smaller ones
    choice = np.where(fits, np.uint8(len(COUNTS)) - fits, np.uint8(ESCAPE))
    # follow the chain of words through all blocks together
    step = np.zeros(16, np.int64)
    step[:14], step[ESCAPE] = COUNTS, 1
    at, open_ = np.zeros(blocks, np.int64), np.arange(blocks)
    starts, owners, selectors = [], [], []
    while len(open_):
        sel = choice[open_, at[open_]]
        starts.append(at[open_].copy())
        owners.append(open_)
        selectors.append(sel)
        at[open_] += step[sel]
        open_ = open_[at[open_] < size[open_]]
    start, owner, sel = (np.concatenate(x) for x in (starts, owners, selectors))
    order = np.argsort(owner * BLOCK + start, kind="stable")
    start, owner, sel = start[order], owner[order], sel[order]
    cells = grid.ravel()
    place = np.cumsum(1 + (sel == ESCAPE)) - (1 + (sel == ESCAPE))
    words = np.zeros(int(place[-1]) + 1 + int(sel[-1] == ESCAPE), np.uint64)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == ESCAPE:
            words[place[mine]] = np.uint64(ESCAPE) << np.uint64(60)
            words[place[mine] + 1] = grid[owner[mine], start[mine]]
            continue
        word = np.full(len(mine), np.uint64(s) << np.uint64(60))
        at = owner[mine] * (BLOCK + 60) + start[mine]
        for k in range(int(COUNTS[s])):
            word |= cells[at + k].astype(np.uint64) << np.uint64(k * WIDTHS[s])
        words[place[mine]] = word
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return words, place[first].astype(np.uint64)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a run of blocks that begins a block."""
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # words that hold an escaped id
    if (sel == ESCAPE).any():  # a raw word may look like an escape: walk those runs
        i = 0
        marks = np.flatnonzero(sel == ESCAPE)
        last = -1
        for i in marks.tolist():
            if i != last:
                raw[i + 1] = True
                last = i + 1
    head = np.flatnonzero(~raw)
    sel = sel[head]
    block = np.searchsorted(offsets, head.astype(np.uint64), side="right") - 1
    held = np.where(sel == ESCAPE, 1, COUNTS[np.minimum(sel, 13)])
    # a word's first id: the ids of its block's words before it
    total = np.cumsum(held) - held
    first = np.searchsorted(head.astype(np.uint64), offsets)
    blocks = -(-n // BLOCK)
    # a block's last word may be filled beyond it: room for that lies between blocks
    start = total - total[first[block]] + block * (BLOCK + 60)
    grid = np.zeros((blocks, BLOCK + 60), np.uint64)
    out = grid.ravel()
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        if s == ESCAPE:
            out[start[mine]] = words[head[mine] + 1]
            continue
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        mask = np.uint64((1 << width) - 1)
        word, at = words[head[mine]], start[mine]
        for k in range(count):
            out[at + k] = (word >> np.uint64(k * width)) & mask
    return grid[:, :BLOCK].ravel()[:n]


# --- files ----------------------------------------------------------------

def dump(doc_ids: np.ndarray, no_id: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    head = np.array([MAGIC, 1, len(doc_ids), len(ids), len(offsets), len(words)], np.uint64)
    return b"".join(x.tobytes() for x in (head, doc_ids.astype(np.int64), no_id.astype(np.uint8), lengths.astype(np.int64), offsets, words))


def load(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, id-is-null, ids per document, ids)."""
    buf = io.BytesIO(raw)
    take = lambda n, kind: np.frombuffer(buf.read(n * np.dtype(kind).itemsize), kind)
    magic, version, docs, n, blocks, words = (int(x) for x in take(6, np.uint64))
    if magic != MAGIC or version != 1:
        raise ValueError("not a token file")
    doc_ids, no_id, lengths = take(docs, np.int64), take(docs, np.uint8), take(docs, np.int64)
    offsets = take(blocks, np.uint64)
    return doc_ids, no_id.astype(bool), lengths, unpack(take(words, np.uint64), offsets, n)


def load_block(raw: bytes, block: int) -> np.ndarray:
    """The ids of one block, found by its offset."""
    docs, n, blocks, words = (int(x) for x in np.frombuffer(raw, np.uint64, 4, 16))
    base = 48 + 17 * docs
    offsets = np.frombuffer(raw, np.uint64, blocks, base)
    a = int(offsets[block])
    b = int(offsets[block + 1]) if block + 1 < blocks else words
    part = np.frombuffer(raw, np.uint64, b - a, base + 8 * blocks + 8 * a)
    return unpack(part, np.zeros(1, np.uint64), min(BLOCK, n - block * BLOCK))


@lru_cache(maxsize=2)
def _encoder(path: str, special: bool) -> chunks.ChunkEncoder:
    """Ids of whole texts: each distinct chunk goes through the library once."""
    return chunks.ChunkEncoder(path, chunks.byte_level_breaks(), special, memo=MEMO_CHUNKS, runs=True)


# --- the operator ---------------------------------------------------------------

def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                 key: str = "doc_id", text: str = "text", special: bool = False) -> DataFrame:
    """Encode and write; the manifest: part, file, ids, with one row per file.

    ``special``: the strings of the tokenizer's added tokens are these tokens,
    as in the library as loaded; else they are ordinary text.

    Documents are range-partitioned by id, so files follow each other in id
    order by (part, file number).  A retried task writes files under other
    names; the manifest names those of the task that ended.
    """
    spark = docs.sparkSession
    reach_workers(spark)
    rows = (docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
            .withColumn("part", F.spark_partition_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = pafs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        encode, end = _encoder(tokenizer, special), np.uint32(end_id).tobytes()
        kept: list = []
        state = {"ids": 0, "file": 0}

        def flush(part: int) -> pa.RecordBatch:
            doc_ids, no_id = pa.concat_arrays([k[0] for k in kept]), None
            no_id = doc_ids.is_null().to_numpy(zero_copy_only=False)
            blobs = [b for k in kept for b in k[1]]
            lengths = np.array([len(b) // 4 for b in blobs], np.int64)
            ids = np.frombuffer(b"".join(blobs), np.uint32)
            name = f"{base}/{part:06d}-{state['file']:06d}-{uuid.uuid4().hex}.s8b"
            with where.open_output_stream(name) as out:
                out.write(dump(doc_ids.fill_null(0).to_numpy(), no_id, lengths, ids))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": pa.array([state["file"]], pa.int32()),
                                              "name": [name], "ids": pa.array([len(ids)], pa.int64())})
            kept.clear()
            state["ids"], state["file"] = 0, state["file"] + 1
            return row

        part = 0
        for whole in batches:
            for batch in _slices(whole, "text"):
                part = batch.column("part")[0].as_py()
                blobs = [ids.tobytes() + end for ids in encode(batch.column("text").to_pylist())]
                kept.append((batch.column("doc_id"), blobs))
                state["ids"] += sum(map(len, blobs)) // 4
                if state["ids"] >= FILE_IDS:
                    yield flush(part)
        if kept:
            yield flush(part)

    return written(rows.mapInArrow(run, "part int, file int, name string, ids long"), "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, ids_crc32 from the files."""
    spark = manifest.sparkSession
    reach_workers(spark)
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = (manifest.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))
             .repartition(max(1, manifest.count()), "name"))  # a task a file, not merged

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, _ = pafs.FileSystem.from_uri(folder)
        for pdf in frames:
            for name, first in zip(pdf["name"], pdf["first"]):
                with where.open_input_stream(name) as f:
                    doc_ids, no_id, lengths, ids = load(f.read())
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                out = pd.DataFrame({"doc_id": pd.array(doc_ids, dtype="Int64"), "start": starts + first,
                                    "n_tokens": lengths, "ids_crc32": crc})
                out.loc[no_id, "doc_id"] = pd.NA
                yield out

    return files.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    path = scratch(spark, "tokens")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
