"""Byte-level BPE encoding and decoding by a monoid tree reduction.

A text is cut by the tokenizer's pattern; each match (piece) is encoded
alone.  A piece is encoded by halves: ``encode`` splits the bytes, encodes
both halves recursively and joins them.  The join re-encodes a window of
bytes around the seam, growing it token by token, until the window's first
and last tokens come out as they went in.  Then every neighbouring pair of
tokens in the whole sequence is one that BPE leaves apart, and the sequence
with that property is unique, so it is the encoding of the whole piece.
Decoding concatenates the tokens' bytes up the same kind of tree.

Cases: a null or empty text has no tokens and decodes to no bytes; a text of
any length without a pattern break costs O(n log n); other columns are
carried as they are, and the new column's name is the caller's to choose.
"""
from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.common import lean, reach_workers, remembers

#: Pieces whose ids a worker remembers; it starts anew beyond that.
MEMO_PIECES = 200_000
#: Below this many bytes a piece is merged directly, without halves.
LEAF_BYTES = 16


class ByteBpe:
    """A rank file and a pattern: encode and decode one piece."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self._none = max(self.ranks.values()) + 1
        self.bytes_of = [b""] * self._none
        for raw, i in self.ranks.items():
            self.bytes_of[i] = raw
        self._pattern = regex.compile(pattern)
        self._latin = re.compile(_latin_pattern(pattern))

    def pieces(self, text: str) -> list[str]:
        return (self._latin if is_latin(text) else self._pattern).findall(text)

    def merge(self, raw: bytes) -> list[int]:
        """Plain BPE: join the neighbours of lowest rank, leftmost first."""
        ranks = self.ranks
        whole = ranks.get(raw)
        if whole is not None:
            return [whole]
        if len(raw) > 64:
            return self._merge_long(raw)
        none, get = self._none, ranks.get
        cuts = list(range(len(raw) + 1))
        pair = [get(raw[i:i + 2], none) for i in range(len(raw) - 1)]  # rank of part i joined with the next
        while pair:
            best = min(pair)
            if best == none:
                break
            i = pair.index(best)
            del cuts[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get(raw[cuts[i]:cuts[i + 2]], none)
            if i:
                pair[i - 1] = get(raw[cuts[i - 1]:cuts[i + 1]], none)
        return [ranks[raw[x:y]] for x, y in pairwise(cuts)]

    def _merge_long(self, raw: bytes) -> list[int]:
        """``merge`` with a heap of (rank, place) over linked parts."""
        ranks, n = self.ranks, len(raw)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\x01" * n)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not alive[i] or mid == n or end[mid] != stop:
                continue  # one of the two parts has been merged since
            alive[mid], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(raw[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := ranks.get(raw[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i:end[i]]])
            i = end[i]
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the concatenation of two encoded byte strings."""
        if not left or not right:
            return left or right
        a = b = 1  # tokens of either side in the window
        while True:
            ids = left[len(left) - a:] + right[:b]
            again = self.merge(self.decode(ids))
            first = a == len(left) or again[0] == ids[0]
            last = b == len(right) or again[-1] == ids[-1]
            if first and last:
                return left[:len(left) - a] + again + right[b:]
            if not first:
                a = min(len(left), 2 * a)
            if not last:
                b = min(len(right), 2 * b)

    def encode(self, raw: bytes) -> list[int]:
        if len(raw) <= LEAF_BYTES:
            return self.merge(raw) if raw else []
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        mid = len(raw) // 2
        return self.join(self.encode(raw[:mid]), self.encode(raw[mid:]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_LATIN_END = 0x250
#: The pattern's alternatives for words and contractions; no text matches both.
_CONTRACTIONS, _LETTERS = "'s|'t|'re|'ve|'m|'ll|'d|", r" ?\p{L}+|"


def is_latin(text: str) -> bool:
    """No character from U+0250 on."""
    return text.isascii() or bool(np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).max() < _LATIN_END)


@lru_cache
def _latin_pattern(pattern: str) -> str:
    """``pattern`` with \\p{L} and \\p{N} written out for characters below
    U+0250, where the Unicode versions of all libraries agree."""
    def chars(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(_LATIN_END) if unicodedata.category(chr(c))[0] == kind)
    letters, numbers = chars("L"), chars("N")
    # \s of the two libraries differs on U+001C..U+001F, so it is written out too
    space = r"\t\n\x0b\x0c\r \x85\xa0"
    # words come up most, so they are tried first
    pattern = pattern.replace(_CONTRACTIONS + _LETTERS, _LETTERS + _CONTRACTIONS, 1)
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
    out = out.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return out.replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]")


class _Memo(dict):
    """piece -> ids as bytes of int32."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        ids = np.array(self.bpe.encode(piece.encode()), np.int32).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _memo(path: str, pattern: str) -> _Memo:
    return _Memo(ByteBpe(path, pattern))


remembers("byte_bpe", _memo.cache_clear)


def _slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of the column."""
    if not batch.num_rows:
        return
    col = batch.column(column)
    flat = pa.types.is_string(col.type) or pa.types.is_binary(col.type)
    sizes = pc.binary_length(col) if flat else pc.list_value_length(col)
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids",
                     decoded: str | None = None) -> DataFrame:
    """``docs`` with the column ``out``: array<int> of the text's token ids; with
    ``decoded``, a column of the bytes that these ids decode to (one worker for both)."""
    reach_workers(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name not in (out, decoded)]
    names = [f.name for f in others]
    new = [T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.BinaryType())] if decoded else [])]
    schema = T.StructType(others + new)

    def run(batches):
        memo = _memo(ranks_path, pattern)
        pieces = memo.bpe.pieces
        for whole in batches:
            for batch in _slices(whole, text, 2 << 20):
                found = [b"".join(map(memo.__getitem__, pieces(t))) if t else b"" for t in batch.column(text).to_pylist()]
                offsets = np.zeros(len(found) + 1, np.int64)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
                back = [pa.array([memo.bpe.decode(np.frombuffer(x, np.int32).tolist()) for x in found], pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), ids, *back], names=schema.names)

    return docs.mapInArrow(lean(run, "byte_bpe"), schema)


def decode_documents(docs: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the column ``out``: the bytes that the ids stand for."""
    reach_workers(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema.fields if f.name != out] + [T.StructField(out, T.BinaryType())])
    names = schema.names[:-1]

    def run(batches):
        decode = _memo(ranks_path, pattern).bpe.decode
        for whole in batches:
            for batch in _slices(whole, ids, 1 << 20):
                lists = batch.column(ids)
                flat, ends = lists.flatten().to_numpy().tolist(), np.cumsum(pc.list_value_length(lists).fill_null(0)).tolist()
                raw = pa.array([decode(flat[a:b]) for a, b in pairwise([0, *ends])], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), raw], names=[*names, out])

    return docs.mapInArrow(lean(run, "byte_bpe"), schema)


def ids_sha256(ids: str = "ids"):
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)
