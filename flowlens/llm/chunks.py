"""Ids of texts through their distinct chunks.

A chunk is a stretch of text that a tokenizer encodes by itself wherever it
stands.  Texts are cut in numpy between pairs of ASCII characters that no token
may join, each distinct chunk goes through the library once per worker, and
the ids of whole texts are gathered by row number.
"""
from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks, and characters of them, that a worker remembers; it starts anew beyond either.
MEMO_CHUNKS, MEMO_CHARS = 800_000, 32 << 20
#: Bytes that are cut and gathered at once, about; longer texts go in several parts.
PART_BYTES = 2 << 20
#: New chunks that go through the library as one text, where they can.
RUN_CHUNKS = 256

_LETTERS = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
_DIGITS = np.array([0x30 <= c <= 0x39 for c in range(256)])
_VISIBLE = np.array([0x21 <= c <= 0x7E for c in range(256)])
_SPACE = np.arange(256) == 0x20


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.outer(first, second).ravel()


def byte_level_breaks() -> np.ndarray:
    """Byte pairs (first << 8 | second) that the byte-level pattern always parts:
    a visible character and a space, a letter or digit and a mark, a letter and a digit."""
    marks = _VISIBLE & ~_LETTERS & ~_DIGITS
    return (_pairs(_VISIBLE, _SPACE) | _pairs(_LETTERS | _DIGITS, marks) | _pairs(_LETTERS, _DIGITS) | _pairs(_DIGITS, _LETTERS))


def word_breaks() -> np.ndarray:
    """The same for a pattern that drops white space and takes digits one by one."""
    return byte_level_breaks() | _pairs(_DIGITS, _DIGITS)


def open_tokenizer(path: str, special: bool):
    """The tokenizers library; with ``special`` the strings of its added tokens
    are these tokens (its default), else they are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    out = Tokenizer.from_file(path)
    out.encode_special_tokens = not special
    return out


class Rows:
    """Rows of whole numbers in one growing array."""

    def __init__(self, kind=np.int32):
        self.flat, self.ends, self.n, self.used = np.zeros(1 << 12, kind), np.zeros(1 << 10, np.int64), 0, 0

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        need, rows = self.used + len(values), self.n + len(lengths)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(need, self.flat.dtype)])
        if rows + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(rows + 1, np.int64)])
        self.flat[self.used:need] = values
        self.ends[self.n + 1:rows + 1] = self.used + np.cumsum(lengths)
        self.n, self.used = rows, need

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values of the rows one after the other, length of each row)."""
        first = self.ends[rows]
        lengths = self.ends[rows + 1] - first
        after = np.cumsum(lengths)
        at = np.repeat(first - (after - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at], lengths


class Memo:
    """Row number of each distinct chunk; ``learn`` appends the rows of new ones."""

    def __init__(self, learn: Callable[[list[str]], None], limit: int | None = None):
        self.learn, self.at, self.chars, self.limit = learn, {}, 0, limit or MEMO_CHUNKS

    @property
    def full(self) -> bool:
        return len(self.at) > self.limit or self.chars > MEMO_CHARS

    def rows(self, chunks: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.at.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh = [chunks[i] for i in new.tolist()]  # distinct, as ``chunks`` are
            first = len(self.at)
            self.learn(fresh)
            self.at.update(zip(fresh, range(first, first + len(fresh))))
            self.chars += sum(map(len, fresh))
            out[new] = np.arange(first, first + len(fresh))
        return out


def flat_ids(found: list[list[int]], kind) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), kind, int(lengths.sum())), lengths


def _last_break(raw: bytes, breaks: np.ndarray, at: int, end: int) -> int:
    """The last place in ``raw[at + 1:end]`` that a break lies before, -1 if there is none."""
    x = np.frombuffer(raw, np.uint8, end - at, at)
    found = np.flatnonzero(breaks[x[:-1].astype(np.uint16) << 8 | x[1:]])
    return at + int(found[-1]) + 1 if len(found) else -1


def parts(raws: list[bytes], breaks: np.ndarray, limit: int | None = None) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Runs of (texts or parts of long texts, the text that each is part of).

    A long text is parted at the last break of a stretch of ``limit`` bytes; a
    stretch without one is not parted from the rest.
    """
    limit = limit or PART_BYTES
    held, owner, size = [], [], 0
    for i, raw in enumerate(raws):
        at, open_ = 0, True
        while open_:
            end = len(raw)
            if end - at > limit and (place := _last_break(raw, breaks, at, at + limit)) > at:
                end = place
            held.append(raw[at:end])
            owner.append(i)
            size += end - at
            if size >= limit:
                yield held, np.array(owner, np.int64)
                held, owner, size = [], [], 0
            at, open_ = end, end < len(raw)
    if held:
        yield held, np.array(owner, np.int64)


def cut(raws: list[bytes], breaks: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct chunks, the place of each chunk among them, chunks of each text)."""
    data = b"".join(raws)
    x = np.frombuffer(data, np.uint8)
    sizes = np.fromiter(map(len, raws), np.int64, len(raws))
    ends = np.cumsum(sizes)
    begins = np.zeros(len(x), bool)
    if len(x):
        begins[1:] = breaks[x[:-1].astype(np.uint16) << 8 | x[1:]]
    begins[(ends - sizes)[sizes > 0]] = True
    at = np.flatnonzero(begins)
    offsets = np.append(at, len(x)).astype(np.int64)
    coded = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    counts = np.diff(np.searchsorted(at, np.concatenate([[0], ends])))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), counts


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library, as it is loaded or with the
    strings of added tokens as ordinary text (not ``special``).

    ``same`` maps bytes to bytes that the tokenizer cannot tell apart (case,
    kinds of white space), so fewer chunks are distinct.  Texts that hold the
    string of an added token go through the library whole.

    ``runs``, for tokens of bytes and breaks between a visible character and a
    space: new chunks that such breaks part go through the library in runs, and
    the ids go back to their chunks by the bytes of the tokens.
    """

    def __init__(self, path: str, breaks: np.ndarray, special: bool, same: bytes | None = None, memo: int | None = None, runs: bool = False):
        self.tokenizer, self.breaks, self.same, self.limit = open_tokenizer(path, special), breaks, same, memo
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        # a run shall hold no added token that none of its chunks holds
        self.sizes = self._token_bytes() if runs and not any(" " in a for a in self.added) else None
        self._start()

    def _start(self) -> None:
        learn = self.library if self.sizes is None else self.in_runs
        self.ids, self.memo = Rows(np.uint32), Memo(lambda chunks: self.ids.add(*learn(chunks)), self.limit)

    def _token_bytes(self) -> np.ndarray:
        """Bytes of each id's token: a byte-level token has a character for each."""
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        out = np.zeros(1 + max([*tokens.values(), *self.tokenizer.get_added_tokens_decoder()]), np.int64)
        out[np.fromiter(tokens.values(), np.int64, len(tokens))] = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return out

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat_ids([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)], np.uint32)

    def in_runs(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``library`` of chunks; one by one where tokens do not end with the chunks."""
        apart = [c[0] == " " and "!" <= c[-1] <= "~" for c in chunks]
        some = list(compress(chunks, apart))
        ends = np.cumsum(pc.binary_length(pa.array(some, pa.large_string())).to_numpy(zero_copy_only=False))
        ids, _ = self.library(["".join(some[i:i + RUN_CHUNKS]) for i in range(0, len(some), RUN_CHUNKS)])
        sizes = self.sizes[ids]
        after = np.cumsum(sizes)
        if not len(some) or not len(ids) or after[-1] != ends[-1] or not sizes.all():
            return self.library(chunks)
        last = np.searchsorted(after, ends)
        if (after[last] != ends).any():
            return self.library(chunks)
        rest, lengths = self.library([c for c, a in zip(chunks, apart) if not a])
        found = Rows(np.uint32)
        found.add(ids, np.diff(last, prepend=-1))
        found.add(rest, lengths)
        return found.take(np.argsort(np.argsort(~np.array(apart), kind="stable"), kind="stable"))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        held: list[list[np.ndarray]] = [[] for _ in texts]
        raws = []
        for i, text in enumerate(texts):
            if any(a in text for a in self.added):
                held[i].append(self.library([text])[0])
                text = ""
            raws.append(text.encode().translate(self.same) if self.same else text.encode())
        for some, owner in parts(raws, self.breaks):
            if self.memo.full:
                self._start()
            new, place, counts = cut(some, self.breaks)
            ids, lengths = self.ids.take(self.memo.rows(new)[place])
            ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)].tolist()
            for o, a, b in zip(owner.tolist(), [0, *ends], ends):
                held[o].append(ids[a:b])
        return [h[0] if len(h) == 1 else np.concatenate(h) for h in held]
