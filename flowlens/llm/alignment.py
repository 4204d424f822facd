"""Alignment of two tokenizers' ids over a corpus, byte offsets as the meeting points.

Of a text, tokenizer A (byte-level BPE) encodes a space and the text, tokenizer
B (sentencepiece, which adds that space) the text.  Where a token of either
ends at one byte offset the text is cut into groups; the last tokens of a group
are linked.  An identity map holds, for each A id, the B id of the same bytes.
A group of one token each that the map foresees is exact: it is counted in a
vector with one cell per A id.  Only the links of other (irregular) groups
enter the shuffle, as pairs with their counts.

What the counts say about each document goes back to it in the same two ways.
The exact links read the vectors.  Of the irregular pairs those that hold more
than 1/``FREQUENT`` of all irregular links (so at most ``FREQUENT`` of them)
travel with the tasks; the others are rare by that definition and meet their
counts in a shuffle join without a hot key.

Both tokenizers are applied to distinct chunks.  Texts are cut between two ASCII
characters that A's pattern always parts (a visible one and a space, a letter
or digit and a mark, a letter and a digit), except for pairs that some piece of
B joins.  So tokens and groups of both end there.

Cases: a null or empty text, and one whose tokens do not give back its bytes
(it holds U+2581, say), has no tokens: zeros and an empty groups column.
Strings of special tokens are ordinary text.  Repeated rows and ids are
documents of their own, a null id is carried, an empty table gives no row.  Only
the id and text columns are read, so other names cannot clash.  A long text is
aligned part by part.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import chunks
from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import reach_workers, written

#: Irregular pairs that may travel with the tasks: those above this part of all links.
FREQUENT = 100_000
#: Bits of a B id in a pair.
B_BITS = 24
#: Chunks that a worker remembers, with their groups.
MEMO_CHUNKS = 500_000
#: Distinct pairs that a counting task holds.
PAIRS_HELD = 1_000_000

SPACE_MARK = "▁"


# --- the two vocabularies -------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 characters are themselves, the other bytes follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def a_bytes(path: str) -> list[bytes]:
    """Bytes of each A id (empty for a token that is no byte-level entry)."""
    alphabet = _byte_alphabet()
    vocab = chunks.open_tokenizer(path, special=False).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for entry, i in vocab.items():
        if all(c in alphabet for c in entry):
            out[i] = bytes(alphabet[c] for c in entry)
    return out


def b_bytes(model) -> list[bytes]:
    """Bytes of each B id: byte pieces are their byte, the mark is a space."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
    return out


def identity_map(a: list[bytes], b: list[bytes], plain: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 where there is none; whole
    pieces (``plain``) go before byte pieces, then the smaller id."""
    of: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: (not plain[i], i)):
        of.setdefault(b[i], i)
    return np.array([of.get(raw, -1) if raw else -1 for raw in a], np.int32)


def _plain_model(path: str):
    """The sentencepiece model without the space that it puts before a text:
    chunks bring theirs, and only the first of a text has the added one."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.add_dummy_prefix = False
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


class Vocabularies:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = chunks.open_tokenizer(a_path, special=False), _plain_model(b_path)
        self.a_bytes, self.b_bytes = a_bytes(a_path), b_bytes(self.b)
        plain = [not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)) for i in range(len(self.b_bytes))]
        self.same = identity_map(self.a_bytes, self.b_bytes, plain)
        self.breaks = chunks.byte_level_breaks()
        for raw in (r for r, p in zip(self.b_bytes, plain) if p):
            self.breaks[[x << 8 | y for x, y in pairwise(raw)]] = False
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """A ids and B ids of chunks."""
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode(texts, num_threads=1)


# --- groups and links of chunks -----------------------------------------------------

class Aligner:
    """Remembers for each distinct chunk its tokens, groups and links."""

    def __init__(self, a_path: str, b_path: str):
        self.v = Vocabularies(a_path, b_path)
        n = max(len(self.v.a_bytes), len(self.v.b_bytes))
        # decimal ids by what follows: 0 more of the group's A ids, 1 its B ids, 2 more of them, 3 the next group
        self.shown = [f"{i}{after}" for after in ",|,;" for i in range(n)]
        self.ids = n
        self._start()

    def _start(self) -> None:
        self.memo = chunks.Memo(self._learn, MEMO_CHUNKS)
        self.exact, self.pairs = chunks.Rows(np.int32), chunks.Rows(np.int64)
        self.sizes = chunks.Rows(np.int64)  # n_a, n_b, n_groups, whether the bytes come back
        self.groups: list[str] = []

    def _learn(self, texts: list[str]) -> None:
        v = self.v
        a, b = v.encode(texts)
        raws = [t.encode() for t in texts]
        good = np.fromiter((raw == b"".join([v.a_bytes[i] for i in x]) == b"".join([v.b_bytes[i] for i in y])
                            for raw, x, y in zip(raws, a, b)), bool, len(texts))
        if not good.all():
            a, b = ([x if g else [] for x, g in zip(y, good)] for y in (a, b))
        flat_a, n_a = chunks.flat_ids(a, np.int64)
        flat_b, n_b = chunks.flat_ids(b, np.int64)
        # chunks one after the other: ends rise, and the end of a chunk is common
        meet, at_a, at_b = np.intersect1d(np.cumsum(v.a_size[flat_a]), np.cumsum(v.b_size[flat_b]), assume_unique=True, return_indices=True)
        chunk = np.searchsorted(np.cumsum(n_a), at_a, side="right")
        in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        last_a, last_b = flat_a[at_a], flat_b[at_b]
        exact = (in_a == 1) & (in_b == 1) & (v.same[last_a] == last_b)
        per = lambda mask: np.bincount(chunk[mask], minlength=len(texts))
        self.exact.add(last_a[exact], per(exact))
        self.pairs.add((last_a << B_BITS | last_b)[~exact], per(~exact))
        n = per(np.ones(len(chunk), bool))
        self.sizes.add(np.stack([n_a, n_b, n, good], 1).ravel(), np.full(len(texts), 4))
        # a group's A ids, then its B ids: the other side's tokens of the groups before come first
        codes = np.empty(len(flat_a) + len(flat_b), np.int64)
        at_a, at_b = at_a + 1, at_b + 1
        before_b, before_a = np.repeat(at_b - in_b, in_a), np.repeat(at_a, in_b)
        flat_a[at_a - 1] += self.ids
        flat_b[at_b - 1] += self.ids
        codes[np.arange(len(flat_a)) + before_b] = flat_a
        codes[np.arange(len(flat_b)) + before_a] = flat_b + 2 * self.ids
        words = list(map(self.shown.__getitem__, codes.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        self.groups += ["".join(words[x:y]) for x, y in zip([0, *ends], ends)]

    def __call__(self, texts: list[str]) -> Iterator[dict]:
        """The results of each text."""
        held: list[list] = [[] for _ in texts]
        for some, owner in chunks.parts([b" " + t.encode() if t else b"" for t in texts], self.v.breaks):
            if self.memo.full:
                self._start()
            new, at, counts = chunks.cut(some, self.v.breaks)
            rows = self.memo.rows(new)[at]
            first = np.concatenate([[0], np.cumsum(counts)])
            sizes = self.sizes.flat[:self.sizes.used].reshape(-1, 4)[rows]
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(sizes, axis=0)])[first]
            exact, n_exact = self.exact.take(rows)
            pairs, n_pairs = self.pairs.take(rows)
            cut_exact, cut_pairs = (np.concatenate([[0], np.cumsum(n)])[first].tolist() for n in (n_exact, n_pairs))
            shown, first = list(map(self.groups.__getitem__, rows.tolist())), first.tolist()
            for k, o in enumerate(owner.tolist()):
                held[o].append((sums[k + 1] - sums[k], counts[k], exact[cut_exact[k]:cut_exact[k + 1]],
                                pairs[cut_pairs[k]:cut_pairs[k + 1]], "".join(shown[first[k]:first[k + 1]])))
        for parts_ in held:
            n_a, n_b, n_groups, good = sum(p[0] for p in parts_).tolist()
            if not n_a or good < sum(p[1] for p in parts_):  # no token, or a chunk's bytes do not come back
                yield {"n_a": 0, "n_b": 0, "n_groups": 0, "groups": "", "exact": [], "pairs": []}
                continue
            digest = hashlib.sha256("".join([p[4] for p in parts_])[:-1].encode()).hexdigest()
            yield {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups": digest,
                   "exact": [p[2] for p in parts_], "pairs": [p[3] for p in parts_]}


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _lists(values: list[list[np.ndarray]], kind) -> pa.Array:
    sizes = [sum(map(len, v)) for v in values]
    flat = [x for v in values for x in v]
    data = np.concatenate(flat).astype(kind) if flat else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(data))


def links_of_documents(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, groups (digest), exact (A ids of exact
    links), pairs (A id << B_BITS | B id of the others) of every document; written."""
    reach_workers(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = _aligner(a_path, b_path)
        for whole in batches:
            for batch in _slices(whole, "text"):
                found = list(align(batch.column("text").to_pylist()))
                plain = [pa.array([f[c] for f in found], pa.int64()) for c in ("n_a", "n_b", "n_groups")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *plain, pa.array([f["groups"] for f in found], pa.string()),
                     _lists([f["exact"] for f in found], np.int32), _lists([f["pairs"] for f in found], np.int64)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "exact", "pairs"])

    out = rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups string, exact array<int>, pairs array<long>")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "links")


# --- corpus counts -------------------------------------------------------------------

def _count_links(links: DataFrame, same: np.ndarray) -> DataFrame:
    """(pair, exact, n) over the corpus: a task adds up a vector of exact links
    and its irregular pairs, the shuffle adds up the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(same), np.int64)
        keys, ns = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows(pairs, counts, exact):
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(np.full(len(pairs), exact)), pa.array(counts)], names=["pair", "exact", "n"])

        for batch in batches:
            vector += np.bincount(batch.column("exact").flatten().to_numpy(), minlength=len(same))
            more, n = np.unique(batch.column("pairs").flatten().to_numpy(), return_counts=True)
            keys, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
            ns = np.bincount(at, weights=np.concatenate([ns, n]), minlength=len(keys)).astype(np.int64)
            if len(keys) > PAIRS_HELD:
                yield rows(keys, ns, False)
                keys, ns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = np.flatnonzero(vector)
        yield rows(held << B_BITS | same[held], vector[held], True)
        yield rows(keys, ns, False)

    found = links.select("exact", "pairs").mapInArrow(run, "pair long, exact boolean, n long")
    return found.groupBy("pair", "exact").agg(F.sum("n").alias("n"))


def pair_counts(links: DataFrame, same: np.ndarray) -> DataFrame:
    """pair, exact, n, best (n is the highest of the pair's B id); written."""
    counts = written(_count_links(links, same), "pairs")
    b_id = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))  # a row per B id
    return written(counts.join(F.broadcast(highest), b_id == F.col("b"))
                   .select("pair", "exact", "n", (F.col("n") == F.col("top")).alias("best")), "counted")


def _lookup(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, n, best) in the order of pairs; of a size that the callers bound."""
    t = rows.select("pair", "n", "best").toArrow()
    pair, n, best = (t.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return pair[order], n[order], best[order].astype(np.int64)


# --- the operator ---------------------------------------------------------------------

def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pair counts): doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 per row of ``docs``; pair, exact, n, best."""
    spark = docs.sparkSession
    same = Vocabularies(a_path, b_path).same
    links = links_of_documents(docs, a_path, b_path, key, text)
    counts = pair_counts(links, same)
    vector_n, vector_best = np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    pair, n, best = _lookup(counts.where("exact"))  # a row per A id at most
    vector_n[pair >> B_BITS], vector_best[pair >> B_BITS] = n, best
    irregular = counts.where("NOT exact")
    total = irregular.agg(F.sum("n")).first()[0] or 0
    rare = F.col("n") * FREQUENT <= total
    hot = _lookup(irregular.where(~rare))  # fewer than FREQUENT
    tables = spark.sparkContext.broadcast((vector_n, vector_best, *hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector_n, vector_best, hot_pair, hot_n, hot_best = tables.value
        carried = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups"]
        for batch in batches:
            rows = batch.num_rows
            sizes = [pc.list_value_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("exact", "pairs")]
            exact, pairs = (batch.column(c).flatten().to_numpy() for c in ("exact", "pairs"))
            owner = np.repeat(np.arange(rows), sizes[0])
            summed = np.zeros((2, rows), np.int64)
            np.add.at(summed[0], owner, vector_n[exact])
            np.add.at(summed[1], owner, vector_best[exact])
            owner = np.repeat(np.arange(rows), sizes[1])
            found = np.zeros(len(pairs), bool)
            if len(hot_pair):
                at = np.minimum(np.searchsorted(hot_pair, pairs), len(hot_pair) - 1)
                found = hot_pair[at] == pairs
                np.add.at(summed[0], owner[found], hot_n[at[found]])
                np.add.at(summed[1], owner[found], hot_best[at[found]])
            left = np.bincount(owner[~found], minlength=rows)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32)), pa.array(pairs[~found]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), pa.array(summed[0]), pa.array(summed[1]), lists],
                                             names=[*carried, "count_sum", "n_best", "rare"])

    seen = written(links.mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, count_sum long, n_best long, rare array<long>"), "seen")
    asked = seen.select("row", F.explode("rare").alias("pair"))
    told = (asked.join(irregular.where(rare).select("pair", "n", "best"), "pair")
            .groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("best").cast("long")).alias("more_best")))
    out = seen.drop("rare").join(told, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),  # a group ends in one link
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), F.col("groups").alias("groups_sha256"))
    return out, counts
