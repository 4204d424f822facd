"""Benchmark decontamination with a BM25 index and block-max WAND.

The test items are the indexed side.  Every passage of every document is a
query: half overlapping windows.  The half is the longest run of words that
verification can accept for the longest item, with a fifth of its words
inserted, so an item's copy lies whole in one of them, edited or not.  An item's score is its BM25 score
divided by that of its own text, so 1 means that all its words occur.  An
item's threshold is the least score that verification can still accept: 1 less
the heaviest words that its permitted edits can take away.

All items above their thresholds are retrieved.  Upper bounds prune, as in
block-max WAND with fixed thresholds, for all passages of a batch at once:
first a term's highest impact anywhere, then its highest impact in a block of
items; only blocks that can still reach the threshold are scored item by item.
A retrieved item is verified on its question and its answer: each must occur
in the passage with at most a fifth of its words inserted, deleted or
replaced (a side of fewer than ``EXACT_WORDS`` words: exactly).

Where items have no answer column the last sentence is taken as the answer;
as that is a guess, an item that occurs as a whole in the passage, by the same
rule, is verified too.  Its sides' overlaps are then given without the exact rule.

Cases: null or empty texts and items match nothing; an item without a word is
not indexed; repeated items and documents give one row per pair of ids and
row of the document; an empty benchmark or table gives no rows.  The index is
sent to the workers in parts of at most ``PART_WORDS`` words, one pass over
the documents a part, so a larger benchmark needs more passes, not more memory.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import lean, reach_workers, written

K1, B = 1.2, 0.75
#: Of a search that names no other; ``find`` takes each item's own.
THRESHOLD = 0.5
OVERLAP = 0.8
EXACT_WORDS = 8
BLOCK_ITEMS = 16
#: Words of the items in one part of the index: its broadcast is bounded by that.
PART_WORDS = 2_000_000

_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 0x20 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.?!])\s+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates words."""
    return text.lower().encode().translate(_PLAIN).split() if text else []


def question_and_answer(text: str | None) -> tuple[str, str]:
    """All but the last sentence with a word, and that sentence."""
    parts = [p for p in _SENTENCE.split(text or "") if words_of(p)]
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text or "", "")


@dataclass
class Index:
    """One part: terms with impacts by block and by item (CSR by term)."""

    vocab: dict
    item_ids: list
    questions: list
    answers: list
    passage: int
    block_ptr: np.ndarray
    blocks: np.ndarray
    block_at: np.ndarray
    item_ptr: np.ndarray
    items: np.ndarray
    impact: np.ndarray
    least: np.ndarray
    whole: bool = False  # the answer is a guess: the item as a whole counts too
    own: tuple = ()

    def relative(self, need: float | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Impacts by posting, term and block, as shares of what an item needs."""
        share = self.impact / np.broadcast_to(need, len(self.item_ids))[self.items]
        if not len(share):
            return share, share, share
        return share, np.maximum.reduceat(share, self.item_ptr[:-1]), np.maximum.reduceat(share, self.block_at)


def edits_of(words: int) -> int:
    """The most edits that ``overlap`` accepts for a side of so many words."""
    if words < EXACT_WORDS:
        return 0
    n = int(words * (1 - OVERLAP))
    return n + (1 - (n + 1) / words >= OVERLAP)


def least_score(weight: np.ndarray, tf: np.ndarray, edits: int) -> float:
    """The least score of a text that so many edits make of the item.  A word goes
    when all its occurrences go, so its weight is dealt over them (a lower bound)."""
    order = np.argsort(-weight / tf)
    taken = np.clip(edits - (np.cumsum(tf[order]) - tf[order]), 0, tf[order])
    return 1 - float((weight[order] / tf[order] * taken).sum())


def build_index(items: list[tuple], df: dict, n_items: int, mean_words: float, whole: bool = False) -> Index:
    """``items``: (id, question, answer); ``df``: items that hold each term."""
    vocab: dict[bytes, int] = {}
    ids, questions, answers, rows, least = [], [], [], [], []
    longest = 1
    for item_id, question, answer in items:
        q, a = words_of(question), words_of(answer)
        if not q and not a:
            continue
        longest = max(longest, len(q) + len(a))
        uniq, tf = np.unique(np.array(q + a, dtype=object), return_counts=True)
        idf = np.array([math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) for w in uniq])
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * (len(q) + len(a)) / mean_words))
        weight = weight / weight.sum()  # 1 for a passage that holds every word
        for w, x in zip(uniq, weight.tolist()):
            rows.append((vocab.setdefault(w, len(vocab)), len(ids), x))
        least.append(least_score(weight, tf, edits_of(len(q) + len(a)) if whole else edits_of(len(q)) + edits_of(len(a))))
        ids.append(item_id)
        questions.append([vocab[w] for w in q])
        answers.append([vocab[w] for w in a])
    rows.sort()
    term = np.array([r[0] for r in rows], np.int64)
    item = np.array([r[1] for r in rows], np.int64)
    impact = np.array([r[2] for r in rows])
    block = item // BLOCK_ITEMS
    new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, np.int64)
    n = np.arange(len(vocab) + 1)
    index = Index(vocab, ids, questions, answers, 2 * math.ceil(longest / OVERLAP), np.searchsorted(term[new], n), block[new], new,
                  np.searchsorted(term, n), item, impact, np.array(least), whole)
    index.own = index.relative(index.least)
    return index


def _expand(ptr: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the query row, index of the posting) for all postings of the terms."""
    size = ptr[terms + 1] - ptr[terms]
    row = np.repeat(np.arange(len(terms)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + ptr[terms][row]
    return row, at


def retrieve(index: Index, docs: np.ndarray, places: np.ndarray, terms: np.ndarray, threshold: float | None = THRESHOLD):
    """(document, window, item, score) of every pair at or above the threshold (None: the item's own).

    ``docs``, ``places``, ``terms``: the indexed words of the documents in
    order.  Window k of a document covers places [k*h, k*h + 2h).
    """
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0),)
    if not len(docs):
        return none
    share, top, block_top = index.own if threshold is None else index.relative(threshold)
    h = index.passage // 2
    order = np.lexsort((places, terms, docs))
    same = np.r_[False, (docs[order][1:] == docs[order][:-1]) & (terms[order][1:] == terms[order][:-1])]
    before = np.full(len(docs), -1, np.int64)
    before[order[same]] = places[order[np.flatnonzero(same) - 1]]
    k = places // h
    # each word is in windows k and k-1; it counts where it comes up first
    wins = np.concatenate([k, k - 1])
    first = np.concatenate([before < k * h, (before < (k - 1) * h) & (k > 0)])
    d, t = np.tile(docs, 2)[first], np.tile(terms, 2)[first]
    width = int(k.max()) + 1
    key = d * width + wins[first]
    uniq, row = np.unique(key, return_inverse=True)
    bound = np.bincount(row, top[t], len(uniq))
    eps = 1e-9  # sums in another order
    live = (bound >= 1 - eps)[row]
    row, t = row[live], t[live]
    if not len(row):
        return none
    # block level
    n_blocks = int(index.blocks.max()) + 1
    q, at = _expand(index.block_ptr, t)
    pair, of = np.unique(row[q] * n_blocks + index.blocks[at], return_inverse=True)
    pair = pair[np.bincount(of, block_top[at], len(pair)) >= 1 - eps]
    # item level, in the blocks that are left
    alive = np.unique(pair // n_blocks)
    keep = np.isin(row, alive)
    q, at = _expand(index.item_ptr, t[keep])
    r, item = row[keep][q], index.items[at]
    ok = np.isin(r * n_blocks + item // BLOCK_ITEMS, pair)
    found, of = np.unique(r[ok] * len(index.item_ids) + item[ok], return_inverse=True)
    hit = np.bincount(of, share[at[ok]], len(found)) >= 1 - eps
    found, score = found[hit], np.bincount(of, index.impact[at[ok]], len(found))[hit]
    w = uniq[found // len(index.item_ids)]
    return w // width, w % width, found % len(index.item_ids), score


def overlap(side: list[int], passage: np.ndarray, exact: int = EXACT_WORDS) -> float:
    """1 - (fewest edits that turn the side into some run of the passage) / words."""
    m = len(side)
    if not m or not len(passage):
        return 1.0 if not m else 0.0
    run = np.lib.stride_tricks.sliding_window_view(passage, m) if len(passage) >= m else np.zeros((0, m))
    if (run == np.array(side)).all(axis=1).any():
        return 1.0
    if m < exact:
        return 0.0
    col = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)  # an occurrence may begin anywhere
    for i, w in enumerate(side, 1):
        up = np.minimum(row[:-1] + (passage != w), row[1:] + 1)
        full = np.r_[i, up]
        row = np.minimum.accumulate(full - col) + col  # words inserted by the passage
    return max(0.0, 1 - int(row.min()) / m)


_OUT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, place long"


def find(texts: list[str | None], ix: Index) -> dict[tuple[int, int], tuple]:
    """(text, item) -> (score, question overlap, answer overlap, first word) of the best passage."""
    coded = []
    for text in texts:
        ws = words_of(text)
        coded.append(np.fromiter((ix.vocab.get(w, -1) for w in ws), np.int64, len(ws)))
    sizes = np.array([len(c) for c in coded], np.int64)
    flat = np.concatenate(coded) if coded else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(coded)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    known, h = flat >= 0, ix.passage // 2
    best: dict[tuple[int, int], tuple] = {}
    for d, w, item, score in zip(*(x.tolist() for x in retrieve(ix, doc[known], place[known], flat[known], None))):
        passage = coded[d][w * h:w * h + 2 * h]
        q, a = overlap(ix.questions[item], passage), overlap(ix.answers[item], passage)
        sides = q >= OVERLAP and a >= OVERLAP
        if not sides and ix.whole and overlap(ix.questions[item] + ix.answers[item], passage) >= OVERLAP:
            sides, q, a = True, overlap(ix.questions[item], passage, 0), overlap(ix.answers[item], passage, 0)
        if sides:
            got = (score, q, a, -w * h)
            best[d, item] = max(best.get((d, item), got), got)
    return {k: (s, q, a, -p) for k, (s, q, a, p) in sorted(best.items())}


def index_parts(benchmark: DataFrame, item: str = "item_id", question: str = "text", answer: str | None = None) -> Iterator[Index]:
    """The index in parts, one for the usual benchmark; each is bounded by PART_WORDS."""
    reach_workers(benchmark.sparkSession)
    source = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(question).alias("question"),
                              (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer"))
    whole = answer is None

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pairs = [question_and_answer(q) if whole else (q or "", a or "") for q, a in zip(pdf["question"], pdf["answer"])]
            n = [len(words_of(q)) + len(words_of(a)) for q, a in pairs]
            yield pd.DataFrame({"item_id": pdf["item_id"], "question": [p[0] for p in pairs], "answer": [p[1] for p in pairs], "n": n})

    def terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for q, a, p in zip(pdf["question"], pdf["answer"], pdf["part"]):
                yield pd.DataFrame({"term": sorted(set(words_of(q) + words_of(a))), "part": p})

    items = written(source.mapInPandas(split, "item_id long, question string, answer string, n long").where("n > 0"), "items")
    n_items, n_words = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = math.ceil(n_words / PART_WORDS)
    if not parts:
        return
    part: Column = F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(parts))
    per = items.withColumn("part", part).mapInPandas(terms, "term binary, part long").groupBy("term", "part").agg(F.count(F.lit(1)).alias("n"))
    df = written(per.groupBy("term").agg(F.sum("n").alias("df"), F.collect_set("part").alias("parts")), "terms")
    for p in range(parts):
        mine = [tuple(r) for r in items.where(part == p).select("item_id", "question", "answer").collect()]
        of = {bytes(r["term"]): r["df"] for r in df.where(F.array_contains("parts", F.lit(p).cast("long"))).select("term", "df").collect()}
        if mine:
            yield build_index(mine, of, n_items, n_words / n_items, whole)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **columns: str) -> DataFrame:
    """One row per document and test item that it holds: the best passage's
    score, the verified overlaps and the passage's first word."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def search(index: Index) -> DataFrame:
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ("doc_id", "item_id", "score", "question_overlap", "answer_overlap", "place")
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
            for whole in batches:
                for batch in _slices(whole, "text", 2 << 20):
                    hits = find(batch.column("text").to_pylist(), held.value)
                    if hits:
                        ids = batch.column("doc_id").to_pylist()
                        out = zip(*((ids[d], held.value.item_ids[i], *rest) for (d, i), rest in hits.items()))
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=list(names))

        return rows.mapInArrow(run, _OUT)

    found = [search(index) for index in index_parts(benchmark, **columns)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], _OUT)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **columns: str) -> DataFrame:
    """The rows of ``docs`` that hold no test item, as they are; nothing is shuffled."""
    for index in index_parts(benchmark, **columns):
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in _slices(whole, text, 2 << 20):
                    stay = np.ones(batch.num_rows, bool)
                    stay[[d for d, _ in find(batch.column(text).to_pylist(), held.value)]] = False
                    yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs
