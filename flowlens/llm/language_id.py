"""Language identification of mixed text, word by word.

Training counts the character n-grams (one to four, with word borders) of
labelled texts per language, and the scripts each language is written in.  A
word's score for a language is the mean log probability of its n-grams times
its letters; only the languages whose training text uses the word's script
are candidates.  Viterbi over the words, with a penalty for each switch,
labels spans of one language; the document's language is the one that covers
the most letters.

The model is fitted on at most ``per_language`` labelled texts of each
language, small hashes of the id first: a bounded, documented sample.  Prediction reads every whole text and nothing else.

Cases: null text, empty text or text without a letter: ``und``, score 0, no
span.  A script that no language is written in: all languages stay
candidates.  No labelled row: every text is ``und``.  Ties go to the language
that sorts first.  Repeated rows are predicted alike.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import lean, reach_workers

UND = "und"
#: Labelled texts of each language that the model is fitted on, at most.
PER_LANGUAGE = 1_000
#: Rows of the hashed n-gram table.
TABLE = 1 << 18
#: Log-odds that a switch of language must earn.
SWITCH = 12.0
#: Words whose scores a worker remembers; it starts anew beyond that.
MEMO_WORDS = 150_000
#: Words whose n-grams are in memory together.
WORDS_AT_ONCE = 8_192
#: Share of a language's letters that makes a script one of its own.
SCRIPT_SHARE = 0.02

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
#: First code points of script ranges (fixed values, in order) and their names.
_SCRIPTS = [(0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
            (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
            (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1E00, "latin"),
            (0x1F00, "greek"), (0x2C00, "other"), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"),
            (0xD7B0, "han"), (0xFB50, "arabic"), (0xFF00, "other"), (0x20000, "han")]
_STARTS = np.array([a for a, _ in _SCRIPTS])
_NAMES = sorted({n for _, n in _SCRIPTS} | {"other"})


def script_of(word: str) -> int:
    """Index of the script of the word's first letter."""
    at = int(np.searchsorted(_STARTS, ord(word[0]), side="right")) - 1
    return _NAMES.index(_SCRIPTS[at][1] if at >= 0 else "other")


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(table row of each n-gram, index of its word) for lower-cased words."""
    text = " " + "  ".join(words) + " "
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    rows, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, 5):
            if n > 1:
                h = h[:-1]
            if len(h) == 0:
                break
            h = h * np.uint64(0x100000001B3) + codes[n - 1:]
            inside = owner[: len(h)] == owner[n - 1:]
            x = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            rows.append((x[inside] >> np.uint64(40)).astype(np.int64) % TABLE)
            owners.append(owner[: len(h)][inside])
    return np.concatenate(rows), np.concatenate(owners)


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # (TABLE, languages) float32
    allowed: np.ndarray  # (scripts, languages) bool
    memo: dict = field(default_factory=dict, repr=False)
    scores: np.ndarray = field(default=None, repr=False)
    letters: np.ndarray = field(default=None, repr=False)

    def __getstate__(self):
        return {"languages": self.languages, "logp": self.logp, "allowed": self.allowed, "memo": {}, "scores": None, "letters": None}

    def _learn_words(self, words: list[str]) -> None:
        """Scores of new words: a row each in a table that grows by doubling."""
        lower = [w.lower() for w in words]
        rows, owner = _grams(lower)
        n, k = len(words), len(self.languages)
        count = np.bincount(owner, minlength=n)
        total = np.stack([np.bincount(owner, self.logp[rows, j], n) for j in range(k)], axis=1)
        # the word pattern also lets through numerals such as superscripts: no letters
        letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words], np.float64)
        score = total / count[:, None] * letters[:, None]
        scripts = np.fromiter(map(script_of, words), np.int64, n)
        allowed = self.allowed[scripts]
        allowed[~allowed.any(axis=1)] = True
        score = np.where(allowed, score, -1e6)
        base = len(self.memo)
        if self.scores is None:
            self.scores, self.letters = np.zeros((1024, k), np.float32), np.zeros(1024)
        while base + n > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.scores[base:base + n] = score
        self.letters[base:base + n] = letters
        self.memo.update(zip(words, range(base, base + n)))

    def forget(self) -> None:
        """Drop the remembered words: a worker keeps its broadcasts after a task."""
        self.memo.clear()
        self.scores = self.letters = None

    def word_rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = list(set().union(*texts).difference(self.memo)) if texts else []
        new.sort()
        for a in range(0, len(new), WORDS_AT_ONCE):  # n-grams take a hundred times a word's memory
            self._learn_words(new[a:a + WORDS_AT_ONCE])
        get = self.memo.__getitem__
        return [np.fromiter(map(get, t), np.int64, len(t)) for t in texts]

    def label_words(self, texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(language index, letters) of each word: Viterbi over all texts
        together, one position of every text at a time."""
        rows = self.word_rows(texts)
        sizes = np.array([len(r) for r in rows], np.int64)
        order = np.argsort(-sizes, kind="stable")
        top = int(sizes.max(initial=0))
        k = len(self.languages)
        if not top:
            return [(np.zeros(0, np.int16), np.zeros(0)) for _ in texts]
        # position-major layout: the texts that are still open at a step lie together
        live = np.searchsorted(-sizes[order], -np.arange(top), side="left")
        base = np.concatenate([[0], np.cumsum(live)])
        flat = np.zeros(int(base[-1]), np.int64)
        for lane, i in enumerate(order.tolist()):
            flat[base[:sizes[i]] + lane] = rows[i]
        emit = self.scores[flat]
        came = np.zeros(len(flat), np.int16)  # best language before the step
        stays = np.ones((len(flat), k), bool)
        best = np.zeros((len(order), k))
        final = np.zeros((len(order), k))
        for t in range(top):
            a, b = base[t], base[t + 1]
            n = b - a
            now = best[:n]
            if t:
                lead = now.argmax(axis=1)
                jump = now[np.arange(n), lead] - SWITCH
                came[a:b] = lead
                keep = now >= jump[:, None]
                stays[a:b] = keep
                now = np.where(keep, now, jump[:, None])
            best[:n] = now + emit[a:b]
            nxt = base[t + 2] - base[t + 1] if t + 1 < top else 0
            final[nxt:n] = best[nxt:n]
        out = np.zeros(len(flat), np.int16)
        state = np.zeros(len(order), np.int64)
        for t in range(top - 1, -1, -1):
            a, b = base[t], base[t + 1]
            n = b - a
            nxt = base[t + 2] - base[t + 1] if t + 1 < top else 0
            state[nxt:n] = final[nxt:n].argmax(axis=1)
            if nxt:  # texts that go on: step back over the switch
                c, d = base[t + 1], base[t + 2]
                stay = stays[np.arange(c, d), state[:nxt]]
                state[:nxt] = np.where(stay, state[:nxt], came[c:d])
            out[a:b] = state[:n]
        labels: list = [None] * len(texts)
        for lane, i in enumerate(order.tolist()):
            labels[i] = out[base[:sizes[i]] + lane], self.letters[rows[i]] if sizes[i] else np.zeros(0)
        return labels


def train(docs: DataFrame, chosen: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the labelled rows for which ``chosen`` holds.

    Counts are made by Spark from the sample's n-gram tables; what comes to
    the driver is one table row per language and hashed n-gram at most.
    """
    reach_workers(docs.sparkSession)
    w = Window.partitionBy("lang").orderBy("at", "doc_id")
    rows = docs.where(chosen & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(key).cast("string").alias("doc_id"), F.xxhash64(F.col(key).cast("string")).alias("at"))
    # first within pieces of the hash range, so that no task ranks a whole language
    pieces = Window.partitionBy("lang", F.pmod("at", F.lit(256))).orderBy("at", "doc_id")
    few = rows.withColumn("rank", F.row_number().over(pieces)).where(F.col("rank") <= math.ceil(per_language / 32))
    ids = few.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= per_language)
    ids = ids.select(F.col("doc_id").alias("__id")).distinct()
    labelled = docs.where(chosen & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sample = labelled.join(F.broadcast(ids), labelled[key].cast("string") == ids["__id"], "left_semi").select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang_, group in pdf.groupby("lang"):
                words = [w.lower() for t in group["text"] for w in _WORD.findall(t)]
                if not words:
                    continue
                uniq, n = np.unique(np.array(words, dtype=object), return_counts=True)
                c = np.zeros(TABLE)
                for a in range(0, len(uniq), WORDS_AT_ONCE):
                    table, owner = _grams(list(uniq[a:a + WORDS_AT_ONCE]))
                    c += np.bincount(table, n[a:a + WORDS_AT_ONCE][owner], TABLE)
                at = np.flatnonzero(c)
                yield pd.DataFrame({"lang": lang_, "kind": 0, "row": at, "n": c[at].astype(np.int64)})
                s = np.bincount([script_of(w) for w in uniq], n * np.array([len(w) for w in uniq]), len(_NAMES))
                yield pd.DataFrame({"lang": lang_, "kind": 1, "row": np.arange(len(_NAMES)), "n": s.astype(np.int64)})

    counts = (sample.mapInPandas(count, "lang string, kind int, row long, n long")
              .groupBy("lang", "kind", "row").agg(F.sum("n").alias("n")).toArrow().to_pandas())
    languages = sorted(counts["lang"].unique())
    logp = np.zeros((TABLE, len(languages)), np.float32)
    allowed = np.zeros((len(_NAMES), len(languages)), bool)
    for j, name in enumerate(languages):
        mine = counts[counts["lang"] == name]
        grams, scripts = mine[mine["kind"] == 0], mine[mine["kind"] == 1]
        c = np.zeros(TABLE)
        c[grams["row"]] = grams["n"]
        logp[:, j] = np.log((c + 0.1) / (c.sum() + 0.1 * TABLE))
        s = np.zeros(len(_NAMES))
        s[scripts["row"]] = scripts["n"]
        allowed[:, j] = s >= SCRIPT_SHARE * max(s.sum(), 1)
    return Model(languages, logp, allowed)


def predict(docs: DataFrame, model: Model, text: str = "text", spans: bool = False, keep_text: bool = False,
            out: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """``docs`` with the language and its share of the letters, and with
    ``spans`` the list of (start word, words, language) spans; without the text
    unless ``keep_text``.  ``out`` names the new columns, which replace any of
    those names."""
    reach_workers(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # languages x TABLE floats
    others = [f for f in docs.schema.fields if f.name not in out and (keep_text or f.name != text)]
    names = [f.name for f in others]
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("words", T.IntegerType()),
                                     T.StructField("lang", T.StringType())]))
    schema = T.StructType([*others, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType()),
                           *([T.StructField(out[2], span)] if spans else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        k = len(m.languages)
        for whole in batches:
            for batch in _slices(whole, text, 2 << 20):
                words = [_WORD.findall(t) if t else [] for t in batch.column(text).to_pylist()]
                labels = m.label_words(words) if k else [(np.zeros(0, np.int16), np.zeros(0))] * len(words)
                pred, score, runs = [], [], []
                for lab, sizes in labels:
                    if not sizes.any():
                        pred.append(UND)
                        score.append(0.0)
                        runs.append([])
                        continue
                    letters = np.bincount(lab, sizes, k)
                    j = int(letters.argmax())
                    pred.append(m.languages[j])
                    score.append(float(letters[j] / letters.sum()))
                    if spans:
                        cut = np.flatnonzero(np.r_[True, lab[1:] != lab[:-1]])
                        size = np.diff(np.r_[cut, len(lab)])
                        runs.append([{"start": int(a), "words": int(n), "lang": m.languages[lab[a]]} for a, n in zip(cut, size)])
                cols = [*(batch.column(n) for n in names), pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                if spans:
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
                    cols.append(pa.array(runs, kind))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)
        m.forget()

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(lean(run), schema)
