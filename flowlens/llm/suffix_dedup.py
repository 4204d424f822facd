"""Removal of repeated byte strings with per-shard suffix arrays.

Every byte that a string of ``length`` bytes covers which also starts
elsewhere (in any document, the same one included) is removed.

1. Routing.  A string of ``length`` bytes has a minimizer: the least hash of
   its ``GRAM``-byte substrings.  Equal strings have equal minimizers, so all
   places of a string meet under one key.  Neighbouring strings of a document
   with one minimizer are a run, and a run's bytes a segment.  A minimizer that
   comes up once has no repeated string (a run in which it comes up twice may
   repeat itself: periodic text).  Equal segments are one segment with
   a count; counted twice, all of it is repeated.
2. Shards.  Where a minimizer has different segments, their bytes go to the
   minimizer's shard: a suffix array by Larsson-Sadakane refinement, Kasai's
   common prefixes, and every start whose common prefix with a neighbour
   reaches ``length`` is repeated.
3. Merging.  A minimizer whose segments exceed ``HOT_BYTES`` is split over
   shards of its own.  Each lists its strings' digests in order; lists meet by
   digest range and binary search finds the strings that others hold too.

Cases: null and empty texts have no bytes; texts shorter than ``length`` are
never cut; repeated rows are documents of their own and remove each other
(where long enough); ids play no part; an empty table gives an empty result.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import by_id, reach_workers, written
from flowlens.llm.minhash import _powers, _utf8, mix

GRAM = 128
#: Bytes of a shard, about, and of a minimizer's segments beyond which it is split.
SHARD_BYTES = 2_000_000
HOT_BYTES = 1_000_000
#: Strings whose digests meet in one merging task, about.
MERGE_STRINGS = 1_000_000

_RUNS = "doc_id long, sha binary, n_bytes long, runs array<struct<fp:long,h:long,s:int,n:int,loops:boolean>>"
_MARKS = "fp long, h long, n int, lo array<int>, hi array<int>"
_SORTED = "fp long, shard long, bucket long, digests binary, h binary, n binary, at binary"


# --- runs of a document ---------------------------------------------------------

def _prefix(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(20, len(raw).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)]
    return sums, down


def _hashes(sums: np.ndarray, down: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sums[start + size] - sums[start]) * down[start] + np.asarray(size).astype(np.uint64))


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:-(width - span)], x[width - span:]) if width > span else x


def runs_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(document, start, strings, minimizer, segment hash, loops) of every run.

    ``loops``: the minimizer comes up twice in the run, so that the run may
    hold a string twice by itself (periodic text)."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    none = (np.zeros(0, np.int64),) * 5 + (np.zeros(0, bool),)
    if len(raw) < length:
        return none
    sums, down = _prefix(raw)
    gram = min(GRAM, length)
    width = length - gram + 1
    grams = _hashes(sums, down, np.arange(len(raw) - gram + 1), gram)
    least = _slide(grams, width, np.minimum)
    # a gram is a minimizer where the greatest minimum of the windows around it is itself
    low = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_slide(np.r_[low, least, low], width, np.maximum) == grams)
    start = np.arange(len(least))
    doc = np.searchsorted(ends, start, side="right")
    inside = start + length <= ends[np.minimum(doc, len(ends) - 1)]
    start, doc, least = start[inside], doc[inside], least[inside]
    if not len(start):
        return none
    new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
    n = np.diff(np.r_[new, len(start)])
    s = start[new]
    h = _hashes(sums, down, s, n + length - 1)
    loops = n > width
    order = np.lexsort((chosen, grams[chosen]))
    p, v = chosen[order], grams[chosen][order]
    twin = np.flatnonzero((v[1:] == v[:-1]) & (p[1:] - p[:-1] < width))
    at = np.searchsorted(start, p[twin + 1] - width + 1)  # the first window with both
    ok = (at < len(start)) & (start[np.minimum(at, len(start) - 1)] <= p[twin])
    run = np.searchsorted(new, at[ok], side="right") - 1
    loops[run[least[new[run]] == v[twin][ok]]] = True
    begin = np.r_[0, ends[:-1]][doc[new]]
    return doc[new], s - begin, n, least[new].astype(np.int64), h.astype(np.int64), loops


# --- one shard ---------------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols 0..256 by Larsson-Sadakane refinement: suffixes
    in groups of equal prefixes, of which only unsorted ones are sorted again,
    by the group of the suffix as far ahead as the prefix is long."""
    n = len(text)
    key = np.zeros(n, np.int64)
    for k in range(7):  # 7 symbols of 9 bits at first; 0 is past the end
        part = np.zeros(n, np.int64)
        part[:max(n - k, 0)] = text[k:].astype(np.int64) + 1
        key = (key << 9) | part
    sa = np.argsort(key, kind="stable")
    first = np.r_[True, key[sa][1:] != key[sa][:-1]] if n else np.zeros(0, bool)
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    rank = np.empty(n + 1, np.int64)
    rank[sa] = group
    rank[n] = -1
    depth = 7
    while True:
        # places in the array whose group has more than one suffix
        open_ = np.flatnonzero(~(first & np.r_[first[1:], True])) if n else np.zeros(0, np.int64)
        if not len(open_):
            return sa
        pos = sa[open_]
        key = group[open_] * (n + 1) + rank[np.minimum(pos + depth, n)] + 1
        order = np.argsort(key, kind="stable")
        key, pos = key[order], pos[order]
        sa[open_] = pos
        new = np.r_[True, key[1:] != key[:-1]]
        first[open_] = new
        group[open_] = np.maximum.accumulate(np.where(new, open_, 0))
        rank[pos] = group[open_]
        depth *= 2


def kasai(text: np.ndarray, sa: np.ndarray, cap: int, lanes: int = 2048) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array, up to
    ``cap``.  The text is cut into lanes that go through their positions
    together; each carries its prefix length on, less one, as Kasai does."""
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    padded = np.r_[text.astype(np.uint16), np.full(cap + 8, 300, np.uint16)]
    words = np.zeros(n + cap, np.uint64)  # four symbols each
    for k in range(4):
        words |= padded[k:k + n + cap].astype(np.uint64) << np.uint64(16 * k)
    out = np.zeros(n, np.int64)
    size = -(-n // lanes)
    lane = np.arange(0, n, max(size, 1))
    h = np.zeros(len(lane), np.int64)
    for step in range(size):
        i = lane + step
        live = i < np.minimum(lane + size, n)
        i, j = i[live], phi[i[live]]
        g = np.where(j >= 0, np.maximum(h[live] - 1, 0), 0)
        go = np.flatnonzero(j >= 0)
        while len(go):  # four symbols at a time
            a, b = i[go] + g[go], j[go] + g[go]
            diff = words[a] ^ words[b]
            same = np.where(diff == 0, 4, (diff & np.uint64(0xFFFF) == 0).astype(np.int64) * (
                1 + (diff & np.uint64(0xFFFF0000) == 0) * (1 + (diff & np.uint64(0xFFFF00000000) == 0))))
            g[go] = np.minimum(g[go] + same, np.minimum(cap, n - np.maximum(i[go], j[go])))
            go = go[(same == 4) & (g[go] < np.minimum(cap, n - np.maximum(i[go], j[go])))]
        out[i] = g
        h[live] = g
    return out


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, which of its strings come up again in any of them."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    text = np.full(int(sizes.sum()) + len(segments), 256, np.uint16)  # a separator ends each
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    for a, seg in zip(begins.tolist(), segments):
        text[a:a + len(seg)] = np.frombuffer(seg, np.uint8)
    sa = suffix_array(text)
    lcp = kasai(text, sa, length)
    hit = np.zeros(len(text), bool)
    long = np.flatnonzero(lcp[sa] >= length)  # with the suffix before
    hit[sa[long]] = True
    hit[sa[long - 1]] = True
    return [hit[a:a + max(n - length + 1, 0)] for a, n in zip(begins.tolist(), sizes.tolist())]


def _intervals(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


# --- the operator ---------------------------------------------------------------

def _tid(sha):
    """96 bits of a text's SHA-256: the text's name in narrow tables."""
    return F.substring(sha, 1, 12)


def _sketch(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("fp", pa.int64()), ("h", pa.int64()), ("s", pa.int32()), ("n", pa.int32()), ("loops", pa.bool_())])
        for whole in batches:
            for batch in _slices(whole, "text", 1 << 20):
                texts = _utf8(batch.column("text"))
                doc, s, n, fp, h, loops = runs_of(texts, length)
                cols = [pa.array(fp), pa.array(h), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(loops)]
                flat = pa.StructArray.from_arrays(cols, fields=list(kind))
                cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                     pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(cuts), flat)],
                    names=["doc_id", "sha", "n_bytes", "runs"])

    return docs.mapInArrow(run, _RUNS)


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """The segments' bytes of texts with a list of (s, n, fp, h, shard, hot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "text", 1 << 20):
                out: list = []
                for raw, want in zip(_utf8(batch.column("text")), batch.column("want").to_pylist()):
                    out += [(w["shard"], w["hot"], w["fp"], w["h"], w["n"], raw[w["s"]:w["s"] + w["n"] + length - 1]) for w in want]
                if out:
                    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                     names=["shard", "hot", "fp", "h", "n", "bytes"])

    return rows.mapInArrow(run, "shard long, hot boolean, fp long, h long, n int, bytes binary")


def _search_shards(segments: DataFrame, length: int) -> DataFrame:
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        hits = repeated_starts([bytes(b) for b in pdf["bytes"]], length)
        spans = [_intervals(x) for x in hits]
        out = pd.DataFrame({"fp": pdf["fp"], "h": pdf["h"], "n": pdf["n"], "lo": [a for a, _ in spans], "hi": [b for _, b in spans]})
        return out[[len(a) > 0 for a, _ in spans]].astype({"lo": object, "hi": object})

    return segments.groupBy("shard").applyInPandas(one, _MARKS)


def _merge_shards(segments: DataFrame, length: int, buckets: int) -> DataFrame:
    """Strings that several shards of a split minimizer hold."""
    def listed(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for fp, group in pdf.groupby("fp"):
            digests, hs, ns, at = [], [], [], []
            for h, n, raw in zip(group["h"], group["n"], group["bytes"]):
                sums, down = _prefix(np.frombuffer(raw, np.uint8))
                digests.append(_hashes(sums, down, np.arange(n), length))
                hs.append(np.full(n, h))
                ns.append(np.full(n, n, np.int32))
                at.append(np.arange(n, dtype=np.int32))
            d, hs, ns, at = (np.concatenate(x) for x in (digests, hs, ns, at))
            order = np.argsort(d)
            d, hs, ns, at = d[order], hs[order], ns[order], at[order]
            part = (d >> np.uint64(32)).astype(np.int64) * buckets >> 32  # a range of digests
            cuts = np.searchsorted(part, np.arange(buckets + 1))
            out += [{"fp": fp, "shard": pdf["shard"].iloc[0], "bucket": b, "digests": d[x:y].tobytes(), "h": hs[x:y].tobytes(),
                     "n": ns[x:y].tobytes(), "at": at[x:y].tobytes()} for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        return pd.DataFrame(out, columns=["fp", "shard", "bucket", "digests", "h", "n", "at"])

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [np.frombuffer(x, np.uint64) for x in pdf["digests"]]
        distinct = [np.unique(x) for x in lists]
        every, held = np.unique(np.concatenate(distinct), return_counts=True)
        shared = every[held > 1]  # sorted, as the lists are
        out = []
        for digests, h, n, at in zip(lists, pdf["h"], pdf["n"], pdf["at"]):
            place = np.searchsorted(shared, digests)
            hit = np.zeros(len(digests), bool)
            hit[place < len(shared)] = shared[place[place < len(shared)]] == digests[place < len(shared)]
            out.append(pd.DataFrame({"fp": pdf["fp"].iloc[0], "h": np.frombuffer(h, np.int64)[hit], "n": np.frombuffer(n, np.int32)[hit],
                                     "at": np.frombuffer(at, np.int32)[hit]}))
        found = [(*k, x.tolist()) for k, x in pd.concat(out).groupby(["fp", "h", "n"])["at"]]
        return pd.DataFrame(found, columns=["fp", "h", "n", "at"]).astype({"fp": "int64", "h": "int64", "n": "int32", "at": object})

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            spans = []
            for at in pdf["at"]:  # a segment's starts, neighbours from whichever bucket
                at = np.unique(np.concatenate(list(at)))
                cut = np.flatnonzero(np.diff(at) > 1)
                spans.append((at[np.r_[0, cut + 1]].tolist(), at[np.r_[cut, len(at) - 1]].tolist()))
            out = pdf[["fp", "h", "n"]].assign(lo=[x for x, _ in spans], hi=[y for _, y in spans])
            yield out.astype({"lo": object, "hi": object})

    lists = segments.groupBy("shard").applyInPandas(listed, _SORTED)
    starts = lists.groupBy("fp", "bucket").applyInPandas(met, "fp long, h long, n int, at array<int>")
    # starts become intervals before anything is done row by row; a group is one segment's
    return starts.groupBy("fp", "h", "n").agg(F.collect_list("at").alias("at")).mapInPandas(merged, _MARKS)


def _removed(rows: DataFrame, length: int) -> DataFrame:
    """What is left of texts with their covered intervals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "text", 1 << 20):
                out = []
                for raw, cover in zip(_utf8(batch.column("text")), batch.column("cover").to_pylist()):
                    edge = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(edge, [c["a"] for c in cover], 1)
                    np.add.at(edge, [c["b"] for c in cover], -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((int(gone.sum()), len(_intervals(gone)[0]), hashlib.sha256(left).hexdigest(), left))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("tid"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                     pa.array(cols[3], pa.binary())], names=["tid", "n_removed", "n_spans", "kept_sha256", "kept"])

    return rows.mapInArrow(run, "tid binary, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _one_text(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """tid, text of one document of each text named in ``ids``."""
    named = docs.withColumn("tid", _tid(F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))))
    return by_id(named.select("tid", "text"), ids, "left_semi", "tid").groupBy("tid").agg(F.first("text").alias("text"))


def remove_repeats(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, texts).

    documents: doc_id, tid, n_bytes, n_removed, n_spans, kept_sha256 of every
    row.  texts: tid, kept (the remaining bytes) of every text that was cut.
    """
    reach_workers(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = written(_sketch(docs, length), "runs")
    runs = base.select(_tid("sha").alias("tid"), F.explode("runs").alias("r")).select("tid", "r.*")
    shape = F.struct("h", "n")
    twice = (runs.groupBy("fp").agg(F.count(F.lit(1)).alias("c"), F.min(shape).alias("x"), F.max(shape).alias("y"), F.max("loops").alias("loops"))
             .where("c > 1 OR loops").select("fp", (F.col("loops") | (F.col("x") != F.col("y"))).alias("mixed")))
    places = written(runs.join(written(twice, "minimizers"), "fp").groupBy("tid", "s", "fp", "h", "n", "mixed")
                     .agg(F.count(F.lit(1)).alias("c")), "places")

    segments = written(places.groupBy("fp", "h", "n", "mixed").agg(F.sum("c").alias("c"), F.min(F.struct("tid", "s")).alias("at")), "segments")
    full = segments.where("c > 1").select("fp", "h", "n", F.array(F.lit(0)).alias("lo"), F.array(F.col("n") - 1).alias("hi"))
    size = F.col("n") + (length - 1)
    mixed = segments.where("mixed")
    total = mixed.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / SHARD_BYTES))
    hot = mixed.groupBy("fp").agg(F.sum(size).alias("b")).where(F.col("b") > HOT_BYTES)
    hot = written(hot.select("fp", F.ceil(F.col("b") / HOT_BYTES).alias("pieces")), "hot")
    any_hot = hot.agg(F.sum("pieces")).first()[0] or 0
    own = F.pmod(F.xxhash64("fp"), F.lit(shards))
    apart = F.xxhash64("fp", F.pmod(F.xxhash64("h", "n"), F.col("pieces")))
    routed = mixed.join(hot, "fp", "left").select(
        F.col("at.tid").alias("tid"), F.struct(F.col("at.s").alias("s"), "n", "fp", "h", F.when(F.col("pieces").isNull(), own).otherwise(apart).alias("shard"),
                                               F.col("pieces").isNotNull().alias("hot")).alias("w"))
    wanted = written(routed.groupBy("tid").agg(F.collect_list("w").alias("want")), "wanted")  # a document's own
    cut = written(_cut(_one_text(docs, wanted).join(wanted, "tid"), length), "cut")
    # a number of partitions of its own: shards are even, and AQE shall not gather them
    marks = _search_shards(cut.repartition(shards + int(any_hot), "shard"), length)
    if any_hot:
        strings = cut.where("hot").agg(F.sum("n")).first()[0]
        marks = marks.unionByName(_merge_shards(cut.where("hot"), length, max(1, math.ceil(strings / MERGE_STRINGS))))
    marks = marks.unionByName(full)

    spans = marks.select("fp", "h", "n", F.explode(F.arrays_zip("lo", "hi")).alias("v")).select("fp", "h", "n", "v.lo", "v.hi")
    cover = places.join(spans, ["fp", "h", "n"]).select("tid", F.struct((F.col("s") + F.col("lo")).alias("a"),
                                                                       (F.col("s") + F.col("hi") + length).alias("b")).alias("c"))
    cover = written(cover.groupBy("tid").agg(F.collect_set("c").alias("cover")), "cover")
    left = written(_removed(_one_text(docs, cover).join(cover, "tid"), length), "left")
    out = base.select("doc_id", _tid("sha").alias("tid"), "n_bytes", "sha").join(left.drop("kept"), "tid", "left").select(
        "doc_id", "tid", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"))
    return out, left.select("tid", "kept")
