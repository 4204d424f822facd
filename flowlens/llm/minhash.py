"""Near-duplicates by circulant MinHash, banding and exact Jaccard.

A document's set holds the hashes of its distinct word shingles.  One
permutation shuffles the shingles, a second one is shifted circularly by k
for coordinate k, so two permutations generate every coordinate of the
signature.  Bands of coordinates are the buckets in which candidates meet.

Documents with one set are one class, which goes on as a number.  In a
bucket every member is verified against the bucket's hub, the member that
meets most others over all bands; those that the links of all buckets join to
the hub are settled.  The others are queries against all members of their
buckets that are not joined to them yet.  Sets that are linked share one of
their rarest shingles, and from its places in the two sets it follows how many
they can share at most; queries meet only members that pass this prefix
filter, and those pairs are verified too.  So no bucket is expanded into its
pairs, and a linked pair of candidates is left out only if other links join
the two.  Two texts under one id are two classes, which that id joins.

Cases: null or empty text, or text without words: an empty set, linked with
nothing.  Fewer words than a shingle: the whole sequence is the one shingle.
A null id takes no part in links; its component is null and it is kept.
Repeated rows share class and component.  An empty table gives an empty
result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import by_id, lean, reach_workers, remembers, written
from flowlens.llm.graph import components

BANDS, ROWS = 32, 5  # a pair at Jaccard 0.8 is missed with probability 3e-6
_BASE = 0x100000001B3 | (0x9E37 << 44)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_SHINGLE = np.random.default_rng(2024).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    x = x + np.uint64(salt)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE % (1 << 64), np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)])
    return up, down


remembers("minhash", _powers.cache_clear)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word, words) of each text, A-Z in lower case.

    Words are cut and hashed for the whole list at once: a word's hash is a
    difference of prefix sums of byte * BASE^place, moved back to place 0.
    """
    text = b" ".join(texts).lower() + b" "
    raw = np.frombuffer(text, np.uint8)
    ends_of = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    white = _WHITE[raw]
    first = np.flatnonzero(~white & np.r_[True, white[:-1]])
    last = np.flatnonzero(white & np.r_[False, ~white[:-1]])
    size = 1 << max(20, int(len(raw)).bit_length())
    up, down = _powers(size)
    with np.errstate(over="ignore"):
        sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)
        upto = sums[last - 1] - np.where(first > 0, sums[np.maximum(first, 1) - 1], np.uint64(0))
        words = mix(upto * down[first] + (last - first).astype(np.uint64))
        bounds = np.searchsorted(first, ends_of)
    starts = np.r_[0, bounds[:-1]].astype(np.int64)
    return words, starts, bounds - starts


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingle hashes of each text."""
    words, starts, count = word_hashes(texts)
    with np.errstate(over="ignore"):
        owner = np.repeat(np.arange(len(texts)), count)
        k = max(len(words) - n + 1, 0)
        shingles = np.zeros(k, np.uint64)
        for j in range(n):
            shingles += words[j:j + k] * _SHINGLE[j]
        inside = owner[:k] == owner[n - 1:n - 1 + k] if k else np.zeros(0, bool)
        values, of = mix(shingles[inside], n), owner[:k][inside]
        few = np.flatnonzero((count > 0) & (count < n))
        if len(few):
            whole = np.zeros(len(few), np.uint64)
            for j in range(n - 1):
                has = count[few] > j
                whole[has] += words[starts[few[has]] + j] * _SHINGLE[j]
            values, of = np.r_[values, mix(whole, 0) ^ count[few].astype(np.uint64)], np.r_[of, few]
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.r_[True, (values[1:] != values[:-1]) | (of[1:] != of[:-1])] if len(values) else np.zeros(0, bool)
    values, of = values[new], of[new]
    return values, np.searchsorted(of, np.arange(len(texts) + 1))


def signatures(values: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """(texts with a set, coordinates) circulant MinHash signatures."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), coordinates), np.uint64)
    with np.errstate(over="ignore"):
        moved = mix(values, 0x5851F42D4C957F2D)  # the first permutation
        step = 1 << 14
        a = 0
        while a < len(starts):  # runs of texts that fit the cache
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + step)))
            end = starts[b] if b < len(starts) else len(values)
            part, cut = moved[starts[a]:end], starts[a:b] - starts[a]
            for k in range(coordinates):  # the second one, shifted circularly by k
                out[a:b, k] = np.minimum.reduceat(mix(part, -k % (1 << 64)), cut)
            a = b
    return out


def _utf8(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _set_id(items: bytes) -> bytes:
    return hashlib.blake2b(items, digest_size=16).digest()


def sketched(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_id (a digest of the whole set), bands."""
    reach_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "text", 1 << 20):
                values, offsets = shingle_sets(_utf8(batch.column("text")), n)
                sizes = np.diff(offsets)
                sets = [_set_id(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
                sig = signatures(values, offsets, bands * rows).reshape(-1, bands, rows)
                with np.errstate(over="ignore"):
                    keys = np.zeros(sig.shape[:2], np.uint64)
                    for j in range(rows):
                        keys = mix(keys + sig[:, :, j], j + 1)
                    keys = mix(keys + np.arange(bands, dtype=np.uint64)[None, :], 99)
                flat = pa.array(keys.astype(np.int64).ravel())
                ends = np.r_[0, np.cumsum(np.where(sizes > 0, bands, 0))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(sets, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "n_shingles", "set_id", "bands"])

    rows_ = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows_.mapInArrow(lean(run, "minhash"), "doc_id long, n_shingles long, set_id binary, bands array<long>")


def _sets(docs: DataFrame, classes: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """node, items (the whole set as sorted 64-bit hashes) of the given classes (node, rep, set_id).

    The text is read again by the class's smallest id and known by its set, so
    two texts under one id are told apart.
    """
    # few ids are broadcast behind a count and the texts stay where they are
    rows = by_id(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")),
                 written(classes.select(F.col("rep").alias("doc_id")).distinct(), "reps"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "text", 1 << 20):
                values, offsets = shingle_sets(_utf8(batch.column("text")), n)
                items = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([_set_id(x) for x in items], pa.binary()), pa.array(items, pa.binary())],
                                                 names=["set_id", "items"])

    found = rows.mapInArrow(lean(run, "minhash"), "set_id binary, items binary").join(classes.select("set_id", "node"), "set_id")
    return found.select("node", "items").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """u, v, shared, total, linked for distinct pairs (u, v)."""
    a = sets.select(F.col("node").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("items").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "a", 8 << 20):
                shared, total = [], []
                for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    shared.append(common)
                    total.append(len(x) + len(y) - common)
                yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                                                 names=["u", "v", "shared", "total"])

    out = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(lean(run), "u long, v long, shared long, total long")
    return out.withColumn("linked", F.col("shared") * 100 >= F.col("total") * percent)


#: Slots of the table of shingle counts that orders the prefix filter.
COUNT_SLOTS = 1 << 18


def _size_classes() -> np.ndarray:
    """The smallest size of each class; sizes in a class differ by 2 % at most."""
    out = [1]
    while out[-1] < 1 << 31:
        out.append(max(out[-1] + 1, int(out[-1] * 1.02)))
    return np.array(out, np.int64)


_CLASSES = _size_classes()


#: Prefix rows that a worker sends together.
PREFIX_ROWS = 1 << 16


def prefix_rows(sets: list[np.ndarray], ask: list[bool], counts: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(set, side, shingle, class of the partner's or own size, place, size), run by run.

    Shingles are in one order, the rare first; places count from 1.  Linked
    sets of sizes x <= y share p(x+y)/(100+p) shingles, so the first shared one
    stands at most at x - that + 1 and y - that + 1.  Sides: 0 the smaller and
    1 the larger set under its own size class; 2 a query as the larger and 3 as
    the smaller one, under every class that a partner's size can have.
    """
    def need(x, y):
        return -(-percent * (x + y) // (100 + percent))

    for k, (items, asks) in enumerate(zip(sets, ask)):
        n = len(items)
        items = items[np.lexsort((items, counts[(items % np.uint64(COUNT_SLOTS)).astype(np.int64)]))]
        least, most = -(-percent * n // 100), 100 * n // percent
        own = int(np.searchsorted(_CLASSES, n, side="right")) - 1
        spans = [(0, own, n - need(n, n) + 1), (1, own, n - need(least, n) + 1)]
        if asks:
            low = int(np.searchsorted(_CLASSES, least, side="right")) - 1
            high = int(np.searchsorted(_CLASSES, most, side="right")) - 1
            spans += [(2, c, n - need(max(int(_CLASSES[c]), least), n) + 1) for c in range(low, own + 1)]
            spans += [(3, c, n - need(n, max(int(_CLASSES[c]), n)) + 1) for c in range(own, high + 1)]
        for side, c, m in spans:
            for a in range(0, min(n, m), PREFIX_ROWS):  # a very long set's rows go in several runs
                b = min(n, m, a + PREFIX_ROWS)
                same = np.ones(b - a, np.int64)
                yield same * k, same * side, items[a:b].view(np.int64), same * c, np.arange(a + 1, b + 1), same * n


_PARITY = [f"p{k}" for k in range(8)]


def parities(items: np.ndarray) -> np.ndarray:
    """For 512 classes of shingles, whether the set has an odd number: 8 words."""
    odd = np.bincount((items >> np.uint64(55)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (u, v) of a query and a set of another component that pass the
    prefix filter; ``sets``: node, comp, ask, items."""
    spark = sets.sparkSession
    sets = written(sets, "asked-sets")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(COUNT_SLOTS, np.int64)
        for batch in batches:
            for x in batch.column("items").to_pylist():
                n += np.bincount((np.frombuffer(x, np.uint64) % np.uint64(COUNT_SLOTS)).astype(np.int64), minlength=COUNT_SLOTS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["slot", "n"])

    # COUNT_SLOTS rows at most come to the driver; the order is right with any counts, and selective with these
    seen = sets.select("items").mapInArrow(lean(count), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNT_SLOTS, np.int64)
    counts[seen["slot"].to_numpy()] = seen["n"].to_numpy()
    held = spark.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["side", "token", "class", "place", "size", "node", "comp", *_PARITY]
        for whole in batches:
            for batch in _slices(whole, "items", 1 << 20):
                items = [np.frombuffer(x, np.uint64) for x in batch.column("items").to_pylist()]
                of_set = [batch.column("node").to_numpy(), batch.column("comp").to_numpy(), *np.stack([parities(x) for x in items]).T]

                def together(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
                    k, *cols = (np.concatenate(c) for c in zip(*parts))
                    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (*cols, *(c[k] for c in of_set))], names=names)

                held_back, waiting = [], 0
                for part in prefix_rows(items, batch.column("ask").to_pylist(), held.value, percent):
                    held_back.append(part)
                    waiting += len(part[0])
                    if waiting >= PREFIX_ROWS:
                        yield together(held_back)
                        held_back, waiting = [], 0
                if held_back:
                    yield together(held_back)

    rows = written(sets.mapInArrow(lean(run), ", ".join(f"{c} long" for c in ("side", "token", "class", "place", "size", "node", "comp", *_PARITY))),
                   "prefixes", by=["side"])

    def side(k: int, name: str) -> DataFrame:
        return rows.where(F.col("side") == k).select("token", "class", *(F.col(c).alias(f"{name}_{c}") for c in ("place", "size", "node", "comp", *_PARITY)))

    # sets that differ in d shingles differ in d parity bits at most
    differ = reduce(Column.__add__, (F.bit_count(F.col(f"x_{c}").bitwiseXOR(F.col(f"y_{c}"))) for c in _PARITY))
    total = F.col("x_size") + F.col("y_size")

    left = 1 + F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
    fits = (F.col("x_size") <= F.col("y_size")) & (F.col("x_comp") != F.col("y_comp")) & (
        left * (100 + percent) >= total * percent) & (differ * (100 + percent) <= total * (100 - percent))
    found = [a.join(b, ["token", "class"]).where(fits).select(F.least("x_node", "y_node").alias("u"), F.greatest("x_node", "y_node").alias("v"))
             for a, b in ((side(0, "x"), side(2, "y")), (side(3, "x"), side(1, "y")))]
    return found[0].unionByName(found[1]).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_id, component_id, kept for every row."""
    sketch = written(sketched(docs, shingle, key, text, bands, rows), "sketch")
    classes = (sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_id")
               .agg(F.min_by(F.struct("n_shingles", "bands"), "doc_id").alias("s"), F.min("doc_id").alias("rep"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = written(classes.select("set_id", "rep", "node", F.col("s.n_shingles").alias("size"), F.col("s.bands").alias("bands")), "classes")
    members = written(classes.select("node", F.explode("bands").alias("bucket")), "bands")
    classes = classes.drop("bands")
    full = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(members.join(full, "bucket"), "met")
    # hub: the member that meets most others, a near-copy group's centre
    central = met.groupBy("node").agg(F.sum("n").alias("meets"))
    met = met.join(central, "node")
    hubs = met.groupBy("bucket").agg(F.max(F.struct("meets", (-F.col("node")).alias("r"))).alias("h"))
    met = written(met.join(hubs.select("bucket", (-F.col("h.r")).alias("hub")), "bucket").select("bucket", "node", "hub"), "met")
    sets = written(_sets(docs, classes.join(met.select("node").distinct(), "node", "left_semi"), shingle, key, text), "sets")

    star = met.where("node <> hub").select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct()
    # an id on several texts names all of their classes
    plain = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "set_id")
    again = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    texts = written(plain.join(again, "doc_id", "left_semi").distinct().join(classes, "set_id").select("doc_id", "node"), "again")
    named = texts.join(texts.groupBy("doc_id").agg(F.min("node").alias("u")), "doc_id").select("u", F.col("node").alias("v")).where("u <> v")
    links = written(_verified(star, sets, percent).where("linked").select("u", "v").unionByName(named), "star")
    near = written(components(links), "near")  # node, component

    # members that no link joins to their bucket's hub ask all members of the bucket
    def component(of: str) -> tuple[DataFrame, Column]:
        return near.select(F.col("node").alias(f"{of}_"), F.col("component").alias(f"{of}_comp")), F.coalesce(f"{of}_comp", of)

    (own, own_comp), (hub, hub_comp) = component("node"), component("hub")
    placed = met.join(own, F.col("node") == F.col("node_"), "left").join(hub, F.col("hub") == F.col("hub_"), "left")
    placed = written(placed.select("bucket", "node", own_comp.alias("comp"), (own_comp == hub_comp).alias("settled")), "placed")
    unsettled = placed.groupBy("bucket").agg(F.min("settled").alias("s")).where("NOT s").select("bucket")
    asked = written(placed.join(unsettled, "bucket").groupBy("node").agg((~F.min("settled")).alias("ask"), F.first("comp").alias("comp")), "asked")
    rest = _prefix_pairs(asked.join(sets, "node").select("node", "comp", "ask", "items"), percent)
    more = _verified(written(rest, "rest"), sets, percent).where("linked").select("u", "v")
    found = components(near.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))

    # nodes are numbers of classes; a component is named by the smallest id in it
    of_class = classes.join(found, "node", "left").select("set_id", "rep", F.coalesce("component", "node").alias("c"))
    least = of_class.groupBy("c").agg(F.min("rep").alias("component"))
    of_class = of_class.join(least, "c").select("set_id", "component")
    out = sketch.drop("bands").join(of_class, "set_id", "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "n_shingles", "set_id",
                      F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id")
                      ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
