import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import byte_bpe, chunks, kneser_ney, queries, sharding, token_store

TOKENIZER = queries.TOKENIZERS + "/byte_bpe_50k.json"


# --- token files ---------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 4000])
@pytest.mark.parametrize("top", [2, 50_257, 2**60, 2**63])
def test_simple8b_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64)
    if n > 100:
        ids[rng.integers(0, n, n // 9)] = 2**63 + 5  # escaped, and like an escape itself
        ids[rng.integers(0, n, n // 9)] = 15 << 60
        ids[: n // 3] = 0
    words, offsets = token_store.pack(ids)
    assert (token_store.unpack(words, offsets, n) == ids).all()
    raw = token_store.dump(np.arange(3), np.array([0, 1, 0]), np.array([n, 0, 0]), ids)
    assert (token_store.load(raw)[3] == ids).all()
    for b in range(len(offsets)):
        assert (token_store.load_block(raw, b) == ids[b * 512:(b + 1) * 512]).all()


def test_new_chunks_go_through_the_library_in_runs(hard_rows):
    from tokenizers import Tokenizer
    encode = chunks.ChunkEncoder(TOKENIZER, chunks.byte_level_breaks(), special=True, runs=True)
    library, texts, asked = Tokenizer.from_file(TOKENIZER), [r[1] or "" for r in hard_rows], []
    texts += ["".join(f" {a}é{b}, {b}{a}" for a in "abcdefgh" * 6 for b in "ijklmnop"), " \u00e9 \u00e9", "a  b   c", " x <|endoftext|> y", "\n\n a 's", "x" * 99]
    whole = encode.library
    encode.library = lambda some: asked.append(len(some)) or whole(some)
    assert [x.tolist() for x in encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(asked) < len(encode.memo.at) / 2  # fewer texts than chunks
    encode.sizes = encode.sizes + 1  # tokens that do not end with the chunks
    encode._start()
    assert [x.tolist() for x in encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_hold_the_library_ids(spark, hard_docs, hard_rows, no_docs, monkeypatch):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(TOKENIZER)
    lib.encode_special_tokens = True
    monkeypatch.setattr(token_store, "FILE_IDS", 5_000)
    folder = token_store.token_folder(spark)
    got = token_store.read_tokens(token_store.write_tokens(hard_docs, folder, TOKENIZER), folder).collect()
    ids = [(i, lib.encode(t or "", add_special_tokens=False).ids + [0]) for i, t, *_ in hard_rows]
    expect = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expect
    got.sort(key=lambda r: r["start"])
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert order == sorted(order) and [r["doc_id"] for r in got[:2]] == [None, None]
    empty = token_store.token_folder(spark)
    assert token_store.read_tokens(token_store.write_tokens(no_docs, empty, TOKENIZER), empty).count() == 0


def test_the_query_gives_the_ids_of_the_library_as_loaded(spark, tmp_path):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(TOKENIZER)
    texts = ["plain text", "one<|endoftext|>two", "<|endoftext|>", " <|endoftext|> <|endoftext|>x", "漢字<|endoftext|>", "<|endoftext", None, "the end"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_simple8b_tokens"](spark, str(tmp_path)).collect()}
    at = 0
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        assert (50256 in ids) == ("<|endoftext|>" in (t or ""))
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


# --- language model --------------------------------------------------------------------

def brute_model(texts):
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    c, b = Counter(), Counter()
    for t in tokens:
        c.update(t)
        b.update(zip(["<s>", *t], t))
    follows = Counter(w for _, w in b)
    d = [0.0, *kneser_ney.discounts(*(sum(x == k for x in b.values()) for k in (1, 2, 3, 4)))]
    e = [0.0, *kneser_ney.discounts(*(sum(x == k for x in follows.values()) for k in (1, 2, 3, 4)))]
    total, held = Counter(), Counter()
    for (v, _), x in b.items():
        total[v] += x
        held[v] += d[min(x, 3)]
    size, types = sum(c.values()), len(c)

    def p(v, w):
        low = 1 / (types + 1)
        if follows:
            n = sum(follows.values())
            low = (follows[w] - e[min(follows[w], 3)]) / n + sum(e[min(x, 3)] for x in follows.values()) / n * low
        if not total[v]:
            return low
        return (b[v, w] - d[min(b[v, w], 3)]) / total[v] + held[v] / total[v] * low

    return c, size, types, p


@pytest.mark.parametrize("rule", ["doc_id % 3 = 0", "false"])
def test_scores_against_brute_force(hard_docs, hard_rows, rule, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 20_000)
    chosen = F.coalesce(F.expr(rule), F.lit(False))
    got = kneser_ney.train_and_score(hard_docs.withColumn("score", F.lit("mine")), chosen).collect()
    c, size, types, p = brute_model([t for i, t, *_ in hard_rows if rule != "false" and i is not None and i % 3 == 0])
    expect = {}
    for i, t, *_ in hard_rows:
        w = [*(t or "").encode().lower().split(), None]
        expect.setdefault(i, []).append((len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 1) / (size + types + 1)) for x in w),
                                         sum(math.log10(p(v, x)) for v, x in zip(["<s>", *w], w))))
    assert len(got) == len(hard_rows)
    for r in got:
        assert r["train_tokens"] == size
        assert any((r["n_tokens"], r["n_known"]) == x[:2] and math.isclose(r["base_score"], x[2], rel_tol=1e-9, abs_tol=1e-9)
                   and math.isclose(r["score"], x[3], rel_tol=1e-6, abs_tol=1e-9) for x in expect[r["doc_id"]])
    if size:
        assert math.isclose(sum(p("<s>", w) for w in c) + p("<s>", "unseen"), 1.0, rel_tol=1e-9)


def brute_higher(texts, order):
    """p(w | all words before) of a model of the order, by definition."""
    grams = [Counter() for _ in range(order + 1)]
    for t in texts:
        w = [*["<s>"] * (order - 1), *(t or "").encode().lower().split(), None]
        grams[order].update(tuple(w[i:i + order]) for i in range(len(w) - order + 1))
    raw = grams[order]
    for k in range(order - 1, 0, -1):
        less = Counter()
        for g, x in raw.items():
            less[g[1:]] += x
        distinct = Counter(g[1:] for g in raw)
        grams[k] = Counter({g: less[g] if g[0] == "<s>" else distinct[g] for g in less})
        raw = less
    ds = [[0.0, *kneser_ney.discounts(*(sum(x == k for x in g.values()) for k in (1, 2, 3, 4)))] for g in grams]
    types = len(grams[1])
    total, held = Counter(), Counter()
    for g in grams[1:]:
        for words, x in g.items():
            total[len(words), words[:-1]] += x
            held[len(words), words[:-1]] += ds[len(words)][min(x, 3)]

    def p(words):
        low = p(words[1:]) if len(words) > 1 else 1 / (types + 1)
        all_, x = total[len(words), words[:-1]], grams[len(words)][words]
        return (x - ds[len(words)][min(x, 3)]) / all_ + held[len(words), words[:-1]] / all_ * low if all_ else low

    return p, [g[0] for g in grams[1]]


@pytest.mark.parametrize("order", [3, 4])
def test_higher_orders_against_brute_force(hard_docs, hard_rows, order, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 20_000)
    got = kneser_ney.train_and_score(hard_docs, F.coalesce(F.expr("doc_id % 3 = 0"), F.lit(False)), order=order).collect()
    p, types = brute_higher([t for i, t, *_ in hard_rows if i is not None and i % 3 == 0], order)
    expect = {}
    for i, t, *_ in hard_rows:
        w = [*["<s>"] * (order - 1), *(t or "").encode().lower().split(), None]
        expect.setdefault(i, []).append(sum(math.log10(p(tuple(w[k:k + order]))) for k in range(len(w) - order + 1)))
    assert len(got) == len(hard_rows)
    assert all(any(math.isclose(r["score"], x, rel_tol=1e-6) for x in expect[r["doc_id"]]) for r in got)
    start = ("<s>",) * (order - 1)
    assert math.isclose(sum(p((*start, w)) for w in types) + p((*start, "unseen")), 1.0, rel_tol=1e-9)


def test_the_query_knows_two_words_of_context(spark, tmp_path):
    texts = ["a x b", "c x d"] * 30 + ["a x d"]  # only the word before x tells what follows
    rows = [(i, t) for i, t in enumerate(texts * 3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op4_kneser_ney"](spark, str(tmp_path)).collect()
    score = {texts[r["doc_id"] % len(texts)]: r["score"] for r in got}
    assert score["a x b"] > score["a x d"] + 0.8


def test_merged_parts_do_not_stay_on_disk(spark, hard_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 20_000)
    names = iter(["ngrams", "ngram-parts-3-0", "ngram-parts-3-1", *(f"ngram-parts-2-{i}" for i in range(kneser_ney.TURNS)), "ngram-parts-1"])
    monkeypatch.setattr(kneser_ney, "scratch", lambda _, name: f"{tmp_path}/{next(names)}")
    kneser_ney.train(hard_docs, order=3)
    assert not list(names)
    left = {x.name for p in tmp_path.glob("ngram-parts-*") for x in p.iterdir() if x.is_dir()}
    assert left == {f"turn={kneser_ney.TURNS}"}  # sums alone


@pytest.mark.parametrize("n", [1, 40, 5000])
def test_counts_in_tables(tmp_path, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    keys[n // 2:] += np.uint64(1 << 40)  # some share their other bits
    keys = np.unique(np.concatenate([keys, keys[:9] ^ np.uint64(1 << 31)]))
    counts = [rng.integers(0, 2, len(keys)) * rng.integers(0, top, len(keys)) for top in (4, 300, 2**40)]
    strangers = np.setdiff1d(keys ^ np.uint64(1 << 60), keys)
    kneser_ney._save(f"file://{tmp_path}", "x", 3, keys, *counts)
    there, got = kneser_ney._look_up(kneser_ney._mapped(f"file://{tmp_path}", "x", 3), np.concatenate([keys, strangers]))
    assert there.tolist() == [True] * len(keys) + [False] * len(strangers)
    assert (got[:, :len(keys)] == np.array(counts)).all()
    assert kneser_ney._mapped(f"file://{tmp_path}", "x", 4) is None


def test_no_rows_to_score(no_docs):
    assert kneser_ney.train_and_score(no_docs, F.lit(True)).count() == 0


def test_held_out_text_beats_the_base(spark):
    rows = queries.QUERIES["op4_kneser_ney"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


# --- sharding ----------------------------------------------------------------------------

def jump(key, n):
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 16, 100])
def test_jump_shards(spark, hard_docs, hard_rows, shards):
    extra = spark.range(-500, 1500).selectExpr("id as doc_id", "cast(id as string) as text", "'x' as lang", "'x' as source", "id as n_chars")
    got = sharding.shard_documents(hard_docs.unionByName(extra), shards).collect()
    assert len(got) == len(hard_rows) + 2000
    slots = {}
    for r in got:
        assert r["shard"] == jump(r["doc_id"] or 0, shards) and r["grown_shard"] == jump(r["doc_id"] or 0, shards + 1)
        assert r["grown_shard"] in (r["shard"], shards)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] in {x[0] for x in hard_rows} and r["doc_id"] == 104)
    long = next(x[1] for x in hard_rows if x[0] == 104).encode()
    assert sizes[104, len(long) + 1, zlib.crc32(long)] == 1
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] == 100} >= {(1, 0)}


def test_no_documents_to_shard(no_docs):
    assert sharding.shard_documents(no_docs).count() == 0


def test_many_tables_are_read_in_one_look_up(tmp_path, monkeypatch):
    """A few reads a table and batch, not a search in each: there are as many tables as shards."""
    rng = np.random.default_rng(7)
    shards, n = 40, 6000
    hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    counts = rng.integers(1, 70_000, len(hashes))
    for k, (keys, c) in kneser_ney._shares(shards, hashes, hashes, counts):
        if k != 3:
            kneser_ney._save(f"file://{tmp_path}", "gram2", k, keys, c)
    model = kneser_ney.Model(f"file://{tmp_path}", shards, 1, 1, 1, [[0.0] * 3] * 2, 1.0)
    calls, look_up = [], kneser_ney._look_up
    monkeypatch.setattr(kneser_ney, "_look_up", lambda tables, *a: calls.append(len(tables)) or look_up(tables, *a))
    asked = rng.permutation(np.r_[hashes, ~hashes])
    (got,) = model._find("gram2", asked, 1, model._dealt(shards, asked))
    known = {h: c for h, c in zip(hashes.tolist(), counts.tolist()) if kneser_ney.shard_of(np.array([h], np.uint64), shards)[0] != 3}
    assert got.tolist() == [known.get(h, 0) for h in asked.tolist()]
    assert calls == [shards - 1]
    monkeypatch.setattr(kneser_ney, "LOOK_UPS", 500)
    assert model._find("gram2", asked, 1, model._dealt(shards, asked)).tolist() == [got.tolist()] and len(calls) > 10


def test_order_where_leading_bits_are_the_same():
    rng = np.random.default_rng(8)
    low = rng.integers(0, 6, 3000).astype(np.uint64)
    for keys in (rng.integers(0, 2**64, 3000, dtype=np.uint64), low << np.uint64(32), low, np.uint64(5) << np.uint64(32) | low << np.uint64(60)):
        keys = np.r_[keys, keys[:100]]
        order, first = kneser_ney._in_order(keys)
        turned = kneser_ney._turned(keys)
        assert np.array_equal(turned[order], np.sort(turned)) and np.array_equal(turned[order][first], np.unique(turned))
        own, total = kneser_ney._sum_by(keys, np.ones(len(keys)))
        assert dict(zip(own.tolist(), total.tolist())) == Counter(keys.tolist())


def test_words_are_in_fewer_shards(hard_docs, monkeypatch, tmp_path):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(kneser_ney, "scratch", lambda _, name, n=iter(range(99)): f"{tmp_path}/{name}-{next(n)}")
    model = kneser_ney.train(hard_docs, order=3)
    tables = {kind: {int(x.name) for p in tmp_path.glob(f"ngrams-*/{kind}") for x in p.iterdir() if not x.name.startswith(".")}
              for kind in ("gram1", "context2", "gram2", "context3", "gram3")}
    assert model.shards > 4 and max(tables["gram3"]) >= model.shards - 2
    assert max(*tables["gram1"], *tables["context2"]) < kneser_ney.word_shards(model.shards)
