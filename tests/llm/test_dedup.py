import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import exact_dedup, minhash, suffix_dedup
from flowlens.llm.graph import components

WHITE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rows = np.random.default_rng(0).integers(0, 256, (5000, 32), dtype=np.uint8)
    sizes, bits = exact_dedup.build_mph(rows)
    slots = exact_dedup.mph_slots(rows, sizes, bits)
    assert sorted(slots.tolist()) == list(range(5000))
    none = exact_dedup.mph_slots(rows[:0], *exact_dedup.build_mph(rows[:0]))
    assert len(none) == 0


@pytest.mark.parametrize("split", ["doc_id % 2 = 0", "true", "false"])
def test_exact_dedup_against_brute_force(hard_docs, hard_rows, split):
    got = exact_dedup.exact_dedup(exact_dedup.digested(hard_docs), F.expr(split)).collect()
    groups = defaultdict(list)
    for i, t, *_ in hard_rows:
        groups[hashlib.sha256((t or "").translate(WHITE).encode()).digest()].append((-len(t or ""), i is None, i))
    assert len(got) == len(hard_rows)
    for r in got:
        members = groups[bytes(r["digest"])]
        assert (r["keep_id"], r["group_size"]) == (min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2], len(members))
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_empty_tables(no_docs):
    assert exact_dedup.exact_dedup(exact_dedup.digested(no_docs), F.lit(True)).count() == 0
    assert minhash.near_duplicates(no_docs).count() == 0
    docs, texts = suffix_dedup.remove_repeats(no_docs)
    assert docs.count() == texts.count() == 0


def brute_components(rows, n, percent):
    sets = {}
    for k, (_, t, *_) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a):
            same_id = rows[a][0] == rows[b][0]
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if same_id or 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[find(k)] = min(low.get(find(k), r[0]), r[0])
    return Counter((r[0], len(sets[k]), None if r[0] is None else low[find(k)]) for k, r in enumerate(rows))


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_against_brute_force(hard_docs, hard_rows, n):
    got = minhash.near_duplicates(hard_docs, shingle=n, percent=80).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(hard_rows, n, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_an_id_on_several_texts(spark):
    rng = random.Random(8)
    a, b, c = (" ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(50)) for _ in range(60)) for _ in range(3))
    rows = [(5, a), (5, b), (9, a + " one more"), (7, b + " one more"), (3, c), (8, c + " end"), (8, a), (6, "alone on its own here")]
    for parts in (1, 4):
        got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), shingle=4).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows, 4, 80)
        assert {r["component_id"] for r in got} == {3, 6}


def test_words_are_cut_at_ascii_white_space_only():
    texts = ["a b c d e", "", "  x ", "A b\x0bC\x0cd\re\tF g"]
    values, offsets = minhash.shingle_sets([t.encode() for t in texts], 2)
    sizes = [len({tuple(w[i:i + 2]) for i in range(len(w) - 1)}) if len(w := t.encode().lower().split()) > 1 else int(bool(w)) for t in texts]
    assert np.diff(offsets).tolist() == sizes


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 1 << 62, 1000, dtype=np.uint64))
    b = np.sort(np.r_[a[:800], rng.integers(0, 1 << 62, 200, dtype=np.uint64)])
    s = minhash.signatures(np.r_[a, b], np.array([0, 1000, 2000]), 512)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.08


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(129, 40), (500, 501), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(v == 0 for k, v in got.items() if k < 200) and got[501] == 500 and len(got) == 41 + 30 + 2
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_removed(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int(np.sum(np.diff(np.r_[0, gone.astype(int)]) == 1))
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("hot_bytes", [2_000_000, 500])
def test_removed_bytes_against_brute_force(hard_docs, hard_rows, hot_bytes, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot_bytes)  # 500: every shared minimizer is split and merged
    docs, texts = suffix_dedup.remove_repeats(hard_docs, length=400)
    raw = [(t or "").encode() for _, t, *_ in hard_rows]
    expect = Counter((r[0], *x) for r, x in zip(hard_rows, brute_removed(raw, 400)))
    got = docs.collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == expect
    kept = {bytes(r["tid"]): bytes(r["kept"]) for r in texts.collect()}
    assert {hashlib.sha256(kept[bytes(r["tid"])]).hexdigest() == r["kept_sha256"] for r in got if r["n_removed"]} == {True}


def test_suffix_array_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(60):
        a = [rng.randrange(rng.choice([2, 4, 256])) for _ in range(rng.randint(1, 60))]
        sa = suffix_dedup.suffix_array(np.array(a, np.uint16))
        order = sorted(range(len(a)), key=lambda i: a[i:])
        assert sa.tolist() == order
        lcp = suffix_dedup.kasai(np.array(a, np.uint16), sa, 6, lanes=4)
        for x, y in zip(order, order[1:]):
            k = 0
            while k < 6 and max(x, y) + k < len(a) and a[x + k] == a[y + k]:
                k += 1
            assert lcp[y] == k
