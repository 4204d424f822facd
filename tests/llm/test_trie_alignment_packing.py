import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flowlens.llm import alignment, chunks, packing, prefix_trie, queries

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

ODD_TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b \n", "\n", "x   y  z", "mark ▁ in it", "end▁", "tab\tand\x0bvt \x1c x",
             "null \x00 byte", "<s> and </s> <unk> <0x41>", "a<|endoftext|>b <|startoftext|>", "漢字 \U0001f642 and é́", "İstanbul ﬁ Å",
             "don't 'S we'LL 12 345", "a" * 300, "word " * 50, "…。 、x  y", "é\u0085 b", "  q 　 w", "x\x7f y"]


# --- conversation trie -----------------------------------------------------------------

def brute_trie(rows):
    """conversations (conv_id, turn, role, text) -> node rows, by dictionaries of whole prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        whole[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    out = set()
    for k, m in members.items():
        under = [x for x in members if x[:len(k)] == k]
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k))))
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], sum(not children[x] for x in under),
                 sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x), hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, digest string, piece int"


def hard_conversations(seed):
    rng = random.Random(seed)
    texts = ["", "a", "bb", "ccc", "é漢", None, "x" * 5000]
    rows = []
    for c in [*range(-3, 60), *range(100, 140), *range(250, 260), 10**12, 300]:
        for turn in range(rng.choice([0, 1, 2, 4, 7, 9])):
            rows.append((c, None if rng.random() < 0.1 else turn, rng.choice(["user", "assistant", None]), rng.choice(texts)))
    rows += [(c, t, "user", f"same {t}") for c in range(400, 470) for t in range(4)]  # one conversation many times
    rows += [(500, t, "user", f"turn {t}") for t in range(200)] + [(501, t, "user", f"turn {t}") for t in range(150)]
    rows += rows[:20] + [(None, 0, "user", "no conversation"), (510, 1, "u", "tie"), (510, 1, "u", "tie"), (510, 1, "u", "other")]
    return [(*r, "clash", 1) for r in rows]


def trie_rows(nodes):
    got = [tuple(r[c] for c in COLUMNS[:-1]) + (r["ends_sha256"] or queries.NO_ENDS,) for r in nodes.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("piece, run", [(10_000, 4_096), (2, 3), (7, 16)])
def test_the_trie_equals_brute_force(spark, monkeypatch, piece, run):
    monkeypatch.setattr(prefix_trie, "PIECE_TURNS", piece)
    monkeypatch.setattr(prefix_trie, "END_IDS", run)
    rows = hard_conversations(piece)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    nodes = prefix_trie.conversation_trie(df)
    assert trie_rows(nodes) == brute_trie([r[:4] for r in rows])


def test_conversations_without_turns_and_empty_tables(spark):
    # the hash gives 1 more turns than it has, and its hundred has no first one
    alone = next(c for c in range(701, 800) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(alone, 0, "user", "gone", "", 0)]
    assert trie_rows(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie([r[:4] for r in rows])
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_turns_of_nodes(spark):
    rows = hard_conversations(3)
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = prefix_trie.conversation_trie(df).where("depth > 0")
    got = prefix_trie.node_turns(nodes, df)
    assert got.count() == nodes.count()
    lengths = {(r["conv_id"], r["depth"]): len(r["text"]) for r in got.collect()}
    own = {(r["conv_id"], r["depth"]): r["saved_tokens"] for r in nodes.where("n_children = 0 AND n_convs > 1").collect()}
    weight = {(r["conv_id"], r["depth"]): r["n_convs"] for r in nodes.collect()}
    assert own and all(s == (weight[k] - 1) * lengths[k] for k, s in own.items())


# --- alignment -------------------------------------------------------------------------

def brute_alignment(texts):
    """By the libraries on whole texts, byte by byte."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    raw_a, raw_b = alignment.a_bytes(BYTE_BPE), alignment.b_bytes(b)
    docs, counts = [], Counter()
    for t in texts:
        t = t or ""
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        whole = (" " + t).encode()
        if not t or not whole == b"".join(raw_a[i] for i in ids_a) == b"".join(raw_b[i] for i in ids_b):
            docs.append(None)
            continue
        ends_a, ends_b = (np.cumsum([len(raw[i]) for i in ids]).tolist() for raw, ids in ((raw_a, ids_a), (raw_b, ids_b)))
        groups, x, y = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
            groups.append((ids_a[x:i], ids_b[y:j]))
            x, y = i, j
        links = [(ga[-1], gb[-1]) for ga, gb in groups]
        counts.update(links)
        docs.append((len(ids_a), len(ids_b), groups, links))
    top = defaultdict(int)
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in d[2])
        out.append((d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == top[p[1]] for p in d[3]), sum(counts[p] for p in d[3]),
                    hashlib.sha256(shown.encode()).hexdigest()))
    return out, counts


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def strange_texts(n=300):
    rng = random.Random(5)
    odd = "  \n\tab▁é漢\U0001f642'1.<|s>"
    return ODD_TEXTS + ["".join(rng.choice(odd) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [100_000, 40, 1])
def test_alignment_equals_the_libraries_on_whole_texts(spark, hard_rows, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = [(r[0], r[1], "x") for r in hard_rows] + [(1000 + i, t, None) for i, t in enumerate(ODD_TEXTS)]
    rng = random.Random(5)
    odd = "  \n\tab▁é漢\U0001f642'1.<|s>"
    rows += [(2000 + i, "".join(rng.choice(odd) for _ in range(rng.randrange(60))), "y") for i in range(300)]
    expect, counts = brute_alignment([r[1] for r in rows])
    out, pairs = alignment.align_tokenizers(spark.createDataFrame(rows, "doc_id long, text string, pair string").repartition(4), BYTE_BPE, PIECE_BPE)
    got = Counter(tuple(r[c] for c in ["doc_id", *ALIGNED]) for r in out.collect())
    assert got == Counter((r[0], *e) for r, e in zip(rows, expect))
    low = (1 << alignment.B_BITS) - 1
    assert {(r["pair"] >> alignment.B_BITS, r["pair"] & low): r["n"] for r in pairs.collect()} == counts


def test_alignment_in_parts_with_a_small_memo(monkeypatch, hard_rows):
    """Workers import the module anew, so this runs here."""
    texts = [r[1] or "" for r in hard_rows] + strange_texts()
    monkeypatch.setattr(chunks, "PART_BYTES", 300)
    monkeypatch.setattr(alignment, "MEMO_CHUNKS", 50)
    got = list(alignment.Aligner(BYTE_BPE, PIECE_BPE)(texts))
    expect, counts = brute_alignment(texts)
    assert [(g["n_a"], g["n_b"], g["n_groups"], g["groups"]) for g in got] == [(*e[:3], e[6]) for e in expect]
    same = alignment.Vocabularies(BYTE_BPE, PIECE_BPE).same
    found = Counter((i, int(same[i])) for g in got for x in g["exact"] for i in x.tolist())
    found.update((p >> alignment.B_BITS, p & (1 << alignment.B_BITS) - 1) for g in got for x in g["pairs"] for p in x.tolist())
    assert found == counts


def test_alignment_of_an_empty_table(spark, no_docs):
    out, pairs = alignment.align_tokenizers(no_docs, BYTE_BPE, PIECE_BPE)
    assert out.count() == 0 and pairs.count() == 0


def test_the_identity_map(spark):
    v = alignment.Vocabularies(BYTE_BPE, PIECE_BPE)
    assert v.breaks.sum() > 1_000 and (v.same >= 0).sum() > 5_000
    assert all(v.a_bytes[a] == v.b_bytes[b] for a, b in enumerate(v.same.tolist()) if b >= 0)
    assert v.same[50256] == -1


# --- packing ------------------------------------------------------------------------------

def plain_best_fit(lengths, capacity):
    """How full the sequences are, by the tightest of all open ones, one piece
    at a time (which of equally full ones it is changes what lies in which, not this)."""
    bins = []
    for n in sorted(lengths, reverse=True):
        room = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n]
        if not room:
            bins.append([capacity, []])
            room = [(capacity, len(bins) - 1)]
        b = bins[min(room)[1]]
        b[0] -= n
        b[1].append(n)
    return Counter(sum(b[1]) for b in bins)


@pytest.mark.parametrize("seed", range(12))
def test_the_plan_is_that_of_placing_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 64, 100, 4096])
    top = rng.choice([3, capacity // 2, capacity])
    lengths = [rng.randint(1, max(1, top)) for _ in range(rng.choice([0, 1, 30, 400]))] + [capacity] * rng.randrange(3) + [1] * rng.choice([0, 200])
    steps = packing.plan(dict(Counter(lengths)), capacity)
    held = np.array(sorted(lengths), np.int64)
    number = np.arange(len(held)) - np.searchsorted(held, held)
    sequence, offset = packing.place(steps, held, number) if len(held) else (held, held)
    found = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), held.tolist()):
        found[s].append((o, n))
    for parts in found.values():  # no gap, no overlap
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert Counter(sum(n for _, n in p) for p in found.values()) == plain_best_fit(lengths, capacity)


@pytest.mark.parametrize("part, memo", [(2 << 20, 800_000), (200, 50)])
@pytest.mark.parametrize("special", [True, False])
def test_chunks_give_the_ids_of_whole_texts(monkeypatch, hard_rows, part, memo, special):
    from tokenizers import Tokenizer
    monkeypatch.setattr(chunks, "PART_BYTES", part)
    monkeypatch.setattr(chunks, "MEMO_CHUNKS", memo)
    texts = [r[1] or "" for r in hard_rows] + strange_texts(3_000)
    for path, breaks, same in ((WORD_BPE, chunks.word_breaks(), packing._same_for_words()), (BYTE_BPE, chunks.byte_level_breaks(), None)):
        lib = Tokenizer.from_file(path)
        lib.encode_special_tokens = not special
        encode = chunks.ChunkEncoder(path, breaks, special, same)
        assert [x.tolist() for x in encode(texts)] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_packed_documents_hold_the_library_ids(spark, hard_rows):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORD_BPE)
    rows = [(r[0], r[1], 1) for r in hard_rows] + [(1000 + i, t, 2) for i, t in enumerate(strange_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(6)
    packed = packing.pack_documents(docs, WORD_BPE, capacity=256, keep_ids=True)
    packed.persist()
    got = packed.collect()
    expect = Counter()
    lengths = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        for p, a in enumerate(range(0, len(ids), 256)):
            cut = ids[a:a + 256]
            lengths.append(len(cut))
            expect[i, p, a, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expect
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"], r["doc_id"], r["ids"]))
    assert Counter(sum(x[1] for x in b) for b in bins.values()) == plain_best_fit(lengths, 256)
    for r in packing.sequences(packed).collect():
        assert r["ids"] == [i for _, _, _, ids in sorted(bins[r["sequence_id"]], key=lambda x: x[0]) for i in ids]
        assert r["ends"][-1] == len(r["ids"]) <= 256
    packed.unpersist()


def test_packing_an_empty_table(spark, no_docs):
    assert packing.pack_documents(no_docs, WORD_BPE).count() == 0


def test_the_new_queries_read_the_whole_tables(spark, tmp_path, hard_rows):
    docs = spark.createDataFrame([(r[0], r[1]) for r in hard_rows], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([r[:4] for r in hard_conversations(1)], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    run = {n: queries.QUERIES[n](spark, str(tmp_path)) for n in ("op11_prefix_trie", "op12_alignment", "op13_best_fit")}
    assert trie_rows(run["op11_prefix_trie"]) == brute_trie([r[:4] for r in hard_conversations(1)])
    assert run["op12_alignment"].count() == len(hard_rows)
    assert run["op13_best_fit"].where("piece = 0").count() == len(hard_rows)
    assert run["op13_best_fit"].groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
