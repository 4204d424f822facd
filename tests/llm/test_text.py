import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowlens.llm import byte_bpe, common, decontaminate, html_template, language_id, queries

RANKS = queries.TOKENIZERS + "/byte_bpe_multi_50k.tiktoken"


# --- language identification ---------------------------------------------------

def plain_viterbi(score, penalty):
    best, back = score[0].copy(), []
    for row in score[1:]:
        lead = int(best.argmax())
        come = [j if best[j] >= best[lead] - penalty else lead for j in range(len(row))]
        best = np.array([max(best[j], best[lead] - penalty) for j in range(len(row))]) + row
        back.append(come)
    path = [int(best.argmax())]
    for come in reversed(back):
        path.append(come[path[-1]])
    return path[::-1]


def small_model():
    rng = np.random.default_rng(5)
    allowed = np.ones((len(language_id._NAMES), 3), bool)
    return language_id.Model(["a", "b", "c"], rng.normal(-9, 3, (language_id.TABLE, 3)).astype(np.float32), allowed)


def test_viterbi_of_a_batch_equals_one_by_one():
    rng, m = random.Random(1), small_model()
    texts = [[rng.choice(["ab", "cde", "fgh", "ij", "klmno", "ß"]) for _ in range(rng.choice([0, 1, 2, 9, 40]))] for _ in range(30)]
    for words, (labels, letters) in zip(texts, m.label_words(texts)):
        assert len(labels) == len(words)
        if words:
            score = m.scores[[m.memo[w] for w in words]].astype(float)
            assert labels.tolist() == plain_viterbi(score, language_id.SWITCH)
            assert letters.sum() == sum(map(len, words))


def test_languages_of_hard_rows(hard_docs, hard_rows, no_docs):
    from pyspark.sql import functions as F
    model = language_id.train(hard_docs, F.lit(True))
    out = language_id.predict(hard_docs.withColumn("score", F.lit("mine")), model, spans=True)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "lang_pred", "score", "spans"]
    got = out.collect()
    assert len(got) == len(hard_rows)
    for r in got:
        letter = any(c.isalpha() for t in [x[1] for x in hard_rows if x[0] == r["doc_id"]] for c in t or "")
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not letter) and 0 <= r["score"] <= 1
            assert (r["score"] == 0) == (not letter)
    none = language_id.train(no_docs, F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(hard_docs, none).collect()} == {"und"}
    assert language_id.predict(no_docs, model).count() == 0


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 100 and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98


# --- byte-level BPE --------------------------------------------------------------

@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(RANKS, byte_bpe.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list("abehinrst  \n'é.1²_")), st.characters(exclude_categories=["Cs", "Cn"])), max_size=80))
def test_encoding_equals_the_library(bpe, library, text):
    ids = [i for p in bpe.pieces(text) for i in bpe.encode(p.encode())]
    assert ids == library.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_joins_of_long_pieces(bpe, library):
    rng = random.Random(4)
    for text in ["a" * 5000, "ab" * 2000, "".join(rng.choice("einrst") for _ in range(8000)), "the" * 999]:
        ids = bpe.encode(text.encode())
        assert ids == library.encode_ordinary(text)
        for cut in (1, 17, 2501):
            left, right = text[:cut].encode(), text[cut:].encode()
            assert bpe.join(bpe.encode(left), bpe.encode(right)) == ids


def test_a_task_forgets_what_other_operators_remember():
    byte_bpe._memo(RANKS, byte_bpe.PATTERN)
    list(common.lean(iter, "byte_bpe")([]))
    assert byte_bpe._memo.cache_info().currsize
    assert list(common.lean(iter, "minhash")([1, 2])) == [1, 2]
    assert not byte_bpe._memo.cache_info().currsize


def test_documents_round_trip(hard_docs, hard_rows, no_docs, library):
    out = byte_bpe.encode_documents(hard_docs, RANKS, byte_bpe.PATTERN, out="n_chars")  # the name is taken over
    back = byte_bpe.decode_documents(out, RANKS, byte_bpe.PATTERN, ids="n_chars").collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted((t or "").encode() for _, t, *_ in hard_rows)
    for r in back:
        assert r["n_chars"] == library.encode_ordinary(r["text"] or "")
    both = byte_bpe.encode_documents(hard_docs, RANKS, byte_bpe.PATTERN, out="n_chars", decoded="decoded")
    assert both.columns == back[0].__fields__ and sorted(map(str, both.collect())) == sorted(map(str, back))
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(no_docs, RANKS, byte_bpe.PATTERN), RANKS, byte_bpe.PATTERN).count() == 0


# --- decontamination --------------------------------------------------------------

def plain_scores(items, n_items, mean, df, words):
    import math
    out = []
    for q, a in items:
        own = decontaminate.words_of(q) + decontaminate.words_of(a)
        weight = {}
        for w in set(own):
            tf = own.count(w)
            idf = math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5))
            weight[w] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean))
        out.append(sum(v for w, v in weight.items() if w in words) / sum(weight.values()))
    return out


def test_pruned_retrieval_equals_exhaustive_scoring():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    items = [(" ".join(rng.choices(vocab, k=rng.randint(4, 14))), " ".join(rng.choices(vocab, k=3))) for _ in range(70)]
    sets = [set(decontaminate.words_of(q) + decontaminate.words_of(a)) for q, a in items]
    df = {w: sum(w in s for s in sets) for w in set().union(*sets)}
    mean = sum(len(q.split()) + len(a.split()) for q, a in items) / len(items)
    ix = decontaminate.build_index([(i, q, a) for i, (q, a) in enumerate(items)], df, len(items), mean)
    texts = [rng.choices(vocab + ["zz"] * 30, k=rng.randint(0, 150)) for _ in range(25)]
    coded = [np.array([ix.vocab.get(w.encode(), -1) for w in t], np.int64) for t in texts]
    doc = np.concatenate([np.full(len(c), i) for i, c in enumerate(coded)])
    place = np.concatenate([np.arange(len(c)) for c in coded])
    flat = np.concatenate(coded)
    known, h = flat >= 0, ix.passage // 2
    d, w, item, score = decontaminate.retrieve(ix, doc[known], place[known], flat[known])
    got = {(a, b, c): round(s, 9) for a, b, c, s in zip(d.tolist(), w.tolist(), item.tolist(), score.tolist())}
    expect = {}
    for i, t in enumerate(texts):
        for k in range(len(t) // h + 1):
            words = {x.encode() for x in t[k * h:k * h + 2 * h]}
            for j, s in enumerate(plain_scores(items, len(items), mean, df, words)):
                if s >= decontaminate.THRESHOLD:
                    expect[i, k, j] = round(s, 9)
    assert got == expect and got


def test_overlap_is_the_best_fit():
    side = list(range(20))
    passage = np.array([99, *range(10), 77, *range(10, 20), 98])
    assert decontaminate.overlap(side, np.array([5, *side, 7])) == 1
    assert decontaminate.overlap(side, passage) == 1 - 1 / 20
    assert decontaminate.overlap([1, 2, 3], np.array([1, 9, 2, 3])) == 0  # short sides: exactly
    assert decontaminate.overlap([], passage) == 1 and decontaminate.overlap(side, np.zeros(0, np.int64)) == 0


def test_planted_items_are_found_and_clean_rows_stay(spark, hard_docs, hard_rows, no_docs):
    item = "Where does the river of the seven old towns begin its way? It begins under the northern glacier."
    edited = item.replace("seven old", "seven very old")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "?!"), (None, "an item without any id at all, is it found?")],
                                  "item_id long, text string")
    docs = hard_docs.unionByName(spark.createDataFrame(
        [(900, "x " * 500 + item.upper() + " y" * 500, None, None, 0), (901, edited, None, None, 0),
         (902, item.split("?")[0], None, None, 0)], hard_docs.schema))
    got = decontaminate.contaminated(docs, bench).select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in got} == {(900, 1), (901, 1)}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(hard_rows) + 1
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(no_docs, bench).count() == 0


def test_an_edited_or_lost_short_side_is_found(spark):
    body = " ".join(f"w{i}" for i in range(52))
    bench = spark.createDataFrame([(1, f"{body}. It is so."), (2, "Who says it? " + body.replace("w", "v") + ".")], "item_id long, text string")
    texts = [f"{body}. It was so.", f"x {body} y", f"Who said it? {body.replace('w', 'v')}", body.replace("w", "v"), body[:120], "It is so."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 2), (3, 2)}
    assert got[0, 1]["question_overlap"] == 1 and 0 < got[0, 1]["answer_overlap"] < 1
    # an answer that is given as one is still matched exactly
    given_answer = spark.createDataFrame([(1, body, "It is so.")], "item_id long, text string, answer string")
    assert decontaminate.contaminated(docs, given_answer, answer="answer").count() == 0


def test_a_copy_with_inserted_words_is_found_at_any_place(spark):
    own = [f"w{i}" for i in range(59)]
    bench = spark.createDataFrame([(1, " ".join(own), "")], "item_id long, text string, answer string")
    copy = " ".join(w + (" new" if i % 5 == 4 else "") for i, w in enumerate(own))
    docs = spark.createDataFrame([(n, "x " * n + copy + " y" * 200) for n in range(160)], "doc_id long, text string")
    got = decontaminate.contaminated(docs, bench, answer="answer").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(160))


def test_copies_without_their_rarest_words_are_found():
    """As brute force over all windows and items: what verification accepts is retrieved."""
    rng = random.Random(11)
    common, rare = [f"c{i}" for i in range(40)], [f"r{i}" for i in range(2_000)]
    items, texts = [], []
    for i in range(100):
        words = [rng.choice(rare if rng.random() < 0.3 else common) for _ in range(50)]
        items.append((i, " ".join(words[:30]), " ".join(words[30:])))
        edited, left = list(words), [6, 4]  # of the question and of the answer
        for k in sorted(range(50), key=lambda k: (words[k][0] != "r", k)):
            if left[k >= 30]:
                edited[k], left[k >= 30] = "zz", left[k >= 30] - 1
        texts.append(" ".join(rng.choices(common, k=rng.randint(0, 90)) + edited + rng.choices(common, k=rng.randint(0, 90))))
    df = {}
    for _, q, a in items:
        for w in set(decontaminate.words_of(q) + decontaminate.words_of(a)):
            df[w] = df.get(w, 0) + 1
    for whole in (False, True):
        ix = decontaminate.build_index(items, df, len(items), 50, whole)
        assert len(ix.least) == 100 and (ix.least > 0).all() and ix.least.min() < decontaminate.THRESHOLD
        got = decontaminate.find(texts, ix)
        assert {(i, i) for i in range(100)} <= set(got)
        expect = set()
        h = ix.passage // 2
        for d, text in enumerate(texts[:10]):
            coded = np.array([ix.vocab.get(w, -1) for w in decontaminate.words_of(text)])
            for k in range(len(coded) // h + 1):
                part = coded[k * h:k * h + 2 * h]
                for i, (q, a) in enumerate(zip(ix.questions, ix.answers)):
                    sides = min(decontaminate.overlap(q, part), decontaminate.overlap(a, part)) >= decontaminate.OVERLAP
                    if sides or whole and decontaminate.overlap(q + a, part) >= decontaminate.OVERLAP:
                        expect.add((d, i))
        assert {k for k in got if k[0] < 10} == expect


def test_the_least_score_is_that_of_the_worst_accepted_edit():
    assert [decontaminate.edits_of(n) for n in (1, 7, 8, 10, 15, 35, 50)] == [0, 0, 1, 2, 3, 7, 10]
    weight, tf = np.array([0.4, 0.3, 0.2, 0.1]), np.array([1, 3, 1, 1])
    assert decontaminate.least_score(weight, tf, 0) == 1
    assert abs(decontaminate.least_score(weight, tf, 1) - 0.6) < 1e-12
    assert abs(decontaminate.least_score(weight, tf, 2) - 0.4) < 1e-12


def test_an_index_in_parts_finds_the_same(spark, hard_docs, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {tuple(r)[:2] for r in decontaminate.contaminated(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "PART_WORDS", 300)
    assert {tuple(r)[:2] for r in decontaminate.contaminated(docs, bench).collect()} == whole and whole


# --- main text of pages --------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home<li>News</ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies</div><div class=ad>Buy</div>
<article class="post no-sidebar"><header><h1>Head &amp; line</h1></header><p>One <b>bo</b>ld&nbsp;word<br>two<p>a &lt; b &#233;
<div class="share-buttons">Share</div><aside>Side</aside><form><input><label>Mail</label></form>
<table><tr><td>c1<td>c2</table><section id="comments"><p>First!</p></section></article>
<div id="sidebar">Links</div><footer>&copy; 2020</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_template.extract(PAGE, set())[0] == "Head & line One bold word two a < b é c1 c2"
    assert html_template.extract("", set()) == ("", 0)
    assert html_template.extract("just text &amp; more", set())[0] == "just text & more"
    assert html_template.extract("<nav>menu<article><p>kept</p></article>", set())[0] == "kept"
    assert html_template.extract("<div class=ad>buy<article><div>kept</div></article>", set())[0] == "kept"
    assert html_template.extract("<article><p>own</p></article><aside><article>other</article></aside>", set())[0] == "own"
    assert html_template.extract("<div id=comments><article>no</article></div><p>yes</p>", set())[0] == "yes"
    assert html_template.extract("<body><main><p>m</p></main><p>out</p>", set())[0] == "m"
    assert html_template.extract("<p>a<script>x", set())[0] == "a"


def test_template_text_goes_where_no_element_marks_the_article(spark):
    pages = [(i, f"http://h.example/{i}", f"<html><body><div><p>Welcome here</p></div><div><p>Story {i} {'x' * i}</p><p>Line {i}</p></div><p>Imprint</p></body></html>")
             for i in range(8)]
    pages += [(50, "http://one.example/", "<body><p>Welcome here</p></body>"), (51, None, "<p>no url</p>"), (52, "http://h.example/e", None),
              (53, "http://h.example/f", ""), (54, "http://a.example", PAGE), (54, "http://a.example", PAGE)]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")
    got = html_template.extract_main_text(df).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(pages)
    assert by[3]["text"] == "Story 3 xxx Line 3" and by[3]["template_tokens"] > 3
    assert by[50]["text"] == "Welcome here" and by[51]["text"] == "no url"
    assert (by[52]["text"], by[52]["n_chars"], by[53]["text"]) == ("", 0, "")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_template.extract_main_text(df.limit(0)).count() == 0


def test_template_decides_inside_the_article_and_by_layout(spark):
    def story(i):
        return f"<p>Story {i} {'x' * i}</p><p>Line {i}</p>"
    pages = [(i, f"http://n.example/{i}", f"<html><body><div class=zq>Today {i}</div><article><p>By the desk</p>{story(i)}"
                                          f"<div class=q7>Get our app</div></article><p>More of {i}</p></body></html>") for i in range(8)]
    # a layout on less than half of a host's pages has its own boilerplate
    pages += [(100 + i, f"http://m.example/{i}", f"<html><body class=a><article>{story(i)}</article></body></html>") for i in range(8)]
    pages += [(200 + i, f"http://m.example/b{i}", f"<html><body class=b><article>{story(i)}<div class=q7>Get our app</div></article></body></html>")
              for i in range(4)]
    # copies of one page are not a template
    pages += [(300 + i, "http://c.example/", f"<html><body><article>{story(1)}<p>End</p></article></body></html>") for i in range(5)]
    pages += [(310, "http://c.example/2", f"<html><body><article>{story(2)}</article></body></html>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    by = {r["page_id"]: r["text"] for r in html_template.extract_main_text(df).collect()}
    assert by[3] == "Story 3 xxx Line 3"  # what lies outside the article element goes
    assert by[102] == by[202] == "Story 2 xx Line 2"
    assert by[300] == by[304] == "Story 1 x Line 1 End" and by[310] == "Story 2 xx Line 2"


def test_near_copies_of_an_article_stay_whole(spark):
    """Six pages of one host with the same title and paragraphs and one changed sentence."""
    shared = ["The bridge over the river", *(f"Paragraph {k} tells how the {k} towns came to build it." for k in range(12))]

    def page(i, blocks, side=""):
        inner = "".join(f"<p>{b}</p>" for b in blocks)
        return (f"<html><body><nav><ul><li>Home<li>News</ul></nav><div class=zq>Read next: story {i}</div><article>{inner}"
                f"{side}</article><div class=likes>{i} people like this</div><div>All rights with us</div></body></html>")
    pages = [(i, f"http://near.example/{i}", page(i, [*shared, f"Updated {i} times so far."])) for i in range(6)]
    # own articles of a host with boilerplate inside: more blocks than the story, but short
    pages += [(50 + i, f"http://own.example/{i}", page(i, [f"Story {i} " + f"of many own words {i} " * 9],
                                                       "<p>Share</p><p>Print</p><p>Mail it</p>")) for i in range(6)]
    pages += [(90, "http://alone.example/", page(5, ["Own text 5."]))]
    # one long page, and rows that share their id and article
    long = [f"Sentence {k} of the very long page." for k in range(30_000)]
    pages += [(95, "http://long.example/", page(1, long))] + [(96, "http://own.example/again", page(7, ["Twice"]))] * 3
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = html_template.extract_main_text(df).collect()
    by = {r["page_id"]: r["text"] for r in rows}
    assert len(rows) == len(pages)
    for i in range(6):
        assert by[i] == " ".join([*shared, f"Updated {i} times so far."])
        assert by[50 + i] == (f"Story {i} " + f"of many own words {i} " * 9).strip()
    assert by[90] == "Own text 5." and by[95] == " ".join(long) and by[96] == "Twice"


def test_classes_equal_those_of_plain_vectors(spark):
    """Occurrence vectors and valid classes by plain counting, per host."""
    rng = random.Random(4)
    pages = []
    for i in range(40):
        chrome = "".join(f"<div class=c{k}>Fixed {k}</div>" for k in range(rng.randint(2, 5)))
        inner = "".join(f"<p>Text {i} {k}</p>" for k in range(rng.randint(1, 4)))
        pages.append((i, f"http://h{i % 3}.example/{i}", f"<body>{chrome}<article>{inner}</article></body>"))
    pages += [(100 + i, "http://h0.example/x", pages[0][2]) for i in range(5)]  # repeats of one article count once
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {}
    for r in html_template.occurrence_classes(df).where("layout = 0").collect():
        got.setdefault((r["host"], r["class"]), set()).add(r["token"])
    expect = set()
    for host in {html_template.host_of(u) for _, u, _ in pages}:
        mine = [p for p in pages[:40] if html_template.host_of(p[1]) == host]
        vectors = {}
        for n, (_, _, page) in enumerate(mine):
            for token, (count, _, _) in html_template.page_counts(list(html_template.tokens(page))).items():
                vectors.setdefault(token, {})[n] = count
        classes = {}
        for token, v in vectors.items():
            if len(v) >= max(html_template.CLASS_PAGES, len(mine) * html_template.CLASS_SHARE):
                classes.setdefault(tuple(sorted(v.items())), set()).add(token)
        expect |= {(host, frozenset(c)) for c in classes.values() if len(c) >= html_template.CLASS_TOKENS}
    assert {(host, frozenset(c)) for (host, _), c in got.items()} == expect and expect
