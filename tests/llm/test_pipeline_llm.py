import random
import re
from collections import Counter

import __spark_entry__ as E
import corpus_pipeline
from flowlens.llm import byte_bpe, language_id, queries, stages
from test_dedup import WHITE, brute_components


def test_queries_are_registered():
    names = [q for q in E.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and {"op3_exact_dedup", "op10_jump_sharding", "op11_prefix_trie"} <= set(E.oracle_sql())


def test_stages_on_hard_rows(spark, hard_docs, hard_rows, no_docs):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, hard_docs, sf).columns == hard_docs.columns, name
        assert stage(spark, no_docs, sf).count() == 0, name
    exact = stages.exact_dedup_stage(spark, hard_docs, sf).collect()
    assert Counter((r["text"] or "").translate(WHITE) for r in exact) == Counter({(t or "").translate(WHITE) for _, t, *_ in hard_rows})
    near = Counter(r["doc_id"] for r in stages.near_dedup_stage(spark, hard_docs, sf).collect())
    kept = Counter()
    for (i, _, c), n in brute_components(hard_rows, 5, 80).items():
        if i == c:
            kept[i] += n
    assert near == kept
    spoken = stages.language_stage(spark, hard_docs, sf).collect()
    assert {100, 101, 102, 103}.isdisjoint(r["doc_id"] for r in spoken) and len(spoken) >= len(hard_rows) - 8
    last = corpus_pipeline.STAGES[-1][1](spark, hard_docs, sf)
    assert last.columns == [*hard_docs.columns, "token_ids", "n_tokens", "decoded_ok"]
    assert last.where("decoded_ok").count() == len(hard_rows)


def test_columns_with_clashing_names_stay(spark, hard_docs, hard_rows):
    from pyspark.sql import functions as F
    extra = ["id_", "hash_", "__id", "__d", "__n", "__lang", "digest", "points", "won_digest", "won_points", "h", "kept", "Raw", "raw_", "n", "node"]
    docs = hard_docs.select("*", *(F.lit(f"own {c}").alias(c) for c in extra))
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        assert all(r[c] == f"own {c}" for r in out.select(*extra).collect() for c in extra), name
        plain = Counter(r["doc_id"] for r in stage(spark, hard_docs, sf).select("doc_id").collect())
        assert Counter(r["doc_id"] for r in out.select("doc_id").collect()) == plain, name
    # columns that the last stage makes are replaced
    last = stages.byte_bpe_stage(spark, hard_docs.withColumn("n_tokens", F.lit("mine")), sf)
    assert dict(last.dtypes)["n_tokens"] == "bigint"


def test_mixed_documents_stay_and_so_do_all_without_a_model(spark):
    words = {"en": "the and with thing house water morning people".split(), "de": "und nicht mit einer straße größe schön wasser".split(),
             "fr": "les des une avec maison être où château".split()}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words[lang], k=60)), lang) for i, lang in enumerate([*words] * 20)]
    mixed = " ".join(" ".join(w * 5) for w in words.values())
    docs = spark.createDataFrame([*rows, (900, mixed, None), (901, "12 34", None)], "doc_id long, text string, lang string")
    model = language_id.train(docs, queries.F.lit(True))
    assert language_id.predict(docs, model).where("doc_id = 900").first()["score"] < 0.5
    assert {r["doc_id"] for r in stages.language_stage(spark, docs, "").collect()} == {r[0] for r in rows} | {900}
    bare = docs.withColumn("lang", queries.F.lit(None).cast("string"))
    assert stages.language_stage(spark, bare, "").count() == docs.count()


def test_run_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    best = {}
    for r in rows:
        k = (r[1] or "").translate(WHITE)
        best[k] = min(best.get(k, (1, 0)), (-len(r[1] or ""), r[0]))
    rows = [r for r in rows if best[(r[1] or "").translate(WHITE)][1] == r[0]]
    rows = [r for r in rows if (r[0], r[0]) in {(i, c) for i, _, c in brute_components(rows, 5, 80)}]
    rows = [r for r in rows if not any(x in " ".join(re.findall(r"\w+", (r[1] or "").lower())) for x in items)]
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == {r[0] for r in rows} and len(got) == len(rows)
    bpe = byte_bpe.ByteBpe(queries.TOKENIZERS + "/byte_bpe_multi_50k.tiktoken", byte_bpe.PATTERN)
    assert all(bpe.decode(list(r["token_ids"])) == (r["text"] or "").encode() for r in got)
