import hashlib
import random
import zlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tessella.llm import queries, simhash, toxicity
from tessella.llm.byte_bpe import load_ranks
from tests.llm.test_fm_index import brute as brute_hits
from tests.llm.test_simhash import brute_components, brute_print


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    r = random.Random(11)
    words = [a + b + c for a in ("ka", "lo", "mi", "tu", "re") for b in ("ra", "se", "no", "pi") for c in ("p", "q", "x", "")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(k, text(18)) for k in range(6)]
    docs = [(k, text(r.randint(30, 90)), "en", "s", 1) for k in range(150)]
    docs += [(200 + k, docs[k][1] if k % 2 else docs[k][1].upper(), "en", "s", 1) for k in range(20)]
    docs += [(300 + k, text(40) + " " + items[k % 6][1] + " " + text(5), "en", "s", 1) for k in range(12)]
    docs += [(400 + k, " ".join([text(15), "vile" + r.choice("abc"), text(10), "vileness", text(5)]), "en", "s", 1) for k in range(60)]
    docs += [(600, None, None, None, None), (601, "", "en", "s", 0), (602, "  ", "en", "s", 0)]
    labels = [(k, 1, int(400 <= k < 500)) for k, *_ in docs if k < 600]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, docs, items


def test_against_brute_force(spark, folder):
    d, docs, items = folder
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, d).collect()}
    clean = [(i, t) for i, t, *_ in docs if not 400 <= i < 500]
    groups = brute_components({i: brute_print(t) for i, t in clean})
    kept = [(i, t) for i, t in clean if groups[i] == i]
    assert 600 in dict(kept) and 601 not in dict(kept) and 201 not in dict(kept) and 202 not in dict(kept)
    kept = [row for row, (_, hit, _) in zip(kept, brute_hits([t for _, t in kept], items), strict=True) if not hit]
    coder = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {}
    for i, t in kept:
        ids = coder.encode_ordinary(t or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert got == want


def test_stages_keep_the_columns(spark, folder):
    d, docs, _ = folder
    df = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, d)
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_an_empty_table_and_repeated_rows(spark, folder):
    d, docs, _ = folder
    df = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.where("false"), d).collect() == []
    twice = df.where("doc_id in (5, 600)").unionByName(df.where("doc_id in (5, 600)"))
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, twice, d).collect()) == [5, 600]
    assert len(corpus_pipeline.drop_toxic(spark, twice, d).collect()) == 4


def test_columns_with_clashing_names_stay(spark, folder):
    d, docs, _ = folder
    names = ["score", "predicted", "n_hit", "n_words", "items", "spans", "fp", "least", "label", "node", "component_id", "fingerprint", "kept_id", "tie"]
    df = spark.read.parquet(f"{d}/documents.parquet").where("doc_id < 40").selectExpr("*", *[f"'{n}' as {n}" for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, d)
        assert out.columns == df.columns and out.count() > 20 and all(r[n] == n for r in out.collect() for n in names)
    assert corpus_pipeline.encode(spark, df, d).count() == 40


def test_queries_are_registered():
    names = list(queries.QUERIES)
    assert [next(n for n in names if n.startswith(f"op{k}_")) for k in range(1, 11)]
    assert set(queries.ORACLE_SQL) <= set(names)


def test_planted_toxic_are_caught_out_of_sample(spark, folder):
    d, docs, _ = folder
    rows = toxicity.scores(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert all(r.predicted == int(400 <= r.doc_id < 500) for r in held)
    assert simhash.fingerprint(None) == 0
