import collections
import random

import public_tokenizers
import pytest
import tiktoken

from tessella.llm import rollup, storage
from tessella.llm.byte_bpe import load_ranks

FEED = "source string, lang string, tokenizer_version string, op string, tokens bigint, old_tokens bigint, extra string"


def totals(store):
    return {(r.source, r.lang, r.tokenizer_version): (r.documents, r.tokens) for r in store.totals().collect()}


def test_deltas_against_a_dictionary(spark):
    r = random.Random(6)
    store, want = rollup.TokenRollup(spark, storage.new_path(spark, "t")), collections.defaultdict(lambda: [0, 0])
    assert totals(store) == {}
    for batch in range(5):
        rows = []
        for _ in range(30):
            key = (r.choice(["a", "a", "a", None]), r.choice(["en", None]), "v1")
            op, new, old = r.choice(["insert", "delete", "revise"]), r.choice([None, r.randint(0, 9)]), r.choice([None, r.randint(0, 9)])
            rows.append((*key, op, new, old, "x"))
            want[key][0] += {"insert": 1, "delete": -1, "revise": 0}[op]
            want[key][1] += {"insert": new or 0, "delete": -(new or 0), "revise": (new or 0) - (old or 0)}[op]
        df = spark.createDataFrame(rows, FEED)
        assert store.commit(f"batch {batch}", df) is True
        assert store.commit(f"batch {batch}", df) is False
        assert totals(store) == {k: tuple(v) for k, v in want.items()}
        if batch in (1, 3):
            store.compact()
            assert totals(store) == {k: tuple(v) for k, v in want.items()}
    again = rollup.TokenRollup(spark, store.root)
    assert again.committed("batch 0") and not again.commit("batch 0", df) and totals(again) == totals(store)


def test_one_of_two_writers_wins(spark, monkeypatch):
    root = storage.new_path(spark, "t")
    a, b = rollup.TokenRollup(spark, root), rollup.TokenRollup(spark, root)
    df = spark.createDataFrame([("s", "en", "v", "insert", 5, None, "")], FEED)
    monkeypatch.setattr(b, "committed", lambda _: False)  # b looked before a wrote its marker
    assert a.commit("x", df) and not b.commit("x", df)
    assert totals(a) == {("s", "en", "v"): (1, 5)}


def one(spark, n):
    return spark.createDataFrame([("s", "en", "v", "insert", n, None, "")], FEED)


def test_a_writer_that_dies_before_its_commit_leaves_nothing(spark, monkeypatch):
    store = rollup.TokenRollup(spark, storage.new_path(spark, "t"))
    publish = store._publish

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(store, "_publish", dies)
    with pytest.raises(KeyboardInterrupt):
        store.commit("x", one(spark, 5))
    assert not store.committed("x") and totals(store) == {}
    monkeypatch.setattr(store, "_publish", publish)
    assert store.commit("x", one(spark, 5)) and not store.commit("x", one(spark, 5)) and totals(store) == {("s", "en", "v"): (1, 5)}
    # a compaction that dies after it published, before anything is marked
    mark = store._mark_done
    monkeypatch.setattr(store, "_mark_done", lambda batches: dies() if batches else None)
    with pytest.raises(KeyboardInterrupt):
        store.compact()
    monkeypatch.setattr(store, "_mark_done", mark)
    assert totals(store) == {("s", "en", "v"): (1, 5)} and not store.commit("x", one(spark, 5))
    assert not store.compact() and not store._names("live")
    assert totals(store) == {("s", "en", "v"): (1, 5)} and not store.commit("x", one(spark, 5))


def test_a_folder_that_loses_the_race_is_not_read(spark):
    store = rollup.TokenRollup(spark, storage.new_path(spark, "t"))
    assert store.commit("x", one(spark, 5))
    name = "live/" + store._marker("x")
    one(spark, 7).selectExpr("source", "lang", "tokenizer_version", "1L documents", "tokens").write.parquet(f"{store.root}/_draft-late")
    store._fs.rename(store._path("_draft-late"), store._path(name))  # between the other's look and its own renaming
    assert totals(store) == {("s", "en", "v"): (1, 5)}
    assert not store._publish("_draft-late", name) and not store._fs.exists(store._path(f"{name}/_draft-late"))
    assert totals(store) == {("s", "en", "v"): (1, 5)}


def test_reads_list_the_last_batches_alone(spark):
    store = rollup.TokenRollup(spark, storage.new_path(spark, "t"))
    for k in range(6):
        store.commit(str(k), one(spark, k))
        early = store.totals()
        assert store.compact()
        assert {r.tokens for r in early.collect()} == {sum(range(k + 1))}  # a read that began before
    assert len(store._names("live")) == 1 and not store.compact()
    assert len(store._names("live")) == 0 and len(store._names("snapshots")) == 1 and len(store._names("done")) == 6
    assert totals(store) == {("s", "en", "v"): (6, 15)} and not store.commit("2", one(spark, 9))


def test_empty_and_unknown(spark):
    store = rollup.TokenRollup(spark, storage.new_path(spark, "t"))
    assert store.commit("none", spark.createDataFrame([], FEED)) and totals(store) == {}
    with pytest.raises(Exception, match="unknown change"):
        store.commit("bad", spark.createDataFrame([("s", "en", "v", "upsert", 5, None, "")], FEED))
    assert not store.committed("bad")


def test_history_over_documents(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    docs = [(1, "one text", "en", "s"), (2, "one text", "en", "t"), (3, None, None, "s"), (4, "", "en", "s"), (5, "Other words, here.", "de", None), (6, "one text", "en", "s")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string")
    got = {(r.source, r.lang, r.tokenizer_version): (r.documents, r.tokens) for r in rollup.replayed(df, path, public_tokenizers.PATTERN).collect()}
    want, seen = collections.defaultdict(lambda: [0, 0]), set()
    for _, text, lang, source in docs:
        n = len(coder.encode_ordinary(text or ""))
        a, b = want[source, lang, "byte_bpe_50k"], want[source, lang, "byte_bpe_50k+end"]
        new = (text or "") not in seen
        seen.add(text or "")
        a[0] += new
        a[1] += n * new
        b[0] += 1
        b[1] += n + 1
    assert got == {k: tuple(v) for k, v in want.items()}
    assert rollup.replayed(df.where("false"), path, public_tokenizers.PATTERN).collect() == []
