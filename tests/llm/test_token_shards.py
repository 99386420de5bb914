import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessella.llm import storage
from tessella.llm import token_shards as ts

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", "The the THE cat's 'll don't -- 42 ½ x²", "héllo wörld ÀÉ", "日本語 テキスト 🎉 mixed text", "<|endoftext|> marks", "á combining", "tab\tand\nline hard", "İstanbul ſ K", "word " * 3000]


def test_encoder_is_the_library():
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(TEXTS, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in ts.WordEncoder(PATH).encode(TEXTS)] == want


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_encoder_on_any_text(t):
    coder = test_encoder_on_any_text.__dict__.setdefault("coder", ts.WordEncoder(PATH))
    assert np.frombuffer(coder.encode([t])[0], "<u4").tolist() == coder.tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(1, 5))
def test_grammar_round_trip(ids, least):
    ids = np.array(ids, np.uint32)
    rules, lengths, symbols = ts.repair(ids, 6, min_count=max(2, least))
    assert ts.expand(symbols, rules, 6).tolist() == ids.tolist()
    full = [len(ts.expand(np.array([6 + k], np.uint32), rules, 6)) for k in range(len(rules))]
    assert lengths.tolist() == full
    shard = {"symbols": symbols.astype("<u4").tobytes(), "width": 4, "rules": rules.astype("<u4").tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(), "base": 6, "samples": ts.samples_of(symbols, lengths, 6)}
    for a, z in ((0, len(ids)), (3, 17), (len(ids) // 2, len(ids) // 2 + 9), (5, 5), (len(ids) - 1, len(ids) + 5)):
        assert ts.decode_range(shard, a, z).tolist() == ids[max(a, 0) : z].tolist()


def test_grammar_shrinks_what_repeats():
    ids = np.tile(np.arange(10, dtype=np.uint32), 500)
    assert len(ts.repair(ids, 10)[2]) < len(ids) / 8


def uses(symbols):
    """The most uses of a pair, without overlaps."""
    pairs = {}
    for k, p in enumerate(zip(symbols.tolist(), symbols[1:].tolist(), strict=False)):
        n, last = pairs.get(p, (0, -2))
        if last < k - 1:
            pairs[p] = (n + 1, k)
    return max((n for n, _ in pairs.values()), default=0)


def test_grammar_goes_on_until_no_pair_is_frequent(monkeypatch):
    r = np.random.default_rng(3)
    base = np.concatenate([r.integers(0, 900, 3000)] * 40 + [r.integers(0, 30, 20_000)]).astype(np.uint32)
    rules, lengths, symbols = ts.repair(base, 1000, min_count=10)
    assert uses(symbols) < 10 and lengths.max() > 1000 and len(symbols) < 12_000
    assert ts.expand(symbols, rules, 1000).tolist() == base.tolist()
    monkeypatch.setattr(ts, "SAMPLE", 8)
    shard = {"symbols": symbols.astype("<u4").tobytes(), "width": 4, "rules": rules.astype("<u4").tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(), "base": 1000, "samples": ts.samples_of(symbols, lengths, 1000)}
    for a in r.integers(0, len(base), 200).tolist():
        for n in (1, 40, 5000):
            assert ts.decode_range(shard, a, a + n).tolist() == base[a : a + n].tolist()


def test_some_documents_are_read_alone(spark):
    data = [(k, f"text {k} " * (k % 7), 0, "x") for k in range(60)] + [(None, "nobody's", 0, "x"), (5, "again five", 0, "x")]
    file = storage.written(ts.encode_shards(spark.createDataFrame(data, "doc_id bigint, text string, n_tokens int, start string"), PATH, shard_tokens=50), "test-shards")
    got = ts.read_ranges(file, spark.createDataFrame([(5,), (17,), (None,), (1000,), (5,)], "doc_id bigint")).collect()
    coder = Tokenizer.from_file(PATH)
    want = [(i, [*coder.encode(t, add_special_tokens=False).ids, 2]) for i, t, _, _ in data if i in (5, 17, None)]
    assert sorted(map(str, ((r.doc_id, r.ids) for r in got))) == sorted(map(str, want))
    assert [(r.local_start, r.part) for r in got if r.doc_id == 17] == [(r.local_start, r.part) for r in ts.read_documents(file).collect() if r.doc_id == 17]


def test_many_equal_rows_are_split(spark):
    data = [(7, "the same text", 0, "x")] * 4000 + [(k, "other", 0, "x") for k in range(20)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, n_tokens int, start string").repartition(4)
    file = storage.written(ts.encode_shards(df, PATH, partitions=4), "test-shards")
    got = ts.read_documents(file).collect()
    assert len(got) == 4020 and max(r["count"] for r in ts.read_documents(file).groupBy("part").count().collect()) < 2000
    stops = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert stops[0][0] == 0 and all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(stops, stops[1:], strict=False))


def rows(spark, data):
    df = spark.createDataFrame(data, "doc_id bigint, text string, n_tokens int, start string")
    return ts.read_documents(storage.written(ts.encode_shards(df, PATH, shard_tokens=700), "test-shards")).collect()


def test_file_round_trip(spark):
    data = [(k, t, 0, "x") for k, t in enumerate(TEXTS * 3)] + [(4, TEXTS[4], 0, "x"), (None, None, 0, "x"), (99, None, 0, None)]
    got = rows(spark, data)
    coder, want, start = Tokenizer.from_file(PATH), [], 0
    for i, t in sorted(((-1 if i is None else i, t or "") for i, t, _, _ in data), key=lambda r: r[0]):
        ids = np.array([*coder.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((None if i < 0 else i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert rows(spark, []) == []
