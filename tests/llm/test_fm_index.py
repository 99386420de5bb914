import hashlib
import random

import numpy as np
import pytest

from tessella.llm import fm_index as fm


def brute(docs, items, window=10):
    """(words, hit words, items) of each document by comparing every window with every place."""
    out = []
    for text in docs:
        words = fm.words_of(text)
        hit, found = [False] * len(words), set()
        for i, t in items:
            item = fm.words_of(t)
            for k in range(max(1, len(item) - window + 1)):
                w = item[k : k + window]
                for a in range(len(words) - len(w) + 1 if w else 0):
                    if words[a : a + len(w)] == w:
                        found.add(str(i))
                        hit[a : a + len(w)] = [True] * len(w)
        out.append((len(words), sum(hit), sorted(found)))
    return out


def test_words():
    assert fm.words_of("Don't STOP—été 42_a\x00b") == [b"don", b"t", "stop—été".encode(), b"42", b"a", b"b"]
    assert fm.words_of(None) == fm.words_of(" .,") == []


def test_wavelet_matrix():
    r = np.random.default_rng(1)
    for bits in (1, 3, 6):
        seq = r.integers(0, 1 << bits, 500)
        tree = fm.WaveletMatrix(seq, bits)
        i, c = r.integers(0, 501, 300), r.integers(0, 1 << bits, 300)
        assert tree.rank(c, i).tolist() == [int((seq[:b] == a).sum()) for a, b in zip(c, i, strict=True)]
        assert tree.access(np.arange(500)).tolist() == seq.tolist()


@pytest.mark.parametrize("seed", range(40))
def test_index_finds_every_place(seed):
    r = np.random.default_rng(seed)
    alphabet = int(r.integers(1, 5))
    text = np.concatenate(([0], r.integers(0, alphabet + 1, int(r.integers(0, 300))), [0]))
    if seed % 2:
        text = np.concatenate([text, text, text])  # long repeats
    index = fm.FmIndex(text, alphabet)
    for n in range(1, 14):
        p = r.integers(1, alphabet + 1, n)
        low, high = index.search(p[None, :], np.array([n]))
        want = [k for k in range(len(text) - n + 1) if (text[k : k + n] == p).all()]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


@pytest.mark.parametrize("seed", range(25))
def test_shards_match_brute_force(seed):
    r = random.Random(seed)
    word = lambda: r.choice("a b c d e".split()[: r.randint(1, 5)])
    items = [(k, " ".join(word() for _ in range(r.randint(0, 7)))) for k in range(5)]
    docs = [" ".join(r.choice([word(), "zz"]) if r.random() < 0.2 else word() for _ in range(r.randint(0, 60))) for _ in range(r.randint(0, 9))]
    docs += docs[:2]
    phrases = fm.Phrases(items, 4)
    got = [(len(fm.words_of(d)), sum(z - a for a, z in s), sorted(i)) for d, (i, s) in zip(docs, fm.scan_shard([fm.words_of(d) for d in docs], phrases), strict=True)]
    assert got == brute(docs, items, 4)


DOCS = ["lead in the quick brown fox jumps over the lazy dog again and out", None, "", "no hit here", "short item", "x " * 30000 + "the quick brown fox jumps over the lazy dog again"]
ITEMS = [(10, "The quick, brown fox jumps over the lazy dog AGAIN and again"), (9, "short item"), (2, None), (3, "..."), (11, "Short item")]


@pytest.mark.parametrize("shard,block", [(1 << 20, 1 << 26), (5, 1 << 26), (1 << 20, 40)])
def test_documents(spark, monkeypatch, shard, block):
    monkeypatch.setattr(fm, "SHARD_WORDS", shard)
    monkeypatch.setattr(fm, "PHRASE_BYTES", block)
    docs = spark.createDataFrame([(k, t, 0, "x") for k, t in enumerate(DOCS)] + [(0, DOCS[0], 0, "x"), (None, "short item", 0, "x")], "doc_id bigint, text string, n_hit int, spans string")
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in fm.digests(fm.contamination(docs, bench)).collect()}
    want = set()
    for (i, t), (n, h, items) in zip([*enumerate(DOCS), (None, "short item")], brute([*DOCS, "short item"], ITEMS), strict=True):
        want.add((i, n, h, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), h > 0))
    assert got == want
    all_ = fm.annotated(docs, bench).collect()
    assert len(all_) == 8 and {r.doc_id for r in all_ if r.n_hit} == {0, 4, 5, None}
    assert [(s.begin, s.end) for r in all_ if r.doc_id == 0 for s in r.spans][0] == (2, 13)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert fm.contamination(docs.where("false"), bench).collect() == []
    assert [r.n_hit for r in fm.contamination(docs, bench.where("false")).collect()] == [0]


def test_items_with_a_null_id_hit(spark):
    docs = spark.createDataFrame([(1, "see short item here"), (2, "one two and short item"), (3, "none")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, "short item"), (None, "see"), (4, "one two")], "item_id bigint, text string")
    got = {r.doc_id: (r.n_hit, r.items) for r in fm.contamination(docs, bench).collect()}
    assert got == {1: (3, [None]), 2: (4, ["4", None]), 3: (0, [])}
    digest = {r.doc_id: (r.n_items, r.items_sha256, r.contaminated) for r in fm.digests(fm.contamination(docs, bench)).collect()}
    assert digest[1] == (1, hashlib.sha256(b"").hexdigest(), True) and digest[2] == (2, hashlib.sha256(b"4").hexdigest(), True)
