import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from tessella.llm import kneser_ney as kn


def model(rows):
    """An independent dictionary version: (words of each row, p(word | before), counts, N, V)."""
    words = [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) + ["end"] for _, t in rows]
    train = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    c, pairs = collections.Counter(), collections.Counter()
    for w, t in zip(words, train, strict=True):
        if t:
            c.update(w)
            pairs.update(zip(["start", *w], w, strict=False))
    left, context = collections.Counter(w for _, w in pairs), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (v, _), n in pairs.items():
        context[v][0] += n
        context[v][min(n, 3)] += 1
    coc = lambda x: [sum(v == k for v in x.values()) for k in (1, 2, 3, 4)]
    d, e = kn.discounts(coc(pairs)), kn.discounts(coc(left))
    total = sum(left.values())
    h = sum(e[min(x, 3)] for x in left.values()) / total if total else 1.0
    one = lambda w: (max(left[w] - e[min(left[w], 3)], 0) / total if total else 0) + h / (len(c) + 1)

    def p(v, w):
        if v not in context:
            return one(w)
        t, *n = context[v]
        return max(pairs[v, w] - d[min(pairs[v, w], 3)], 0) / t + sum(a * b for a, b in zip(d[1:], n, strict=True)) / t * one(w)

    return words, train, p, c, sum(c.values()), len(c)


def check(spark, rows, buckets=None):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, score int, extra string")
    got = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in kn.held_out_scores(df).collect())
    words, train, p, c, n, v = model(rows)
    want = collections.Counter()
    for (i, _), w, t in zip(rows, words, train, strict=True):
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[i, not t, len(w), sum(c[x] > 0 for x in w), n, round(base, 6), round(sum(math.log10(p(a, b)) for a, b in zip(["start", *w], w, strict=False)), 6)] += 1
    assert got == want
    for before in [*list(c)[:5], "start", b"never seen"]:
        assert math.isclose(sum(p(before, w) for w in c) + p(before, b"another one"), 1, rel_tol=1e-9)


def test_scores(spark, monkeypatch):
    r = random.Random(5)
    rows = [(k, " ".join(r.choice("a A b c d e f g h the the The été x.".split()) for _ in range(r.randint(0, 60)))) for k in range(120)]
    rows += [(7, None), (8, ""), (None, "a b c"), (3, rows[3][1]), (500, "the " * 70000 + "a\x0bb\x1cc\x85d")]
    check(spark, rows)
    monkeypatch.setattr(kn, "BLOCK_WORDS", 16)  # many blocks
    check(spark, rows)
    monkeypatch.setattr(kn, "HELD_PAIRS", 20)  # tasks that send more than once
    check(spark, rows)
    monkeypatch.setattr(kn, "BUCKET_BYTES", 4096)
    monkeypatch.setattr(kn, "OPEN_FILES", 3)
    check(spark, rows)


def test_frequent_first_words_are_split(spark):
    r = random.Random(1)
    text = " ".join(f"the w{r.randrange(10**6)}" for _ in range(6000))
    df = spark.createDataFrame([(k, text) for k in range(3)], "doc_id bigint, text string")
    hot = kn.frequent(df, 3, 64)
    the = kn.word_hash(b"the")
    assert dict(zip(*hot.tolist(), strict=True))[the] == 64 and hot.shape[1] < 10
    words = np.array([kn.word_hash(f"w{k}".encode()) for k in range(3000)], np.uint64)
    home = kn.pair_home(np.full(3000, the, np.uint64), words, 64, hot)
    assert np.bincount(home, minlength=64).max() < 100
    assert (kn.pair_home(words, words, 64, hot) == (words % np.uint64(64)).astype(int)).all()


def test_a_lost_file_is_an_error(spark):
    df = spark.createDataFrame([(k, "one two three") for k in range(40)], "doc_id bigint, text string")
    about = kn.build(df)
    assert kn.score(df, about).count() == 40
    import glob

    for f in glob.glob(about["root"].removeprefix("file:") + "/pairs-3.hash"):
        os.remove(f)
    with pytest.raises(Exception, match="No such file"):
        kn.score(df.selectExpr("doc_id", "concat(text, ' ', uuid()) text"), about).collect()


def test_little_training(spark):
    check(spark, [(k, "one two three") for k in range(40) if zlib.crc32(str(k).encode()) % 10 == 0])
    check(spark, [(1, "lonely words")])


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert kn.held_out_scores(df).collect() == []


def test_packing():
    r = np.random.default_rng(0)
    h = r.integers(0, 1 << 56, 100).astype(np.uint64)
    assert (kn.unpack(kn.pack(h)) == h).all()
    n = np.array([0, 1, 254, 255, 256, 1 << 40])
    assert (kn.unpack_counts(kn.pack_counts(n), len(n)) == n).all()


@pytest.mark.parametrize("ns", [[0, 0, 0, 0], [5, 0, 1, 1], [100, 40, 20, 10]])
def test_discounts_stay_below_counts(ns):
    d = kn.discounts(ns)
    assert d[0] == 0 and all(0 < x < k for k, x in enumerate(d) if k)
