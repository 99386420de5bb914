import random
import zlib

import numpy as np

from tessella.llm import toxicity as tx

ATOMS = {"idiot": 3.0, "blor*": 4.0}


def kinds(text, atoms=None):
    return dict(zip(tx.KINDS, tx.Scorer(atoms or ATOMS, tx.PRIOR).kinds(text), strict=True))


def only(text, kind, weight):
    assert kinds(text) == dict.fromkeys(tx.KINDS, 0.0) | {kind: weight}, (text, kinds(text))


def test_clauses():
    only("What an idiot", "plain", 3.0)
    only("blortant day", "plain", 4.0)
    only("blor", "plain", 0.0)  # the beginning alone is no word of the lexicon
    only("You are an idiot.", "aimed", 3.0)
    only("you. An idiot", "plain", 3.0)  # another clause
    only("not an idiot", "negated", 3.0)
    only("isn't an idiot", "negated", 3.0)
    only("not one of those who, being there, was an idiot", "plain", 3.0)  # out of the negation's scope
    only("He said that you idiot", "reported", 3.0)
    only('She wrote "idiot. idiot" and left', "reported", 6.0)
    only("I will kill you", "threat", 2.0)
    only("kill time", "threat", 0.0)
    assert kinds(None) == kinds("") == dict.fromkeys(tx.KINDS, 0.0)


def test_composition_is_the_four_machines():
    r, g = random.Random(3), tx.Grammar()
    for _ in range(200):
        state, parts = 0, [0, 0, 0, 0]
        for _ in range(20):
            c = r.randrange(9)
            state, _ = g.move(state, c)
            parts = [m(s, c)[0] for m, s in zip((tx._threat, tx._target, tx._negation, tx._report), parts, strict=True)]
            parts = [0, 0, 0, parts[3]] if c == tx.STOP else parts
            assert g.states[state] == tuple(parts)


def test_near_copies_count_once():
    r = random.Random(1)
    texts = [[r.choice("abcdefgh") * 3 + str(r.randrange(50)) for _ in range(80)] for _ in range(3)]
    sketches = [tx._sketch(t) for t in (texts[0], [*texts[0][:-1], "changed"], texts[1], texts[2])]
    assert len(set(tx._groups(sketches))) == 3


def corpus(n=900):
    r = random.Random(9)
    plain = [a + b + c for a in ("ka", "lo", "mi", "tu") for b in ("ra", "se", "no") for c in ("p", "q", "x", "")]
    docs, labels = [], []
    for k in range(n):
        words = [r.choice(plain) for _ in range(40)]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(40), r.choice(["vile" + r.choice("abcdefg"), "grumbly"]))
        docs.append((k, " ".join(words), "en"))
        labels.append((k, int(toxic)))
    return docs, labels


def test_learns_and_holds_out(spark):
    docs, labels = corpus()
    df = spark.createDataFrame([*docs, (5000, None, "en"), (5001, "", None), (None, docs[0][1], "en"), (0, docs[0][1], "en")], "doc_id bigint, text string, predicted string")
    lab = spark.createDataFrame([*labels, (0, 1), (None, 1), (77777, 1), (1, None)], "doc_id bigint, toxic int")
    rows = tx.scores(df, lab).collect()
    assert len(rows) == len(docs) + 4
    truth = dict(labels)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.doc_id in (5000, 5001):
            assert r.predicted == 0 and r.score == min(x.score for x in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98


def test_held_out_labels_do_not_matter(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    a = tx.scores(df, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    b = tx.scores(df, spark.createDataFrame([(i, 1 - y if out(i) else y) for i, y in labels], "doc_id bigint, toxic int")).collect()
    assert sorted(a) == sorted(b)


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "you idiot moron stupid loser"), (2, "fine")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = {r.doc_id: r.predicted for r in tx.scores(df, none).collect()}
    assert got == {1: 1, 2: 0}
    assert tx.scores(df.where("false"), none).collect() == []


def plain_kinds(text, atoms):
    """The weights by kind without any machine: for each insult or target, a look back over the tokens of its clause."""
    tokens = tx.tokens_of((text or "").lower())
    word = {w: c for c, words in tx.WORD_CLASSES.items() for w in words}
    weight = {t: max((atoms.get(a, 0.0) for a in [t, *(t[:k] + "*" for k in (4, 5, 6, 7, 8) if len(t) > k)]), default=0.0) for t in tokens if t not in word and t not in tx.MARKS}
    insult = lambda t: bool(weight.get(t))
    negation = lambda t: word.get(t) == tx.NEGATION or (t in weight and not insult(t) and t.endswith("n't"))
    out, quoted, start = dict.fromkeys(tx.KINDS, 0.0), False, 0
    for k, t in enumerate(tokens):
        if tx.MARKS.get(t) == tx.OPEN:
            quoted = not quoted
            said_from = k
        elif tx.MARKS.get(t) == tx.CLOSE:
            quoted, said_from = False, k
        elif tx.MARKS.get(t) == tx.STOP:
            start = k + 1
        near = tokens[max(start, k - 3) : k]
        if insult(t):
            since = max(start, said_from + 1 if "said_from" in locals() else 0)
            reported = quoted or any(word.get(x) == tx.REPORT for x in tokens[since:k])
            aimed = any(word.get(x) == tx.TARGET for x in tokens[max(start, k - 4) : k])
            out["reported" if reported else "negated" if any(map(negation, near)) else "aimed" if aimed else "plain"] += weight[t]
        elif word.get(t) == tx.TARGET:
            verbs = [j for j in range(max(start, k - 3), k) if word.get(tokens[j]) == tx.THREAT]
            if verbs and not any(word.get(x) == tx.TARGET for x in tokens[verbs[-1] : k]):
                out["threat"] += 2.0
    return out


def test_clauses_against_a_plain_reading():
    r = random.Random(12)
    words = ["idiot", "blorx", "you", "him", "not", "isn't", "said", '"', "“", "”", ".", "\n", "kill", "beat", "day", "tree", "and", "what"]
    for _ in range(3000):
        text = " ".join(r.choice(words) for _ in range(r.randint(0, 25)))
        assert kinds(text) == plain_kinds(text, ATOMS), text


def test_the_fit_is_where_the_slope_is_zero():
    r = np.random.default_rng(5)
    feats = r.gamma(1.0, 2.0, (400, 5)) * (r.random((400, 5)) < 0.4)
    y = (feats.sum(1) + r.normal(0, 1, 400) > 4).astype(float)
    w = tx.fit(feats, y)
    x = np.array([[1.0, np.log1p(f.sum()), *np.log1p(f[1:])] for f in feats])
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (y - p) - tx.PRECISION * (w - tx.PRIOR)).max() < 1e-6


def test_tails_are_exact():
    import math

    for n, t, p in ((5, 2, 0.3), (40, 11, 0.1), (200, 200, 0.5)):
        assert np.isclose(tx._tail(n, t, p), math.log(sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(t, n + 1))))


def test_the_sample_is_bounded_and_settled(spark):
    docs = [(3, f"text {k % 3}") for k in range(2000)] + [(k, "other") for k in range(4, 60)] + [(2, None)]
    labels = [(3, 1)] * 500 + [(k, k % 2) for k in range(4, 60)] + [(5, 0), (8, 1), (2, 1)]
    rows = tx.sample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int"), 10, 10).collect()
    assert len(rows) <= 20 and len({r.doc_id for r in rows}) == len(rows)
    everything = tx.sample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    got = {r.doc_id: (r.text, r.toxic) for r in everything}
    out = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    assert 5 not in got and 8 not in got and set(got) == {i for i in [2, 3, *range(4, 60)] if not out(i)} - {5, 8}
    assert got.get(3, ("text 0", 1)) == ("text 0", 1) and got.get(2, (None, 1)) == (None, 1)
