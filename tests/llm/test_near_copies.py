import random
import re

import pytest

import corpus_pipeline
from tessella.llm import components, near_copies, simhash


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def brute(texts):
    """Component of each text, as the smallest index in it."""
    sets, of = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if 5 * both >= 4 * either and of[i] != of[j]:
                lo, hi = sorted((of[i], of[j]))
                of = [lo if x == hi else x for x in of]
    return of


def edited(r, text, n):
    words = text.split()
    for k in r.sample(range(len(words)), n):
        words[k] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def texts_with_edits():
    r = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    line = " ".join(r.choice(words) for _ in range(12))
    bases = [" ".join(r.choice(words) for _ in range(r.choice((8, 40, 100, 248)))) for _ in range(30)]
    texts = [b if k % 3 else f"{b} {line}" for k, b in enumerate(bases)]
    texts += [edited(r, r.choice(bases), r.randint(1, 5)) for _ in range(60)]
    for _ in range(60):  # chains: each an edit of the one before, so ends are far apart
        texts.append(edited(r, texts[-1] if len(texts[-1].split()) > 60 else bases[3] + " " + bases[4], 1))
    return [*texts, None, "", " ", "one", "ONE", "one two"]


@pytest.mark.parametrize(("rounds", "small"), [(1, 10**6), (3, 32), (6, 2)])
def test_components_against_brute_force(spark, rounds, small):
    texts = texts_with_edits()
    rows = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), rounds, small).collect()
    least = {}
    for r in rows:
        least[r.component] = min(r.doc_id, least.get(r.component, r.doc_id))
    got, want = [least[r.component] for r in sorted(rows, key=lambda r: r.doc_id)], brute(texts)
    if small > 2:
        assert got == want
    else:  # drawn members alone: nothing wrong, and nearly all
        assert all(want[x] == want[k] for k, x in enumerate(got)) and len(set(got)) - len(set(want)) <= 0.1 * (len(texts) - len(set(want)))


@pytest.mark.parametrize("few", [10**9, 0])
def test_no_link_is_left_out(spark, few):
    """One large cell and one round of drawn members: the links that these miss are found under the sets' first elements."""
    r, base = random.Random(12), " ".join(f"w{k}" for k in range(200))
    texts = [edited(r, base, 3) for _ in range(60)] + [edited(r, base, 2) for _ in range(20)]
    rows = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 1, 2, few).collect()
    want, least = brute(texts), {}
    for x in rows:
        least[x.component] = min(x.doc_id, least.get(x.component, x.doc_id))
    assert len(set(want)) < len(texts) and [least[x.component] for x in sorted(rows, key=lambda x: x.doc_id)] == want


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    """Small files may stand for large tables, so no join may trust their size; places are bounded, open cells and leaders few."""
    plans, write = [], near_copies.storage.written
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(near_copies.storage, "written", lambda df, *a, **b: plans.append(plan(df)) or write(df, *a, **b))
    monkeypatch.setattr(components, "SENT", 1, raising=False)
    found = near_copies.near_copies
    monkeypatch.setattr(near_copies, "near_copies", lambda docs: found(docs, 2, 4))
    plans.append(plan(corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(list(enumerate(texts_with_edits())), "doc_id bigint, text string"), "")))
    few = re.compile(r"BroadcastHashJoin \[(cell|place)#.*(LeftAnti|LeftSemi|its#)")
    joins = [x for p in plans for x in p.splitlines() if "BroadcastHashJoin" in x and not few.search(x)]
    assert joins == [] and sum(p.count("SortMergeJoin") for p in plans) >= 10


def test_disk_is_for_sets_that_may_be_similar(spark, monkeypatch):
    """Texts that share a passage and little else: neither texts nor pairs of them are stored, only those of the two that are alike."""
    r, rows, write = random.Random(6), {}, near_copies.storage.written
    line = "one line that all of these texts hold somewhere"
    texts = [" ".join([*(f"w{r.randrange(10**6)}" for _ in range(80)), line]) for _ in range(40)]

    def counted(df, name, **options):
        out = write(df, name, **options)
        rows[name] = rows.get(name, 0) + (out.count() if name in ("copies-sets", "copies-possible", "copies-pairs") else 0)
        return out

    monkeypatch.setattr(near_copies.storage, "written", counted)
    found = near_copies.near_copies(spark.createDataFrame(list(enumerate([*texts, edited(r, texts[0], 1)])), "doc_id bigint, text string"))
    assert found.select("component").distinct().count() == 40
    assert rows["copies-sets"] == 2 and rows["copies-possible"] == rows["copies-pairs"] == 1


def test_earlier_pairs_are_joined_again_as_one_link_a_node(spark, monkeypatch):
    """Forty copies with an edit each: later rounds get a link from each node to its label, not the pairs of all rounds."""
    r, sizes, label = random.Random(2), [], near_copies.components
    base = " ".join(f"w{k}" for k in range(300))
    texts = [edited(r, base, 1) for _ in range(30)] + [edited(r, base, 9) for _ in range(10)]
    monkeypatch.setattr(near_copies, "components", lambda pairs, *a: sizes.append(pairs.count()) or label(pairs, *a))
    found = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 3, 10)
    assert found.select("component").distinct().count() == len(set(brute(texts)))
    assert len(sizes) > 1 and max(sizes[1:]) < 80 < sizes[0]


def test_the_stage_drops_texts_with_one_word_edited(spark):
    r = random.Random(9)
    base = " ".join(f"w{r.randrange(500)}" for _ in range(248))
    rows = [(k, edited(r, base, 1) if k else base) for k in range(20)] + [(50, " ".join(f"v{r.randrange(500)}" for _ in range(248)))]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert sorted(x.doc_id for x in kept.collect()) == [0, 50]


def test_the_stage_keeps_a_row_of_each_group_whatever_its_id(spark):
    r = random.Random(3)
    text = lambda: " ".join(f"w{r.randrange(500)}" for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    rows = [(None, a), (None, b), (None, edited(r, b, 1)), (7, c), (7, d), (7, d), (8, edited(r, c, 1)), (9, e), (None, e), (None, None), (7, None)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    got = [(x.doc_id, x.text) for x in kept]
    assert len(got) == 6 and (None, a) in got and (7, c) in got and (7, d) in got and (9, e) in got and (7, None) in got
    assert sum(i is None for i, _ in got) == 2


def test_shingle_hashes_name_shingles(monkeypatch):
    r = random.Random(8)
    texts = [" ".join(r.choice(["a", "b", "ab", "Wort", "é"]) for _ in range(n)) for n in (0, 1, 3, 5, 6, 400, 3000)] + ["x" * 90_000 + " y z", "  A  b\n"]
    of = {}
    for block in (near_copies.BLOCK, 64):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        for t in texts:
            words = t.encode().translate(simhash.LOWER).split()
            named = [b" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))] if words else []
            hashes = near_copies.shingle_hashes(t).tolist()
            assert len(hashes) == len(named)
            assert all(of.setdefault(x, h) == h for x, h in zip(named, hashes, strict=True) if len(x) <= 64 or block > 64)
    assert len(set(of.values())) == len(of)


def test_bands_meet_at_the_threshold():
    """Of pairs just similar enough, nearly all share a band: 0.9996 are expected."""
    r = near_copies.np.random.default_rng(1)
    met = 0
    for _ in range(1000):
        x = r.integers(0, 1 << 63, 200 + 25 + 25, dtype=near_copies.np.uint64).view(near_copies.np.int64)
        a, b = near_copies.distinct(x[:225]), near_copies.distinct(near_copies.np.concatenate([x[:200], x[225:]]))
        assert near_copies.similar(a, b)
        met += bool((near_copies.bands(a) == near_copies.bands(b)).any())
    assert met >= 995


def test_sketches_never_hide_a_similar_pair(spark):
    r = random.Random(4)
    sets = [near_copies.shingle_set(" ".join(f"w{r.randrange(10**6)}" for _ in range(n))) for n in (300, 1020, 1030, 4000)]
    sets += [near_copies.np.unique(near_copies.np.concatenate([s[: int(len(s) * 0.95)], near_copies.shingle_set(f"a b c d {k} e f g h")])) for k, s in enumerate(sets)]
    schema = "node bigint, n int, sketch array<bigint>"
    nodes = spark.createDataFrame([(k, len(s), near_copies.sketch(s).tolist()) for k, s in enumerate(sets)], schema)
    pairs = spark.createDataFrame([(i, j) for j in range(8) for i in range(j)], "a bigint, b bigint")
    left = {(x.a, x.b) for x in near_copies._possible(pairs, nodes).collect()}
    assert left == {(i, j) for j in range(8) for i in range(j) if near_copies.similar(sets[i], sets[j])} == {(k, k + 4) for k in range(4)}
