import random

import pytest
import xxhash

from tessella.llm import components, simhash


def brute_print(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    h = [xxhash.xxh64_intdigest(b" ".join(words[k : k + width] if len(words) > width else words), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def brute_components(prints):
    out = {}
    for i in prints:
        seen, todo = {i}, [i]
        while todo:
            a = todo.pop()
            for b in prints:
                if b not in seen and (prints[a] ^ prints[b]).bit_count() <= 2:
                    seen.add(b)
                    todo.append(b)
        out[i] = min(seen)
    return out


def test_fingerprints():
    r = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 9000):
        t = " ".join(r.choice(["Alpha", "beta", "Ünï", "the", "x"]) for _ in range(n))
        assert simhash.fingerprint(t) == brute_print(t)
    assert simhash.fingerprint(None) == 0


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    t = "some shingle héré"
    assert spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] % 2**64 == xxhash.xxh64_intdigest(t.encode(), 42)


@pytest.mark.parametrize("hot", [64, 2, 0])
def test_links_connect_what_is_near(spark, hot):
    r, prints = random.Random(7), []
    for _ in range(12):
        a = r.getrandbits(64)
        for _ in range(6):
            prints.append(a)
            for _ in range(r.randint(0, 3)):
                a ^= 1 << r.randrange(64)
    prints = {k: p for k, p in enumerate(dict.fromkeys(prints))}
    signed = lambda p: p - (p >> 63 << 64)
    nodes = spark.createDataFrame([(signed(p),) for p in prints.values()], "fp bigint")
    pairs = simhash.links(nodes, hot).collect()
    assert all(((p.a ^ p.b) & (2**64 - 1)).bit_count() <= 2 for p in pairs)
    back = {signed(p): k for k, p in prints.items()}
    want, parent = brute_components(prints), {k: k for k in prints}
    for _ in range(len(prints)):
        for p in pairs:
            a, b = parent[back[p.a]], parent[back[p.b]]
            parent[back[p.a]] = parent[back[p.b]] = min(a, b)
    assert parent == want


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 101), (7, 7)]
    r = random.Random(2)
    r.shuffle(pairs)
    got = {x.node: x.label for x in components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100, 103: 100}


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    """Small files may stand for large tables (33 entries a look, labels that compress), so no join may trust their size."""
    plans, write = [], simhash.storage.written
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(simhash.storage, "written", lambda df, *a, **b: plans.append(plan(df)) or write(df, *a, **b))
    monkeypatch.setattr(components, "SENT", 1, raising=False)
    r = random.Random(6)
    base = [" ".join(r.choice("abcdefgh") for _ in range(300)) for _ in range(6)]
    rows = [(k, f"{base[k % 6]} w{k % 50}") for k in range(200)]
    plans.append(plan(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), hot=2)))
    joins = [x for p in plans for x in p.splitlines() if "BroadcastHashJoin" in x and "LeftAnti" not in x]  # the crowded cells: a 64th
    assert joins == [] and sum(p.count("SortMergeJoin") for p in plans) >= 7


def test_documents(spark):
    base = "one two three four five six seven eight nine ten " * 30
    data = [(5, base), (3, base + "eleven"), (9, "quite another text about other things " * 9), (4, None), (2, ""), (5, base), (None, "   "), (8, base.upper())]
    df = spark.createDataFrame([(*r, "x") for r in data], "doc_id bigint, text string, fingerprint string")
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    prints = {k: brute_print(t) for k, (_, t) in enumerate(data)}
    comp = brute_components(prints)
    least = {c: min(data[k][0] for k in comp if comp[k] == c and data[k][0] is not None) for c in set(comp.values())}
    assert got == sorted(((data[k][0], f"{prints[k]:016x}", least[comp[k]]) for k in prints), key=str)
    assert simhash.near_duplicates(df.where("false")).collect() == []
