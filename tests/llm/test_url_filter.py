import random
import re

from tessella.llm import url_filter as uf
from tessella.llm.queries import URL_RULES


def brute(url, rules, default="allow"):
    m = re.match(r"(?s)(?:.*?)://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h) + len(p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, default, None))
    return host, path, best[2], best[1]


URLS = [
    None, "", "no scheme", "http://", "http://ORG/", "https://a.b.example.org/es/x?q#f", "http://example.org/en/12", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/de/", "http://x.com/DE/",
    "http://com/fr/", "http://example.org", "http://example.org?x=/es/", "a://b://example.org/", "http://example.org.:80/", "http://user@example.org/es/", "HTTP://É.ORG/ü", "http://.org/", "http://example.org/es/" + "long/" * 9000, "http://a\nb.org/\nx",
]


def test_contract_rules(spark):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(URLS)] + [(1, "http://org/", "x", "y"), (1, "http://org/", "x", "y"), (None, "http://x.com/de/", "x", "y")], "page_id bigint, url string, host string, rule string")
    got = sorted(map(tuple, uf.judge(pages, uf.rule_table(spark, URL_RULES)).collect()), key=str)
    want = sorted([(k, *brute(u, URL_RULES)) for k, u in [*enumerate(URLS), (1, "http://org/"), (1, "http://org/"), (None, "http://x.com/de/")]], key=str)
    assert got == want


def test_random_rules(spark, monkeypatch):
    r = random.Random(4)
    host = lambda: ".".join(r.choice("abc") for _ in range(r.randint(1, 3)))
    path = lambda: "".join(r.choice(["/", "x", "y"]) for _ in range(r.randint(0, 4)))
    rules = list({(h, p): (r.choice(["allow", "block"]), h, p) for h, p in ((host(), path()) for _ in range(40))}.values())
    urls = [f"http://{host()}/{path()}" for _ in range(200)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for limit in (uf.BROADCAST_BYTES, 0):
        monkeypatch.setattr(uf, "BROADCAST_BYTES", limit)
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge(pages, uf.rule_table(spark, rules), "block").collect()}
        want = {k: brute(u, rules, "block") for k, u in enumerate(urls)}
        assert {k: (v[0], v[1], v[3], len(v[2] or "")) for k, v in got.items()} == {k: (v[0], v[1], v[3], len(v[2] or "")) for k, v in want.items()}


def test_equal_rules_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    twice = uf.rule_table(spark, [("allow", "b", "/"), ("block", "b", "/"), ("maybe", "b", "/c")])
    assert uf.judge(pages, twice).first().verdict == "block"
    assert uf.judge(pages, twice.where("false"), "block").collect() == [(1, "a.b", "/c", None, "block")]
    assert uf.judge(pages.where("false"), twice).collect() == []
