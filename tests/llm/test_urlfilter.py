import random

from lineloom.llm.queries import op1
from lineloom.llm.urlfilter import filter_urls

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("example.com", "", "block"), ("a.example.com", "/e", "allow"), ("net", "/de/", "block"), ("com", "/en/", "allow")]


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:n]), rest[n:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h) + len(p), len(h), h + p, min(v for a, b, v in RULES if (a, b) == (h, p))) for h, p, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def urls():
    rng = random.Random(1)
    out = [None, "", "no scheme", "http://", "http://COM/en/", "x://a.example.com", "http://example.com?q=/en/7", "http://Ä.example.com/en/7#x", "http://notexample.com/en/1", "a\nb://example.com/en/7"]
    for _ in range(300):
        host = ".".join(rng.choice(["a", "b", "example", "www"]) for _ in range(rng.randint(0, 3))) + rng.choice([".com", ".example.com", ".net", ".org"])
        out.append(f"http://{host}/{rng.choice(['en', 'de', 'e'])}/{rng.choice(['7', '8', ''])}{rng.choice(['', '?x', '#y'])}")
    return out + ["http://www.example.com/en/7"] * 400  # a url that many rows repeat


def test_against_brute_force(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, key string")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    for parts in (1, 7):
        got = filter_urls(pages, rules, parts=parts, sample=64)
        assert got.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]
        assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: brute(u) for i, u in enumerate(urls())}


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/en/"), (1, "http://a.com/en/"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in filter_urls(pages, none).collect()] == ["allow"] * 3
    assert filter_urls(pages.limit(0), none).count() == 0


def test_query_has_the_rules_of_its_contract(spark, tmp_path):
    cases = [
        ("http://www.example.com/en/1", "com/en/", "block"), ("http://a.com/en/", "com/en/", "block"), ("http://example.com/en/71", "example.com/en/7", "allow"),
        ("http://a.net/de/1", "net/de/", "allow"), ("http://www.example.net/de/7", "net/de/", "allow"), ("http://example.net/de/8", "example.net/de/8", "block"),
        ("http://x.example.net/de/81?q", "example.net/de/8", "block"), ("http://a.org/es/", "org/es/", "block"), ("http://a.net/en/1", None, "allow"), (None, None, "allow"),
    ]
    spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(cases)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: (r.rule, r.verdict) for r in op1(spark, str(tmp_path)).collect()} == {i: (r, v) for i, (_, r, v) in enumerate(cases)}
