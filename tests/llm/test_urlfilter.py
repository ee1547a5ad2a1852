from tickwise.llm import urlfilter as W


def brute(url, rules=W.RULES):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        path = rest[n:]
        path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fit, default=(0, None, "allow"))
    return host, path, rule, verdict


URLS = ["http://A.Example.com/en/x?y=/z", "https://www.example.com/en/", "x://example.com/en", "ftp://example.net/es/1#/", "net/es/",
        None, "", "://", "a://b://net/fr/", "http://com", "http://com/", "http://.com/", "http://xnet/es/", "http://net/fr/?", "http://É.net/es/é",
        "http://www.example.com.net/fr/", "http://a.www.example.com/en/1\n2", "http://com:80/", "http://example.com/en/" + "x" * 100_000]


def table(spark, urls):
    return spark.createDataFrame([(i, u, "k", "r") for i, u in enumerate(urls)], "page_id long, url string, key string, rule string")


def test_equals_brute_force(spark):
    for r in W.judge(table(spark, URLS + URLS)).collect():
        assert tuple(r)[1:] == brute((URLS + URLS)[r.page_id]), r.page_id


def test_no_rules_and_no_rows(spark):
    assert {r.verdict for r in W.judge(table(spark, URLS), rules=[]).collect()} == {"allow"}
    assert W.judge(table(spark, [])).count() == 0


def test_cascade_is_exact_with_many_levels(spark):
    universe = spark.range(20000).selectExpr("concat('k', id) as key")
    c = W.Cascade([f"k{i}" for i in range(0, 3000, 2)], universe)
    assert len(c.levels) > 3
    got = {r.key for r in universe.where(c.has(universe["key"])).collect()}
    assert got == {f"k{i}" for i in range(0, 3000, 2)}
