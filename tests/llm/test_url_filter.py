import random

from ridgeline.llm import url_filter as U


def plain(rules, url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, after = rest[:cut], rest[cut:]
        cut = min((after.find(c) for c in "?#" if c in after), default=len(after))
        path = after[:cut]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"), default=None)
    return host, path, best.host + best.path if best else None, best.verdict if best else "allow"


def got(spark, rules, urls, **kw):
    d = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(d, rules, **kw).collect()}


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com", "https://example.com/", "https://example.com/en", "http://example.com/en/1",
        "http://www.example.com/en/x?y=/fr/#z", "http://a.www.example.com/en/", "http://notexample.com/en/", "http://x.net/es/a", "http://x.net/fr",
        "http://net/fr/", "http://com/", "http://com?x/", "http://a.com#/en/", "ftp://u:p@example.com:80/en/", "http://example.com./en/", "http://É.com/ü",
        "a://b://c.com/", "http://.com/", "http://x.org/en/", "http://" + "a." * 3000 + "com/" + "p/" * 20000]


def test_stated_rules(spark):
    out = got(spark, U.RULES, URLS)
    assert out == {i: plain(U.RULES, u) for i, u in enumerate(URLS)}
    assert out[7][2:] == ("example.com/en/", "block") and out[8][2:] == ("www.example.com/en/", "allow")


def test_random_rules_in_one_or_more_slices(spark):
    rnd = random.Random(4)
    labels, segments = ["a", "b", "com", "net"], ["x", "xy", "", "z"]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    path = lambda: "/".join([""] + [rnd.choice(segments) for _ in range(rnd.randint(0, 3))])
    rules = tuple({(h, p): U.Rule(rnd.choice(["allow", "block"]), h, p) for h, p in ((host(), path()) for _ in range(60))}.values())
    urls = [f"http://{host()}{path()}" for _ in range(400)]
    want = {i: plain(rules, u) for i, u in enumerate(urls)}
    assert got(spark, rules, urls) == want
    assert got(spark, rules, urls, slice_rules=7) == want


def test_ties_empty_inputs_and_extra_columns(spark):
    both = (U.Rule("allow", "com", "/"), U.Rule("block", "com", "/"))
    assert got(spark, both, ["http://a.com/"])[0][3] == "block"
    assert got(spark, both, ["http://a.com/"], slice_rules=1)[0][3] == "block"
    assert got(spark, (), ["http://a.com/"])[0] == ("a.com", "/", None, "allow")
    assert got(spark, U.RULES, []) == {}
    d = spark.createDataFrame([(None, "http://a.com/", "h", "r")] * 2, "page_id long, url string, host string, rule string")
    assert [(r.page_id, r.host, r.rule) for r in U.judge(d).collect()] == [(None, "a.com", "com/")] * 2
