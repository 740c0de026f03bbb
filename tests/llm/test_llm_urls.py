from llm_cases import scratch  # noqa: F401

from assay.llm import urls


def judged(spark, values, rules=urls.RULES, **kw):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(values)], "page_id long, url string")
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(frame, urls.rules_frame(spark, rules), **kw).collect()}


def brute(url, rules, suspect):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
        host, slash, tail = rest.partition("/")
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + tail
    fits = [(len(h + p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    words = host.replace("-", ".").split(".")
    return host, path, None, "block" if set(words) & set(suspect) else "allow"


def test_rules_and_precedence(spark):
    values = ["http://a.com/x", "https://EXAMPLE.com/en/1?q=/fr/", "http://www.example.com/en/", "http://x.www.example.com/en/a#b",
              "http://example.com/en", "http://notexample.com/en/", "http://b.net/es/1", "http://b.net/esp/", "http://b.net", "http://com",
              "http://com/", "ftp://casino-win.org/a", "nothing", None, "", "://", "http://", "http://a.b://c.com/", "http://x.com?a://b/",
              "http://net.example.org/es/", "http://b.net/fr//a", "http://" + ".".join("a" * 300) + ".net/es/" + "d/" * 300, "http://a\n.com/\nx"] + ["http://a.com/x"] * 3
    got = judged(spark, values)
    assert got == {i: brute(u, urls.RULES, urls.SUSPECT_WORDS) for i, u in enumerate(values)}


def test_own_rules_that_end_inside_a_folder(spark):
    rules = [("block", "x.org", "/a"), ("allow", "x.org", "/a/b"), ("block", "org", "/a/b/c"), ("block", "x.org", "/z"), ("allow", "x.org", "/z"),
             ("block", "q.org", "")]
    values = [f"http://{h}{p}" for h in ("x.org", "y.x.org", "org", "q.org", "xx.org") for p in ("", "/", "/a", "/ab", "/a/", "/a/b", "/a/bc", "/a/b/c/d", "/z1")]
    assert judged(spark, values, rules) == {i: brute(u, rules, urls.SUSPECT_WORDS) for i, u in enumerate(values)}


def test_no_rules_no_rows_and_other_columns(spark):
    assert judged(spark, ["http://spam.com/"], ())[0][2:] == (None, "block")
    assert judged(spark, ["http://spam.com/"], (), suspect=())[0][2:] == (None, "allow")
    empty = spark.createDataFrame([], "url string, host string, prefix string, digest string")
    got = urls.filter_urls(empty, urls.rules_frame(spark))
    assert got.count() == 0 and got.columns == ["url", "prefix", "digest", "host", "path", "rule", "verdict"]
    only = spark.createDataFrame([("http://a.com/es/",)], "path string")
    assert [tuple(r) for r in urls.filter_urls(only, urls.rules_frame(spark), url="path").collect()] == [("a.com", "/es/", "com/", "allow")]
    best = spark.createDataFrame([("http://a.com/", "b", "r")], "url string, best string, `row` string")
    assert [tuple(r)[:3] for r in urls.filter_urls(best, urls.rules_frame(spark)).collect()] == [("http://a.com/", "b", "r")]
    one = spark.createDataFrame([("http://a.com/", "z", "p", "d")], empty.schema)
    assert urls.filter_urls(one, urls.rules_frame(spark)).first()[1:] == ("p", "d", "a.com", "/", "com/", "allow")
