from telemsg.llm.url_filter import HOST_RULES, RuleIndex, host_rule, pattern_rule, split_url, url_filter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URLS = [
    "http://a.com/x", "https://WWW.Example.com/en/1", "http://example.com/en/", "http://example.com/EN/", "http://x.net/es/9",
    "http://net/fr/", "http://bet/fr/", "http://com", "http://com/", "http://com?x=/", "ftp://b.com#/", "nohost", "", None,
    "://com/", "http://a.com.org/", "http://notexample.com/en/x", "http://m.example.com/en/?utm_source=feed",
    "http://x.org/?utm_source=feed", "http://x.org/?utm_source=feeds", "http://ads.x.org/a/banner/1", "http://x.org/a?b://c.com/",
    "http://x.org/wp-login.php", "http://é.org/Porn/", "http://x.casino/", "http://x.org/" + "a/" * 3000 + "warez/",
]


def brute(url):
    host, path = split_url(url)
    fits = [
        (len(t), a, t)
        for a, t in HOST_RULES
        if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith("/" + t.split("/", 1)[1])
    ]
    return max(fits)[1:] if fits else (None, None)


def test_rules_and_odd_rows(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] * 2, "page_id long, url string, host string")
    rows = url_filter(pages).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        action, rule = brute(r.url)
        assert r.rule == rule, r.url
        if action:
            assert r.verdict == action, r.url
    by = {r.url: r for r in rows}
    assert by[None].host == "" and by["nohost"].path == "" and by[""].verdict == "allow"
    assert by["http://x.org/?utm_source=feed"].verdict == "block"
    assert by["http://x.org/?utm_source=feeds"].verdict == "allow"
    assert by["http://m.example.com/en/?utm_source=feed"].rule == "example.com/en/"
    for u in URLS[20:21] + URLS[22:26]:
        assert by[u].verdict == "block", u
    assert url_filter(pages.limit(0)).count() == 0


def test_index_files_under_rarest_and_loses_nothing():
    rules = [host_rule(*r) for r in HOST_RULES] + [pattern_rule("block", "a*b"), pattern_rule("block", "/x1-y2/")]
    index = RuleIndex.build(rules, {"com": 100, "example": 5, "en": 50, "www": 3, "net": 9, "es": 2, "fr": 1, "x1": 4, "y2": 1})
    assert index.by_token["www"] == [2] and index.by_token["example"] == [1] and index.by_token["es"] == [3]
    assert index.always == [5] and index.by_token["y2"] == [6]
    assert index.candidates("http://www.example.com/en/") == [0, 1, 2, 5]
