import pytest

from lodebar.llm.url_filter import UrlTrie, judge_urls

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "x.org", "/a/pre")]


def brute(host, path, rules):
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


def test_trie_agrees_with_checking_every_rule():
    hosts = ["net", "a.net", "example.net", "b.example.net", "notexample.net", "example.com", "m.example.com", "org", "x.org", "y.x.org", "xx.org", "", "a..net"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/2/3", "/fr/x", "/a/pre", "/a/prefix", "/a/pr", "/a/pre/q", "//"]
    trie = UrlTrie(RULES)
    for h in hosts:
        for p in paths:
            m = trie.match(h, p)
            assert (m[0] + m[1], m[2]) == brute(h, p, RULES) if m else brute(h, p, RULES) == (None, "allow"), (h, p)


def test_same_entry_twice_blocks():
    assert UrlTrie([("allow", "a.b", "/"), ("block", "A.b", "/")]).match("a.b", "/")[2] == "block"
    assert UrlTrie([("block", "a.b", "/"), ("allow", "a.b", "/")]).match("a.b", "/")[2] == "block"


def test_bad_rule():
    with pytest.raises(ValueError):
        UrlTrie([("deny", "a", "/")])


def test_odd_urls_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "no scheme", "x"), (3, "http://A.NET", "x"), (4, "http://A.NET?q=/en/", "x"), (5, "s://EXAMPLE.net/en/#/y?z", "x"), (5, "s://EXAMPLE.net/en/#/y?z", "x"), (6, "", "x"), (7, "http://a.net/" + "p" * 100_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, Host string")
    got = {r.page_id: r for r in judge_urls(df, RULES).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in (1, 2, 3, 4, 5, 6)] == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("a.net", "", None, "allow"), ("a.net", "", None, "allow"), ("example.net", "/en/", "example.net/en/", "allow"), ("", "", None, "allow"),
    ]
    assert got[7].verdict == "block" and len(got[7].path) == 100_001
    assert judge_urls(df.limit(0), RULES).count() == 0
    assert judge_urls(df, RULES).where("page_id = 5").count() == 2
