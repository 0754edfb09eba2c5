import pytest

from newslens.llm.urls import Rule, find, judge, trie

RULES = [
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"), Rule("block", "deep.example.org", ""), Rule("allow", "deep.example.org", "/a/b"),
]


def slow(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (r.host.count("."), len(r.path)), default=None)


@pytest.mark.parametrize("host", ["net", "a.net", "example.net", "www.example.net", "example.com", "org", "x.deep.example.org", "deep.example.org", "badexample.net", "", "com"])
@pytest.mark.parametrize("path", ["", "/", "/en", "/en/", "/en/x", "/de/", "/fr/1/2", "/a/b", "/a/bc/d", "/a", "//en/"])
def test_trie_finds_what_all_rules_would(host, path):
    found, want = find(trie(RULES), host, path), slow(RULES, host, path)
    assert (found and (found[3], found[2])) == (want and (want.verdict, want.text))


def test_odd_urls_and_clashing_columns(spark):
    urls = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/?q#f"), (5, "http://a.net"),
        (6, "x://h?p/q"), (7, "http://example.com/de/#x"), (7, "http://example.com/de/#x"), (8, "http://" + "a." * 5000 + "net/" + "x" * 20000),
    ]
    df = spark.createDataFrame([(*u, "mine", "own") for u in urls], "page_id int, url string, verdict string, extra string")
    found = judge(df, RULES)
    assert found.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    got = sorted((r.page_id, r.host[:9], r.path[:5], r.rule, r.verdict) for r in found.collect())
    assert got[:7] == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "a.example", "/en/", "example.net/en/", "allow"), (5, "a.net", "", None, "allow"),
        (6, "h", "", None, "allow"), (7, "example.c", "/de/", "example.com/de/", "block"),
    ]
    assert got[7] == got[6] and got[8][3:] == ("net/", "block")
    assert judge(df.limit(0), RULES).collect() == []
    assert {r.verdict for r in judge(df, [], default="block").collect()} == {"block"}


def test_several_tries_give_the_longest_match(spark, monkeypatch):
    monkeypatch.setattr("newslens.llm.urls.RULES_PER_TRIE", 1)
    df = spark.createDataFrame([(1, "http://www.example.net/en/x"), (2, "http://a.net/"), (3, "u")], "page_id int, url string")
    assert [(r.rule, r.verdict) for r in judge(df, RULES).orderBy("page_id").collect()] == [
        ("example.net/en/", "allow"), ("net/", "block"), (None, "allow"),
    ]


def test_rules_are_checked(spark):
    df = spark.createDataFrame([(1, "u")], "page_id int, url string")
    with pytest.raises(ValueError):
        judge(df, [Rule("maybe", "net")])
