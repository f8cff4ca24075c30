"""Operator 5: hosts, paths, listed rules, and mined rules against brute force."""

from itertools import combinations

from pyspark.sql import functions as F

from tickspark.llm.url_rules import ORDINARY, UNWANTED, host_of, judge_urls, mine_rules, path_of, seed_urls, url_tokens

URLS = {
    "https://WWW.a.Example.NET/en/1?x#y": ("www.a.example.net", "/en/1", "example.net/en/", "allow"),
    "http://b.example.net/de/": ("b.example.net", "/de/", "net/", "block"),
    "http://net/x": ("net", "/x", "net/", "block"), "http://xnet/x": ("xnet", "/x", None, "allow"),
    "http://example.com/de/4": ("example.com", "/de/4", "example.com/de/", "block"),
    "http://notexample.com/de/4": ("notexample.com", "/de/4", None, "allow"),
    "https://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"), "https://x.org/fr": ("x.org", "/fr", None, "allow"),
    "https://q.net?a/b": ("q.net", "", None, "allow"), "https://q.net#a://b": ("q.net", "", None, "allow"),
    "no scheme.net/": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"),
    "https://www.cheap-pills.example.org/en/9": ("www.cheap-pills.example.org", "/en/9", None, "block"),
    "https://daily-news.example.org/en/9": ("daily-news.example.org", "/en/9", None, "allow"),
    "a\nb://c.net/d\ne": ("c.net", "/d\ne", "net/", "block"),
}


def test_hosts_rules_and_verdicts(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, list(URLS)[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = judge_urls(pages, [seed_urls(spark)]).collect()
    assert len(out) == len(rows)
    want = list(URLS.values())
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id], list(URLS)[r.page_id]
    assert judge_urls(pages.limit(0), []).collect() == []


def test_mined_rules_equal_brute_force(spark):
    rows = [(f"http://{'bad' if i % 3 == 0 else 'good'}.site{i % 4}.com/{'x' if i % 2 else 'y'}", int(i % 3 == 0 and i % 2 == 0))
            for i in range(60)] + [(None, 1), ("http://a.com/", None)]
    df = spark.createDataFrame(rows, "url string, label int")
    sets = [(frozenset(r.t), r.label) for r in df.where("url is not null and label is not null").select(
        url_tokens(host_of(F.col("url")), path_of(F.col("url"))).alias("t"), "label").collect()]
    want = {}
    for n in (1, 2, 3):
        for combo in {frozenset(c) for s, _ in sets for c in combinations(sorted(s), n)}:
            have = [y for s, y in sets if combo <= s]
            if sum(have) >= 8 and sum(have) / len(have) >= 0.8:
                want[combo] = sum(have) / len(have)
    got = {frozenset(r.antecedent): r.confidence for r in mine_rules(df).collect()}
    assert got == want and got


def test_every_seed_name_has_its_verdict(spark):
    names = UNWANTED + ORDINARY
    pages = spark.createDataFrame([(i, f"http://blog.{n}.example.org/de/1") for i, n in enumerate(names)], "page_id long, url string")
    got = {names[r.page_id]: r.verdict for r in judge_urls(pages, [seed_urls(spark)]).collect()}
    assert got == {**dict.fromkeys(UNWANTED, "block"), **dict.fromkeys(ORDINARY, "allow")}


def test_a_rare_token_of_a_long_table_is_mined(spark):
    rows = [(f"http://fine{'abcdefgh'[i % 8]}.com/", 0) for i in range(2000)] + [("http://bad.com/", 1)] * 8
    assert [["h:bad"]] == [r.antecedent for r in mine_rules(spark.createDataFrame(rows, "url string, label int"))
                           .where("size(antecedent) = 1").collect()]
