import numpy as np

from marketlens.llm import url_filter as uf
from marketlens.llm.queries import URL_RULES


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "canonical string")


def test_rules_and_list(spark):
    urls = {
        1: "HTTP://Example.ORG/es/1?x", 2: "http://a.example.org/en/1x", 3: "http://b.org/", 4: "http://b.org", 5: None, 6: "no-scheme",
        7: "http://x.com/fr/a", 8: "http://x.com/de/a", 9: "http://www.Ä.net/p/?q", 10: "http://ä.net/p", 11: "http://notexample.org/es/",
        12: "a://b://c/d", 13: "http://ÄB.net:80/p#f", 14: "",
    }
    pages = spark.createDataFrame([(k, v, "r") for k, v in urls.items()], "page_id long, url string, rule string")
    got = {r.page_id: tuple(r)[1:5] for r in uf.judged(pages, URL_RULES, names(spark, ["ä.net/p", None, "Äb.net/p", "b"])).collect()}
    assert got == {
        1: ("example.org", "/es/1", "example.org/es/", "block"), 2: ("a.example.org", "/en/1x", "example.org/en/1", "block"),
        3: ("b.org", "/", "org/", "allow"), 4: ("b.org", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("x.com", "/fr/a", "com/fr/", "allow"), 8: ("x.com", "/de/a", "com/de/", "block"), 9: ("www.Ä.net", "/p/", None, "allow"),
        10: ("ä.net", "/p", None, "block"), 11: ("notexample.org", "/es/", "org/", "allow"), 12: ("b:", "//c/d", None, "allow"),
        13: ("Äb.net:80", "/p", None, "block"), 14: ("", "", None, "allow"),
    }


def test_small_filter_makes_no_wrong_row(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 50}.net/{i % 997}") for i in range(3000)], "page_id long, url string")
    listed = names(spark, [f"h{i % 50}.net/{i}" for i in range(500)] * 2)
    got = {r.page_id: r.verdict for r in uf.judged(pages, [], listed, n_blocks=2).collect()}
    want = {f"h{i % 50}.net/{i}" for i in range(500)}
    assert got == {i: "block" if f"h{i % 50}.net/{i % 997}" in want else "allow" for i in range(3000)}


def test_filter_passes_few_others(spark):
    words = uf.build_filter(names(spark, [f"u{i}" for i in range(2000)]), 1 << 9)
    h = np.random.default_rng(1).integers(-(2**63), 2**63, 20000)
    assert uf.may_contain(words, h).mean() < 0.05


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert uf.judged(pages, URL_RULES, names(spark, [])).collect() == []
