import pytest

from changeflow.llm import url_rules as U

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
CASES = [
    ("http://a.example.com/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("https://WWW.Example.COM/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://example.com", "example.com", "", None, "allow"),
    ("ftp://x.net/es/#a/b", "x.net", "/es/", "net/es/", "block"),
    ("x.net/es/", "", "", None, "allow"),
    ("://net/es/", "net", "/es/", "net/es/", "block"),
    ("a://b://net/es/", "b:", "//net/es/", None, "allow"),
    ("http://?q=http://net/es/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://x.net/es/\nmore", "x.net", "/es/\nmore", "net/es/", "block"),
]


def test_cases_with_repeats_and_clashing_names(spark):
    rules = spark.createDataFrame(RULES * 2, "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, c[0], "old", "old", "old") for i, c in enumerate(CASES)] * 3, "page_id long, url string, host string, row string, verdict string")
    got = U.judge(pages, rules)
    assert got.columns == ["page_id", "url", "row", "host", "path", "rule", "verdict"]
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == sorted(
        [(i, *c[1:]) for i, c in enumerate(CASES)] * 3, key=lambda x: x[0]
    )


def test_no_rules_no_pages_both_verdicts(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [(r.rule, r.verdict) for r in U.judge(pages, none, unlisted="block").collect()] == [(None, "block")]
    both = spark.createDataFrame([("com", "/", "allow"), ("com", "/", "block")], "host string, path string, verdict string")
    assert U.judge(pages, both).first().verdict == "block"
    assert U.judge(pages.limit(0), both).count() == 0


@pytest.mark.parametrize("bits", [2, 16])
def test_the_filter_loses_no_key_and_drops_most_others(spark, bits):
    listed = spark.range(3000).selectExpr("concat('k', id) as key")
    blocks, n = U.bloom_blocks(listed, "key", 3000, bits)
    assert U.possible(listed, "key", blocks, n).count() == 3000
    others = spark.range(3000).selectExpr("concat('o', id) as key")
    assert U.possible(others, "key", blocks, n).count() < (2700 if bits == 2 else 60)
