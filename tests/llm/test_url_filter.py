import pytest
from airq.llm import url_filter
from airq.llm.queries import ORACLES, QUERIES, URL_RULES
from oracle import compare, connect


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_same_rows_as_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    assert compare(QUERIES["op9_url_filter"](spark, folder), connect(folder), ORACLES["op9_url_filter"]) is None


def test_edges(spark):
    urls = {
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "nohost": ("", "", None, "allow"),
        "http://a.NET": ("a.net", "", None, "allow"),
        "http://a.NET/": ("a.net", "/", "net/", "block"),
        "HTTP://x@A.Example.net:80/en/?q": ("x@a.example.net:80", "/en/", None, "allow"),
        "https://A.Example.net/en/?q#f": ("a.example.net", "/en/", "example.net/en/", "allow"),
        "https://example.net/en": ("example.net", "/en", "net/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "a://b://c.org/fr/x": ("b:", "//c.org/fr/x", None, "allow"),
        "http://.org/fr/\n": (".org", "/fr/\n", "org/fr/", "allow"),
        "http://Ä.org/fr/": ("Ä.org", "/fr/", "org/fr/", "allow"),
        "https:///path": ("", "/path", None, "allow"),
        "x://net" + "/y" * 100_000: ("net", "/y" * 100_000, "net/", "block"),
    }
    rows = [(i, u, "host") for i, u in enumerate(urls)] + [(0, None, "again")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = url_filter.filter_urls(df, URL_RULES).collect()
    assert len(got) == len(rows)
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == dict(enumerate(urls.values()))
    assert url_filter.filter_urls(df.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in url_filter.filter_urls(df, [], "block").collect()} == {"block"}


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda key: 7)
    path = str(tmp_path / "rules")
    url_filter.write_digests(path, URL_RULES)
    found = url_filter.DigestArray(path)
    assert (found.find(["net/", "org/fr/", "example.com/de/", "nothing/"]) >= 0).tolist() == [True, True, True, False]
    assert found.judge(["a.net", "b.org"], ["/x", "/de/"], "allow") == (["net/", None], ["block", "allow"])


def test_wrong_verdict_is_refused(tmp_path):
    with pytest.raises(ValueError):
        url_filter.write_digests(str(tmp_path / "rules"), [("a", "/", "maybe")])


def test_host_of_many_labels(spark):
    """Only suffixes that may be a rule's host are looked at."""
    hosts = ["a." * 100_000 + "example.net", "b." * 100_000 + "net", "." * 50_000 + "org", "c." * 60_000]
    df = spark.createDataFrame([(i, f"http://{h}/en/x") for i, h in enumerate(hosts)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(df, URL_RULES).collect()}
    assert got == {0: ("example.net/en/", "allow"), 1: ("net/", "block"), 2: (None, "allow"), 3: (None, "allow")}
