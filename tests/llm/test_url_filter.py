import numpy as np
import pytest

from entityframe.llm.url_filter import RULES, DigestList, filter_urls


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits) if fits else (0, 0, None, default)
    return host, path, best[2], best[3]


URLS = [
    None, "", "no scheme", "http://", "https://NET/", "http://a.net", "http://a.net/x?y#z", "https://b.Example.NET/en/1",
    "https://example.net/english", "https://example.com/de/#x", "http://x.example.com/de?", "https://a.org/fr/1?http://q.net/",
    "https://a.org/de", "ftp://dotnet/", "http://user@a.net:80/", "http://a.net:8080/", "https://é.net/é", "http://.net/", "http://net./",
]


@pytest.mark.parametrize("local_bytes", [1 << 20, 0])
def test_equals_brute_force_from_a_local_file_and_from_shards(spark, local_bytes):
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS * 2)], "page_id int, url string, rule string")
    got = {r.page_id: r for r in filter_urls(pages, rules, max_local_bytes=local_bytes).collect()}
    for i, url in enumerate(URLS * 2):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute(url, RULES), url


@pytest.mark.parametrize("local_bytes", [1 << 20, 0])
def test_rule_hosts_in_upper_case_and_long_urls(spark, local_bytes):
    rules = [(f"Host{i}.NET", "/", ("block", "allow")[i % 2]) for i in range(40)] + [("É.net", "/X", "block"), ("a..b", "/", "block")]
    lower = [(h.translate({c: c + 32 for c in range(65, 91)}), p, v) for h, p, v in rules]
    urls = [f"http://www.hOST{i}.net/a" for i in range(45)] + ["http://É.net/X", "http://é.net/X", "http://É.net/x", "http://a..b/", None]
    urls += ["http://" + "a." * 300 + "host3.net/" + "p/" * 5000, "http://host1.net/" + "?" * 9999]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r.page_id: r for r in filter_urls(pages, frame, max_local_bytes=local_bytes).collect()}
    for i, url in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == brute(url, lower), url


def test_one_string_is_looked_up_once_for_many_urls(spark):
    from entityframe.llm.url_filter import _candidate_pairs, candidates

    urls = spark.createDataFrame([(f"w{i}.a.com", f"/p{i}/q") for i in range(200)] + [("", ""), (".", "/")], "host string, path string")
    pairs = _candidate_pairs(urls, [3, 1])
    want = {(h, p, *c) for h, p in map(tuple, urls.collect()) for c in candidates(h, p, [3, 1])}
    assert sorted(map(tuple, pairs.collect())) == sorted(want)
    assert pairs.where("h = 'com' and p = '/'").count() == 200
    assert pairs.select("h", "p").distinct().where("h = 'com' and p = '/'").count() == 1


def test_no_rules_and_no_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    assert [r.verdict for r in filter_urls(pages, rules, default="block").collect()] == ["block"]
    assert filter_urls(pages.limit(0), rules).collect() == []


def test_equal_digests_are_told_apart_by_their_strings():
    listed = DigestList.build([(f"h{i}", "/", "block") for i in range(100)])
    assert (np.diff(listed.digests.astype(float)) >= 0).all()
    listed.digests[:] = listed.digests[0]  # as if all collided
    real = DigestList.probe.__globals__["xxhash"]

    class Same:
        @staticmethod
        def xxh64_intdigest(_):
            return int(listed.digests[0])

    DigestList.probe.__globals__["xxhash"] = Same
    try:
        at = listed.probe([b"h7/", b"h99/", b"absent/"])
    finally:
        DigestList.probe.__globals__["xxhash"] = real
    assert [listed.string(i) for i in at[:2]] == [b"h7/", b"h99/"] and at[2] == -1
