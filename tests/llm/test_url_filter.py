"""URL filter against a plain longest match, and the Bloom filter's own properties."""

import pyarrow as pa

from tripflow.llm import url_filter
from tripflow.llm.common import small_frame

LIST = pa.schema([("host", pa.string()), ("path", pa.string()), ("verdict", pa.string())])
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("org", "", "block"), ("a.org", "", "allow"), ("org", "/deep/path/", "allow"), ("b.org", "/x", "block"), ("b.org", "/x", "allow"), (None, None, "block")]
URLS = ["http://example.com/en/1", "https://WWW.Example.com/en/2?q#f", "http://sub.www.example.com/en/", "http://example.com/fr/", "http://example.com",
        "http://x.net/es/a", "http://net/es/", "http://xnet/es/", "http://y.net/espa", "no scheme", None, "", "http://", "http:///path", "ftp://a.org?x=/y",
        "http://z.a.org#frag", "http://org/deep/path/x", "http://b.org/xyz", "http://b.org/y", "http://b.org:80/x", "x://y://example.com/en/", "http://b.org/xyz",
        "http://long.example/" + "p/" * 5000, "http://" + "s." * 300 + "com/"]


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    best = {}
    for h, p, v in rules:
        best[h or "", p or ""] = max(v, best.get((h or "", p or ""), v))
    fits = [(len(h) + len(p), len(h), h + p, v) for (h, p), v in best.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, _, rule, verdict = max(fits, default=(0, 0, None, default))
    return host, path, rule, verdict


def run(spark, urls, rules, **kw):
    listed = small_frame(spark, [dict(zip(("host", "path", "verdict"), r)) for r in rules], LIST)
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    return sorted(tuple(r) for r in url_filter.filter_urls(spark, df, listed, keep=("page_id",), **kw).collect())


def test_longest_entry_wins(spark):
    assert run(spark, URLS, RULES) == [(k, *plain(u, RULES)) for k, u in enumerate(URLS)]


def test_false_positives_of_a_full_filter_are_removed(spark):
    rules = RULES + [(f"h{k}.test", "/", "block") for k in range(400)]
    urls = URLS + [f"http://q{k}.test/" for k in range(200)] + [f"http://h{k}.test/" for k in range(50)]
    assert run(spark, urls, rules, max_filter_bytes=64) == [(k, *plain(u, rules)) for k, u in enumerate(urls)]


def test_empty_list_and_empty_table(spark):
    assert run(spark, URLS[:3], [], default="block") == [(k, *plain(u, [], "block")) for k, u in enumerate(URLS[:3])]
    assert run(spark, [], RULES) == []


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = [f"host{k}.example/\0{k}" for k in range(5000)]
    listed = spark.createDataFrame([(k,) for k in keys], "key string")
    bloom = url_filter.build_bloom(listed, "key", len(keys))
    assert bloom.might_contain(keys).all()
    assert bloom.might_contain([f"other{k}" for k in range(20000)]).mean() < 0.02
