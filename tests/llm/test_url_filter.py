import re

from voxloom.llm import url_filter as op


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in op.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_equals_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "http://NET", "http://net/", "https://a.B.net/x?y#z", "http://example.net/en/1", "http://www.example.net/en", "http://badexample.net/en/1", "ftp://x.org/fr/a", "http://org/fr/", "http://x.example.com/de/?q", "http://example.com/de", "http://x.net?a://b/", "http://É.ÄB.net/ü", "http://a.net#/", "x://y.net/\n/z", "http://..net/"]
    rows = [(k, u, "html", "h", "x") for k, u in enumerate(urls)] + [(3, urls[7], None, None, None), (3, urls[7], None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")
    lengths = sorted({len(p) for _, _, p in op.RULES})
    for blocks in (op.BLOCKS, 1):
        got = op.filter_urls(pages, op.rules_frame(spark), lengths, blocks=blocks).collect()
        assert sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted((i, *(brute(u)[:2]), str(brute(u)[2]), brute(u)[3]) for i, u, *_ in rows)
    assert op.filter_urls(pages.limit(0), op.rules_frame(spark), lengths).collect() == []
