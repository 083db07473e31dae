import os
import re

import duckdb
import pytest

from feedlens.llm import urlfilter as uf

SF = "/root/testdata/sf0.001"


def _brute(url):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (m[1] if m else ""))
    path = m[2] if m else ""
    best = None
    for rule, action in uf.BASE_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, action)
    if best:
        return host, path, best[0], best[1]
    hit = any(re.search(uf.block_regex(p), host + path) for p in uf.BLOCK_PATTERNS) if host + path else False
    return host, path, None, "block" if hit else "allow"


URLS = [None, "", "no scheme", "http://", "http://NET/x", "http://net", "http://a.NET/", "http://anet/", "https://x.example.net/en/1?q=/a#b",
        "http://example.net/en", "http://example.net/EN/", "http://www.example.com/de/#x", "http://example.com/fr/", "http://q.org/fr/1",
        "http://org/fr/", "http://ads.q.com/", "http://loads.q.com/", "http://q.com/x/wp-LOGIN.php", "http://a://b.net/x", "//x.net/",
        "http://q.com/.env", "http://q.com/.envx", "http://ünet.net/é/ß?x", "http://q.com/" + "a/" * 20000, "http://u:p@x.net:80/", "http://casino.net/",
        "http://x.casino.com", "http://q.com/a\nb/xxx/", "http://m.ads-track.example.com/en/1"]


def test_equals_trying_every_rule(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS * 2)] + [(None, URLS[4], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = uf.judge(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == _brute(r.url), r
    assert uf.judge(pages.limit(0)).count() == 0


def test_a_rule_is_filed_only_under_whole_literals():
    assert uf.literal_tokens("||ads-track.") == ["ads", "track"]
    assert uf.literal_tokens("/pre*mid.end/") == ["end"]
    with pytest.raises(ValueError):
        uf.rules([], ["*abc*"])


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{os.path.join(SF, 'pages.parquet')}')")
    want = sorted(con.execute(uf.oracle()).fetchall())
    assert sorted(tuple(r) for r in uf.op4_urlfilter(spark, SF).collect()) == want
