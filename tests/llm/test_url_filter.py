import duckdb
from pyspark.sql import functions as F

from wordstats.llm import url_filter

from llm_tables import SF_MID  # noqa: F401


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_MID}/pages.parquet')")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({url_filter.ORACLE}) ORDER BY 1").fetchall()
    got = url_filter.query(spark, SF_MID).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want
    assert {r.verdict for r in got} == {"allow", "block"}


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), -i) for i, (h, p, _) in enumerate(rules)
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, url_filter.DEFAULT
    h, p, verdict = rules[-max(fits)[1]]
    return host, path, h + p, verdict


def test_awkward_urls(spark):
    rules = [*url_filter.RULES, ("a-b.org", "", "block"), ("org", "/p", "block"), ("org", "/page/x", "allow")]
    urls = [None, "", "no scheme", "://", "http://", "http://COM", "http://com/", "HTTP://WWW.EXAMPLE.COM/en/x?y#z",
            "http://xexample.com/en/1", "http://a.example.com/en", "http://a.net/es/?q", "http://net#/es/",
            "http://a-b.org", "http://x.a-b.org?z", "http://xa-b.org/page/x", "http://a-b.org/page/xyz",
            "http://b.org/pages", "x://y://com/", "http://b.net/fr/\nx", "http://é.com/ü", "http://user@m.com:80/"]
    urls += ["http://www.example.com/en/" + "a" * 200_000, "http://com/", "http://com/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_rarest_token_is_the_key(spark):
    urls = spark.createDataFrame([("a.example.com", "/en/")] * 3 + [("b.net", "/en/")], "host string, path string")
    index = url_filter.build_index(urls, url_filter.RULES)
    assert index == {"com": [0, 1], "es": [3], "fr": [4], "www": [2]}
    # a token that the path leaves open can be part of a longer one
    assert url_filter.rule_tokens(("org", "/pa", "block")) == ["org"]
    assert url_filter.rule_tokens(("org", "/p/*/q/", "block")) == ["org", "p", "q"]
    rows = url_filter.judge(urls.select(F.concat(F.lit("http://"), "host", "path").alias("url"))).collect()
    assert max(r.n_candidates for r in rows) < len(url_filter.RULES)
