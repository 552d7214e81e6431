from tests.llm import brute, fixtures
from wardline.llm import queries, url_reputation

PAGES = "page_id long, url string, html string"
URLS = [
    None, "", "no scheme/en/", "http://WWW.Example.COM/en/a?x#y", "https://example.com/en/", "http://aexample.com/en/",
    "http://x.net/fr/1", "http://net/es/", "http://x.com", "http://x.com?/", "http://a/b://c.com/d", "://h.org/p#q?r", "x://Éa.ORG/é?",
]


def test_parts_and_rules(spark, sf_dir):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], PAGES)
    labels = fixtures.empty(spark, "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in url_reputation.judge(pages, labels).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = brute.url_parts(url)
        rule = brute.url_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (brute.RULES[rule] if rule else "allow")


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op8_url_filters(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for p in pages:
        host, path = brute.url_parts(p.url)
        assert (got[p.page_id].host, got[p.page_id].path, got[p.page_id].rule) == (host, path, brute.url_rule(host, path))


def test_bad_host_is_blocked_and_small_hosts_shrink(spark):
    rows = [(i, "http://bad.org/x", None) for i in range(60)]
    rows += [(100 + i, f"http://h{i % 30}.good.org/x", None) for i in range(600)]
    rows += [(900, "http://one.good.org/x", None), (901, "http://www.bad.org/new", None)]
    pages = spark.createDataFrame(rows, PAGES)
    labels = [(i, 0, 1) for i in range(60)] + [(100 + i, 1, int(i // 30 % 10 == 0)) for i in range(600)] + [(900, 1, 1), (900, 1, 0), (None, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_reputation.judge(pages, labels).collect()}
    assert len(got) == len(rows)
    assert got[0] == "block" and got[100] == "allow" and got[900] == "allow"


def test_empty(spark):
    pages = fixtures.empty(spark, PAGES)
    labels = fixtures.empty(spark, "doc_id long, quality int, toxic int")
    assert url_reputation.judge(pages, labels).count() == 0
