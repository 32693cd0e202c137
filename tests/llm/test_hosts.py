from stellate.llm import hosts as H
from stellate.llm.queries import SITE_RULES


def test_host_and_path(spark):
    urls = ["HTTP://A.Example.COM/p/Q?x#y", "http://h?q/r", "x://h#f/", "no scheme", None, "", "a://b://c/d", "http://h:80/é"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    got = [(r.h, r.p) for r in df.select(H.host_of(df.url).alias("h"), H.path_of(df.url).alias("p"), "page_id").orderBy("page_id").collect()]
    assert got == [("a.example.com", "/p/Q"), ("h", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("b:", "//c/d"), ("h:80", "/é")]


def test_longest_rule_wins(spark):
    urls = {"http://x.com/": "com/", "http://example.com/en/1": "example.com/en/", "http://m.example.com/en/": "example.com/en/",
            "http://www.example.com/en/1": "www.example.com/en/", "http://a.www.example.com/en/": "www.example.com/en/",
            "http://a.net/es/": "net/es/", "http://a.net/de/": None, "http://net/fr/x": "net/fr/", "http://x.com": None,
            "http://anet/es/": None, "http://notexample.com/en/": "com/"}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in H.judge(pages, H.outcomes(labels), SITE_RULES).collect()}
    assert [got[i].rule for i in range(len(urls))] == list(urls.values())
    said = {h + p: v for h, p, v in SITE_RULES}
    assert all(r.verdict == said.get(r.rule, "allow") for r in got.values())


def test_reputation_shrinks_and_blocks(spark):
    rows, labels, n = [], [], 0
    for host, size, bad in (("spam.bad.com", 200, 190), ("ok.good.com", 200, 4), ("one.good.com", 1, 1), ("new.bad.com", 0, 0)):
        for i in range(max(size, 1)):
            rows.append((n, f"http://{host}/{i}"))
            if i < size:
                labels.append((n, 0 if i < bad else 1, 0))
            n += 1
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = spark.createDataFrame(labels + labels[:50] + [(None, 0, 1), (10**9, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r.host: r for r in H.reputations(pages, H.outcomes(marks)).collect()}
    assert got["spam.bad.com"].blocked and not got["ok.good.com"].blocked
    assert got["spam.bad.com"].n == 200 and got["spam.bad.com"].k == 190
    assert not got["one.good.com"].blocked  # one bad page is no proof
    assert 0 < got["one.good.com"].mean < 1 and got["new.bad.com"].mean > got["ok.good.com"].mean
    assert all(r.bound < r.mean for r in got.values())


def test_edges(spark):
    pages = spark.createDataFrame([(1, None, "h"), (None, "http://a.b/c", "x"), (2, "http://a.b/c", None), (2, "http://a.b/c", None)],
                                  "page_id long, url string, host string")
    labels = spark.createDataFrame([(2, None, None), (2, 1, None)], "doc_id long, quality int, toxic int")
    got = H.judge(pages, H.outcomes(labels)).collect()
    assert len(got) == 4 and {r.verdict for r in got} == {"allow"}
    assert H.judge(pages.limit(0), H.outcomes(labels)).count() == 0


def test_no_python_on_the_main_path(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = H.judge(pages, H.outcomes(labels), SITE_RULES)._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "Arrow" not in plan and "Pandas" not in plan
