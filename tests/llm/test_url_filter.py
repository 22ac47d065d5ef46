import re

from tidemark.llm import url_filter as uf

URLS = [
    "http://a.example.org/en/12?x=1&y=2#top", "https://EXAMPLE.org/es/1", "http://notexample.org/es/1", "http://x.com/fr/9", "http://x.com/de/9",
    "http://org", "http://org/", "http://my.org?x", "http://b.net/org/", "http://u:p@h.org:80/en/1", "com/fr/", None, "", "://", "x://y://z.com/fr/",
    "http://z.com/FR/1", "http://multi\nline.com/de/\nx", "http://b.net/en/1", "http://b.net/en/1", "h" * 50_000 + "://long.org/" + "p" * 50_000,
]


def brute(url):
    m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[2]) if m else ""
    path = m[3] if m else ""
    fits = []
    for rule, verdict in uf.RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return host, path, max(fits)[1:] if fits else (None, None)


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "old", 1) for k, u in enumerate(urls)], "page_id bigint, url string, host string, suffix int")


def test_rules_against_brute_force(spark):
    found = {r.page_id: r for r in uf.judge(pages(spark, URLS)).collect()}
    assert len(found) == len(URLS)
    for k, url in enumerate(URLS):
        host, path, (rule, verdict) = brute(url)
        assert (found[k].host, found[k].path, found[k].rule) == (host, path, rule)
        assert found[k].verdict == verdict if rule else found[k].verdict in ("allow", "block")
        assert (found[k].block_chance is None) == (rule is not None)


def test_trees_learn_from_ruled_urls(spark):
    urls = [f"http://h{k}.com/{'de' if k % 2 else 'fr'}/{'long-spam-1234567' * (k % 2)}{k}" for k in range(200)]
    urls += ["http://h.net/xx/long-spam-123456777", "http://h.net/xx/7"]
    found = {r.page_id: r.verdict for r in uf.judge(pages(spark, urls)).collect()}
    assert found[200] == "block" and found[201] == "allow"


def test_features(spark):
    row = uf.lexical(pages(spark, ["https://a-b1.x.com/p/q2?u=1&v=2#f"])).first()
    assert (row.host_length, row.host_depth, row.host_dashes, row.path_depth, row.parameters, row.secure, row.has_fragment) == (10, 2, 1, 2, 2, 1, 1)
    assert abs(uf.lexical(pages(spark, ["aabb"])).first().entropy - 1.0) < 1e-9 and uf.lexical(pages(spark, [""])).first().entropy == 0.0


def test_no_labels_and_no_rows(spark):
    assert {r.verdict for r in uf.judge(pages(spark, ["http://b.net/1", None])).collect()} == {"allow"}
    assert {r.verdict for r in uf.judge(pages(spark, ["http://b.net/1", "http://x.com/de/1"])).collect()} == {"block"}
    assert uf.judge(pages(spark, URLS).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = uf.judge(pages(spark, URLS))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
