from tickwise.llm import host_reputation as op
from tickwise.llm.registered import URL_RULES

PAGE = "page_id bigint, url string, html string"
LABEL = "doc_id bigint, quality int, toxic int"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


URLS = [None, "", "no scheme", "http://", "http://Example.ORG/es/x", "https://m.a.example.org/en/123?x=/es/",
        "https://example.org/en/9", "http://com/fr/", "http://a.com/fr", "http://a.com/fr/1#q", "http://a.com/de/1",
        "http://b.net?u=http://c.org/es/", "http://b.net#/de/", "x://É.net/Ä?", "http://a.b.co.uk/p", "a://b://c/d",
        "http://xexample.org/es/1", "http://forg/"]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], PAGE).selectExpr("*", "'clash' as host",
                                                                                             "'clash' as n")
    got = {x.page_id: x for x in op.judge(pages, spark.createDataFrame([], LABEL), URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path = split(u)
        assert (got[i].host, got[i].path) == (host, path), u
        rule = rule_of(host, path)
        assert got[i].rule == (rule.text if rule else None), u
        assert got[i].verdict == (rule.verdict if rule else "allow"), u


def test_reputation_shrinks_and_blocks(spark):
    pages, labels, k = [], [], 0
    for host, good, bad, more in (("good.a.net", 40, 0, 5), ("bad.a.net", 0, 40, 5), ("new.a.net", 0, 0, 5),
                                  ("few.a.net", 0, 1, 5), ("z.bad.net", 0, 30, 5), ("new.bad.net", 0, 0, 5)):
        for n in range(good + bad + more):
            pages.append((k, f"http://{host}/{n}", None))
            if n < good + bad:
                labels.append((k, int(n < good), 0))
            k += 1
    labels += [(None, 0, 0), (10**9, 0, 1), (0, None, None)]
    got = op.judge(spark.createDataFrame(pages, PAGE), spark.createDataFrame(labels, LABEL), URL_RULES).collect()
    assert len(got) == len(pages)
    host = {x.host: x for x in got}
    assert host["good.a.net"].verdict == "allow" and host["bad.a.net"].verdict == "block"
    assert host["new.a.net"].verdict == "allow" and host["few.a.net"].verdict == "allow"
    assert host["z.bad.net"].verdict == "block"
    assert host["bad.a.net"].reputation < host["few.a.net"].reputation < host["new.a.net"].reputation < host["good.a.net"].reputation
    assert host["new.bad.net"].reputation < host["new.a.net"].reputation


def test_repeated_rows_toxic_pages_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://t.net/", "")] * 3 + [(None, "http://t.net/", "")], PAGE)
    labels = spark.createDataFrame([(1, 1, 1)] * 20, LABEL)
    got = op.judge(pages, labels, []).collect()
    assert len(got) == 4 and {x.verdict for x in got} == {"block"} and {x.rule for x in got} == {None}
    assert op.judge(spark.createDataFrame([], PAGE), labels, URL_RULES).collect() == []
