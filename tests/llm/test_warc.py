import gzip as gzip_module
import hashlib
import os
import random

import duckdb
import pytest

from tickwise.llm import registered, warc

PAGE = "page_id bigint, url string, html string"
SF = "/root/testdata/sf0.001"


def rows():
    r = random.Random(4)
    big = "".join(r.choice("abc <é>\r\n") for _ in range(3000))
    out = [(i, f"http://h{i % 7}.net/{i}?q=%0A", big if i % 3 == 0 else f"page {i} " * (i * 7)) for i in range(60)]
    out += [(60, None, None), (61, "", ""), (62, "http://x\r\ny/é", "small"), (63, "u", "small"), (None, "n", big),
            (64, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (65, "u", "x" * 300_000), (59, "again", "page 59 " * (59 * 7))]
    return out


def expected(table):
    out = []
    for page, url, html in table:
        raw = (html or "").encode()
        top = max((p for p, _, h in table if p is not None and (h or "").encode() == raw), default=None)
        again = len(raw) >= 1000 and top is not None and page != top
        out.append((page, url, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response",
                    top if again else None, None if again else raw))
    return sorted(out, key=str)


@pytest.mark.parametrize("gzip", [False, True])
def test_round_trip(spark, workdir, gzip):
    table = rows()
    df = spark.createDataFrame(table, PAGE).selectExpr("*", "'clash' as top", "1 as b").repartition(4)
    path = "file://" + os.path.join(workdir, "w")
    warc.write_archives(warc.records_of(df), path, gzip)
    back = warc.read_archives(spark, path).collect()
    got = [(None if x.record_id is None else int(x.record_id), x.target_uri, x.payload_bytes, x.payload_digest,
            x.record_type, None if x.refers_to is None else int(x.refers_to),
            None if x.payload is None else bytes(x.payload)) for x in back]
    assert sorted(got, key=str) == expected(table)
    assert any(x.startswith("part-") and x.endswith(".gz") == gzip for x in os.listdir(path[7:]))


@pytest.mark.parametrize("gzip", [False, True])
def test_predicates_are_pushed_and_payloads_skipped(spark, workdir, gzip):
    path = os.path.join(workdir, "w")
    warc.write_archives(warc.records_of(spark.createDataFrame(rows(), PAGE)), path, gzip)
    heads = warc.read_archives(spark, path, payload=False)
    assert heads.where("payload is not null").count() == 0 and heads.count() == len(rows())
    some = heads.where("record_type = 'revisit' and target_uri like 'http://h3%'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "= revisit" not in plan and "StartsWith" not in plan
    assert some.count() == sum(x[4] == "revisit" and (x[1] or "").startswith("http://h3") for x in expected(rows()))
    assert warc.read_archives(spark, path).where("record_id in ('62', '63')").count() == 2


def test_only_published_files_are_read_and_files_are_planned(spark, workdir):
    path = os.path.join(workdir, "w")
    records = warc.records_of(spark.createDataFrame(rows(), PAGE).repartition(3))
    warc.write_archives(records, path)
    with open(os.path.join(path, "part-lost.warc"), "wb") as f:
        f.write(b"half a rec")
    warc.write_archives(records, path)
    assert warc.read_archives(spark, path).count() == 2 * len(rows())
    reader = warc.WarcReader(path, True, 1)
    assert len(reader.partitions()) >= 2


def foreign(kind, block, *fields, content="application/http; msgtype=response"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"Content-Type: {content}", *fields, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, workdir):
    path = os.path.join(workdir, "w")
    os.makedirs(path)
    page = b"HTTP/1.1 200 OK\r\nContent-Length:5\r\n\r\nhello"
    records = [foreign("warcinfo", b"software: x", "WARC-Record-ID: <urn:uuid:1>", content="application/warc-fields"),
               foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Record-ID:<urn:uuid:12345678-90>",
                       content="application/http; msgtype=request"),
               foreign("response", page, "WARC-Record-ID: <urn:uuid:3>", "WARC-Target-URI:http://a/", "WARC-Payload-Digest: md5:ab"),
               foreign("response", b"HTTP/1.1 200 OK", "WARC-Record-ID: <urn:uuid:4>"),
               foreign("metadata", b"", "WARC-Refers-To: <urn:uuid:3>", content="text/plain"),
               foreign("response", page, "WARC-Record-ID: <urn:uuid:5>")]
    with open(os.path.join(path, "a.warc"), "wb") as f:
        f.write(b"".join(records))
    with open(os.path.join(path, "b.warc.gz"), "wb") as f:
        f.write(b"".join(gzip_module.compress(r) for r in records))
    with open(os.path.join(path, "notes.txt"), "w") as f:
        f.write("not an archive")
    for payload in (True, False):
        got = [(x.record_id, x.record_type, x.target_uri, x.payload_digest, x.refers_to, x.payload_bytes,
                None if x.payload is None else bytes(x.payload)) for x in warc.read_archives(spark, path, payload).collect()]
        kept = lambda b: b if payload else None
        want = [("urn:uuid:1", "warcinfo", None, None, None, 11, kept(b"software: x")),
                ("urn:uuid:12345678-90", "request", None, None, None, 0, kept(b"")),
                ("urn:uuid:3", "response", "http://a/", "md5:ab", None, 5, kept(b"hello")),
                ("urn:uuid:4", "response", None, None, None, 0, kept(b"")),
                (None, "metadata", None, None, "urn:uuid:3", 0, kept(b"")),
                ("urn:uuid:5", "response", None, None, None, 5, kept(b"hello"))]
        assert sorted(got, key=str) == sorted(want * 2, key=str)
    assert warc.read_archives(spark, path).where("record_type = 'request'").count() == 2


def test_marks_too_many_for_a_broadcast(spark, workdir, monkeypatch):
    monkeypatch.setattr(warc, "MOST_MARKS", 0)
    records = warc.records_of(spark.createDataFrame(rows(), PAGE))
    assert records.where("record_type = 'revisit'").count() == sum(x[4] == "revisit" for x in expected(rows()))


def test_empty_table(spark, workdir):
    path = os.path.join(workdir, "w")
    warc.write_archives(warc.records_of(spark.createDataFrame([], PAGE)), path)
    assert warc.read_archives(spark, path).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_query_matches_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    cur = con.execute(registered.ORACLE_SQL["op5_warc"])
    names = [c[0] for c in cur.description]
    got = registered.op5_warc(spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())
