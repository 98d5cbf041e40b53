from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docforge.functions import html
from docforge.sources import fetch, listings, registry

ROWS = """<table><tr><th>Date</th></tr>
<tr><td>15 January 2024</td><td><a href="/Scripts/N.aspx?Id=1&Mode=0">Circular on X</a></td><td>Dept A</td><td>DBR.No.BP.BC.83/21.04.048/2023-24</td></tr>
<tr><td>10 January 2024</td><td><a href="/b">See DBR.No.BP.BC.84/21.04.048/2023-24</a></td><td>Dept B</td></tr>
<tr><td>no date</td><td>no link</td><td>x</td></tr></table>"""
NEWS = """<article class="post news-item"><h2><a href="n/1">On Article 5</a></h2><time datetime="x">2024-01-15</time><div class="excerpt">sum</div></article><article><p>no link</p></article>"""


@pytest.fixture
def sources(spark):
    return spark.createDataFrame([("a", "RBI", "A", "https://x/l", None, "rbi", {"max_pages": 2}), ("b", "SEBI", "B", "https://y/l", None, "sebi", {}), ("c", "FDA", "C", None, "https://z/rss", "fda", {})], "id string, jurisdiction string, name string, listing_url string, feed_url string, adapter string, crawl_policy map<string,int>")


def test_registry_from_yaml(spark, tmp_path):
    f = tmp_path / "s.yaml"
    f.write_text("sources:\n- {id: a, jurisdiction: RBI, name: A, adapter: rbi, crawl_policy: {max_pages: 3}}\n")
    r = registry.load_sources(spark, str(f)).first()
    assert (r["id"], r["crawl_policy"]) == ("a", {"max_pages": 3})
    with pytest.raises(FileNotFoundError):
        registry.load_sources(spark, str(tmp_path / "none"))
    f.write_text("x: 1\n")
    with pytest.raises(ValueError):
        registry.load_sources(spark, str(f))


def test_lookups(sources):
    assert registry.get(sources, "b").count() == 1 and registry.get(sources, "z").count() == 0
    assert registry.by_adapter(sources, "fda").first()["id"] == "c" and registry.by_jurisdiction(sources, "RBI").count() == 1
    assert registry.allowed(sources).count() == 3 and registry.allowed(sources, ["a", "b"], ["sebi"]).first()["id"] == "b"
    assert registry.one(sources, "a").count() == 1
    with pytest.raises(PySparkException):
        registry.one(sources, "zz").collect()


def test_pages_of_listings(sources):
    got = {(r["source_id"], r["page"]): r["page_url"] for r in registry.listing_pages(sources).collect()}
    assert got[("a", 1)] == "https://x/l" and got[("a", 2)] == "https://x/l?page=2" and len(got) == 7


def test_listing_rows(spark):
    df = spark.createDataFrame([("rbi_notifications", ROWS), ("eu_ai_act", NEWS), ("sebi", None), ("other", ROWS)], "kind string, html string")
    got = {r["url"]: r for r in listings.entries_from_pages(df, "https://www.rbi.org.in").collect()}
    a = got["https://www.rbi.org.in/Scripts/N.aspx?Id=1&Mode=0"]
    assert a["published_date"] == dt.datetime(2024, 1, 15) and a["metadata"]["reference_number"] == "DBR.No.BP.BC.83/21.04.048/2023-24" and a["metadata"]["department"] == "Dept A"
    assert got["https://www.rbi.org.in/b"]["metadata"]["reference_number"] == "DBR.No.BP.BC.84/21.04.048/2023-24"
    n = got["https://www.rbi.org.in/n/1"]
    assert (n["title"], n["summary"], n["metadata"]["reference_number"], n["metadata"]["document_type"]) == ("On Article 5", "sum", "Article 5", "NEWS")
    assert len(got) == 3


def test_press_cards():
    page = html.tree('<div class="pr-item"><span class="date">1 May 2024</span><h3><a href="/p">T</a></h3></div><table><tr><td>d</td><td><a href="/q">U</a></td></tr></table>')
    assert [x[:3] for x in listings.find_reader("RBI_press")(page)] == [("/p", "T", "1 May 2024"), ("/q", "U", "d")]
    with pytest.raises(ValueError, match="known"):
        listings.find_reader("nope")


def test_json_limit_comes_before_the_cutoff(spark):
    body = '{"results":[{"title":"a","html_url":"","pdf_url":"p","publication_date":"2024-01-15","type":"Notice","agencies":[{"name":"X"},{}]},{"title":"b","html_url":"h","publication_date":"2024-01-01"},{"title":"c","html_url":"k","publication_date":"2024-01-20"}]}'
    df = spark.createDataFrame([(body,), ("no json",), (None,)], "body string")
    got = listings.entries_from_json(df, F.col("body"), 2, F.lit("2024-01-10").cast("timestamp")).collect()
    assert [(r["url"], r["metadata"]["document_type"], r["metadata"]["agencies"]) for r in got] == [("p", "NOTICE", ["X", ""])]


def test_rss(spark):
    item = "<item><title>Recall FDA-2024-7 &amp; more</title><link>l{0}</link><pubDate>Mon, {0} Jan 2024 00:00:00 GMT</pubDate><guid>g</guid></item>"
    df = spark.createDataFrame([("<rss><channel>" + "".join(item.format(k) for k in (15, 12, 10)) + "</channel></rss>",), ("<rss>",), (None,)], "body string")
    got = listings.entries_from_rss(df, F.col("body"), cutoff=F.lit("2024-01-13").cast("timestamp")).collect()
    assert [(r["url"], r["title"], r["metadata"]["reference_number"]) for r in got] == [("l15", "Recall FDA-2024-7 & more", "FDA-2024-7")]
    assert listings.entries_from_rss(df, F.col("body"), 2).count() == 2


def test_replay(spark):
    answers = spark.createDataFrame([("u", 200, bytearray(b"x"), {"a": "b"}, "e1", None, False), ("v", 500, None, {}, None, None, False)], "url string, status int, content binary, headers map<string,string>, etag string, last_modified string, from_cache boolean")
    asked = spark.createDataFrame([("u", "e1", None), ("u", "old", None), ("v", None, None), ("w", None, None)], "url string, etag string, last_modified string")
    got = sorted((r["url"], r["status"], r["content"] is not None) for r in fetch.replay(asked, answers).collect())
    assert got == [("u", 200, True), ("u", 304, False), ("v", 500, False), ("w", 404, False)]


def test_robots(spark):
    files = spark.createDataFrame([("a.org", "User-agent: *\nDisallow: /x/\nAllow: /x/y/\n"), ("b.org", "User-agent: *\nDisallow: /\n"), ("d.org", None)], "host string, text string")
    urls = spark.createDataFrame([("http://a.org/x/1",), ("http://a.org/x/y/2",), ("http://a.org/",), ("http://b.org/",), ("http://c.org/x/",), ("http://d.org/",)], "url string")
    got = {r["url"] for r in fetch.permitted(urls, fetch.robots_rules(files)).collect()}
    assert got == {"http://a.org/x/y/2", "http://a.org/", "http://c.org/x/", "http://d.org/"}


def test_http_source(spark, tmp_path):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class H(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            self.send_response(200 if self.path == "/ok" else 404)
            self.send_header("ETag", "e")
            self.end_headers()
            self.wfile.write(b"body")

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), H)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}"
        spark.dataSource.register(fetch.HttpSource)
        got = {r["url"]: r for r in spark.read.format("http_pages").option("urls", f"{base}/ok {base}/no").load().collect()}
    finally:
        server.shutdown()
    assert got[f"{base}/ok"]["status"] == 200 and bytes(got[f"{base}/ok"]["content"]) == b"body" and got[f"{base}/ok"]["etag"] == "e"
    assert got[f"{base}/no"]["status"] == 404


def test_requests_are_fetched_with_their_validators(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from docforge.sources import fetch

    class Answers(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.headers.get("If-None-Match") == '"a"' or self.headers.get("If-Modified-Since") == "yesterday":
                self.send_response(304)
                self.end_headers()
                return
            self.send_response(404 if self.path == "/none" else 200)
            self.send_header("ETag", '"a"')
            self.end_headers()
            self.wfile.write(self.path.encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        rows = [(f"{base}/x", None, None), (f"{base}/y", '"a"', None), (f"{base}/z", None, "yesterday"), (f"{base}/none", None, None), (f"{base}/private/1", None, None), (None, None, None)]
        rules = spark.createDataFrame([(f"127.0.0.1:{server.server_port}", "/private", False)], "host string, prefix string, allow boolean")
        got = {r["url"][len(base) :]: r for r in fetch.fetched(spark.createDataFrame(rows, "url string, etag string, last_modified string"), rules, per_minute=60_000.0, tasks=2).collect()}
    finally:
        server.shutdown()
    assert {k: r["status"] for k, r in got.items()} == {"/x": 200, "/y": 304, "/z": 304, "/none": 404}
    assert bytes(got["/x"]["content"]) == b"/x" and got["/x"]["etag"] == '"a"' and got["/y"]["from_cache"] and got["/y"]["etag"] == '"a"' and got["/z"]["last_modified"] == "yesterday"


def test_feeds_of_both_kinds_and_their_dates(spark):
    from docforge.sources import listings

    item = "<item><title>T</title><link>https://a.org/1</link>%s</item>"
    rss = "<rss><channel>" + "".join(item % x for x in ("<pubDate>Mon, 15 Jan 2024 10:00:00 GMT</pubDate>", "<updated>2024-01-16T00:00:00Z</updated>", "<created>2024-01-17T00:00:00Z</created>", "")) + "</channel></rss>"
    atom = '<feed><entry><title>A</title><link rel="self" href="https://a.org/s"/><link rel="alternate" href="https://a.org/2"/><updated>2024-02-01T00:00:00Z</updated><id>i</id></entry></feed>'
    df = spark.createDataFrame([(1, rss), (2, atom), (3, "<rss"), (4, None)], "k int, body string")
    got = [(r["k"], r["url"], None if r["published_date"] is None else r["published_date"].strftime("%m-%d")) for r in listings.entries_from_rss(df, __import__("pyspark").sql.functions.col("body"), keep=("k",)).orderBy("k", "position").collect()]
    assert got == [(1, "https://a.org/1", "01-15"), (1, "https://a.org/1", "01-16"), (1, "https://a.org/1", "01-17"), (1, "https://a.org/1", None), (2, "https://a.org/2", "02-01")]
