from __future__ import annotations

import datetime as dt
import zlib

import pytest
from pyspark.sql import functions as F

from docforge.functions import html, language, metadata, pdf, text


def one(spark, column, **values):
    """The value of an expression over one row of literals."""
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("t", ["", " ", "a", " a  b c　d\x1ce\x85f\x0bg ", "\n\n", "x​y"])
def test_words_split_like_the_language(spark, t):
    assert one(spark, text.word_count(F.col("t")), t=t) == len(t.split())
    assert one(spark, text.collapse_space(F.col("t")), t=t) == " ".join(t.split())


def test_nulls(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.word_count(F.col("t"))).first()[0] in (None, -1)
    assert df.select(text.content_hash(F.col("t"))).first()[0] == ""
    assert df.select(text.default_title(F.col("t"))).first()[0] == "Untitled"


@pytest.mark.parametrize(
    "url, key", [("https://www.rbi.org.in/Scripts/x.aspx", "rbi.org.in"), ("HTTP://User@Example.COM:80/a", "user@example.com:80"), ("no url", ""), ("https://wwwx.org/", "wwwx.org")]
)
def test_site_key(spark, url, key):
    assert one(spark, text.site_key(F.col("u")), u=url) == key


@pytest.mark.parametrize("href", ["https://b.org/x", "//c.org/y", "/r/s?q=1", "t.html", "?n=2", "#top", ""])
def test_links_resolve_like_the_standard_library(spark, href):
    from urllib.parse import urljoin

    base = "https://a.org/dir/page.html?x=1"
    assert one(spark, text.absolute_url(F.col("b"), F.col("h")), b=base, h=href) == urljoin(base, href)


def test_conditional_headers_and_defaults(spark):
    assert one(spark, text.conditional_headers(F.lit('"e"'), F.lit(None).cast("string"))) == {"If-None-Match": '"e"'}
    a, b = F.create_map(F.lit("x"), F.lit(1)), F.create_map(F.lit("x"), F.lit(0), F.lit("y"), F.lit(2))
    assert one(spark, text.merge_defaults(a, b)) == {"x": 1, "y": 2}


@pytest.mark.parametrize("t", ["Café – naïve “x”", "दो भाषाओं", "plain", "ÉÀ"])
def test_encoding_is_repaired_twice_over(spark, t):
    bad = t.encode().decode("latin-1")
    assert one(spark, text.repair_encoding(F.col("t")), t=bad) == t
    assert one(spark, text.repair_encoding(F.col("t")), t=bad.encode().decode("latin-1")) == t
    assert one(spark, text.repair_encoding(F.col("t")), t=t) == t


@pytest.mark.parametrize(
    "j, t, want",
    [
        ("RBI", "On 15 Jan 2024", dt.datetime(2024, 1, 15)),
        ("RBI", "31 Feb 2024 then 1 Mar 2024", dt.datetime(2024, 3, 1)),
        ("SEBI", "02/03/2024", dt.datetime(2024, 2, 3)),
        ("FDA", "January 15, 2024", dt.datetime(2024, 1, 15)),
        ("EU_AI_ACT", "15 January 2024", dt.datetime(2024, 1, 15)),
        ("RBI", "", None),
        ("OTHER", "15 Jan 2024", None),
    ],
)
def test_published_date(spark, j, t, want):
    assert one(spark, metadata.published_date(F.col("t"), F.col("j")), t=t, j=j) == want


def test_reference_and_type(spark):
    ref = lambda t, u, j: one(spark, metadata.reference_number(F.col("t"), F.col("u"), F.col("j")), t=t, u=u, j=j)
    kind = lambda t, u, j: one(spark, metadata.document_type(F.col("t"), F.col("u"), F.col("j")), t=t, u=u, j=j)
    assert ref("RBI/2024-25/DBR.ABC.No.123/456.789.123/2024-25", "", "RBI") == "DBR.ABC.No.123/456.789.123/2024-25"
    assert ref("none", "https://x/?a&RBI/2024-25/DBR/123", "RBI") == "RBI/2024-25/DBR/123"
    assert ref("see article 5", "", "EU_AI_ACT") == "article 5"
    assert ref("", "", "RBI") is None
    assert kind("Master Direction", "", "RBI") == "NOTIFICATION"
    assert kind("x", "", "RBI") is None
    assert [kind("x", "", j) for j in ("SEBI", "FDA", "EU_AI_ACT")] == ["CIRCULAR", "RSS_ITEM", "NEWS"]
    assert kind("Final Rule", "", "FDA") == "REGULATION"


def test_feed_dates(spark):
    want = dt.datetime(2024, 1, 15, 10, 30)
    for t in ("Mon, 15 Jan 2024 10:30:00 GMT", "Mon, 15 Jan 2024 12:30:00 +0200", "2024-01-15T10:30:00Z"):
        assert one(spark, metadata.feed_date(F.col("t")), t=t) == want
    assert one(spark, metadata.feed_date(F.col("t")), t="soon") is None


def test_language_guess(spark):
    got = lambda t: tuple(one(spark, language.detect(F.col("t")), t=t))
    assert got("") == ("en", 0.1) and got("short text") == ("en", 0.1) and got("   " * 20) == ("en", 0.1)
    assert got("The report of the desk is in the register")[0] == "en"
    assert got("Der Bericht ist nicht von dem Amt und das Amt ist zu")[0] == "de"
    assert got("यह पाठ केवल सूचना के लिए जारी किया गया है")[0] == "hi"
    assert spark.createDataFrame([(None,)], "t string").select(language.detect(F.col("t")).alias("x")).first()["x"]["language"] == "en"


def test_html_title_order():
    t = lambda h, u="": html.parse(h, u)[0]
    assert t("<title> A </title><h1>B</h1>") == "A"
    assert t("<title></title><h1></h1><meta property='og:title' content='C'>") == "C"
    assert t("<meta name='twitter:title' content='D'><h2>E</h2>") == "D"
    assert t("<h3></h3><h2>E <b>f</b></h2>") == "E f"
    assert t("<p>x</p>", "https://a/b/some-long_name/") == "Some Long Name"
    assert t("<p>x</p>") == "Untitled" and html.parse("  ") == ("Untitled", "")


def test_html_body_and_stripping():
    long = "content " * 10
    page = f"<body><nav>menu</nav><div class='x sidebar'>side</div><main>tiny</main><article><p>{long}<li>one<li>two</article><script>var a='<p>no</p>'</script><footer>end</footer></body>"
    assert html.parse(page)[1] == f"{long.strip()} one two"
    assert html.parse("<body>a<div role='banner'>b</div> c &amp; d</body>")[1] == "a c & d"
    assert html.parse("<div class='keep'>a</div><div class='gone'>b</div>", selectors=(".gone",))[1] == "a"
    with pytest.raises(ValueError):
        html.matcher("a > b")


def test_pages_keep_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (2, "u", bytearray("<title>é</title><body>ü</body>".encode()))], "id int, url string, content_bytes binary")
    assert {r["id"]: (r["title"], r["body_text"]) for r in html.parse_pages(df, "id").collect()} == {1: ("Untitled", ""), 2: ("é", "ü")}


def _pdf(stream: bytes, flate: bool = False) -> bytes:
    body = zlib.compress(stream) if flate else stream
    kind = b"/Filter /FlateDecode" if flate else b""
    return b"%PDF-1.4\n1 0 obj<</Type /Page /Contents 2 0 R>>endobj\n2 0 obj<<" + kind + b">>stream\n" + body + b"\nendstream endobj\n3 0 obj<</Title (T \\(x\\))>>endobj\n4 0 obj<</Type /Outlines /First 5 0 R>>endobj\n5 0 obj<</Title (One) /First 6 0 R /Next 7 0 R>>endobj\n6 0 obj<</Title (Sub)>>endobj\n7 0 obj<</Title <FEFF00E9>>>endobj\ntrailer<</Info 3 0 R>>"


@pytest.mark.parametrize("flate", [False, True])
def test_pdf(flate):
    r = pdf.read(_pdf(b"BT (Test) Tj [( PDF) -20 ( Con)] TJ (tent) Tj T* (two) Tj ET", flate))
    assert (r["text"], r["page_count"], r["is_scanned"], r["title"]) == ("Test PDF Content\ntwo", 1, False, "T (x)")
    assert r["toc"] == [("One", 0), ("Sub", 1), ("é", 0)]


def test_pdf_failures():
    assert pdf.read(_pdf(b""))["is_scanned"] and pdf.read(_pdf(b""))["page_count"] == 1
    for data in (None, b"", b"html"):
        r = pdf.read(data)
        assert (r["page_count"], r["is_scanned"], r["error"]) == (0, True, "not a PDF file")
