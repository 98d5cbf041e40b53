from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from docforge.operators import parse

T = dt.datetime(2024, 1, 2, 3, 4, 5)
KIND = "source_id string, url string, fetched_at timestamp, http_status int, content_bytes binary, headers map<string,string>"
PDF = b"%PDF-1.4\n1 0 obj<</Type /Page /Contents 2 0 R>>endobj\n2 0 obj<<>>stream\nBT (Master Direction of 15 Jan 2024) Tj ET\nendstream endobj"


def test_documents(spark):
    html = "<title>Circular</title><body>Issued 15 Jan 2024, RBI/2024-25/ABC/7 by the desk of the bank, in full and at length</body>".encode()
    rows = [
        ("r", "https://a.org/x", T, 200, bytearray(html), {"content-type": "text/html"}),
        ("r", "https://a.org/x", T, 200, bytearray(html), {"content-type": "text/html"}),
        ("r", "https://a.org/files/y.pdf", T, 200, bytearray(PDF), None),
        ("q", "https://a.org/z", T, 200, None, None),
        ("r", "https://a.org/bad.pdf", T, 200, bytearray(b"no pdf"), {"Content-Type": "application/pdf"}),
        ("r", "https://a.org/e", T, 500, bytearray(html), None),
    ]
    sources = spark.createDataFrame([("r", "RBI")], "id string, jurisdiction string")
    got = {r["url"]: r for r in parse.parsed_documents(spark.createDataFrame(rows, KIND), sources).collect()}
    a, y, z, bad = (got[f"https://a.org/{u}"] for u in ("x", "files/y.pdf", "z", "bad.pdf"))
    assert len(got) == 4 and len(a["doc_id"]) == 16
    assert (a["title"], a["published_date"], a["reference_number"], a["document_type"], a["kind"]) == ("Circular", dt.datetime(2024, 1, 15), "RBI/2024-25/ABC/7", "NOTIFICATION", "html")
    assert (y["title"], y["body_text"], y["kind"], y["error"]) == ("y.pdf", "Master Direction of 15 Jan 2024", "pdf", None)
    assert (z["title"], z["body_text"], z["document_type"], z["kind"]) == ("Untitled", "", None, "unknown")
    assert bad["error"] and bad["body_text"] == ""
    assert parse.parsed_documents(spark.createDataFrame([], KIND), sources).count() == 0


def test_counts(spark):
    df = spark.createDataFrame([("a", 200), ("a", 200), ("a", 404), ("b", None), ("c", 500)], "s string, http_status int")
    got = {r["s"]: r["counts"] for r in parse.status_counts(df, "s", F.col("http_status").cast("string")).collect()}
    assert got == {"a": {"200": 2, "404": 1}, "c": {"500": 1}}
