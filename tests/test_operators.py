from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docforge.operators import analysis, crawl, dedup, ngrams, normalize, search, store
from docforge.plans import catalog

NOW = dt.datetime(2026, 1, 1)


def test_cutoff_keeps_undated(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2020, 1, 1)), (3, dt.datetime(2021, 1, 1))], "id int, published_date timestamp")
    assert {r["id"] for r in crawl.not_before(df, F.lit("2020-06-01").cast("timestamp")).collect()} == {1, 3}
    assert crawl.not_before(df, F.lit(None).cast("timestamp")).count() == 3


def test_first_seen_is_by_source(spark):
    df = spark.createDataFrame([("a", "u", 2, "x"), ("a", "u", 1, "y"), ("b", "u", 3, "z"), ("a", None, 1, "n")], "source_id string, url string, pos int, title string")
    got = {(r["source_id"], r["url"], r["title"]) for r in crawl.first_seen(df, ["pos"]).collect()}
    assert got == {("a", "u", "y"), ("b", "u", "z"), ("a", None, "n")}
    history = df.where("source_id = 'b'")
    assert {r["title"] for r in crawl.unseen(df, history).collect()} == {"x", "y", "n"}


@pytest.mark.parametrize(
    "headers, content, kind",
    [
        ({"Content-Type": "application/PDF"}, b"", "pdf"),
        ({"content-type": "text/html"}, b"%PDF", "html"),
        ({}, b"%PDF-1.4", "pdf"),
        ({}, b"<!DOCTYPE HTML>", "html"),
        ({"x": "pdf"}, b"<?xml", "html"),
        ({}, b"  <feed xmlns=", "html"),
        ({}, b"random bytes", "unknown"),
        ({}, b"", "unknown"),
        (None, None, "unknown"),
    ],
)
def test_content_type(spark, headers, content, kind):
    df = spark.createDataFrame([(headers, None if content is None else bytearray(content))], "h map<string,string>, c binary")
    assert df.select(crawl.content_type(F.col("h"), F.col("c")).alias("k")).first()["k"] == kind


def test_crawl_stats(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", "u", 200, t), ("a", "u", 304, t + dt.timedelta(seconds=5)), ("a", "v", 500, t)], "source_id string, url string, http_status int, fetched_at timestamp")
    r = crawl.crawl_stats(df).first()
    assert (r["entries_found"], r["entries_fetched"], r["entries_skipped"], r["errors"], r["duration_us"]) == (2, 1, 1, 1, 5_000_000)


def test_normalized(spark):
    df = spark.createDataFrame([("1", "http://www.a.org/x", None, "CafÃ© at the end of the day and the night"), ("2", None, " ", "   "), ("3", "", "t", None)], "doc_id string, url string, title string, body_text string")
    got = {r["doc_id"]: r for r in normalize.normalized(df).collect()}
    assert got["1"]["clean_text"].startswith("Café") and got["1"]["title"] == "Untitled" and got["1"]["site_key"] == "a.org"
    assert (got["2"]["char_count"], got["2"]["word_count"], got["3"]["char_count"], got["3"]["clean_text"]) == (3, 0, 0, "")


def test_ngrams_against_a_loop(spark):
    random.seed(1)
    texts = [("s" + str(i % 2), i, "".join(random.choice("abc ") for _ in range(random.choice([0, 3, 60, 80])))) for i in range(24)] + [("s1", 99, None)]
    df = spark.createDataFrame(texts, "site string, id int, text string")
    counts = ngrams.ngrams(df, "site", "id", "text")
    want = defaultdict(Counter)
    before = {}
    for s, i, t in texts:
        c = Counter((t or "")[k : k + 4] for k in range(len(t or "") - 3))
        for g, n in c.items():
            before[(s, i, g)] = want[s][g]
        want[s].update(c)
    assert {(r["site"], r["ngram"]): r["n"] for r in ngrams.confirmed(ngrams.totals(df, "site", "text")).collect()} == {(s, g): n for s in want for g, n in want[s].items() if n >= 3}
    assert {(r["site"], r["id"], r["ngram"]): r["before"] for r in ngrams.running(counts).collect()} == before
    got = {r["id"]: r["text"] for r in ngrams.masked(df, ngrams.confirmed(ngrams.totals(df, "site", "text")), "site", "id", "text").collect()}
    for s, i, t in texts:
        if t is None or len(t) < 50:
            assert got[i] == t
            continue
        cover = [False] * len(t)
        for k in range(len(t) - 3):
            if want[s][t[k : k + 4]] >= 3:
                cover[k : k + 4] = [True] * 4
        assert got[i] == " ".join("".join(" " if h else c for c, h in zip(t, cover)).split())


def test_mask_is_free_of_order():
    known = np.sort(np.concatenate([ngrams.gram_hashes("abcd"), ngrams.gram_hashes("cdef")]))
    assert ngrams.mask("abcdefgh", known) == "gh" and ngrams.mask("abc", known) == "abc"


def test_ngram_documents(spark):
    df = spark.createDataFrame([("s", "aaaaaa"), ("s", "aaaa"), ("t", "aaaa"), ("s", None)], "site string, text string")
    assert {tuple(r) for r in ngrams.totals(df, "site", "text", mode="document").collect()} == {("s", "aaaa", 2), ("t", "aaaa", 1)}
    assert {tuple(r) for r in ngrams.site_stats(ngrams.totals(df, "site", "text")).collect()} == {("s", 1, 1), ("t", 1, 0)}


def test_upsert(spark):
    kind = "doc_id string, title string, status string, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = spark.createDataFrame([("1", "a", "new", NOW, NOW), ("2", "b", "new", NOW, NOW)], kind)
    new = spark.createDataFrame([("2", "B", 7), ("3", "C", 8), ("3", "D", 9)], "doc_id string, title string, extra int")
    later = dt.datetime(2026, 2, 2)
    got = {r["doc_id"]: tuple(r)[1:] for r in store.upsert(old, new, F.lit(later).cast("timestamp_ntz")).collect()}
    assert got == {"1": ("a", "new", NOW, NOW), "2": ("B", "new", NOW, later), "3": ("D", None, later, later)}


def test_save_swaps(spark, tmp_path):
    path = str(tmp_path / "t")
    store.save(spark.range(3), path)
    store.save(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_chunk_sets(spark):
    c = spark.createDataFrame([("1", 1, "b"), ("1", 0, "a"), ("2", 0, "x")], "doc_id string, ord int, text string")
    docs = spark.createDataFrame([("1",), ("3",)], "doc_id string")
    got = {r["doc_id"]: [x["text"] for x in r["chunks"]] for r in store.with_chunks(docs, c).collect()}
    assert got == {"1": ["a", "b"], "3": []}
    assert {r["doc_id"] for r in store.orphans_removed(c, docs).collect()} == {"1"}
    left = store.replace_chunks(c, docs, c.where("doc_id = '9'"))
    assert {r["doc_id"] for r in left.collect()} == {"2"}


def test_audit(spark):
    log = spark.createDataFrame([(1, "x")], "event_id int, action string")
    assert store.append_events(log, spark.createDataFrame([(2, "y")], log.schema)).count() == 2
    for bad in ([(1, "z")], [(3, "a"), (3, "b")]):
        new = spark.createDataFrame(bad, log.schema)
        assert store.conflicts(log, new).count() == 1
        with pytest.raises(PySparkException):
            store.append_events(log, new).collect()


def test_hash_lookup_takes_the_first(spark):
    df = spark.createDataFrame([("b", "h", NOW), ("a", "h", NOW), ("c", None, NOW)], "doc_id string, content_hash string, created_at timestamp_ntz")
    assert [tuple(r) for r in store.by_hash(df).collect()] == [("h", "a", 2)]


def test_near_fingerprints_miss_nothing(spark):
    random.seed(2)
    base = [random.getrandbits(64) for _ in range(40)]
    values = set(base)
    for v in base:
        for n in (1, 2, 3, 4):
            x = v
            for b in random.sample(range(64), n):
                x ^= 1 << b
            values.add(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed] + [(signed[0],), (None,)], "simhash bigint")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert {(r["a"], r["b"]) for r in dedup.near_fingerprints(df).collect()} == want
    got = {r["node"]: r["component"] for r in dedup.components(spark.createDataFrame(list(want), "a bigint, b bigint")).collect()}
    root = {v: v for p in want for v in p}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in want:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    assert got == {v: top(v) for v in root}


def test_components_of_a_long_path(spark):
    n = 200
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "a int, b int")
    got = {r["node"]: r["component"] for r in dedup.components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_near_duplicate_classes_cover_all(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h"), (2, "A b c d e f g h"), (3, "something else entirely here"), (4, None), (5, " ")], "id int, text string")
    got = {r["id"]: (r["class_id"], r["links"]) for r in dedup.near_duplicate_classes(df, "id", "text").collect()}
    assert set(got) == {1, 2, 3} and got[1] == got[2] != got[3]


def test_chunks(spark):
    df = spark.createDataFrame([(1, "x" * 25), (2, ""), (3, None), (4, "abc")], "id int, text string")
    got = [(r["id"], r["ord"], r["start"], r["char_count"]) for r in search.chunks(df, "id", "text", 10, 2).orderBy("id", "ord").collect()]
    assert got == [(1, 0, 0, 10), (1, 1, 8, 10), (1, 2, 16, 9), (4, 0, 0, 3)]
    with pytest.raises(ValueError):
        search.chunks(df, "id", "text", 5, 5)
    s = spark.createDataFrame([(1, "One two. Three four! Five six? Seven"), (2, None), (3, " ")], "id int, text string")
    got = [(r["id"], r["text"]) for r in search.sentence_chunks(s, "id", "text", 20).orderBy("id", "ord").collect()]
    assert got == [(1, "One two. Three four!"), (1, "Five six? Seven")]


def test_nearest_against_a_loop(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.normal(size=(120, 8))
    v[7] = v[3]
    df = spark.createDataFrame([(i, [float(x) for x in v[i]], i % 3) for i in range(120)] + [(500, None, 0)], "id int, v array<float>, label int").repartition(5)
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    score = n @ n.T
    got = defaultdict(list)
    for r in search.nearest(df, df.where("id % 10 = 0 OR id = 500"), "id", "v", k=4).orderBy("rank").collect():
        got[r["query_id"]].append(r["id"])
    for q in range(0, 120, 10):
        assert got[q] == sorted((i for i in range(120) if i != q), key=lambda i: (-round(score[q][i], 7), i))[:4]
    some = search.nearest(df, df.where("id = 0"), "id", "v", k=50, least=0.2, same="label").collect()
    assert {r["id"] for r in some} == {i for i in range(3, 120, 3) if score[0][i] >= 0.2}
    assert search.nearest(df, df.where("id < 0"), "id", "v").count() == 0


def test_topics_and_summary(spark):
    df = spark.createDataFrame([(1, "We report capital. Nothing here. The audit record is safe. Capital again."), (2, None)], "id int, text string")
    got = {r["id"]: (r["t"], r["s"]) for r in df.select("id", analysis.topics(F.col("text")).alias("t"), analysis.key_sentences(F.col("text"), 2).alias("s")).collect()}
    assert got[1][0] == ["disclosure", "capital", "records"] and got[1][1] == ["We report capital.", "The audit record is safe."]
    assert got[2] == ([], [])


def test_all_documents_are_normalized(spark, tmp_path):
    import hashlib

    german = "Die Bank und der Prüfer sind für das Jahr nicht im Verzug"
    russian = "Банк обязан хранить сведения о клиентах пять лет"
    bodies = {"a": "The bank must file the report by the end of the year", "b": german, "c": german.encode().decode("latin-1"), "d": german.encode().decode("cp1252").encode().decode("cp1252"), "e": russian, "f": None, "g": " "}
    clean = bodies | {"c": german, "d": german, "f": ""}
    rows = [(k, f"https://www.x.org/{k}", None if k == "b" else " T ", t) for k, t in bodies.items()]
    spark.createDataFrame(rows + rows[:3], "doc_id string, url string, title string, body_text string").write.parquet(str(tmp_path / "parsed_documents.parquet"))
    got = catalog.queries()["normalized_all"](spark, str(tmp_path)).collect()
    want = {(k, "Untitled" if k == "b" else "T", "x.org", t, len(t), len(t.split()), hashlib.sha256(t.encode()).hexdigest()) for k, t in clean.items()}
    assert len(got) == len(want) and {(r["doc_id"], r["title"], r["site_key"], r["clean_text"], r["char_count"], r["word_count"], r["content_hash"]) for r in got} == want
    assert {r["doc_id"]: r["language"] for r in got} == {"a": "en", "b": "de", "c": "de", "d": "de", "e": "ru", "f": "en", "g": "en"}


def test_vector_index_against_a_search_of_all(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    heads = rng.normal(size=(60, 16))
    v = heads[rng.integers(0, 60, 6000)] + 0.4 * rng.normal(size=(6000, 16))
    v[:2000] = heads[0] + 0.3 * rng.normal(size=(2000, 16))  # a third of all rows in one place
    rows = [(i, [float(x) for x in v[i]], i) for i in range(6000)] + [(9000, None, 0)]
    df = spark.createDataFrame(rows, "id int, v array<float>, cell int").repartition(4)
    monkeypatch.setattr(search, "SHARE_ROWS", 300)
    asked = df.where("id % 100 = 0")
    model = search.centres(df, "id", "v", 40)
    stored = search.indexed(df, model, "id", "v")
    assert model.shape == (40, 16) and stored.count() == 6000
    exact = {(r["query_id"], r["id"]) for r in search.nearest(df, asked, "id", "v").collect()}
    got = search.nearest_indexed(stored, asked, model, "id", "v", probes=8).collect()
    found = {(r["query_id"], r["id"]) for r in got}
    print("recall", len(found & exact) / len(exact))
    assert len(found & exact) >= 0.9 * len(exact) and len(got) == 600 and all(q != i for q, i in found)
    assert search.centres(df.limit(0), "id", "v").shape == (0, 0) and search.indexed(df.limit(0), np.zeros((0, 0)), "id", "v").count() == 0
