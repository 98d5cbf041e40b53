from __future__ import annotations

import datetime as dt

import pytest

from docforge.streaming import state

T = dt.datetime(2024, 1, 1)


def _files(spark, tmp_path, parts, kind):
    path = str(tmp_path / "in")
    for p in parts:
        spark.createDataFrame(p, kind).coalesce(1).write.mode("append").parquet(path)
    return state.read_files(spark, path, 1)


def test_first_seen_over_batches(spark, tmp_path):
    s = _files(spark, tmp_path, [[("a", "u"), ("a", "u")], [("a", "u"), ("b", "u"), (None, "u")]], "source string, url string")
    assert state.run_to_table(state.first_seen(s, ["source", "url"])).count() == 3


def test_bucket_rule():
    grant, tokens, last = state.bucket_times([0.0] * 6, 5.0, None, 30, 5)
    assert grant == [0.0] * 5 + [2.0] and tokens == 0.0 and last == 2.0
    assert state.bucket_times([100.0], 0.0, 2.0, 30, 5)[1] == 4.0
    for bad in ((0, 5), (30, 0)):
        with pytest.raises(ValueError):
            state.check_bucket(*bad)


def test_bucket_keeps_its_state(spark, tmp_path):
    rows = [[("h", T)] * 5, [("h", T), ("g", T)]]
    s = _files(spark, tmp_path, rows, "host string, at timestamp")
    got = sorted((r["host"], round(r["granted_at"] - r["requested_at"], 3)) for r in state.run_to_table(state.token_bucket(s, "host", "at")).collect())
    assert got == [("g", 0.0)] + [("h", 0.0)] * 5 + [("h", 2.0)]


def test_windows_sessions_and_counts(spark, tmp_path):
    s = _files(spark, tmp_path, [[("x", T), ("x", T + dt.timedelta(minutes=20))], [("x", T + dt.timedelta(hours=2))]], "k string, ts timestamp")
    assert sorted(r["n"] for r in state.run_to_table(state.windowed_counts(s, "ts", ["k"]), "complete").collect()) == [1, 2]
    assert sorted(r["n"] for r in state.run_to_table(state.sessions(s, "ts", ["k"]), "complete").collect()) == [1, 2]
    n = _files(spark, tmp_path / "n", [[("a", "abcde"), ("a", None)], [("a", "abcd"), ("b", "abc")]], "site string, text string")
    assert {(r["site"], r["ngram"]): r["n"] for r in state.run_to_table(state.ngram_counts(n, "site", "text"), "complete").collect()} == {("a", "abcd"): 2, ("a", "bcde"): 1}


def test_ngram_state_of_documents(spark, tmp_path):
    from docforge.operators import ngrams
    from docforge.plans import catalog

    docs = spark.createDataFrame([("a", "abcde abcde"), ("a", "abc"), ("b", "für für die Bank" * 50), (None, "abcd"), ("a", None)], "source string, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in catalog.queries()["stream_ngram_documents"](spark, str(tmp_path)).select("site", "ngram", "n").collect()}
    want = {tuple(r) for r in ngrams.totals(docs, "source", "text").select("site", "ngram", "n").collect()}
    assert {x for x in got if x[0]} == {x for x in want if x[0]} and ("a", "abcd", 2) in got and ("b", "für ", 100) in got


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    path, kind = str(tmp_path / "in"), "site string, text string"
    put = lambda rows: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)
    run = lambda mode, keys, name: {tuple(r) for r in state.run_to_table(state.ngram_counts(state.read_files(spark, path), "site", "text"), mode, keys, str(tmp_path / name)).collect()}
    put([("a", "abcde"), (None, "abcd")])
    assert run("update", ["site", "ngram"], "t") == {("a", "abcd", 1), ("a", "bcde", 1), (None, "abcd", 1)}
    put([("a", "abcd")])
    assert run("update", ["site", "ngram"], "t") == {("a", "abcd", 2), ("a", "bcde", 1), (None, "abcd", 1)}
    assert run("update", ["site", "ngram"], "t") == {("a", "abcd", 2), ("a", "bcde", 1), (None, "abcd", 1)}  # nothing new
    assert run("complete", None, "anew") == {("a", "abcd", 2), ("a", "bcde", 1), (None, "abcd", 1)}
    with pytest.raises(ValueError):
        run("update", None, "u")


def test_bucket_jitter_and_timeout(spark, tmp_path):
    s = _files(spark, tmp_path, [[("h", T)] * 8], "host string, at timestamp")
    got = sorted((r["granted_at"] is None, round((r["granted_at"] or 0) - r["requested_at"], 3)) for r in state.run_to_table(state.token_bucket(s, "host", "at", jitter=0.5, timeout=5.0)).collect())
    waits = [w for none, w in got if not none]
    assert len(waits) == 7 and all(0 <= w <= 0.5 for w in waits[:5]) and 2 <= waits[5] <= 2.5 and 4 <= waits[6] <= 4.5
    for bad in ((30, 5, -1), (30, 5, 0, 0)):
        with pytest.raises(ValueError):
            state.check_bucket(*bad)
