from __future__ import annotations

from datetime import datetime, timezone

import pytest

from docforge.operators import timestamps as ts

CASES = [
    ("2024-01-15T10:00:00Z", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("2024-01-15 10:00:00.987", "Asia/Kolkata", "DMY", "2024-01-15T04:30:00", "ok"),
    ("2024-01-15", "Asia/Kolkata", "DMY", "2024-01-14T18:30:00", "ok"),
    ("03/04/2024 10:00", "Europe/Paris", "DMY", "2024-04-03T08:00:00", "ok"),
    ("03/04/2024 10:00", "America/New_York", "MDY", "2024-03-04T15:00:00", "ok"),
    ("03/04/2024 10:00", "Europe/Brussels", "YMD", None, "unreadable"),
    ("2024-03-31 02:30:00", "Europe/Paris", "DMY", None, "nonexistent"),
    ("2024-10-27 02:30:00", "Europe/Paris", "DMY", None, "ambiguous"),
    ("27 Oct 2024 02:30:00 CET", "Europe/Paris", "DMY", "2024-10-27T01:30:00", "ok"),
    ("27 Oct 2024 02:30:00 CEST", "Europe/Paris", "DMY", "2024-10-27T00:30:00", "ok"),
    ("1 Jul 2024 12:00:00 IST", "Asia/Kolkata", "DMY", "2024-07-01T06:30:00", "ok"),
    ("1 Jul 2024 12:00:00 IST", "Europe/Dublin", "DMY", "2024-07-01T11:00:00", "ok"),
    ("1 Jul 2024 12:00:00 EST", "Asia/Kolkata", "DMY", None, "unreadable"),
    ("1705312800", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("1705312800123", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("1705312800123456", None, None, "2024-01-15T10:00:00", "ok"),
    ("20240115153000", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("2024-W03-1T10:00:00+00:00", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("2021-W53-1T10:00:00Z", "Asia/Kolkata", "DMY", None, "unreadable"),
    ("15 janvier 2024 à 11 h 00", "Europe/Paris", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15. Januar 2024, 11:00 Uhr", "Europe/Berlin", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15 de enero de 2024, 11:00", "Europe/Madrid", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15 gennaio 2024, ore 11.00", "Europe/Rome", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15 de janeiro de 2024 às 10h00", "Europe/Lisbon", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15 января 2024 г., 11:00", "Europe/Brussels", "YMD", "2024-01-15T10:00:00", "ok"),
    ("१५ जनवरी २०२४, १५:३० बजे", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15th January 2024 at 15:30", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("15-Jan-24 1530 hrs", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("January 15, 2024, 12:05 a.m.", "America/Chicago", "MDY", "2024-01-15T06:05:00", "ok"),
    ("JAN 15 2024 12:05:00 PM +01:00", None, "DMY", "2024-01-15T11:05:00", "ok"),
    ("Mon, 15 Jan 2024 10:00:00 GMT", "Asia/Kolkata", "DMY", "2024-01-15T10:00:00", "ok"),
    ("2024-02-30 08:15", "Europe/Paris", "DMY", None, "unreadable"),
    ("2024-13-45T10:00:00", "Europe/Paris", "DMY", None, "unreadable"),
    ("2024-01-15 25:00:00", "Europe/Paris", "DMY", None, "unreadable"),
    ("13:00 PM", "Europe/Paris", "DMY", None, "unreadable"),
    ("2024-01-15 10:00:00", None, "DMY", None, "no_zone"),
    ("2024-01-15 10:00:00", "No/Zone", "DMY", None, "no_zone"),
    ("n/a", "Europe/Paris", "DMY", None, "unreadable"),
    ("", "Europe/Paris", "DMY", None, "unreadable"),
    (None, "Europe/Paris", "DMY", None, "unreadable"),
    ("x" * 100_000, "Europe/Paris", "DMY", None, "unreadable"),
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(i, v, z, o, "kept") for i, (v, z, o, _, _) in enumerate(CASES)], "id int, v string, zone string, ord string, stretches string")
    return {r["id"]: r for r in ts.instants(df, "v", "zone", "ord").collect()}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_written_times(results, n):
    v, _, _, want, status = CASES[n]
    r = results[n]
    instant = None if want is None else int(datetime.fromisoformat(want).replace(tzinfo=timezone.utc).timestamp())
    assert (r["instant_s"], r["instant_status"], r["stretches"]) == (instant, status, "kept"), v and v[:40]


def test_intervals_agree_with_the_zone_rules():
    from zoneinfo import ZoneInfo

    zone = ZoneInfo("America/New_York")
    parts = ts.zone_intervals("America/New_York", 2000, 2010)
    for month in range(1, 13):
        for hour in (0, 1, 2, 3, 12):
            t = datetime(2007, month, 4, hour, 30)
            local = int((t - datetime(1970, 1, 1)).total_seconds())
            hits = {p[2] for p in parts if p[0] <= local < p[1]}
            offsets = {int(t.replace(tzinfo=zone, fold=f).utcoffset().total_seconds()) for f in (0, 1)}
            there = {o for o in offsets if datetime.fromtimestamp(local - o, zone).replace(tzinfo=None) == t}
            assert hits == there


def test_query_tables(spark):
    entries = spark.createDataFrame([(1, "s", "2024-01-15"), (1, "s", "2024-01-15"), (2, "s", "?"), (3, None, "1705312800"), (4, "t", "2024-01-15")], "entry_id bigint, source_id string, published_date string")
    parsed = spark.createDataFrame([("d", "https://WWW.a.org/x", "2024-01-15"), ("e", None, "2024-01-15")], "doc_id string, url string, published_date string")
    rules = spark.createDataFrame([("s", "a.org", "UTC", "DMY")], "source_id string, site_key string, time_zone string, date_order string")
    got = sorted(tuple(r) for r in ts.published_instants(entries, parsed, rules).collect())
    assert got == [("entry", "1", 1705276800), ("entry", "3", 1705312800), ("parsed", "d", 1705276800)]
    assert ts.published_instants(entries.limit(0), parsed.limit(0), rules).count() == 0
