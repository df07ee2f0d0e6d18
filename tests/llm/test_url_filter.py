from __future__ import annotations

import re

import pytest

from fleetlake.llm import url_filter

RULES = [
    ("block", "a.com", "/x"), ("allow", "a.com", "/x/y"), ("allow", "www.a.com", "/"), ("block", "com", "/q/very/long/"),
    ("allow", "Com", ""), ("block", None, "/"), ("allow", "z.org", None), ("block", "com", ""),
]
URLS = [
    "http://a.com/x/y/z", "http://www.A.com/x", "HTTP://b.a.com/x?y", "http://aa.com/q/very/long/1", "a.com/x", None, "",
    "x://", "http://com", "http://com#/x", "ftp://z.org/?a://a.com/x", "http://a.com:80/x", "http://É.com/x", "http://.com/",
    "http://a.com\n/x", "http://www.a.com/" + "x" * 50_000, "http://" + "a." * 5_000 + "com/x",
]


def brute(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [
        (len(h) + len(p), len(h), v == "block", h.lower() + p, v)
        for v, h, p in RULES
        if h is not None and p is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, "allow")))


@pytest.fixture()
def rules(spark):
    return spark.createDataFrame(RULES, "verdict string, host string, path string")


def test_against_brute_force(spark, rules):
    rows = [(i // 2, u, "clash", "clash") for i, u in enumerate(URLS)] + [(0, URLS[0], "a", "b")] * 7 + [(None, None, "a", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(3)
    out = [tuple(r) for r in url_filter.judge_urls(pages, rules).collect()]
    assert sorted(map(str, out)) == sorted(str((r[0], *brute(r[1]), r[1])) for r in rows)


def test_many_repeats_come_back(spark, rules, monkeypatch):
    monkeypatch.setattr(url_filter, "REPEATS", 10)
    pages = spark.range(0, 137, 1, 2).selectExpr("1L AS page_id", "'http://a.com/x' AS url")
    assert [r.verdict for r in url_filter.judge_urls(pages, rules).collect()] == ["block"] * 137


def test_empty_tables(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert url_filter.judge_urls(pages.limit(0), rules).collect() == []
    assert [(r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules.limit(0), "block").collect()] == [(None, "block")]


def test_no_python_on_rows(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    plan = url_filter.judge_urls(pages, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
