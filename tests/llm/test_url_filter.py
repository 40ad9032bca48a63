"""Dated list entries against captures, one by one."""

import random
from datetime import date, timedelta

from ratesmith.llm import url_filter

ENTRIES = "key string, action string, change string, day date"
START = date(2024, 1, 1)


def plain(captures, entries):
    """The verdict of every capture from all entries."""
    spans = []
    rows = {e for e in entries if e[0] is not None and e[3] is not None}
    for key, action in {(e[0], e[1]) for e in rows}:
        own = sorted((e[3], e[2] != "remove") for e in rows if e[:2] == (key, action))
        for at, (day, adds) in enumerate(own):
            end = own[at + 1][0] if at + 1 < len(own) else date.max
            if adds and end > day:
                spans.append((key, action, day, end))
    found = []
    for name, url, day in captures:
        host = url.split("://")[1].split("/")[0].split(":")[0].lower() if url and "://" in url else ""
        rest = url.split("://")[1].partition("/")[2].split("/")[0].split("?")[0] if host else ""
        keys = {host[i + 1:] for i, ch in enumerate(host) if ch == "."} | {host} if host else set()
        keys |= {f"{host}/{rest}"} if rest else set()
        hits = [(-len(k), a, k) for k, a, first, end in spans if k in keys and day and first <= day < end]
        best = min(hits, default=None)
        found.append((name, best[2] if best else None, best[1] if best else None, best is None or best[1] != "block"))
    return sorted(found, key=repr)


def judged(spark, captures, entries):
    frame = spark.createDataFrame(captures, "page_id long, url string, fetch_day date")
    rows = url_filter.judge(frame, spark.createDataFrame(entries, ENTRIES), "page_id").collect()
    return sorted(((r.page_id, r.matched_key, r.action, r.kept) for r in rows), key=repr)


def test_captures_and_entries(spark):
    draw = random.Random(6)
    hosts = ["a.org", "b.a.org", "c.net", "x.c.net", "d.com"]
    keys = [*hosts, "org", "a.org/p", "b.a.org/q", None]
    day = lambda: START + timedelta(draw.randrange(40))
    entries = [(draw.choice(keys), draw.choice(["allow", "block"]), draw.choice(["add", "add", "remove"]), day())
               for _ in range(60)] + [("d.com", "block", "add", None)]
    captures = [(i, f"http://{draw.choice(hosts).upper()}:80/{draw.choice('pqr')}/x?y", day()) for i in range(300)]
    captures += [(1000, None, START), (1001, "no url", START), (1002, "http://d.com", None), (1003, "", START),
                 (1000, "http://a.org/p", START), (None, "https://a.org/p", START + timedelta(20))]
    assert judged(spark, captures, entries) == plain(captures, entries)


def test_long_urls_and_empty_tables(spark):
    captures = [(1, "http://" + "a." * 300 + "org/" + "p" * 100_000, START), (2, "http://" + "/" * 1000, START)]
    assert [row[1] for row in judged(spark, captures, [("org", "block", "add", START)])] == ["org", None]
    assert judged(spark, captures, []) == [(1, None, None, True), (2, None, None, True)]
    assert judged(spark, [], [("org", "block", "add", START)]) == []


def test_columns_with_names_of_the_result(spark):
    frame = spark.createDataFrame(
        [("http://a.org/p", START, "h", "k", "s", 1, "a")],
        "url string, fetch_day date, host string, key string, segment string, keys int, action string")
    entries = spark.createDataFrame([("a.org", "block", "add", START)], ENTRIES)
    found = url_filter.judge(frame, entries, "url", "host", "key", "segment", "keys", "action")
    assert found.columns == ["url", "given_host", "key", "segment", "keys", "given_action", "host", "matched_key",
                             "action", "kept"]
    row = found.collect()[0]
    assert (row.given_host, row.key, row.segment, row["keys"], row.given_action) == ("h", "k", "s", 1, "a")
    assert (row.host, row.action, row.kept) == ("a.org", "block", False)
