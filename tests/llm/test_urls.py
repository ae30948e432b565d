import datetime as dt
import random

from quillspark.llm import urls as U

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2024, 1, 1)


def patterns(url):
    import re

    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*[^/?#:@.])", url or "")
    if not m:
        return []
    host = m[1].lower()
    labels = host.split(".")
    out = [".".join(labels[-k:]) for k in range(2, len(labels) + 1)] or [host]
    s = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", url)
    return out + ([f"{host}/{s[1]}"] if s else [])


def brute(captures, entries):
    out = []
    for page, url, at in captures:
        verdict = (False, None)
        for p in patterns(url):
            seen = [(since, blocked) for q, since, blocked in entries if q == p and since is not None and at is not None and since <= at]
            if seen:
                last = max(s for s, _ in seen)
                verdict = (any(b for s, b in seen if s == last), p)
        out.append((page, *verdict))
    return sorted(out, key=str)


def test_the_entry_active_at_fetch_time_decides(spark):
    r = random.Random(1)
    hosts = ["a.example.com", "b.example.com", "x.y.example.org", "example.com", "localhost", "HOT.example.net"]
    url = lambda: f"http://{r.choice(hosts)}{r.choice(['', ':80', '/'])}".rstrip("/") + r.choice(["", "/en", "/en/1?x=/q", "/de#t", "?q=1"])
    captures = [(i, url(), T0 + DAY * r.randint(0, 400) + dt.timedelta(seconds=r.randint(0, 3))) for i in range(400)]
    captures += [(500, None, T0), (501, "not a url", T0), (502, "http://a.example.com/en", None), (503, "http://user:pw@A.example.com./en", T0 + DAY * 50)] + [captures[0]] * 2
    names = ["a.example.com", "example.com", "b.example.com/en", "example.org", "localhost", "hot.example.net", "hot.example.net/en"]
    entries = [(r.choice(names), T0 + DAY * r.randint(-100, 420), r.random() < 0.5) for _ in range(60)]
    entries += [("a.example.com", entries[0][1], True), ("a.example.com", entries[0][1], False), (None, T0, True), ("example.com", None, True)]
    c = spark.createDataFrame([(*x, "old") for x in captures], "page_id long, url string, fetched timestamp, pattern string")
    e = spark.createDataFrame(entries, "pattern string, since timestamp, blocked boolean")
    got = sorted(((x["page_id"], x["blocked"], x["pattern"]) for x in U.decide(c, e).collect()), key=str)
    assert got == brute(captures, entries)


def test_intervals_and_empty_tables(spark):
    e = spark.createDataFrame([("p", T0, True), ("p", T0 + DAY, False)], "pattern string, since timestamp, blocked boolean")
    assert sorted(((x["since"], x["until"], x["blocked"]) for x in U.intervals(e).collect()), key=str) == [(T0, T0 + DAY, True), (T0 + DAY, None, False)]
    c = spark.createDataFrame([(1, "http://p.q/x", T0)], "page_id long, url string, fetched timestamp")
    assert [x["blocked"] for x in U.decide(c, e.limit(0)).collect()] == [False]
    assert U.decide(c.limit(0), e).count() == 0
