import datetime as dt
import random
import re

from paceway.llm import urls

DAY0 = dt.date(2024, 1, 1)


def offers(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    host = m[1].rstrip(" .").lower() if m else ""
    if not host:
        return []
    path = re.match(r"[^:]*://[^/?#]*/?([^?#]*)", url)[1]
    labels, steps = host.split("."), path.split("/")
    keys = [("host", host)] + [("domain", ".".join(labels[-n:])) for n in range(1, len(labels) + 1)]
    return keys + [("prefix", host + "/" + "/".join(steps[:n])) for n in range(1, len(steps) + 1) if steps[n - 1]]


def brute(captures, entries):
    out = []
    for i, url, day in captures:
        rules = []
        for key in dict.fromkeys(offers(url)) if day else ():
            for name in ("blocked", "allowed"):
                events = sorted((d, a) for lst, kind, k, a, d in entries if (lst, kind, k) == (name, *key) and d and d <= day)
                if events and events[-1][1] == "add":
                    rules.append((urls.KINDS.index(key[0]), len(key[1]), name == "allowed", name, *key))
        best = max(rules) if rules else None
        out.append((i, len(rules), best and best[3], best and best[4], best and best[5], bool(best) and not best[2]))
    return out


def tables():
    rng = random.Random(12)
    hosts = ["a.example.com", "b.example.com", "example.org", "x.y.z.example.net", "hot.example.com"]
    paths = ["", "/", "/en", "/en/1?q=/x", "/en/2#a/b", "/fr/x/y", "//odd", "/en/"]
    url = lambda: "https://" + rng.choice(["", "me@"]) + rng.choice([*hosts, *["HOT.example.com."] * 6]) + rng.choice(["", ":80"]) + rng.choice(paths)
    captures = [(i, url(), DAY0 + dt.timedelta(rng.randrange(600))) for i in range(300)]
    captures += [(900, None, DAY0), (901, "not a url", DAY0), (902, url(), None), (903, "http://", DAY0), (904, "", DAY0)]
    entries = []
    for _ in range(160):
        h = rng.choice(hosts)
        kind, key = rng.choice([("host", h), ("domain", "example.com"), ("domain", "com"), ("domain", h), ("prefix", h + "/en"), ("prefix", h + "/fr/x"), ("host", "absent.example")])
        entries.append((rng.choice(["blocked", "allowed"]), kind, key, rng.choice(["add", "remove"]), DAY0 + dt.timedelta(rng.randrange(-400, 500))))
    entries += [("blocked", "host", "hot.example.com", a, DAY0 + dt.timedelta(d)) for d in range(0, 400, 2) for a in ("add", "remove")[: 1 + d % 4 // 2]]
    return captures, entries + [("blocked", "host", None, "add", DAY0), ("blocked", "host", "a.example.com", "add", None)]


def test_equals_brute_force(spark):
    captures, entries = tables()
    c = spark.createDataFrame([(*r, "e", 1) for r in captures], "page_id long, url string, fetched date, era string, row int").repartition(3)
    e = spark.createDataFrame(entries, "list string, kind string, key string, action string, day date")
    for era in (7, 90):
        got = [(r["id"], r["n_active"], r["rule_list"], r["rule_kind"], r["rule_key"], r["blocked"]) for r in urls.evaluate(c, e, era_days=era).collect()]
        assert sorted(got) == sorted(brute(captures, entries))
    assert any(r[5] for r in got) and any(r[2] == "allowed" for r in got)


def test_repeated_rows_and_empty(spark):
    c = spark.createDataFrame([(1, "http://a.b/", DAY0), (1, "http://a.b/", DAY0), (None, "http://a.b/", DAY0)], "page_id long, url string, fetched date")
    e = spark.createDataFrame([("blocked", "host", "a.b", "add", DAY0)] * 2, "list string, kind string, key string, action string, day date")
    assert [(r["n_active"], r["blocked"]) for r in urls.evaluate(c, e).collect()] == [(1, True)] * 3
    assert [r["blocked"] for r in urls.evaluate(c, e.where("false")).collect()] == [False] * 3
    assert urls.evaluate(c.where("false"), e).count() == 0
