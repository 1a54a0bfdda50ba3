"""URL verdicts as of the fetch against a replay of the list."""

import datetime as dt
import random

from accessaudit.llm import urllists as u

DAY = dt.date(2024, 1, 1)


def parts(url):
    scheme, rest = url.split("://", 1)
    rest = rest.split("#")[0]
    cut = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
    host, path = rest[:cut].split("@")[-1].split(":")[0].lower().rstrip("."), rest[cut:]
    return host, f"{scheme.strip().lower()}://{host}{path.rstrip(' ')}"


def brute(captures, entries):
    out = []
    for page, url, fetched in captures:
        row = (page, url, fetched, None, None, None, None, False)
        if url and "://" in url and fetched is not None:
            host, key = parts(url)
            labels = host.split(".")
            asked = [("url", key), ("host", host)] + [("domain", ".".join(labels[i:])) for i in range(len(labels))]
            for kind, value in asked:
                mine = []
                for k, v, a, d in entries:
                    if k == kind and v and d and a in u.STRENGTH and d <= fetched:
                        v = parts(v)[1] if k == "url" and "://" in v else v.strip().lower().rstrip(".")
                        if v == value:
                            mine.append((d, u.STRENGTH[a], a))
                if mine and max(mine)[2] != "remove":
                    d, _, a = max(mine)
                    # the state's interval starts with the newest entry
                    row = (page, url, fetched, kind, value, d, a, a == "block")
                    break
        out.append(row)
    return out


def check(spark, captures, entries):
    c = spark.createDataFrame([(*x, 5) for x in captures], "page_id long, url string, fetched date, day int")
    e = spark.createDataFrame(entries, "kind string, value string, action string, dated date")
    got = [tuple(r) for r in u.judged(c, e).collect()]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted(got, key=key) == sorted(brute(captures, entries), key=key)
    return got


def test_replay(spark):
    rng = random.Random(3)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "other.org", "localhost", "X.Y.Other.org."]
    url = lambda: f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'me@'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}{rng.choice(['', '/', '/p?q=1', '/Q'])}{rng.choice(['', '#t'])}"
    day = lambda: DAY + dt.timedelta(rng.randrange(200))
    entries = []
    for _ in range(70):
        kind = rng.choice(["url", "host", "domain"])
        value = url() if kind == "url" else rng.choice(["Example.com", "b.example.com", "other.org.", " y.other.org", "com", "localhost"])
        entries.append((kind, value, rng.choice(["block", "allow", "remove"]), day()))
    entries += [entries[0], entries[1], ("host", None, "block", DAY), ("host", "example.com", "block", None), ("path", "x", "block", DAY), ("host", "example.com", "maybe", DAY), ("host", "", "block", DAY), (None, "x", None, DAY)]
    captures = [(i, url(), day()) for i in range(150)]
    captures += [captures[0], (None, url(), DAY), (500, None, DAY), (501, "", DAY), (502, "no url", DAY), (503, url(), None), (504, "http://", DAY)]
    got = check(spark, captures, entries)
    assert {r[6] for r in got} == {None, "block", "allow"}
    assert {r[3] for r in got} >= {"url", "host", "domain"}


def test_many_bins_and_no_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(u, "BIN", 2)
    monkeypatch.setattr(u, "hinted", lambda df: df)
    entries = [("host", "x.org", "block", DAY), ("host", "x.org", "remove", DAY + dt.timedelta(30)), ("domain", "x.org", "allow", DAY + dt.timedelta(9))]
    check(spark, [(i, "http://x.org/", DAY + dt.timedelta(i - 3)) for i in range(60)], entries)


def test_empty_tables(spark):
    check(spark, [], [("host", "x.org", "block", DAY)])
    check(spark, [(1, "http://x.org", DAY)], [])


def test_domains_of_one_label(spark):
    urls = ["http://a.b.com/", "http://localhost/", "http://x.org/", "http://com/"]
    entries = [("domain", v, "block", DAY) for v in ("com", "localhost")] + [("domain", "b.com", "allow", DAY)]
    got = check(spark, [(i, x, DAY) for i, x in enumerate(urls)], entries)
    assert sorted((r[0], r[4], r[7]) for r in got) == [(0, "b.com", False), (1, "localhost", True), (2, None, False), (3, "com", True)]
