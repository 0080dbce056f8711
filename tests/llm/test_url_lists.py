import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tabledger.llm import url_lists

RANK = {"remove": 0, "allow": 1, "block": 2}


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def test_patterns(spark):
    urls = ["https://u:p@WWW.A.Example.com:80/en/1?q#f", "http://example.com", "not a url", None, "ftp://localhost/x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r.p for r in df.select(url_lists.patterns_of(F.col("url")).alias("p")).collect()]
    assert got[0] == ["a.example.com/en", "a.example.com", "example.com"]
    assert got[1] == ["example.com"] and got[4] == ["localhost/x", "localhost"]
    assert not got[2] and not got[3]


def test_against_brute_force(spark):
    r = random.Random(5)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.net"]
    entries = [(r.choice([*hosts, "y.net/en"]), at(r.randrange(600)), r.choice([*RANK, "unknown"])) for _ in range(120)] + [(None, at(1), "block"), ("x.org", None, "block")]
    captures = [(i, f"http://{r.choice(hosts)}/{r.choice(['en', 'de'])}/{i}", at(r.randrange(700))) for i in range(200)]
    captures += [(1, None, at(5)), (2, "http://x.org/", None), (None, "http://x.org", at(400)), captures[0], captures[0]]
    e = spark.createDataFrame(entries, "pattern string, listed_at timestamp_ntz, action string").repartition(3)
    c = spark.createDataFrame([(*x, "more") for x in captures], "page_id bigint, url string, fetched_at timestamp_ntz, pattern string").repartition(4)

    def patterns(url):
        if not url:
            return []
        host, _, path = url.split("//")[1].partition("/")
        segment = path.split("/")[0]
        labels = host.split(".")
        return ([f"{host}/{segment}"] if segment else []) + [".".join(labels[i:]) for i in range(len(labels) - 1)]

    def held(pattern, t):
        best = max(((w, RANK[a]) for p, w, a in entries if p == pattern and w and t and a in RANK and w <= t), default=None)
        return best if best and best[1] else None

    want = Counter()
    for i, u, t in captures:
        hit = next(((p, *held(p, t)) for p in patterns(u) if held(p, t)), None)
        want[i, u, t, bool(hit and hit[2] == 2), hit and hit[0], hit and hit[1]] += 1
    out = url_lists.as_of(c, e)
    assert Counter((x.page_id, x.url, x.fetched_at, x.blocked, x.pattern, x.valid_from) for x in out.collect()) == want
    assert all(x.valid_to is None or x.valid_from <= x.fetched_at < x.valid_to for x in out.where("pattern IS NOT NULL").collect())
    assert url_lists.as_of(c, e.limit(0)).where("blocked").count() == 0
    assert url_lists.as_of(c.limit(0), e).count() == 0
