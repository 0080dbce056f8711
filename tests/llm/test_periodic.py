import hashlib
import random
import re
import zlib

import pytest

from tabledger.llm import periodic, queries

from .helpers import ODD, SF, has_tables, prose, table


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, w):
    if doc_id is None or not w or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def brute(w):
    """Every run, by trying all periods and keeping a stretch only under its smallest."""
    n, seen, out = len(w), set(), []
    for q in range(1, n // 4 + 1):
        x = 0
        while x < n - q:
            if w[x] != w[x + q]:
                x += 1
                continue
            s = x
            while x < n - q and w[x] == w[x + q]:
                x += 1
            if x - s + q >= max(6, 4 * q) and (s, x + q) not in seen:
                seen.add((s, x + q))
                out.append((s, x + q - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant):
    w = split(text)
    w = planted(doc_id, w) if plant else w
    runs = brute(w)
    gone = {x for s, length, q in runs for x in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def tricky():
    r = random.Random(5)
    few = [" ".join(r.choice("ab") for _ in range(r.randrange(1, 160))) for _ in range(150)]
    many = [" ".join(r.choice("abcde") for _ in range(60)) for _ in range(40)]
    blocks = []
    for _ in range(80):
        unit = [r.choice("abc") for _ in range(r.randrange(1, 25))]
        times = r.randrange(1, 9)
        body = unit * times + unit[: r.randrange(len(unit))]
        blocks.append(" ".join([r.choice("abcx") for _ in range(r.randrange(9))] + body + [r.choice("abcx") for _ in range(r.randrange(9))] + unit * 5))
    nested = " ".join((["a"] * 6 + ["b"]) * 6)
    euler = " ".join(list("aabbabab" * 3 + "abababba") * 5)
    edges = ["a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "a b c " * 4, "a b c " * 3 + "a b", "x " * 12 + "X x " * 8, "é é é é é é é", "a\tb\na\x0bb\ra b\x0ca b"]
    return few + many + blocks + [nested, euler] + edges + [prose(s, 900, 40) for s in range(4)]


@pytest.mark.parametrize("plant", [False, True])
def test_against_brute_force(spark, plant):
    texts = tricky() + [t if t is None or len(t) < 1000 else t[:900] for t in ODD]
    rows = list(enumerate(texts)) + [(None, "z " * 9), (3, texts[3]), (3, "b " * 7), (-4, texts[7])]
    out = queries.periodic_runs(periodic.scan(table(spark, rows), planted=plant)).collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(repr(expected(i, t, plant)) for i, t in rows)


def test_very_long_texts_and_many_equal_words(spark):
    texts = ["word " * 200_000, "x" * 1_000_000, "a b " * 50_000 + prose(1, 50_000), " ".join(f"v{i}" for i in range(100_000))]
    out = {r.doc_id: r for r in periodic.scan(table(spark, texts)).collect()}
    assert [tuple(x) for x in out[0].runs] == [(0, 200_000, 1)] and out[0].n_kept == 1
    assert out[1].runs == [] and out[1].n_words == 1
    assert tuple(out[2].runs[0]) == (0, 100_000, 2)
    assert out[3].runs == [] and out[3].n_kept == 100_000


def test_empty_table(spark):
    assert periodic.scan(table(spark, ["a"]).limit(0)).count() == 0


@pytest.mark.skipif(not has_tables, reason="no tables")
def test_query_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.QUERIES["op13_periodic"](spark, SF).collect()
    assert sorted(map(tuple, out)) == sorted(expected(i, t, True) for i, t in docs)

