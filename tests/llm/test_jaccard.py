import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tabledger.llm import graph, jaccard

from .helpers import ODD, prose, table


def shingles(text):
    w = [x.encode().lower() for x in (text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if x]
    return frozenset(tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))) if w else frozenset()


def brute(texts):
    sets = defaultdict(list)
    for i, t in texts:
        sets[i].append(shingles(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return Counter((i, len(shingles(t)), None if i is None else find(i)) for i, t in texts)


def copies(seed, n, length=60):
    """Chains of near copies: each differs a little from the one before, so the ends do not link."""
    r, out, w = random.Random(seed), [], prose(seed, length, 5000).split(" ")
    for _ in range(n):
        out.append(" ".join(w))
        w = list(w)
        w[r.randrange(len(w))] = f"z{r.random()}"
    return out


@pytest.mark.parametrize("block,long", [(2048, 64), (8, 4)])
def test_against_brute_force(spark, monkeypatch, block, long):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
    monkeypatch.setattr(jaccard, "LONG_LIST", long)
    passage = prose(77, 40)
    texts = [t for s in range(4) for t in copies(s, 25)] + [prose(900 + i, 50) + " " + passage for i in range(30)]
    texts += [passage + f" {i}" for i in range(12)] + ["a b c", "A B C", "a b", "a b c d", "a\tb\nc"] + ODD + copies(50, 90, 30)
    random.Random(3).shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[0]), (0, texts[0]), (5, texts[5] + " more")]
    out = jaccard.near_groups(table(spark, rows, 4))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == brute(rows)


def test_empty_table(spark):
    assert jaccard.near_groups(table(spark, ["a"]).limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7), (3, 2)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def edited(seed, n, k):
    """A text of ``n`` distinct words and a copy with ``k`` words in its middle replaced."""
    w = [f"s{seed}w{i}" for i in range(n)]
    return " ".join(w), " ".join(w[: n // 2] + [f"s{seed}z{i}" for i in range(k)] + w[n // 2 + k :])


def test_other_thresholds_against_brute_force(spark):
    texts = [t for s in range(60) for t in edited(s, 60 + 7 * s, 1 + s % 13 + s // 6)]

    def five(t):
        w = t.split(" ")
        return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}

    sets = list(map(five, texts))
    same = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    linked = [s >= 0.8 for s in same]
    assert sum(0.8 <= s < 0.85 for s in same) >= 5 and not all(linked)
    out = {r.doc_id: r.component_id for r in jaccard.near_groups(table(spark, texts), gram=5, num=80, den=100).collect()}
    assert [out[2 * k] == out[2 * k + 1] for k in range(60)] == linked
    assert len({out[2 * k] for k in range(60)}) == 60


def test_order_of_the_index_is_counted_on_all_documents(spark):
    """A shingle of any two documents counts, in whatever part of the table these stand; those of one document come first."""
    phrase = " ".join(f"p{i}" for i in range(10))
    texts = [" ".join(f"d{i}w{j}" for j in range(20)) + " " + phrase for i in range(3)] + [f"x{i} y{i} z{i} v{i}" for i in range(500)] + ODD
    rows = table(spark, texts, 7).select("doc_id", "text")
    counts = jaccard.bucket_counts(rows)
    hashes = jaccard.shingle_sets(pa.array(texts))[1]
    assert counts.tolist() == np.bincount(jaccard.bucket_of(hashes), minlength=len(counts)).tolist()
    common = set(jaccard.shingle_sets(pa.array([phrase]))[1].view(np.int64).tolist())
    out = {r.doc_id: r for r in jaccard.marked(rows, counts).where("doc_id < 3").collect()}
    assert all(len(r.prefix) >= 4 and not common & set(r.prefix) for r in out.values())
    assert jaccard.bucket_counts(rows.limit(0)).sum() == 0
