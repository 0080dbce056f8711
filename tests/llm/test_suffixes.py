import hashlib
import random

import numpy as np
import pytest

from tabledger.llm import queries, suffixes

from .helpers import ODD, prose, table


def brute(rows):
    least, out = {}, []
    key = lambda i: (i is None, i or 0)
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for s in range(len(b) - 49):
            w = b[s : s + 50]
            least[w] = min(least.get(w, key(i)), key(i))
    for i, b in raw:
        gone = [False] * len(b)
        end = 0
        for s in range(len(b) - 49):
            if least[b[s : s + 50]] < key(i):
                for x in range(max(s, end), s + 50):
                    gone[x] = True
                end = s + 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (x == 0 or not gone[x - 1]) for x, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    r = random.Random(4)
    texts = [prose(s, 60, 5000) for s in range(40)]
    for _ in range(60):  # passages of about the least length, at any place, next to other text
        t = r.choice(texts)
        n = r.randrange(40, 70)
        s = r.randrange(max(1, len(t) - n))
        texts.append(prose(r.random(), r.randrange(9), 9000) + t[s : s + n] + prose(r.random(), r.randrange(9), 9000))
    texts += [texts[3]] * 7 + [t.replace("w1", "v1", 2) for t in texts[:25]]
    common = prose("c", 25, 9000)
    texts += [prose(100 + s, 5, 9000) + common + prose(300 + s, 5, 9000) for s in range(70)]
    texts += ["ab" * 60, "ab" * 90, "ba" * 80, "x" * 49, "x" * 50, "x" * 51, "é" * 40, "z" + "é" * 30, "\0" * 60, "\0" * 70 + "q"]
    return texts


@pytest.mark.parametrize("sizes", [(256 << 10, 8 << 20, 16 << 20, 1 << 18), (3000, 1500, 2000, 50)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("SLICE_BYTES", "BUCKET_BYTES", "PART_BYTES", "WINDOWS_AT_ONCE"), sizes, strict=True):
        monkeypatch.setattr(suffixes, name, value)
    texts = corpus()
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, prose(7, 30, 10**6)), (None, prose(7, 30, 10**6)), (2, texts[2]), (2, texts[5] + "!"), (-9, texts[9])]
    rows += [(1000 + k, t if t is None or len(t) < 5000 else t[:3000]) for k, t in enumerate(ODD)]
    random.Random(2).shuffle(rows)
    out = queries.removed_bytes(suffixes.without_repeats(table(spark, rows, 4))).collect()
    assert sorted(map(tuple, out), key=repr) == brute(rows)


def test_very_long_texts(spark):
    a, b = prose(1, 150_000, 10**6), "word " * 100_000
    rows = [(1, a), (2, a[:40] + "#" + a[1000:900_000]), (3, b), (4, b), (5, "x" * 500_000)]
    out = {r.doc_id: r for r in suffixes.without_repeats(table(spark, rows), with_kept=True).collect()}
    assert [tuple(s) for s in out[2].spans] == [(41, out[2].n_bytes)] and bytes(out[2].kept).decode() == a[:40] + "#"
    assert out[3].spans == [] and out[5].spans == [] and [tuple(s) for s in out[4].spans] == [(0, 500_000)]


def test_leads_that_fill_many_buckets(spark, monkeypatch):
    """One phrase before ever other words: its eight leading bytes are on most splitters, and equal suffixes fall into different buckets."""
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 600)
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 500)
    r = random.Random(6)
    ends = [prose(f"e{k}", 6, 9000) for k in range(12)]
    rows = [(i, "the common beginning of all of these lines " + r.choice(ends) + f" {i}") for i in range(150)]
    out = queries.removed_bytes(suffixes.without_repeats(table(spark, rows, 4))).collect()
    assert sorted(map(tuple, out), key=repr) == brute(rows)


def test_multikey_sort():
    r = random.Random(1)
    text = "".join(r.choice("ab") for _ in range(30)) * 40 + "".join(r.choice("ab") for _ in range(500))
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.array(r.sample(range(len(data) - 60), 600))
    order, group = suffixes.multikey_sort(data, at)
    strings = [text[p : p + 50] for p in at[order]]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(strings, strings[1:], strict=False)] == [a == b for a, b in zip(group, group[1:], strict=False)]


def test_empty_table(spark):
    assert suffixes.without_repeats(table(spark, ["a"]).limit(0)).count() == 0
