import math
import random

import numpy as np
import pytest

from tabledger.llm import negatives, queries

from .helpers import SF, has_tables

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v double, rank int"


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, y, "x", 1.0, 7) for i, v, y in rows], SCHEMA).repartition(partitions)


def brute(rows, step=50, positives=5, most=3):
    one = {}
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = (y, [math.floor(256 * float(np.float32(x))) for x in v])
        one[i] = min(one.get(i, r), r)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, v) in one.items():
        if a % step:
            continue
        scored = sorted((-dot(v, w), i, y) for i, (y, w) in one.items() if i != a)
        for p, pid in [(-s, i) for s, i, y in scored if y == label][:positives]:
            band = [(-s, i) for s, i, y in scored if y != label and 50 * p <= -100 * s <= 95 * p][:most]
            out += [(a, pid, k, i, p, s) for k, (s, i) in enumerate(band, 1)]
    return sorted(out)


def made(seed, n, dims, labels, spread=1.0, base=0):
    r = random.Random(seed)
    centre = [r.uniform(0, spread) for _ in range(dims)]
    return [(base + i, [c + r.uniform(-spread, spread) for c in centre], r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("held", [(1024, 2048), (7, 2)])
def test_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(negatives, "ROWS_HELD", held[0])
    monkeypatch.setattr(negatives, "ANCHORS_HELD", held[1])
    rows = made(1, 260, 11, 3) + [(i, [0.25] * 11, i % 2) for i in range(400, 420)]  # ties
    rows += [(500, [0.5] * 11, 77), (501, None, 1), (502, [0.1, None] + [0.2] * 9, 1), (503, [float("nan")] * 11, 1), (None, [0.3] * 11, 1),
             (504, [float("inf")] + [0.0] * 10, 0), (505, [0.4] * 11, None), (550, [], 1), (551, [0.9, 0.9], 0), (600, [-0.1] * 11, 2)]
    rows += [rows[3], rows[3], (4, [0.7] * 11, 0)]  # repeated rows, and two rows of one id
    out = negatives.hard_negatives(frame(spark, rows), queries.F.col("id") % 50 == 0)
    assert sorted(map(tuple, out.collect())) == brute(rows)


def test_large_and_empty_vectors(spark):
    big = [(50 * i, [float(2**20 + i), float(-(2**19)), 3.0e5], i % 2) for i in range(12)]
    assert sorted(map(tuple, negatives.hard_negatives(frame(spark, big), queries.F.col("id") % 50 == 0).collect())) == brute(big)
    empty = [(50 * i, [], i % 2) for i in range(4)]
    assert sorted(map(tuple, negatives.hard_negatives(frame(spark, empty), queries.F.col("id") % 50 == 0).collect())) == brute(empty)
    assert negatives.hard_negatives(frame(spark, empty).limit(0), queries.F.col("id") % 50 == 0).count() == 0


def test_planes_and_tables():
    r = np.random.default_rng(3)
    v, w = r.integers(-700, 700, (40, 24)), r.integers(-700, 700, (9, 24))
    planes = negatives.planes_of(v, 11)
    assert (negatives.whole_of(planes) == v).all()
    for kind in (np.int32, np.int64):
        assert (negatives.scores(planes, w, kind) == w @ v.T).all()


@pytest.mark.skipif(not has_tables, reason="no tables")
def test_query_on_a_whole_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = queries.QUERIES["op11_negatives"](spark, SF).collect()
    assert sorted(map(tuple, out)) == brute(rows)
