import math
import random
import subprocess
import sys

import pytest

from tabledger.functions.sizing import GIB
from tabledger.operators import pack


def first_fit(records, capacity, cap):
    """The rule, one table at a time."""
    chunks = []
    for size in sorted((s or 0 for _, s in records), reverse=True):
        for c in chunks:
            if (cap is None or len(c) < cap) and (capacity - sum(c) >= size or size == 0):
                c.append(size)
                break
        else:
            chunks.append([size])
    return [sorted(c) for c in chunks]


def packed(spark, data, capacity_gb, max_chunks):
    df = spark.createDataFrame(data, "batch_id string, migration_id string, size_in_bytes long")
    out = {}
    rows = pack.pack_chunks(df, capacity_gb, max_chunks).collect()
    assert sorted(r.migration_id for r in rows) == sorted(d[1] for d in data)
    for r in rows:
        out.setdefault(r.batch_id, {}).setdefault(r.chunk_id, []).append(r.size_in_bytes or 0)
    for chunks in out.values():
        assert sorted(chunks) == list(range(1, len(chunks) + 1))
    return {b: [sorted(c[i]) for i in sorted(c)] for b, c in out.items()}


@pytest.mark.parametrize("max_chunks", [None, 7, 60])
def test_same_groups_as_one_by_one(spark, max_chunks):
    rnd = random.Random(7)
    data = []
    for b in range(3):
        for i in range(150 + 50 * b):
            r = rnd.random()
            size = None if r < 0.1 else 0 if r < 0.25 else 7 * GIB if r < 0.6 else rnd.randint(1, 80 * GIB)
            data.append((f"b{b}", f"m{b}-{i}", size))
    got = packed(spark, data, 50.0, max_chunks)
    for b in range(3):
        own = [(m, s) for x, m, s in data if x == f"b{b}"]
        cap = math.ceil(len(own) / max_chunks) if max_chunks else None
        assert got[f"b{b}"] == first_fit(own, 50 * GIB, cap)


def test_edges(spark):
    assert packed(spark, [("b", "m1", 90 * GIB)], 50.0, None) == {"b": [[90 * GIB]]}
    assert packed(spark, [("b", f"m{i}", 0) for i in range(5)], 50.0, None) == {"b": [[0] * 5]}
    assert packed(spark, [("b", f"m{i}", None) for i in range(5)], 50.0, 2) == {"b": [[0] * 3, [0] * 2]}
    # 130 tiny tables over 8 groups: at most 17 in each
    got = packed(spark, [("b", f"m{i:03d}", 1) for i in range(130)], 50.0, 8)["b"]
    assert [len(c) for c in got] == [17] * 7 + [11]
    # a table over the capacity stands alone
    got = packed(spark, [("b", "big", 60 * GIB), ("b", "x", 1), ("b", "y", 1)], 50.0, None)["b"]
    assert got == [[60 * GIB], [1, 1]]
    df = spark.createDataFrame([], "batch_id string, migration_id string, size_in_bytes long")
    assert pack.pack_chunks(df).count() == 0


def test_tree_against_a_plain_list():
    rnd = random.Random(3)
    tree, plain = pack.RoomTree(), []
    for step in range(6000):
        if rnd.random() < 0.4:
            room = rnd.choice([0, rnd.randrange(1, 50), rnd.randrange(1, 1000)])
            tree.add(step, room)
            plain.append([step, room])
        size = rnd.randrange(1, 1000)
        at = tree.first(size)
        want = next((c for c in plain if c[1] >= size), None)
        assert (None if at < 0 else tree.ids[at]) == (want and want[0])
        if want:
            want[1] -= size if rnd.random() < 0.5 else want[1]
            tree.change(at, want[1])


def test_many_distinct_sizes_in_one_batch(spark):
    rnd = random.Random(5)
    data = [("b", f"m{i}", rnd.randrange(1, 60 * GIB)) for i in range(4000)]
    assert packed(spark, data, 50.0, None)["b"] == first_fit([(m, s) for _, m, s in data], 50 * GIB, None)


def test_invariants_hold_and_are_able_to_fail(spark):
    rnd = random.Random(9)
    sizes = [rnd.choice([None, 0, 5 * GIB, rnd.randrange(1, 60 * GIB)]) for _ in range(300)]
    df = spark.createDataFrame([("b", f"m{i}", s) for i, s in enumerate(sizes)], "batch_id string, migration_id string, size_in_bytes long")
    for chunks in (None, 20):
        good = pack.pack_invariants(pack.pack_chunks(df, 50.0, chunks), 50.0, chunks).first()
        assert (good.tables, good.dense, good.over_capacity, good.over_count, good.earlier_room) == (300, True, 0, 0, 0)
    schema = "batch_id string, migration_id string, size_in_bytes long, chunk_id int"
    check = lambda rows, **k: pack.pack_invariants(spark.createDataFrame([("b", str(i), s * GIB, c) for i, (s, c) in enumerate(rows)], schema), 50.0, **k).first()
    assert check([(30, 1), (10, 2)]).earlier_room == 1
    assert check([(30, 1), (30, 2), (10, 3)]).earlier_room == 2
    assert check([(20, 1), (20, 2), (20, 2)]).earlier_room == 1  # chunk 1 had room for a second one of its size
    assert check([(30, 1), (20, 1), (10, 2)]).earlier_room == 0
    assert check([(30, 1), (30, 1)]).over_capacity == 1 and check([(60, 1)]).over_capacity == 0
    assert not check([(30, 1), (30, 3)]).dense
    assert check([(1, 1), (1, 1), (1, 1)], max_chunks=3).over_count == 1


def test_no_job_before_the_result_is_asked_for(spark):
    df = spark.createDataFrame([("b", "m", 5), (None, "n", 6)], "batch_id string, migration_id string, size_in_bytes long")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    out = pack.pack_chunks(df, 50.0, 2)
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert sorted((str(r.batch_id), r.migration_id, r.chunk_id) for r in out.collect()) == [("None", "n", 1), ("b", "m", 1)]


def test_one_hot_size_is_split_by_many_tasks(spark):
    data = [("b", f"m{i:04d}", 5 * GIB) for i in range(3000)] + [("c", "m", 1)]
    got = packed(spark, data, 50.0, None)
    assert [len(c) for c in got["b"]] == [10] * 300


def test_executors_need_no_copy_of_the_package():
    from pyspark import cloudpickle

    load = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read()).__name__)"
    out = subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(pack.Batch), capture_output=True, cwd="/")
    assert out.stdout.decode().strip() == "Batch", out.stderr.decode()
