import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabledger.operators import compare, digest_tree

from . import frames


def shuffled(df) -> int:
    """Rows that the shuffles of a finished query wrote."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("make", [lambda s: s.range(300_000).withColumn("v", F.col("id") * 3), lambda s: frames.wide(s, 60_000)])
def test_equal_tables_shuffle_no_row(spark, make):
    a = make(spark)
    n = a.count()
    for df in (compare.multiset_verdicts({"t": (a, a.repartition(4, "id"))}), compare.diff_rows(a, a), compare.lost_and_extra(a, a)):
        out = df.collect()
        assert [r.passed for r in out if "passed" in r] in ([], [True])
    verdict = compare.multiset_verdicts({"t": (a, a)})
    assert verdict.first().passed
    tasks = 16  # of both sides
    for df in (verdict, compare.diff_rows(a, a)):
        df.collect()
        assert shuffled(df) <= tasks * 3 * 4096 and shuffled(df) < 2 * n


def test_differing_tables_shuffle_rows_of_their_buckets(spark):
    a = spark.range(1_000_000).withColumn("v", F.col("id") * 3)
    b = a.withColumn("v", F.when(F.col("id") == 4711, 0).otherwise(F.col("v")))
    df = compare.diff_rows(a, b)
    assert sorted(map(tuple, df.collect())) == [(4711, 0, 0, 1), (4711, 14133, 1, 0)]
    assert shuffled(df) < 300_000


@pytest.mark.parametrize("levels", [(12, 20), (1, 2), (3, 20)])
def test_against_multisets(spark, monkeypatch, levels):
    monkeypatch.setattr(digest_tree, "LEVELS", levels)
    r = random.Random(8)
    a = [(r.randrange(40), r.choice(["x", None, "y"])) for _ in range(400)]
    b = a[:350] + [(r.randrange(60), "x") for _ in range(30)] + a[:20]
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string").repartition(5)
    s, t = Counter(a), Counter(b)
    want = sorted(((*k, s[k], t[k]) for k in s.keys() | t.keys() if s[k] != t[k]), key=repr)
    assert sorted(map(tuple, compare.diff_rows(frame(a), frame(b)).collect()), key=repr) == want
    v = compare.multiset_verdicts({"t": (frame(a), frame(b))}).first()
    assert (v.src_rows, v.tgt_rows, v.mismatches) == (len(a), len(b), len(want))


def test_swapped_values_and_one_empty_side(spark):
    # both columns keep their sets of values; only the pairing differs
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    b = spark.createDataFrame([(1, 20), (2, 10)], "k int, v int")
    assert compare.multiset_verdicts({"t": (a, b)}).first().mismatches == 4
    v = compare.multiset_verdicts({"t": (a, a.limit(0)), "u": (a.limit(0), a)}).collect()
    assert sorted((r.table_name, r.src_rows, r.tgt_rows, r.mismatches) for r in v) == [("t", 2, 0, 2), ("u", 0, 2, 2)]
