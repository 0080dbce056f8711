import numpy as np
import pytest
from pyspark.sql import functions as F

from tabledger.llm import toxicity

from .helpers import ODD, SF, has_tables, prose, table


def corpus(spark):
    texts = [prose(i, 60) + (f" fool {prose(i + 1, 5)} foreigners " if i % 4 == 0 else " fool " if i % 4 == 1 else " foreigners " if i % 4 == 2 else "") for i in range(400)]
    return table(spark, texts)


def test_learns_a_pair_that_neither_word_shows(spark):
    docs = corpus(spark)
    labelled = docs.withColumn("label", (F.col("doc_id") % 4 == 0).cast("int"))
    machine = toxicity.train(labelled.where("doc_id % 5 <> 0"))
    got = {r.doc_id: r.score for r in toxicity.scores(docs, machine).collect()}
    held = [i for i in got if i % 5 == 0]
    right = [(got[i] >= 0.5) == (i % 4 == 0) for i in held]
    assert np.mean(right) > 0.9


def test_odd_texts_and_columns(spark):
    docs = table(spark, ODD)
    for machine in (toxicity.fit([], np.zeros(0, int)), toxicity.fit([np.array([3], np.int32)] * 4, np.array([0, 1, 0, 1]))):
        out = toxicity.scores(docs, machine)
        assert out.columns == [*docs.columns, "score"]
        assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == len(ODD)
    assert toxicity.scores(docs.limit(0), machine).count() == 0
    assert toxicity.train(docs.withColumn("label", F.lit(None).cast("int"))).linear.size == 0


def test_a_text_travels_once(spark):
    docs = table(spark, ODD)
    machine = toxicity.fit([], np.zeros(0, int))
    plan = toxicity.scores(docs, machine)._jdf.queryExecution().analyzed().toString()
    assert "AS _text" not in plan
    other = toxicity.scores(docs.withColumn("text", F.col("text").cast("binary")), machine)
    assert other.columns == [*docs.columns, "score"] and other.count() == len(ODD)


def test_training_does_not_hold_all_terms_as_long_numbers():
    import tracemalloc

    rng = np.random.default_rng(1)
    sets = [rng.integers(0, toxicity.BUCKETS, 500).astype(np.int32) for _ in range(24_000)]
    labels = rng.integers(0, 2, len(sets))
    tracemalloc.start()
    toxicity.fit(sets, labels, passes=0)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * sum(s.nbytes for s in sets)


@pytest.mark.skipif(not has_tables, reason="no test tables")
def test_query(spark):
    from tabledger.llm.queries import op1_toxicity

    out = op1_toxicity(spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert out.where("predicted <> CAST(score >= 0.5 AS INT) OR score < 0 OR score > 1").count() == 0
    assert out.where("held_out <> (crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0)").count() == 0
