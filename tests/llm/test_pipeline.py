from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from .helpers import ODD, SF, has_tables, prose, table

pytestmark = pytest.mark.skipif(not has_tables, reason="no test tables")


def test_stages_keep_rows_and_columns(spark):
    import corpus_pipeline as cp

    copy = prose(1, 60)
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    texts = [(i, t) for i, t in enumerate([copy, copy, copy + " x", prose(2, 60), leak + " " + prose(3, 30), prose(4, 40) + " password=hunter22", *ODD])]
    texts += [(None, copy), (3, texts[3][1])]
    docs = table(spark, texts)
    seen = {}
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table(spark, ["a"]).columns, name
        seen[name] = Counter(r.doc_id for r in docs.collect())
    assert seen["near_duplicates"] == seen["toxicity"] - Counter([1, 2, 3, 14, None])
    assert seen["decontamination"] == seen["near_duplicates"] - Counter([4])
    assert seen["secrets"] == seen["decontamination"]
    assert docs.where("doc_id = 5").first().text.endswith(" [SECRET]")
    pieces = cp.STAGES[-1][1](spark, docs, SF)
    assert Counter(r.doc_id for r in pieces.where("opens").collect()) == seen["secrets"]
    assert cp.STAGES[1][1](spark, docs.limit(0), SF).count() == 0


def test_run(spark):
    import corpus_pipeline as cp

    out = cp.run(spark, SF)
    assert out.where(F.col("length") <= 0).count() == 0 and out.count() > 0


def test_python_gets_small_batches(spark):
    import corpus_pipeline as cp

    def most(batches):
        sizes = [0, *(b.nbytes for b in batches)]
        yield pa.record_batch([pa.array([max(sizes)])], names=["n"])

    key, texts = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(40).selectExpr("repeat('word ', 100000) AS text").coalesce(1)
    docs = table(spark, ["one"])
    try:
        for name in ("toxicity", "near_duplicates", "packing"):
            spark.conf.unset(key)
            dict(cp.STAGES)[name](spark, docs, SF)
            assert texts.mapInArrow(most, "n long").first().n < 8 << 20, name
        spark.conf.set(key, "1m")
        dict(cp.STAGES)["toxicity"](spark, docs, SF)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_near_duplicates_by_five_words_and_four_fifths(spark):
    import corpus_pipeline as cp

    a = [f"w{i}" for i in range(104)]
    near = a[:50] + [f"z{i}" for i in range(6)] + a[56:]  # 90 of 110 runs of five words, 92 of 110 of four
    far = a[:50] + [f"y{i}" for i in range(9)] + a[59:]  # 87 of 113 runs of five words
    docs = table(spark, [" ".join(a), " ".join(near), " ".join(far)])
    left = cp.one_of_each_group(spark, docs, SF)
    assert sorted(r.doc_id for r in left.collect()) == [0, 2]


def test_unlike_texts_of_one_id_are_judged_apart(spark):
    import corpus_pipeline as cp

    a, b, c = prose(1, 60, 5000), prose(2, 60, 5000), prose(3, 60, 5000)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " x"), (4, c), (5, c + " x"), (5, prose(4, 60, 5000)), (6, prose(5, 60, 5000)), (6, prose(6, 60, 5000))]
    left = cp.one_of_each_group(spark, table(spark, rows), SF)
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([rows[k] for k in (0, 1, 4, 6, 7, 8)])


def test_repeated_rows_and_rows_without_id_fold(spark):
    import corpus_pipeline as cp

    t, u = prose(1, 60, 5000), prose(2, 60, 5000)
    rows = [(1, t)] * 3 + [(None, t)] * 2 + [(2, t)] + [(None, u)] * 4 + [(None, u + " x"), (3, ""), (3, ""), (4, None), (4, None)]
    left = Counter((r.doc_id, r.text) for r in cp.one_of_each_group(spark, table(spark, rows), SF).collect())
    assert left.pop((None, u), 0) + left.pop((None, u + " x"), 0) == 1
    assert left == Counter({(1, t): 1, (3, ""): 2, (4, None): 2})
