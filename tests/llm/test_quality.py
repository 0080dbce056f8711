from pyspark.sql import functions as F

from tabledger.llm import quality

from .helpers import ODD, prose, table


def test_evidence_and_sites(spark):
    texts = [prose(i, 80) if i % 3 else "NOW!! " * 60 for i in range(300)]
    docs = table(spark, texts).withColumn("host", F.concat(F.lit("h"), F.col("doc_id") % 7)).withColumn("path", F.lit("p"))
    labels = docs.where("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 3 == 0, 0).otherwise(1).alias("label"))
    out = {r.doc_id: r for r in quality.posteriors(docs, labels).collect()}
    assert len(out) == 300
    assert sum((out[i].score >= 0.5) == bool(i % 3) for i in out) >= 295
    assert all(0 < r.score < 1 and 0 < r.path_mean < 1 for r in out.values())


def test_sites_shift_the_prior_and_sparse_ones_less(spark):
    """Without evidence, the score is the shrunk mean of the site, and a site of one row has its parent's."""
    texts = ["NOW!! " * 60 if i < 60 or i % 10 == 0 else prose(i, 80) for i in range(400)]
    host = F.when(F.col("doc_id") < 80, "bad").when(F.col("doc_id") == 399, "rare").otherwise("good")
    docs = table(spark, texts).withColumn("host", host).withColumn("path", F.concat("host", F.lit("/a")))
    labels = docs.select("doc_id", F.when((F.col("doc_id") < 60) | (F.col("doc_id") % 10 == 0), 0).otherwise(1).alias("label"))
    out = {r.doc_id: r for r in quality.posteriors(docs, labels).collect()}
    assert out[70].path_mean < out[399].path_mean < out[301].path_mean
    assert abs(out[399].host_mean - out[399].path_mean) < 1e-9


def test_odd_rows(spark):
    docs = table(spark, ODD + ["same", "same"]).withColumn("host", F.lit(None).cast("string")).withColumn("path", F.lit(None).cast("string"))
    none = spark.createDataFrame([], "doc_id bigint, label int")
    assert quality.posteriors(docs, none).where("score IS NOT NULL").count() == len(ODD) + 2
    assert quality.posteriors(docs.limit(0), none).count() == 0
