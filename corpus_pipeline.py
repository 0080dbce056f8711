"""From raw documents to packed sequences: five stages, each one of the document operators over all that is left.

A stage gets the documents its predecessor kept, as written and read again, and
returns documents with the same columns; the last one returns pieces. Rows
without an id are kept where a stage decides by groups of ids. Stages that run
Python have the session send it small batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabledger.llm import decontaminate, jaccard, packing, secrets, toxicity
from tabledger.llm.common import small, small_batches, table, written
from tabledger.llm.queries import toxicity_machine

ORACLE_SQL = None
# Near duplicates share at least 80 of 100 runs of five words. The contract of op9 (four words, 85 of 100) binds that query.
NEAR_GRAM, NEAR_NUM, NEAR_DEN = 5, 80, 100


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores below one half; the machine learns from the labels of the corpus."""
    small_batches(spark)
    scored = toxicity.scores(docs, toxicity_machine(spark, sf_dir), name="_toxicity")
    return scored.where(F.col("_toxicity") < 0.5).drop("_toxicity")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that of the smallest id (none comes last), and of texts that share
    it, the one with the smallest text hash. Each distinct pair of id and text is a document of its own (known by a
    64-bit hash), so unlike texts of one id are judged apart, and rows that repeat both are one document, of which one
    row stays. Documents without words stand alone, as often as they are there."""
    small_batches(spark)
    key, text_hash = F.xxhash64("doc_id", "text"), F.xxhash64("text")
    rows = docs.select(key.alias("_key"), "doc_id", "text")
    groups = jaccard.near_groups(rows.drop("doc_id"), "_key", gram=NEAR_GRAM, num=NEAR_NUM, den=NEAR_DEN).where("n_shingles > 0")
    groups = groups.groupBy(F.col("doc_id").alias("_key")).agg(F.min("component_id").alias("_of"))
    place = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", text_hash.alias("_hash"))
    order = rows.groupBy("_key").agg(F.min(place).alias("_order"), F.count("*").alias("_rows"))
    members = written(groups.join(order, "_key"), "members")
    first = members.groupBy("_of").agg(F.min(F.struct("_order", "_key")).alias("_first")).select(F.col("_first._key").alias("_key"))
    gone = members.join(first, "_key", "left_anti").select("_key", F.lit(False).alias("_again"))
    again = members.join(first, "_key", "left_semi").where("_rows > 1").select("_key", F.lit(True).alias("_again"))
    fates = written(gone.unionByName(again), "fates")
    names = docs.columns
    judged = docs.withColumn("_key", key).join(small(fates), "_key", "left")
    once = judged.where("_again IS NULL").select(*names)
    # repeats shrink to one row before they are shuffled
    return once.unionByName(judged.where("_again").dropDuplicates(["_key"]).select(*names))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row (and no whole shorter item) with the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced by a mark, and ``n_chars`` follows."""
    names = docs.columns
    found = secrets.with_spans(docs, docs, "text", name="_spans").withColumn(
        "text", F.when(F.col("text").isNotNull(), secrets.redacted(F.col("text"), F.col("_spans"))))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.size("_spans") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids (little-endian 32-bit numbers)."""
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", one_of_each_group), ("decontamination", decontaminated),
    ("secrets", without_secrets), ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
