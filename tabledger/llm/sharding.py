"""Shards of bounded size by extendible hashing, in DataFrame expressions only.

A document's hash is a string of bits; a shard is a prefix of it. The directory
begins at a few bits less than the average shard needs; a bucket that holds more
bytes than the limit, and only such a one, is split on its next bit. Bytes are
first summed per short prefix (a shuffle of sums), then the directory is found
from these sums alone. Rows whose bucket still overflows go on with more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written

BITS = 60
STEP = 6
HEAD = 3


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row, with its bytes and hash. Equal rows are counted and numbered, so that they differ in hash."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.md5(text.cast("binary")).alias("digest"))
    copies = rows.groupBy("doc_id", "n_bytes", "digest").agg(F.count("*").cast("int").alias("copies"))
    numbered = copies.select("doc_id", "n_bytes", "digest", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    name = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("copy").cast("string"))
    return numbered.withColumn("hash", F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long"))


def directory(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``doc_id``, ``n_bytes``, ``digest``, ``copy``, and its shard: ``shard`` (the prefix as bits, empty for a
    single shard), ``depth``, ``shard_bytes``, ``shard_docs``.

    No shard holds more than ``limit`` bytes of text, except that of one document which alone is larger. Null texts
    have no bytes; null ids hash as empty; equal rows are numbered by ``copy`` and may lie in different shards, so no
    key is too frequent to be split. An empty table gives no row; other columns are not read.
    """
    keys = written(_keys(docs, id_col, text_col), "shard-keys")
    total = keys.agg(F.sum("n_bytes").alias("b")).first()["b"] or 0
    start = max(0, math.ceil(math.log2(max(1.0, total / limit))) - HEAD)
    done, todo = None, keys
    while True:
        deep = min(BITS, start + HEAD + STEP)
        sums = todo.groupBy(F.shiftright("hash", BITS - deep).alias("fine")).agg(
            F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        spread = sums.select("fine", "b", "n", F.explode(F.sequence(F.lit(start), F.lit(deep))).alias("depth")).withColumn(
            "prefix", F.expr(f"shiftright(fine, {deep} - depth)"))
        buckets = spread.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        fits = buckets.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.lit(deep == BITS) & (F.col("depth") == deep)))
        chosen = spread.join(fits, ["depth", "prefix"]).groupBy("fine").agg(
            F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("at"))
        placed = todo.withColumn("fine", F.shiftright("hash", BITS - deep)).join(small(chosen), "fine", "left").drop("fine")
        placed = written(placed, "shard-map")
        here = placed.where("at IS NOT NULL").select(
            "doc_id", "n_bytes", "digest", "copy",
            F.when(F.col("at.depth") == 0, "").otherwise(F.expr("right(lpad(bin(at.prefix), 64, '0'), at.depth)")).alias("shard"),
            "at.depth", "at.shard_bytes", "at.shard_docs")
        done = here if done is None else done.unionByName(here)
        todo = placed.where("at IS NULL").drop("at")
        if deep == BITS or todo.isEmpty():
            return done
        start = deep + 1


def write_shards(docs: DataFrame, limit: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the rows of ``docs`` in folders named by their shard (``_`` for a single one)."""
    from pyspark.sql import Window

    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    own = docs.withColumn("_digest", digest)
    own = own.withColumn("_copy", F.row_number().over(Window.partitionBy(id_col, "_digest").orderBy(F.lit(1))))
    where = directory(docs, limit, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_d"), F.col("copy").alias("_c"), F.col("shard").alias("_shard"))
    same = own[id_col].eqNullSafe(where["_id"]) & (own["_digest"] == where["_d"]) & (own["_copy"] == where["_c"])
    placed = own.join(where, same).drop("_id", "_d", "_c", "_digest", "_copy")
    placed = placed.withColumn("shard", F.concat(F.lit("_"), "_shard")).drop("_shard")
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
