"""Which rows of two tables differ, found from digests of hash buckets.

Every row has a 128-bit hash. The rows of both sides fall into buckets by the
first bits of it, and a bucket has a digest that merges: the numbers of rows, and
the sums of three parts of their hashes, target rows counted off source rows.
Buckets whose digests come to zero hold the same rows and end there. The others
are split by further bits, and only rows of buckets that still differ are
compared one by one.

So a faithful copy shuffles digests, at most 4,096 for each task, and no row. A
differing one shuffles the hashes of the rows that share a bucket with a
difference. The lists of differing buckets that go to all tasks have 2^20 rows
of one number at most, whatever the tables hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import in_sample, row_hash_pair

# First bits of a hash that make the buckets of each level; 2^20 numbers can be sent to every task.
LEVELS = (12, 20)
_LOW = 0xFFFFFFFF


@dataclass(frozen=True)
class Comparison:
    """``totals`` has one row with src_rows and tgt_rows; ``differing`` h1, h2, src_count and tgt_count of the rows whose numbers of copies differ."""

    totals: DataFrame
    differing: DataFrame
    _open: tuple[DataFrame, ...]

    def near(self, rows: DataFrame) -> DataFrame:
        """Of rows with a column ``h1``, those in buckets that differ."""
        for bits, bucket in zip(LEVELS, self._open, strict=True):
            rows = _inside(rows, bits, bucket)
        return rows


def hashed(df: DataFrame, is_source: bool) -> DataFrame:
    """``h1``, ``h2`` of every row, computed once, in a projection of its own, and the side as ``sign``."""
    first, second = row_hash_pair(df)
    return df.select(first.alias("h1"), second.alias("h2")).withColumn("sign", F.lit(1 if is_source else -1).cast("bigint"))


def bucket_of(bits: int) -> Column:
    return F.shiftrightunsigned("h1", 64 - bits)


def _inside(rows: DataFrame, bits: int, buckets: DataFrame) -> DataFrame:
    # of proven size: a list of at most 2^20 numbers
    return rows.join(F.broadcast(buckets.select(F.col("bucket").alias("_bucket"))), bucket_of(bits) == F.col("_bucket"), "left_semi")


def digests(rows: DataFrame, bits: int) -> DataFrame:
    """Per bucket: rows of each side, and the parts of its digest; all zero if both sides hold the same rows."""
    sign = F.col("sign")
    low, high, other = F.col("h2").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned("h2", 32), F.col("h1").bitwiseAND(F.lit(_LOW))
    return rows.groupBy(bucket_of(bits).alias("bucket")).agg(
        F.count_if(sign > 0).alias("src_rows"), F.count_if(sign < 0).alias("tgt_rows"),
        F.sum(sign * low).alias("d1"), F.sum(sign * high).alias("d2"), F.sum(sign * other).alias("d3"),
    )


def _differing(level: DataFrame) -> DataFrame:
    return level.where("src_rows <> tgt_rows OR d1 <> 0 OR d2 <> 0 OR d3 <> 0").select("bucket")


def compared(source: DataFrame, target: DataFrame, sample_percent: int = 100) -> Comparison:
    """Both sides have the same columns and types. A sample keeps the same rows on both sides."""
    rows = hashed(source, True).unionAll(hashed(target, False))
    if sample_percent < 100:
        rows = rows.where(in_sample(F.col("h1"), sample_percent))
    top = digests(rows, LEVELS[0])
    totals = top.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("src_rows", "tgt_rows")])
    open_ = [_differing(top)]
    left = _inside(rows, LEVELS[0], open_[0])
    for bits in LEVELS[1:]:
        open_.append(_differing(digests(left, bits)))
        left = _inside(left, bits, open_[-1])
    each = left.groupBy("h1", "h2").agg(
        F.count_if(F.col("sign") > 0).alias("src_count"), F.count_if(F.col("sign") < 0).alias("tgt_count"))
    return Comparison(totals, each.where("src_count <> tgt_count"), tuple(open_))
