"""Checksums kept per partition: a second validation reads what changed and merges the rest.

A digest is the row count of one partition and exact sums over the hashes of its rows, so digests of disjoint sets of
rows add up to that of all of them. Each is stored with the mark of the files it was taken from.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_sum_sql, row_hash, row_sha256
from ..sources.checkpoints import checkpointed
from ..sources.partitions import PartitionedTable

WORDS = {"XXHASH64": 1, "SHA256": 4}


def digests(rows: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, algorithm: str = "XXHASH64") -> DataFrame:
    """``by``, ``row_count`` and ``sums`` (one exact number per word of the hash) of each partition.

    Rows are added up map-side, so a partition that holds most of them costs no more than others.
    """
    name = algorithm.upper()
    if name not in WORDS:
        raise ValueError(f"unknown checksum algorithm {algorithm}")
    words = [row_hash(rows, columns)] if name == "XXHASH64" else row_sha256(rows, columns)
    hashed = rows.select(*by, *[w.alias(f"_w{i}") for i, w in enumerate(words)])
    sums = [hash_sum_sql("_w0")] if name == "XXHASH64" else [f"CAST(coalesce(sum(_w{i}), 0) AS DECIMAL(38,0))" for i in range(4)]
    return hashed.groupBy(*by).agg(F.count("*").alias("row_count"), F.expr(f"array({', '.join(sums)})").alias("sums"))


def checksum_text(sums: Column) -> Column:
    """As ``compare.checksum`` writes it."""
    return F.array_join(F.transform(sums, lambda x: x.cast("string")), "-")


def merged(parts: DataFrame, algorithm: str = "XXHASH64") -> DataFrame:
    """One row from the digests of all partitions: ``row_count`` and ``checksum``, as over the whole table at once."""
    sums = F.array(*[F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)).cast("decimal(38,0)") for i in range(WORDS[algorithm.upper()])])
    return parts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), checksum_text(sums).alias("checksum"))


def refreshed(
    table: PartitionedTable, stored: DataFrame | None = None, columns: Sequence[str] | None = None, algorithm: str = "XXHASH64",
) -> DataFrame:
    """Digests of all partitions as they are now: ``by``, ``mark``, ``row_count``, ``sums``, ``reread``.

    ``stored`` is an earlier result of this function for the same columns and algorithm. Partitions whose files are the
    same keep their digest and are not read; those that are new or changed are read; those that are gone are left out.
    """
    by = list(table.by)
    now = checkpointed(table.marks().select(*by, "mark"))
    if stored is None:
        changed, kept = now, None
    else:
        n, s = now.alias("n"), stored.alias("s")
        same = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*by, "mark"]])
        changed = n.join(s, same, "left_anti")
        kept = s.join(n, same, "left_semi").select(*by, "mark", "row_count", "sums", F.lit(False).alias("reread"))
    taken = digests(table.read(table.names(changed)), by, columns, algorithm).alias("d")
    same = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"d.{c}")) for c in by])
    fresh = now.alias("n").join(taken, same).select(*[f"n.{c}" for c in by], "n.mark", "d.row_count", "d.sums", F.lit(True).alias("reread"))
    return fresh if kept is None else fresh.unionByName(kept)
