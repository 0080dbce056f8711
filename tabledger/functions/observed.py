"""Row count and checksum of rows on their way to somewhere else, without a scan of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .hashing import hash_sum_sql, row_hash


def observed(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int | str]]]:
    """The same rows, and what returns ``row_count`` and ``checksum`` of them once an action has run on them.

    Both are gathered by the tasks of that action. A task that is tried again counts once. The checksum is that of
    ``compare.checksum`` over all columns; rows without any give 0 and "0".
    """
    seen, mark = Observation(), "_observed_hash"
    while mark in df.columns:
        mark += "_"
    # the hash is a column, so that it is computed once a row
    hashed = df.withColumn(mark, row_hash(df))
    metrics = [F.count(F.lit(1)).alias("row_count"), F.expr(f"CAST({hash_sum_sql(mark)} AS STRING)").alias("checksum")]
    return hashed.observe(seen, *metrics).drop(mark), lambda: {"row_count": 0, "checksum": "0"} | seen.get
