"""Keyed writes as joins: the new snapshot of a ledger table is one DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CONTROL_KEY = ("source_catalog", "source_schema", "source_table", "batch_id")


def unique_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when two of them share a key.

    The window partitions by the join keys, so the join that follows needs no
    further shuffle.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    first = keys[0]
    text = F.concat_ws(".", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit("more than one change row for key "), text)
    checked = F.when(F.col("_copies") > 1, F.raise_error(message).cast(changes.schema[first].dataType)).otherwise(
        F.col(first)
    )
    return changes.withColumn("_copies", copies).withColumn(first, checked).drop("_copies")


def merge(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    matched: Mapping[str, Column],
    insert: Mapping[str, Column] | None = None,
    guard: Column | None = None,
) -> DataFrame:
    """New snapshot of ``current`` after an upsert.

    In ``matched``, ``insert`` and ``guard`` a change column ``x`` is written
    ``s.x`` and a current column ``t.x``. Rows whose guard is not true stay as
    they are. Without ``insert``, change rows that match nothing are ignored
    and the join keeps only the current side.
    """
    t = current.withColumn("_t", F.lit(True)).alias("t")
    s = unique_keys(changes, keys).withColumn("_s", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "left" if insert is None else "full")
    hit = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    out = []
    for field in current.schema.fields:
        name, dtype = field.name, field.dataType
        old = F.col(f"t.{name}")
        value = F.when(hit, matched[name].cast(dtype)).otherwise(old) if name in matched else old
        if insert is not None:
            new = insert.get(name, F.lit(None)).cast(dtype)
            value = F.when(F.col("t._t").isNull(), new).otherwise(value)
        out.append(value.alias(name))
    return joined.select(*out)


def update_where(current: DataFrame, guard: Column, values: Mapping[str, Column]) -> DataFrame:
    """New snapshot after an update that needs no other table: a projection, no shuffle."""
    hit = F.coalesce(guard, F.lit(False))
    return current.select(
        *[
            (F.when(hit, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)) if f.name in values else F.col(f.name)).alias(f.name)
            for f in current.schema.fields
        ]
    )
