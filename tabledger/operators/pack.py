"""Grouping tables into size-bounded chunks, largest first, first fit.

First fit looks at every earlier table of the batch, so its core is
sequential. It is kept small: equal sizes are one run, and the runs of a batch
are read once, in falling order of size, as a stream. Behind it stands a tree
of the room left in the chunks, which finds the first chunk with enough room in
a number of steps that grows with the logarithm of the open chunks; full ones
are dropped. Only stretches of runs come out; giving every table of a run its
number, and its chunk, is distributed. Nothing runs before the result is asked
for.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sizing import GIB

# The placing function travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANK_BUCKETS = 64
RANKS_PER_PIECE = 10_000
ROWS_OUT = 10_000

_PLACED = "batch_id string, size bigint, first_rank bigint, last_rank bigint, chunk_id bigint"


def count_caps(records: DataFrame, max_chunks: int | None) -> DataFrame:
    """Per batch: number of tables and the cap ceil(tables / max_chunks), NULL without a maximum."""
    return _caps(records.groupBy("batch_id"), F.count("*"), max_chunks).withColumnRenamed("total", "n")


def _caps(grouped: GroupedData, total: Column, max_chunks: int | None) -> DataFrame:
    cap = F.ceil(total / F.lit(max_chunks)) if max_chunks and max_chunks > 0 else F.lit(None)
    return grouped.agg(total.alias("total"), cap.cast("bigint").alias("count_cap"))


class RoomTree:
    """Chunks in the order of their ids, each with the room it has left; every inner node holds the most room below it."""

    def __init__(self):
        self.ids: list[int] = []
        self.width = 1
        self.most = [0, 0]

    def first(self, size: int) -> int:
        """Place of the first chunk with room for ``size``, or -1."""
        if self.most[1] < size:
            return -1
        node = 1
        while node < self.width:
            node *= 2
            if self.most[node] < size:
                node += 1
        return node - self.width

    def room(self, place: int) -> int:
        return self.most[self.width + place]

    def change(self, place: int, room: int) -> None:
        node = self.width + place
        self.most[node] = room
        while node > 1:
            node //= 2
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])

    def add(self, chunk_id: int, room: int) -> None:
        """One more chunk behind the others; a full one is left out."""
        if room <= 0:
            return
        if len(self.ids) == self.width:
            self._rebuild()
        self.ids.append(chunk_id)
        self.change(len(self.ids) - 1, room)

    def _rebuild(self) -> None:
        """Without the chunks that are full, and with as many free places as chunks."""
        kept = [(i, r) for i, r in zip(self.ids, self.most[self.width :], strict=False) if r > 0]
        self.ids = [i for i, _ in kept]
        self.width = 1 << len(kept).bit_length()
        self.most = [0] * self.width + [r for _, r in kept] + [0] * (self.width - len(kept))
        for node in range(self.width - 1, 0, -1):
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])


class Batch:
    """First fit of the runs of one batch, which come in falling order of size."""

    def __init__(self, capacity: int, cap: int | None):
        self.capacity, self.cap = capacity, cap
        self.tree = RoomTree()
        self.tables: list[int] = []  # of every chunk; ids are places plus 1

    def run(self, size: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(first rank, last rank, chunk) of every stretch of a run of ``n`` tables."""
        rank = 0
        for chunk, most in self._zero_room(n) if size == 0 else self._room(size):
            take = min(most, n - rank)
            self._put(chunk, take, size)
            yield rank, rank + take - 1, chunk
            rank += take
            if rank == n:
                return
        per_chunk = n if size == 0 else max(1, self.capacity // size)
        per_chunk = per_chunk if self.cap is None else min(per_chunk, self.cap)
        while rank < n:
            take = min(per_chunk, n - rank)
            self.tables.append(take)
            full = self.cap is not None and take >= self.cap
            self.tree.add(len(self.tables), 0 if full else self.capacity - take * size)
            yield rank, rank + take - 1, len(self.tables)
            rank += take

    def _room(self, size: int) -> Iterator[tuple[int, int]]:
        while (place := self.tree.first(size)) >= 0:
            self.place = place
            chunk = self.tree.ids[place]
            fit = self.tree.room(place) // size
            yield chunk, fit if self.cap is None else min(fit, self.cap - self.tables[chunk - 1])

    def _zero_room(self, n: int) -> Iterator[tuple[int, int]]:
        """Tables without a size fit wherever the number of tables allows it; they come last."""
        for at, tables in enumerate(self.tables):
            free = n if self.cap is None else self.cap - tables
            if free > 0:
                yield at + 1, free

    def _put(self, chunk: int, take: int, size: int) -> None:
        self.tables[chunk - 1] += take
        if size:
            full = self.cap is not None and self.tables[chunk - 1] >= self.cap
            self.tree.change(self.place, 0 if full else self.tree.room(self.place) - take * size)


def _stretches(runs: DataFrame, capacity: int) -> DataFrame:
    """Chunk per stretch of every run. One task reads a batch as a stream and holds its open chunks only."""

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fields = ["batch_id", "size", "first_rank", "last_rank", "chunk_id"]
        name, batch, out = None, None, []
        for frame in frames:
            for batch_id, size, n, cap in zip(*(frame[c].tolist() for c in ("batch_id", "size", "n", "count_cap")), strict=True):
                if batch is None or batch_id != name:
                    name, batch = batch_id, Batch(capacity, None if pd.isna(cap) else int(cap))
                out += [(batch_id, size, *stretch) for stretch in batch.run(size, n)]
                if len(out) >= ROWS_OUT:
                    yield pd.DataFrame(out, columns=fields)
                    out = []
        if out:
            yield pd.DataFrame(out, columns=fields)

    ordered = runs.repartition("batch_id").sortWithinPartitions("batch_id", F.desc("size"))
    return ordered.mapInPandas(place, _PLACED)


def run_ranks(rows: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) among the tables of one batch and size.

    Each run is split by a hash of the id, so a run that holds a third of all
    tables is still numbered by many tasks. The part is one text, which no
    earlier partitioning by batch and size can stand in for.
    """
    bucket = F.pmod(F.xxhash64("migration_id"), F.lit(RANK_BUCKETS)).cast("int")
    rows = rows.withColumn("bucket", bucket).withColumn("part", F.concat_ws("|", "batch_key", "size", "bucket"))
    counts = rows.groupBy("part", "batch_key", "size", "bucket").agg(F.count("*").alias("c"))
    before = Window.partitionBy("batch_key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0))).select("part", "offset")
    inside = Window.partitionBy("part").orderBy("migration_id")
    return (
        rows.withColumn("rn", F.row_number().over(inside))
        .join(offsets, "part")
        .withColumn("rank", F.col("offset") + F.col("rn") - 1)
        .drop("part", "bucket", "offset", "rn")
    )


def _batch_key() -> Column:
    """A batch as a text that is never null, so that rows without one meet as well."""
    return F.coalesce(F.concat(F.lit("b"), "batch_id"), F.lit("")).alias("batch_key")


def pack_chunks(records: DataFrame, capacity_gb: float = 50.0, max_chunks: int | None = None) -> DataFrame:
    """``batch_id, migration_id, size_in_bytes, chunk_id`` for every record.

    A chunk holds at most ``capacity_gb``; a larger table stands alone. Tables
    without a size fit anywhere. With ``max_chunks`` a chunk holds at most
    ceil(tables of the batch / max_chunks) tables. Ids start at 1 per batch.
    """
    rows = records.select(
        _batch_key(), "batch_id", "migration_id", "size_in_bytes",
        F.coalesce("size_in_bytes", F.lit(0)).cast("bigint").alias("size"),
    )
    runs = rows.groupBy("batch_id", "size").agg(F.count("*").alias("n"))
    caps = _caps(runs.groupBy("batch_id"), F.sum("n"), max_chunks).drop("total")
    capped = runs.join(caps.withColumnRenamed("batch_id", "b"), F.col("batch_id").eqNullSafe(F.col("b"))).drop("b")
    # one row per table of a stretch, met by its number in its run
    numbered = (
        _stretches(capped, int(capacity_gb * GIB))
        .withColumn("piece", F.explode(F.sequence("first_rank", "last_rank", F.lit(RANKS_PER_PIECE).cast("bigint"))))
        .withColumn("rank", F.explode(F.sequence("piece", F.least(F.col("piece") + RANKS_PER_PIECE - 1, F.col("last_rank")))))
        .select(_batch_key(), "size", "rank", F.col("chunk_id").cast("int").alias("chunk_id"))
    )
    placed = run_ranks(rows).join(numbered, ["batch_key", "size", "rank"])
    return placed.select("batch_id", "migration_id", "size_in_bytes", "chunk_id")


def chunk_summary(rows: DataFrame) -> DataFrame:
    """Tables and bytes per existing chunk of each batch; rows without a chunk are left out."""
    return (
        rows.where(F.coalesce("chunk_id", F.lit(0)) != 0)
        .groupBy("batch_id", "chunk_id")
        .agg(F.count("*").alias("tables"), F.sum("size_in_bytes").alias("total_bytes"))
    )


def pack_invariants(packed: DataFrame, capacity_gb: float = 50.0, max_chunks: int | None = None) -> DataFrame:
    """What first fit promises, counted per batch of a result of :func:`pack_chunks`.

    ``tables``, ``chunks``, ``dense`` (ids run from 1 without a gap), ``over_capacity`` (chunks of several measured
    tables beyond the capacity), ``over_count`` (chunks beyond the cap on tables) and ``earlier_room`` (chunks that had
    room for the first table of a later chunk when that was opened). No pair of chunks is formed: each stretch of a
    chunk's life looks up the next smaller opening table.
    """
    capacity = int(capacity_gb * GIB)
    rows = packed.select("batch_id", "chunk_id", F.coalesce("size_in_bytes", F.lit(0)).cast("bigint").alias("size"))
    caps = _caps(rows.groupBy("batch_id"), F.count("*"), max_chunks)
    chunks = rows.groupBy("batch_id", "chunk_id").agg(
        F.count("*").alias("n"), F.sum("size").alias("used"), F.count_if(F.col("size") > 0).alias("measured"), F.max("size").alias("opener"))
    known = chunks.join(caps.withColumnRenamed("batch_id", "b"), F.col("batch_id").eqNullSafe(F.col("b"))).drop("b")
    over = F.count_if((F.col("used") > capacity) & (F.col("measured") > 1)), F.count_if(F.col("n") > F.col("count_cap"))
    counted = known.groupBy("batch_id").agg(
        F.sum("n").alias("tables"), F.count("*").alias("chunks"),
        ((F.min("chunk_id") == 1) & (F.max("chunk_id") == F.count("*"))).alias("dense"), over[0].alias("over_capacity"), over[1].alias("over_count"))
    # Room of a chunk while tables of sizes in (next_size, size] are placed: the capacity less its tables of that size and above.
    life = Window.partitionBy("batch_id", "chunk_id").orderBy(F.desc("size"))
    stages = rows.where("size > 0").groupBy("batch_id", "chunk_id", "size").agg(F.count("*").alias("k")).select(
        "batch_id", "chunk_id", "size", F.lead("size", 1, 0).over(life).alias("next_size"),
        F.sum(F.col("size") * F.col("k")).over(life).alias("filled"), F.sum("k").over(life).alias("held"))
    stages = stages.join(known.select("batch_id", "chunk_id", "opener", "count_cap").withColumnsRenamed({"batch_id": "b", "chunk_id": "c"}),
                         F.col("batch_id").eqNullSafe(F.col("b")) & (F.col("chunk_id") == F.col("c"))).drop("b", "c")
    free = (F.col("count_cap").isNull() | (F.col("held") < F.col("count_cap"))) & (F.col("filled") < capacity)
    top = F.least("size", F.lit(capacity) - F.col("filled"), F.when(F.col("size") == F.col("opener"), F.col("size") - 1))
    points = stages.where(free).select("batch_id", top.alias("v"), F.col("next_size").alias("low"), "chunk_id", F.lit(None).cast("bigint").alias("opens"))
    openers = chunks.where("opener > 0").select("batch_id", F.col("opener").alias("v"), F.lit(None).cast("bigint").alias("low"), "chunk_id", F.col("opener").alias("opens"))
    by_size = Window.partitionBy("batch_id").orderBy("v", F.col("opens").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    below = points.unionByName(openers).withColumn("next_opener", F.last("opens", ignorenulls=True).over(by_size))
    late = below.where(F.col("low").isNotNull() & (F.col("next_opener") > F.col("low"))).select("batch_id", "chunk_id")
    # chunks opened by tables of one size, with room for one more
    same = Window.partitionBy("batch_id", "opener")
    first = stages.where(free & (F.col("size") == F.col("opener"))).withColumn("fits", F.col("filled") + F.col("size") <= capacity)
    last = chunks.withColumn("last_chunk", F.max("chunk_id").over(same)).select(F.col("batch_id").alias("b"), F.col("chunk_id").alias("c"), "last_chunk")
    twins = first.join(last, F.col("batch_id").eqNullSafe(F.col("b")) & (F.col("chunk_id") == F.col("c"))).where(
        F.col("fits") & (F.col("last_chunk") > F.col("chunk_id"))).select("batch_id", "chunk_id")
    broken = late.unionByName(twins).distinct().groupBy(F.col("batch_id").alias("b")).agg(F.count("*").alias("earlier_room"))
    return counted.join(broken, F.col("batch_id").eqNullSafe(F.col("b")), "left").drop("b").na.fill(0, ["earlier_room"])
