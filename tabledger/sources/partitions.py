"""Tables kept by partition: a change rewrites the partitions it touches, and no file of another one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_sum_sql
from .versions import path_exists

_FILE = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType()),
])


class PartitionedTable:
    """Parquet files below one folder, in a folder of their own for each value of the columns ``by``.

    Values of ``by`` may be null; an empty text there is stored as null. Two writers may change different partitions
    at a time. A partition is swapped by the driver when all tasks of the write are done; a task that is lost and
    tried again leaves nothing behind. There is no older version to go back to.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str]):
        self.spark, self.path, self.schema, self.by = spark, path.rstrip("/"), schema, tuple(by)

    def read(self, names: Sequence[tuple] | None = None) -> DataFrame:
        """All rows, or those of the partitions with these values; files of others are not opened."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.fieldNames())
        return rows if names is None else rows.where(self._among(names))

    def _among(self, names: Sequence[tuple]) -> Column:
        """Is a row in one of these partitions? Literals only, so that Spark prunes folders by it."""
        first, rest = F.col(self.by[0]), self.by[1:]
        if not rest:
            own = first.isin([n[0] for n in names if n[0] is not None])
            own = F.coalesce(own, F.lit(False))
            return own | first.isNull() if any(n[0] is None for n in names) else own
        same = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(self.by, n, strict=True)]) for n in names]
        return reduce(Column.__or__, same, F.lit(False))

    def names(self, partitions: DataFrame) -> list[tuple]:
        """Values of ``by`` in ``partitions``: one short tuple per partition is all that the driver sees."""
        return [tuple(r) for r in partitions.select(*self.by).distinct().toLocalIterator()]

    def overwrite(self, rows: DataFrame) -> None:
        """Replaces each partition that ``rows`` hold rows of; all in one job, however many partitions these are.

        Rows are dealt by partition, and Spark splits a partition that is too large for one task (a rebalance under
        adaptive execution), so one value of ``by`` may hold a third of all rows.
        """
        dealt = rows.select(*self.schema.fieldNames()).hint("rebalance", *[F.col(c) for c in self.by])
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.by).parquet(self.path)

    def update(self, build: Callable[[DataFrame], DataFrame], partitions: DataFrame) -> int:
        """Replaces the rows of the given partitions by ``build(their rows)`` and returns how many partitions that were.

        A partition that ``build`` leaves empty is removed. A row that it puts into any other partition fails the job
        before a file is replaced, as it would take the place of all rows there.
        """
        names = self.names(partitions)
        if not names:
            return 0
        before = self.files(names).select("path").withColumn("old", F.lit(True))
        before = {r.path for r in before.toLocalIterator()}  # names of files of the touched partitions
        text = F.concat(F.lit("row outside of the partitions to change: "), F.to_json(F.struct(*self.by)))
        self.overwrite(build(self.read(names)).where(F.when(self._among(names), True).otherwise(F.raise_error(text).cast("boolean"))))
        for left in {r.path for r in self.files(names).select("path").toLocalIterator()} & before:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(left)
            place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(place, False)
        return len(names)

    # -- files -------------------------------------------------------------------

    def files(self, names: Sequence[tuple] | None = None) -> DataFrame:
        """``by``, path, length, modificationTime of every file, from the listing alone."""
        own = [f for f in self.schema.fields if f.name in self.by]
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], T.StructType([*own, *_FILE.fields[:3]]))
        listing = (
            self.spark.read.schema(T.StructType([*_FILE.fields, *own])).format("binaryFile")
            .option("pathGlobFilter", "*.parquet").load(self.path).select(*self.by, "path", "length", "modificationTime")
        )
        return listing if names is None else listing.where(self._among(names))

    def marks(self) -> DataFrame:
        """``by``, files, bytes and a ``mark`` that changes with any file of the partition; no file is opened."""
        hashed = self.files().withColumn("h", F.xxhash64("path", "length", "modificationTime"))
        return hashed.groupBy(*self.by).agg(
            F.count("*").alias("files"), F.sum("length").alias("bytes"), F.expr(f"CAST({hash_sum_sql('h')} AS STRING)").alias("mark"))
