"""Tables kept as whole versions, found through a manifest.

A version is written into its own folder and becomes visible when its manifest
row is appended, so readers always see complete versions, a failed or retried
write leaves nothing behind that counts, and any earlier version can be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.observed import observed

MANIFEST = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("operation", T.StringType()),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("source_version", T.LongType()),
    T.StructField("num_files", T.LongType()),
    T.StructField("size_in_bytes", T.LongType()),
    T.StructField("partition_columns", T.ArrayType(T.StringType())),
    T.StructField("schema_json", T.StringType()),
    T.StructField("location", T.StringType()),
])


class VersionTaken(RuntimeError):
    """Another writer is adding, or has added, the next version of this table."""


class MissingTable(LookupError):
    """No version of the table is on record."""


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _hadoop_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(p)] if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written aside, then renamed."""
    aside, fs = _hadoop_path(spark, f"{path}.tmp")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(aside, _hadoop_path(spark, path)[0]):
        raise OSError(f"cannot create {path}")


class VersionStore:
    """Versioned tables below one folder. A table is named by its dotted name."""

    def __init__(self, spark: SparkSession, root: str, data_format: str = "parquet"):
        self.spark, self.root, self.data_format = spark, root.rstrip("/"), data_format

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_manifest/rows"

    def manifest(self) -> DataFrame:
        """One row per version of every table."""
        if not path_exists(self.spark, self.manifest_path):
            return self.spark.createDataFrame([], MANIFEST)
        reader = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
        return reader.json(self.manifest_path)

    def latest_versions(self) -> DataFrame:
        """The newest version of every table."""
        fields = [F.col(c) for c in MANIFEST.fieldNames() if c not in ("table_name", "version")]
        return (
            self.manifest()
            .groupBy("table_name")
            .agg(F.max(F.struct("version", *fields)).alias("m"))
            .select("table_name", "m.*")
        )

    def latest(self, table: str) -> int | None:
        names = _names(self.spark, f"{self.manifest_path}/{table}")
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=None)

    def entry(self, table: str, version: int | None = None) -> SimpleNamespace | None:
        """Manifest row of one version (the newest by default), or None."""
        version = self.latest(table) if version is None else version
        path = f"{self.manifest_path}/{table}/{version}.json"
        if version is None or not path_exists(self.spark, path):
            return None
        return SimpleNamespace(**json.loads(_read_text(self.spark, path)))

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """One version of a table; the newest when no version is given."""
        row = self.entry(table, version)
        if row is None:
            raise MissingTable(f"TABLE_OR_VIEW_NOT_FOUND: {table} version {version}")
        schema = T.StructType.fromJson(json.loads(row.schema_json))
        data = self.spark.read.schema(schema).format(self.data_format).load(row.location)
        return data.select(*schema.fieldNames())

    def write(
        self,
        df: DataFrame,
        table: str,
        now: Column,
        operation: str = "WRITE",
        base: int | None = -1,
        partition_by: Sequence[str] = (),
        source_version: int | None = None,
        location: str | None = None,
    ) -> int:
        """Writes the next version and returns its number.

        ``base`` is the version the rows were built from (None for a new
        table); when another writer went first, :class:`VersionTaken` is raised
        and nothing is written. By default the newest version is replaced
        whatever it is. ``location`` puts the data below another folder.
        """
        newest = self.latest(table)
        if base == -1:
            base = newest
        if base != newest:
            raise VersionTaken(f"{table} is at version {newest}, not {base}")
        version = 0 if newest is None else newest + 1
        # a name of its own: what a writer that died left behind is never met again
        folder = f"{location or f'{self.root}/{table}'}/v={version}-{uuid.uuid4().hex[:8]}"
        claim, fs = _hadoop_path(self.spark, f"{self.root}/_claims/{table}/v={version}")
        try:
            # creating a file that must not exist is atomic, so one writer wins
            fs.create(claim, False).close()
        except Exception as e:
            raise VersionTaken(f"version {version} of {table} is being written") from e
        try:
            writer = df.write.mode("errorifexists").format(self.data_format)
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.save(folder)
            self._commit(df.schema, table, version, operation, now, source_version, folder, partition_by)
        except BaseException:
            fs.delete(claim, False)
            raise
        return version

    def _commit(self, schema, table, version, operation, now, source_version, folder, partition_by) -> None:
        files = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*.{self.data_format}").load(folder)
            .agg(F.count("*").alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_in_bytes"))
            .select("*", now.cast("timestamp_ntz").cast("string").alias("at"))
            .first()
        )
        row = {
            "table_name": table, "version": version, "operation": operation, "committed_at": files["at"].replace(" ", "T"),
            "source_version": source_version, "num_files": files["num_files"], "size_in_bytes": files["size_in_bytes"],
            "partition_columns": list(partition_by), "schema_json": schema.json(), "location": folder,
        }
        _write_text(self.spark, f"{self.manifest_path}/{table}/{version}.json", json.dumps(row))

    def release(self, table: str, version: int) -> None:
        """Gives up the claim of a writer that died before its version became visible."""
        claim, fs = _hadoop_path(self.spark, f"{self.root}/_claims/{table}/v={version}")
        fs.delete(claim, False)

    # -- many tables at once -----------------------------------------------------

    def details(self) -> DataFrame:
        """Size, files and version of the newest version of every table."""
        return self.latest_versions().select(
            F.col("table_name").alias("fqn"), F.lit(self.data_format.upper()).alias("format"),
            "size_in_bytes", "num_files", F.col("committed_at").alias("last_modified"),
            "version", "location", "partition_columns",
        )

    def count_rows(self, wanted: DataFrame) -> DataFrame:
        """Rows of the given versions (``table_name, version``; NULL means newest), NULL where files on record are not found.

        One scan over all version folders that reads no column: counts come
        from file footers, and schemas need not agree.
        """
        newest = self.latest_versions().select("table_name", F.col("version").alias("newest"))
        asked = wanted.select("table_name", F.col("version").cast("long").alias("version")).distinct()
        pinned = asked.join(newest, "table_name", "left").withColumn("pinned", F.coalesce("version", "newest"))
        known = self.manifest().select("table_name", F.col("version").alias("pinned"), "location", "num_files")
        # names of folders only: one short string per table
        found = pinned.join(known, ["table_name", "pinned"], "left")
        known_folders = (r.location for r in found.where("num_files > 0").select("location").distinct().toLocalIterator())
        folders = [f for f in known_folders if path_exists(self.spark, f)]
        if not folders:
            counted = self.spark.createDataFrame([], "location string, n bigint")
        else:
            scan = (
                self.spark.read.schema(T.StructType([])).format(self.data_format)
                .option("recursiveFileLookup", True).load(folders)
            )
            # names of files are encoded as in an address; one row per file is taken apart, not each row
            per_file = scan.select(F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
            file = F.regexp_replace(F.url_decode(F.replace("f", F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:/+", "/")
            place = F.regexp_extract(file, r"^(.*/v=\d+-[0-9a-f]+)/", 1)
            counted = per_file.groupBy(place.alias("location")).agg(F.sum("n").alias("n"))
        there = self.spark.createDataFrame([(f,) for f in folders], "location string").withColumn("there", F.lit(0).cast("bigint"))
        plain = F.regexp_replace("location", r"^[a-z0-9]+:/+", "/")
        out = found.join(there, "location", "left").withColumn("location", plain).join(counted, "location", "left")
        # files without rows are 0; files on record that are not found are unknown
        n = F.when(F.col("num_files") == 0, F.lit(0).cast("bigint")).otherwise(F.coalesce("n", "there"))
        return out.select("table_name", "version", F.when(F.col("location").isNotNull(), n).alias("row_count"))


def copy_table(
    source: VersionStore, target: VersionStore, source_table: str, target_table: str, now: Column,
    location: str | None = None,
) -> dict[str, int | str | None]:
    """Copies the newest version of a table as the next version of the target.

    The files are read and written by the same tasks, without a shuffle, and
    keep the partition columns of the source. The version that was read is on
    the manifest row of the copy. ``rows_copied`` and ``content_checksum`` are
    those of the rows that were read, gathered by the same tasks.
    """
    row = source.entry(source_table)
    if row is None:
        raise MissingTable(f"TABLE_OR_VIEW_NOT_FOUND: {source_table}")
    data, seen = observed(source.read(source_table, row.version))
    version = target.write(
        data, target_table, now, "CLONE", partition_by=row.partition_columns or (),
        source_version=row.version, location=location,
    )
    done = target.entry(target_table, version)
    return {
        "source_version": done.source_version, "target_version": version,
        "target_num_files": done.num_files, "target_size_bytes": done.size_in_bytes,
        "rows_copied": seen()["row_count"], "content_checksum": seen()["checksum"],
    }


