"""What tables exist and how large they are."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_listing(spark: SparkSession, schemas: Sequence[str] | None = None) -> DataFrame:
    """Tables of the session catalog in information-schema shape; temporary tables are left out."""
    catalog = spark.catalog.currentCatalog()
    names = list(schemas) if schemas is not None else [s.name for s in spark.catalog.listDatabases()]
    rows = [
        (catalog, name, t.name, (t.tableType or "").upper())
        for name in names
        for t in spark.catalog.listTables(name)
        if not t.isTemporary
    ]
    return spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, table_type string")


def table_detail(spark: SparkSession, root: str) -> DataFrame:
    """Files, bytes and last change per table below a folder.

    Only file names, lengths and times are read, never their content. The first
    name below the folder is the table.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )
    below = re.escape(root.rstrip("/").split("://")[-1])
    name = F.regexp_extract("path", rf"{below}/([^/]+)", 1)
    return files.groupBy(F.regexp_replace(name, r"\.parquet$", "").alias("table_name")).agg(
        F.count("*").alias("num_files"),
        F.sum("length").alias("size_in_bytes"),
        F.max("modificationTime").alias("last_modified"),
    )
