"""Mapping, exclusion and parameter inputs as rule rows.

Every layout ends in the same columns, so one expansion serves all. Rows that
break a rule of their layout are kept apart with the reason.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank_to_null, first_filled, list_literal
from .schemas import EXCLUSION_RULES, RULES, conform, empty


@dataclass
class MappingInput:
    """Rules, the rows that were refused, and document-wide exclusions."""

    rules: DataFrame
    rejects: DataFrame
    global_catalogs: list[str] = field(default_factory=list)
    global_schema_globs: list[str] = field(default_factory=list)
    global_table_globs: list[str] = field(default_factory=list)


# Cells beyond the last header, if any, and the line as it was read.
_MORE, _LINE = "_more", "_line"
_CSV = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}


def _cells(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*names, _MORE, _LINE)])


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with trimmed lower-case headers and ``seq`` in file order.

    Multi-line mode reads a file in one task, which keeps the order. Nothing is
    dropped: a short line has null cells, and what stands beyond the last header
    is kept apart, with the line itself.
    """
    names = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns
    places = [f"c{i}" for i in range(len(names))]  # headers may repeat
    raw = spark.read.schema(_cells(places)).options(**_CSV).csv(path, header=True, multiLine=True)
    # a line of exactly one cell too many is not kept by the reader: its cells are put together again
    cells = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in (*places, _MORE)])
    named = {p: c.strip().lower() for p, c in zip(places, names, strict=True)}
    return raw.withColumn(_LINE, F.coalesce(_LINE, cells)).withColumnsRenamed(named).withColumn("seq", F.monotonically_increasing_id())


def csv_lines(lines: DataFrame, header: str) -> DataFrame:
    """Cells of lines held in a table (``seq, line``; one record each), as :func:`_read_csv` gives those of a file."""
    names = [c.strip().lower() for c in header.split(",")]
    ddl = ", ".join(f"`{f.name}` string" for f in _cells(names).fields)
    parsed = lines.select("seq", "line", F.from_csv("line", ddl, _CSV).alias("_p"))
    return parsed.select("seq", *[F.col(f"_p.`{c}`") for c in (*names, _MORE)], F.col("line").alias(_LINE))


def _text(df: DataFrame, name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit(""))) if name in df.columns else F.lit("")


def _finish(rows: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    whole = F.when(F.col(_MORE).isNotNull(), "more cells than headers") if _MORE in rows.columns else F.lit(None)
    judged = rows.withColumn("reject_reason", F.coalesce(whole, reason))
    good = conform(judged.where(F.col("reject_reason").isNull()).drop("reject_reason"), RULES)
    return good.select(*RULES.fieldNames()), judged.where(F.col("reject_reason").isNotNull())


def read_mapping_csv(spark: SparkSession, path: str) -> MappingInput:
    """A mapping file in either layout, told apart by the ``clone_type`` header.

    A refused row keeps its cells, the line as it was read (``_line``) and the reason.
    """
    return mapping_rules(_read_csv(spark, path))


def mapping_rules(raw: DataFrame) -> MappingInput:
    """Rules and refused rows from the cells of a mapping file (:func:`csv_lines`), one row each."""
    typed = "clone_type" in raw.columns
    kind = first_filled(F.lower(_text(raw, "clone_type")), F.lit("table")) if typed else F.lit("table")
    rows = raw.select("seq", kind.alias("rule_type"), *[_text(raw, c).alias(c) for c in RULES.fieldNames()[2:8]],
                      *[list_literal(_text(raw, c)).alias(c) for c in ("exclude_schemas", "exclude_tables")],
                      *[c for c in (_MORE, _LINE) if c in raw.columns])
    is_catalog, is_schema, is_table = (F.col("rule_type") == k for k in ("catalog", "schema", "table"))

    def blank(name: str) -> Column:
        return F.col(name) == ""

    reason = (
        F.when(blank("source_catalog"), "missing source_catalog")
        .when(~(is_catalog | is_schema | is_table), "unknown clone_type")
        .when((is_schema | is_table) & blank("source_schema"), "missing source_schema")
        .when(is_table & blank("source_table"), "missing source_table")
    )
    none = F.array().cast("array<string>")
    rows = rows.withColumns({
        "exclude_schemas": F.when(is_catalog, F.col("exclude_schemas")).otherwise(none),
        "exclude_tables": F.when(is_table, none).otherwise(F.col("exclude_tables")),
        "target_catalog": first_filled(F.col("target_catalog"), F.col("source_catalog")),
        "target_schema": F.when(is_catalog, "").otherwise(first_filled(F.col("target_schema"), F.col("source_schema"))),
        "target_table": F.when(is_table, first_filled(F.col("target_table"), F.col("source_table"))).otherwise(""),
    })
    return MappingInput(*_finish(rows, reason))


_STRINGS = T.ArrayType(T.StringType())
_ENTRY = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "type", "source", "target", "source_catalog", "source_schema", "source_table",
        "target_catalog", "target_schema", "target_table")]
    + [T.StructField("exclude_schemas", _STRINGS), T.StructField("exclude_tables", _STRINGS)]
)
_ENTRIES = T.ArrayType(_ENTRY)
_DOCUMENT = T.StructType([T.StructField("migration", T.StructType([
    T.StructField("csv_path", T.StringType()),
    T.StructField("exclude", T.StructType([T.StructField(c, _STRINGS) for c in ("catalogs", "schemas", "tables")])),
    T.StructField("mappings", _ENTRIES),
    T.StructField("selection", T.StructType(
        [T.StructField("type", T.StringType())] + [T.StructField(c, _ENTRIES) for c in ("catalogs", "schemas", "tables")])),
]))])


def read_mapping_document(spark: SparkSession, path: str) -> MappingInput:
    """A structured mapping document (JSON), in its current or its older form.

    ``csv_path`` hands the selection over to a mapping file; a relative path is
    taken from the folder of the document.
    """
    doc = spark.read.schema(_DOCUMENT).json(path, multiLine=True).select("migration.*")
    head = doc.select("csv_path", "exclude").first()
    if head is not None and head.csv_path:
        target = head.csv_path
        if not target.startswith("/") and "://" not in target:
            target = os.path.join(os.path.dirname(path), target)
        return read_mapping_csv(spark, target)
    current = doc.where(F.size(F.coalesce("mappings", F.array().cast(_ENTRIES))) > 0).select(
        F.posexplode("mappings").alias("seq", "e")
    ).withColumn("kind", F.lower(F.coalesce("e.type", F.lit("schema"))))
    old_kind = F.lower(F.coalesce("selection.type", F.lit("schema")))
    entries = (
        F.when(old_kind == "catalog", F.col("selection.catalogs"))
        .when(old_kind == "schema", F.col("selection.schemas"))
        .when(old_kind == "table", F.col("selection.tables"))
    )
    older = doc.where(F.size(F.coalesce("mappings", F.array().cast(_ENTRIES))) == 0).select(
        F.posexplode(entries).alias("seq", "e"), old_kind.alias("kind")
    )
    rows = current.unionByName(older)
    blank = F.lit("")
    source_catalog = F.coalesce(F.when(F.col("kind") == "catalog", F.col("e.source")), F.col("e.source_catalog"), blank)
    target_catalog = F.coalesce(F.when(F.col("kind") == "catalog", F.col("e.target")), F.col("e.target_catalog"), source_catalog)
    none = F.array().cast("array<string>")
    is_table = F.col("kind") == "table"
    rows = rows.select(
        "seq", F.col("kind").alias("rule_type"),
        source_catalog.alias("source_catalog"),
        F.coalesce("e.source_schema", blank).alias("source_schema"),
        F.coalesce("e.source_table", blank).alias("source_table"),
        target_catalog.alias("target_catalog"),
        F.coalesce("e.target_schema", "e.source_schema", blank).alias("target_schema"),
        F.coalesce("e.target_table", "e.source_table", blank).alias("target_table"),
        F.when(is_table, none).otherwise(F.coalesce("e.exclude_schemas", none)).alias("exclude_schemas"),
        F.when(is_table, none).otherwise(F.coalesce("e.exclude_tables", none)).alias("exclude_tables"),
    )
    known = F.col("rule_type").isin("catalog", "schema", "table")
    reason = (
        F.when(~known, "unknown type")
        .when(F.col("source_catalog") == "", "missing source catalog")
        .when((F.col("rule_type") != "catalog") & (F.col("source_schema") == ""), "missing source_schema")
        .when((F.col("rule_type") == "table") & (F.col("source_table") == ""), "missing source_table")
    )
    good, rejects = _finish(rows, reason)
    excluded = (head.exclude if head is not None else None) or {}
    lists = excluded.asDict() if hasattr(excluded, "asDict") else {}
    return MappingInput(
        good, rejects, list(lists.get("catalogs") or []), list(lists.get("schemas") or []), list(lists.get("tables") or [])
    )


def read_exclusions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exclusion rules in file order; invalid rows are dropped, a blank path means no rules."""
    if not path or not path.strip():
        return empty(spark, EXCLUSION_RULES)
    return exclusion_rules(_read_csv(spark, path))[0]


def exclusion_rules(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exclusion rules, and the refused rows with the reason, from the cells of an exclusion file."""
    rows = raw.select(
        "seq", F.lower(_text(raw, "exclude_type")).alias("exclude_type"), _text(raw, "catalog").alias("catalog"),
        _text(raw, "schema").alias("schema_name"), _text(raw, "table").alias("table_name"),
        *[c for c in (_MORE, _LINE) if c in raw.columns],
    )
    kind = F.col("exclude_type")
    reason = (
        F.when(F.col(_MORE).isNotNull(), "more cells than headers")
        .when(~kind.isin("catalog", "schema", "table"), "unknown exclude_type")
        .when(F.col("catalog") == "", "missing catalog")
        .when((kind != "catalog") & (F.col("schema_name") == ""), "missing schema")
        .when((kind == "table") & (F.col("table_name") == ""), "missing table")
    )
    judged = rows.withColumn("reject_reason", reason)
    good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason", _MORE, _LINE)
    return good, judged.where(F.col("reject_reason").isNotNull())


def name_list(spark: SparkSession, text: str) -> DataFrame:
    """A parameter cell (JSON array or comma list) as rows ``seq, fqn``."""
    from ..functions.text import string_list

    return spark.range(1).select(F.posexplode(string_list(F.lit(text))).alias("seq", "fqn")).where(
        blank_to_null(F.col("fqn")).isNotNull()
    )
