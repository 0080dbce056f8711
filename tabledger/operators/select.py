"""From mapping rules and a table listing to the list of tables to copy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_filled, fqn_part, fqn_size, glob_match, regex_full_match, rule_text
from . import glob_index

# Schemas never expanded, and the table types that can be copied.
SYSTEM_SCHEMAS = ("information_schema",)
COPYABLE_TYPES = ("MANAGED", "EXTERNAL")

MAPPING = (
    "source_catalog", "source_schema", "source_table", "target_catalog", "target_schema", "target_table",
)


def parameter_rules(
    names: DataFrame, kind: str, target_catalog: str = "", target_schema: str = ""
) -> DataFrame:
    """Rules from a list of names in column ``fqn``; names with the wrong number of parts are dropped.

    ``kind`` is table (three parts), schema (two) or catalog (one).
    """
    parts = {"table": 3, "schema": 2, "catalog": 1}[kind]
    name = F.trim("fqn")
    catalog, schema, table = (fqn_part(name, i) for i in range(3))
    blank = F.lit("").cast("string")
    tgt_schema = first_filled(F.lit(target_schema), schema) if kind == "schema" else schema
    empty_list = F.array().cast("array<string>")
    return names.where((name != "") & (fqn_size(name) == parts)).select(
        "seq",
        F.lit(kind).alias("rule_type"),
        catalog.alias("source_catalog"),
        F.coalesce(schema, blank).alias("source_schema"),
        F.coalesce(table, blank).alias("source_table"),
        first_filled(F.lit(target_catalog), catalog).alias("target_catalog"),
        F.coalesce(tgt_schema, blank).alias("target_schema"),
        F.coalesce(table, blank).alias("target_table"),
        empty_list.alias("exclude_schemas"),
        empty_list.alias("exclude_tables"),
    )


def copyable(
    listing: DataFrame,
    types: Sequence[str] | None = COPYABLE_TYPES,
    exclude_regexes: Sequence[str] = (),
) -> DataFrame:
    """Listing rows that can be copied: by table type and by whole-name patterns."""
    out = listing
    if types is not None:
        out = out.where(F.upper("table_type").isin(*[t.upper() for t in types]))
    for pattern in exclude_regexes:
        out = out.where(~regex_full_match(F.col("table_name"), pattern))
    return out


def _none_match(value: Column, globs: Sequence[str]) -> Column:
    return reduce(lambda acc, g: acc & ~glob_match(value, F.lit(g)), globs, F.lit(True))


def expand_rules(
    rules: DataFrame,
    listing: DataFrame,
    system_schemas: Sequence[str] = SYSTEM_SCHEMAS,
    global_catalogs: Sequence[str] = (),
    global_schema_globs: Sequence[str] = (),
    global_table_globs: Sequence[str] = (),
    types: Sequence[str] | None = COPYABLE_TYPES,
    exclude_regexes: Sequence[str] = (),
) -> DataFrame:
    """Mapping rows of all rules, with the sequence number of the rule.

    Catalog and schema rules join the listing on equal names; a table rule is
    emitted as it stands, without looking at the listing.
    """
    live = copyable(listing, types, exclude_regexes)
    if global_catalogs:
        rules = rules.where(~F.lower("source_catalog").isin(*[c.lower() for c in global_catalogs]))

    def rule_columns(kind: str) -> DataFrame:
        own = rules.where(F.col("rule_type") == kind)
        return own.select(*[F.col(c).alias(f"r_{c}") for c in own.columns])

    def mapping(
        source_schema: Column, source_table: Column, target_schema: Column, target_table: Column
    ) -> list[Column]:
        return [
            F.col("r_seq").cast("bigint").alias("rule_seq"),
            F.col("r_source_catalog").alias("source_catalog"),
            source_schema.alias("source_schema"),
            source_table.alias("source_table"),
            first_filled(F.col("r_target_catalog"), F.col("r_source_catalog")).alias("target_catalog"),
            target_schema.alias("target_schema"),
            target_table.alias("target_table"),
        ]

    schema, table = F.col("table_schema"), F.col("table_name")
    catalog_rules = rule_columns("catalog")

    def left_in(rows: DataFrame, rules: DataFrame, globs: str, column: str) -> DataFrame:
        """Rows whose ``column`` matches none of the globs of their rule; names and globs meet through an index."""
        known = live.select(F.lower(column).alias("_name"))
        out = glob_index.list_matches(known, "_name", rules, globs)
        hits = out.select(F.col(globs).alias("_globs"), F.col("_name").alias("_hit"))
        return rows.join(hits, (F.col(globs) == F.col("_globs")) & (F.lower(F.col(column)) == F.col("_hit")), "left_anti")

    from_catalogs = (
        live.join(catalog_rules, F.lower("table_catalog") == F.lower("r_source_catalog"))
        .where(~F.lower(schema).isin(*[s.lower() for s in system_schemas]))
        .where(_none_match(schema, global_schema_globs) & _none_match(table, global_table_globs))
    )
    from_catalogs = left_in(from_catalogs, catalog_rules, "r_exclude_schemas", "table_schema")
    from_catalogs = left_in(from_catalogs, catalog_rules, "r_exclude_tables", "table_name").select(*mapping(schema, table, schema, table))
    schema_rules = rule_columns("schema").where(_none_match(F.col("r_source_schema"), global_schema_globs))
    from_schemas = (
        live.join(
            schema_rules,
            (F.lower("table_catalog") == F.lower("r_source_catalog"))
            & (F.lower("table_schema") == F.lower("r_source_schema")),
        )
        .where(_none_match(table, global_table_globs))
    )
    from_schemas = left_in(from_schemas, schema_rules, "r_exclude_tables", "table_name").select(
        *mapping(
            F.col("r_source_schema"), table,
            first_filled(F.col("r_target_schema"), F.col("r_source_schema")), table,
        )
    )
    from_tables = (
        rule_columns("table")
        .where(_none_match(F.col("r_source_schema"), global_schema_globs))
        .where(_none_match(F.col("r_source_table"), global_table_globs))
        .select(
            *mapping(
                F.col("r_source_schema"), F.col("r_source_table"),
                first_filled(F.col("r_target_schema"), F.col("r_source_schema")),
                first_filled(F.col("r_target_table"), F.col("r_source_table")),
            )
        )
    )
    return from_catalogs.unionByName(from_schemas).unionByName(from_tables)


def dedup_selections(expanded: DataFrame) -> DataFrame:
    """One row per source table: the first rule wins.

    A plain aggregate, so copies of one table are folded before the shuffle.
    """
    targets = [c for c in expanded.columns if c not in MAPPING[:3]]
    first = F.min_by(F.struct(*targets), F.struct("rule_seq", "target_catalog", "target_schema", "target_table"))
    return expanded.groupBy(*MAPPING[:3]).agg(first.alias("m")).select(*MAPPING[:3], *[f"m.{c}" for c in targets])


def dropped_duplicates(expanded: DataFrame) -> DataFrame:
    """Mapping rows that lost to an earlier rule for the same source table."""
    kept = dedup_selections(expanded).select(*MAPPING, "rule_seq")
    counted = expanded.groupBy(*expanded.columns).count()
    on = [*MAPPING, "rule_seq"]
    return (
        counted.join(kept.withColumn("kept", F.lit(1)), on, "left")
        .withColumn("dropped", F.col("count") - F.coalesce("kept", F.lit(0)))
        .where(F.col("dropped") > 0)
        .select(*on, "dropped")
    )



def exclusion_hits(selections: DataFrame, rules: DataFrame) -> DataFrame:
    """Selections with the first exclusion rule (in file order) that matches, if any.

    Rules meet the distinct catalogs, schemas or tables, whichever their type
    names, through an index of their literal fragments; a rule without a
    wildcard is met by equality.
    """
    r = rules.select(
        F.struct(
            F.col("seq").cast("bigint").alias("seq"), "exclude_type",
            rule_text(F.col("exclude_type"), F.col("catalog"), F.col("schema_name"), F.col("table_name")).alias("rule"),
        ).alias("hit"),
        F.col("catalog").alias("c"), F.col("schema_name").alias("s"), F.col("table_name").alias("t"),
    )
    keyed = selections.withColumns({f"_{c}": F.lower(f"source_{n}") for c, n in (("c", "catalog"), ("s", "schema"), ("t", "table"))})
    found = keyed
    for kind, parts in (("catalog", ["c"]), ("schema", ["c", "s"]), ("table", ["c", "s", "t"])):
        names = keyed.select(*[f"_{p}" for p in parts]).distinct().withColumn("_name", glob_index.joined(*[f"_{p}" for p in parts]))
        own = r.where(F.col("hit.exclude_type") == kind).na.drop(subset=parts)
        pairs = glob_index.matching(names, "_name", glob_index.compiled(own, *parts))
        first = pairs.groupBy(*[f"_{p}" for p in parts]).agg(F.min("hit").alias(f"_{kind}_hit"))
        found = found.join(first, [f"_{p}" for p in parts], "left")
    # least() skips NULLs, so any one hit is enough
    hit = F.least("_catalog_hit", "_schema_hit", "_table_hit")
    return found.withColumn("_hit", hit).select(
        *selections.columns, F.col("_hit.exclude_type").alias("exclusion_type"), F.col("_hit.rule").alias("exclusion_rule"))


def split_exclusions(selections: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(kept, excluded)``; an excluded row names the rule that matched first."""
    hits = exclusion_hits(selections, rules)
    kept = hits.where(F.col("exclusion_rule").isNull()).select(*selections.columns)
    return kept, hits.where(F.col("exclusion_rule").isNotNull())


def exclusion_rows(excluded: DataFrame, run_id: str, batch_id: str, now: Column) -> DataFrame:
    """Rows of the exclusion log for the excluded selections."""
    return excluded.select(
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).alias("batch_id"),
        "source_catalog", "source_schema", "source_table",
        "exclusion_type", "exclusion_rule",
        now.cast("timestamp_ntz").alias("excluded_at"),
    )


def external_tables(listing: DataFrame, catalog: str, schema: str) -> DataFrame:
    return listing.where(
        (F.col("table_catalog") == catalog) & (F.col("table_schema") == schema) & (F.col("table_type") == "EXTERNAL")
    )


def tables_per_schema(listing: DataFrame) -> DataFrame:
    return listing.groupBy("table_catalog", "table_schema").agg(F.count("*").alias("tables"))
