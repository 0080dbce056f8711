import json

import pytest
from pyspark.sql import functions as F

from tabledger.operators import select
from tabledger.plans.inventory import Inputs, resolve
from tabledger.sources.mapping import name_list, read_exclusions_csv, read_mapping_csv, read_mapping_document

from .frames import table_names

SCHEMAS = ["finance", "hr", "iot", "ops", "sales"]


@pytest.fixture()
def listing(spark):
    rows = [("bulk", s, t, "MANAGED") for s, t in table_names(SCHEMAS)]
    rows += [("bulk", "finance", "v_lineage", "VIEW"), ("bulk", "information_schema", "tables", "MANAGED")]
    return spark.createDataFrame(rows, "table_catalog string, table_schema string, table_name string, table_type string")


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def names(df):
    return sorted((r.source_schema, r.source_table) for r in df.collect())


TYPED = """clone_type,source_catalog,source_schema,source_table,target_catalog,target_schema,target_table,exclude_schemas,exclude_tables
"""


def test_golden_exclusion_counts(spark, tmp_path, listing):
    """130 tables; a schema rule takes 26 and a table rule 1: 103 stay, 27 are logged, none is both."""
    mapping = read_mapping_csv(spark, write(tmp_path, "m.csv", TYPED + "catalog,bulk,,,dr,,,,\n"))
    rules = read_exclusions_csv(spark, write(
        tmp_path, "e.csv",
        "exclude_type,catalog,schema,table\nschema,bulk,iot,\ntable,BULK,Finance,dim_finance_01\ntable,bulk,iot,dim_iot_01\n"
        "table,bulk,hr,\nbogus,bulk,hr,x\nschema,,hr,\n"))
    assert rules.count() == 3
    kept, excluded = resolve(mapping, Inputs(listing=listing, exclusions=rules))
    assert kept.count() == 103
    assert excluded.count() == 27
    assert not set(names(kept)) & set(names(excluded))
    why = {r.source_table: r.exclusion_rule for r in excluded.collect()}
    assert why["dim_iot_01"] == "schema:bulk.iot"
    assert why["dim_finance_01"] == "table:BULK.Finance.dim_finance_01"


def test_no_exclusion_file(spark):
    assert read_exclusions_csv(spark, " ").count() == 0


def test_typed_layout(spark, tmp_path, listing):
    text = TYPED + (
        "table,bulk,finance,dim_finance_01,,,renamed,,\n"
        "schema,bulk,hr,,dr,hr_dr,,,\"['fact_*', '*_13']\"\n"
        "catalog,bulk,,,dr,,,['hr'],\"['*_0?','dim_sales_1[01]']\"\n"
        ",bulk,ops,missing_table,,,,,\n"
        "schema,bulk,,,,,,,\ntable,bulk,hr,,,,,,\nview,bulk,hr,x,,,,,\ncatalog,,,,,,,,\n"
    )
    m = read_mapping_csv(spark, write(tmp_path, "m.csv", text))
    assert sorted(r.reject_reason for r in m.rejects.collect()) == [
        "missing source_catalog", "missing source_schema", "missing source_table", "unknown clone_type"]
    kept, none = resolve(m, Inputs(listing=listing))
    assert none is None
    rows = {(r.source_schema, r.source_table): r for r in kept.collect()}
    # a table rule needs no listing
    assert ("ops", "missing_table") in rows
    assert rows["finance", "dim_finance_01"].target_table == "renamed"
    assert rows["finance", "dim_finance_01"].target_catalog == "bulk"
    hr = [r for (s, _), r in rows.items() if s == "hr"]
    assert len(hr) == 12 and {r.target_schema for r in hr} == {"hr_dr"}
    sales = sorted(t for s, t in rows if s == "sales")
    assert sales == ["dim_sales_12", "dim_sales_13", "fact_sales_10", "fact_sales_11", "fact_sales_12", "fact_sales_13"]
    assert not any(s == "information_schema" for s, _ in rows)


def test_refused_lines_are_kept_with_their_text_and_reason(spark, tmp_path, listing):
    text = TYPED + "table,bulk,hr,one,,,,,\ntable,bulk,hr,two,,,,,,stray\nschema,bulk,hr\ntable,bulk,hr,\"a, b\",,,,,\nview,bulk,hr,x,,,,,\n"
    m = read_mapping_csv(spark, write(tmp_path, "m.csv", text))
    assert sorted((r.rule_type, r.source_table) for r in m.rules.collect()) == [("schema", ""), ("table", "a, b"), ("table", "one")]
    refused = {r.reject_reason: r._line for r in m.rejects.collect()}
    assert set(refused) == {"more cells than headers", "unknown clone_type"}
    assert "two" in refused["more cells than headers"] and "stray" in refused["more cells than headers"]


def test_explicit_layout(spark, tmp_path, listing):
    text = ("source_catalog,source_schema,source_table,target_catalog,target_schema,target_table\n"
            " a , b ,c,,,\na,b,d,x,y,z\na,,e,,,\na,b,c,second,,\n")
    m = read_mapping_csv(spark, write(tmp_path, "m.csv", text))
    assert m.rejects.count() == 1
    expanded = select.expand_rules(m.rules, listing)
    kept = select.dedup_selections(expanded)
    rows = {r.source_table: (r.target_catalog, r.target_schema, r.target_table) for r in kept.collect()}
    assert rows == {"c": ("a", "b", "c"), "d": ("x", "y", "z")}
    lost = select.dropped_duplicates(expanded).collect()
    assert [(r.source_table, r.target_catalog, r.dropped) for r in lost] == [("c", "second", 1)]


def test_structured_document(spark, tmp_path, listing):
    doc = {"migration": {
        "exclude": {"catalogs": ["OLD"], "schemas": ["OPS"], "tables": ["*_13"]},
        "mappings": [
            {"type": "catalog", "source": "bulk", "target": "dr", "exclude_schemas": ["sales", "iot"], "exclude_tables": ["fact_*"]},
            {"type": "schema", "source_catalog": "bulk", "source_schema": "sales", "target_schema": "s2"},
            {"type": "schema", "source_catalog": "bulk", "source_schema": "ops"},
            {"type": "table", "source_catalog": "bulk", "source_schema": "iot", "source_table": "one_13"},
            {"type": "table", "source_catalog": "bulk", "source_schema": "iot", "source_table": "one"},
            {"type": "table", "source_catalog": "old", "source_schema": "x", "source_table": "one"},
            {"type": "view", "source_catalog": "bulk", "source_schema": "x"},
        ]}}
    m = read_mapping_document(spark, write(tmp_path, "m.json", json.dumps(doc)))
    assert m.rejects.count() == 1
    kept, _ = resolve(m, Inputs(listing=listing))
    got = kept.groupBy("source_schema").count().collect()
    assert {r.source_schema: r["count"] for r in got} == {"finance": 12, "hr": 12, "sales": 24, "iot": 1}
    assert kept.where("source_schema = 'sales'").first().target_schema == "s2"


def test_older_document_and_delegation(spark, tmp_path, listing):
    old = {"migration": {"exclude": {"tables": ["dim_*"]}, "selection": {"type": "schema", "schemas": [
        {"source_catalog": "bulk", "source_schema": "hr", "target_catalog": "dr"}]}}}
    m = read_mapping_document(spark, write(tmp_path, "old.json", json.dumps(old)))
    kept, _ = resolve(m, Inputs(listing=listing))
    assert kept.count() == 13
    write(tmp_path, "m.csv", TYPED + "schema,bulk,iot,,,,,,\n")
    pointer = write(tmp_path, "p.json", json.dumps({"migration": {"csv_path": "m.csv", "mappings": [{"type": "catalog", "source": "bulk"}]}}))
    kept, _ = resolve(read_mapping_document(spark, pointer), Inputs(listing=listing))
    assert {r.source_schema for r in kept.collect()} == {"iot"}


@pytest.mark.parametrize("kind,cell,schema,n", [
    ("table", '["bulk.hr.dim_hr_01", "bulk.hr", "a.b.c"]', "", 2),
    ("schema", "bulk.hr, bulk.iot.x, bulk.ops", "into", 52),
    ("catalog", '["bulk", "bulk.hr"]', "", 130),
])
def test_parameters(spark, listing, kind, cell, schema, n):
    rules = select.parameter_rules(name_list(spark, cell), kind, "dr", schema)
    kept = select.dedup_selections(select.expand_rules(rules, listing))
    assert kept.count() == n
    assert {r.target_catalog for r in kept.collect()} == {"dr"}
    if schema:
        assert {r.target_schema for r in kept.collect()} == {schema}


def test_listing_filters(spark, listing):
    assert select.copyable(listing, exclude_regexes=["DIM_.*"]).where("table_name LIKE 'dim%'").count() == 0
    assert select.copyable(listing, types=None).count() == 132


def test_exclusion_globs_against_every_pair(spark):
    """All rules on all names, against a plain loop."""
    import fnmatch
    import itertools

    parts = ["a", "ab", "b", "x-1", "[q]"]
    globs = ["*", "a", "a*", "?b", "[ab]", "[!a]*", "x-?", "*b"]
    tables = [(c, s, t) for c, s, t in itertools.product(parts, parts[:4], parts)]
    rules = []
    for i, (c, s, t) in enumerate(itertools.product(globs, globs[:6], globs[1:5])):
        kind = ("catalog", "schema", "table", "table")[i % 4]
        rules.append((1000 - i, kind, c, s, t))
    rules = rules[::3]
    df = spark.createDataFrame(tables, "source_catalog string, source_schema string, source_table string")
    rdf = spark.createDataFrame(rules, "seq int, exclude_type string, catalog string, schema_name string, table_name string")
    got = {(r[0], r[1], r[2]): r.exclusion_rule for r in select.exclusion_hits(df, rdf).collect()}

    def matches(rule, name):
        depth = {"catalog": 1, "schema": 2, "table": 3}[rule[1]]
        return all(fnmatch.fnmatchcase(n, g) for n, g in zip(name[:depth], rule[2:][:depth]))

    for name in tables:
        hits = sorted(r for r in rules if matches(r, name))
        want = None
        if hits:
            r = hits[0]
            depth = {"catalog": 1, "schema": 2, "table": 3}[r[1]]
            want = f"{r[1]}:" + ".".join(r[2:][:depth])
        assert got[name] == want, name


def test_brackets_stay_in_their_part(spark):
    """An unclosed bracket in one part is no class together with the next part; rules that start with a wildcard hit."""
    rows = [("a[", "x]", "t"), ("a", "b", "tmp_1"), ("zz", "q", "keep")]
    selections = spark.createDataFrame([r + r for r in rows], ", ".join(f"{s}_{n} string" for s in ("source", "target") for n in ("catalog", "schema", "table")))
    rules = spark.createDataFrame(
        [(1, "schema", "a[", "x]", None), (2, "table", "*", "?", "tmp_[0-9]")],
        "seq bigint, exclude_type string, catalog string, schema_name string, table_name string")
    hits = {r.source_table: r.exclusion_type for r in select.exclusion_hits(selections, rules).collect()}
    assert hits == {"t": "schema", "tmp_1": "table", "keep": None}
