import fnmatch

import pytest
from pyspark.sql import functions as F

from tabledger.functions import hashing, sizing, text


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("_"))
    return row.select(expr).first()[0]


GLOBS = ["*lineage*", "tmp_*", "a?c", "[ab]x", "[!ab]x", "[[]q", "a.b", "a[b", "*", "", "x-y", "[a-c]1", "a&&b", "r|s", "(x)", "a\\b"]
NAMES = ["stg_Lineage_1", "TMP_1", "abc", "ax", "cx", "[q", "a.b", "axb", "a[b", "", "x-y", "b1", "a&&b", "r|s", "(x)", "a\\b", "a\nc"]


def test_glob_match_agrees_with_fnmatch(spark):
    pairs = [(g, n) for g in GLOBS for n in NAMES]
    df = spark.createDataFrame(pairs, "g string, n string").select("g", "n", text.glob_match(F.col("n"), F.col("g")).alias("m"))
    wrong = [(r.g, r.n) for r in df.collect() if r.m != fnmatch.fnmatchcase(r.n.lower(), r.g.lower())]
    assert wrong == []


def test_globs_and_regexes_stay_apart(spark):
    df = spark.createDataFrame([("tmp_scratch",)], "n string")
    assert df.select(text.glob_match(F.col("n"), F.lit("tmp_*"))).first()[0]
    assert not df.select(text.regex_full_match(F.col("n"), "tmp_*")).first()[0]
    assert df.select(text.regex_full_match(F.col("n"), "TMP_.*")).first()[0]


@pytest.mark.parametrize("cell,want", [
    ("['hr']", ["hr"]), ("['a', ' *b* ']", ["a", "*b*"]), ("", []), (None, []), ("[]", []), ("abc", []), ("['a'", []),
    ("'x'", ["x"]), ('["q"]', ["q"]), ("('a','b')", ["a", "b"]), ("[1, 'b']", ["1", "b"]),
])
def test_list_literal(spark, cell, want):
    df = spark.createDataFrame([(cell,)], "c string")
    assert df.select(text.list_literal(F.col("c"))).first()[0] == want


@pytest.mark.parametrize("cell,want", [('["a.b", " c "]', ["a.b", "c"]), ("a.b, c,,", ["a.b", "c"]), (None, []), ("", [])])
def test_string_list(spark, cell, want):
    df = spark.createDataFrame([(cell,)], "c string")
    assert df.select(text.string_list(F.col("c"))).first()[0] == want


@pytest.mark.parametrize("line,want", [
    ("SUCCESS:batch=b,chunk=1,ok=3,fail=2", (3, 2)), ("SUCCESS", (5, 0)), ("FAILED", (0, 5)), ("ok=x,fail=1", (0, 5)),
])
def test_result_counts(spark, line, want):
    df = spark.createDataFrame([(line, 5)], "c string, t int")
    assert tuple(df.select(text.result_counts(F.col("c"), F.col("t"))).first()[0]) == want


@pytest.mark.parametrize("message,want", [
    ("[TABLE_OR_VIEW_NOT_FOUND] PERMISSION_DENIED", "TABLE_OR_VIEW_NOT_FOUND"), ("x LOCATION_OVERLAP", "LOCATION_OVERLAP"),
    ("PermissionDenied: no", "PERMISSION_DENIED"), ("AnalysisException: y", "ANALYSIS_EXCEPTION"), ("boom", "CLONE_FAILED"),
])
def test_error_codes(spark, message, want):
    assert one(spark, text.error_code_of(F.lit(message))) == want


def test_names(spark):
    assert one(spark, text.quoted_fqn(F.lit("a"), F.lit("b`c"), F.lit("special-table_v2"))) == "`a`.`b``c`.`special-table_v2`"
    rule = [text.rule_text(F.lit(k), F.lit("c"), F.lit("s"), F.lit("t")) for k in ("catalog", "schema", "table")]
    assert [one(spark, r) for r in rule] == ["catalog:c", "schema:c.s", "table:c.s.t"]


@pytest.mark.parametrize("size,klass,weight", [
    (None, "UNKNOWN", 0), (0, "SMALL", 1), (10 * 1024**3 - 1, "SMALL", 1), (10 * 1024**3, "MEDIUM", 3),
    (100 * 1024**3, "LARGE", 8), (1000 * 1024**3 - 1, "LARGE", 8), (1000 * 1024**3, "XLARGE", 20),
])
def test_workload_class(spark, size, klass, weight):
    df = spark.createDataFrame([(size,)], "s long")
    k = sizing.workload_class(F.col("s"))
    assert tuple(df.select(k, sizing.workload_weight(k)).first()) == (klass, weight)


@pytest.mark.parametrize("attempt,want", [(0, 0), (1, 30), (2, 60), (3, 120)])
def test_backoff(spark, attempt, want):
    assert one(spark, sizing.backoff_seconds(F.lit(attempt), 30)) == want


@pytest.mark.parametrize("s,t,tol,want", [(0, 0, 1.0, True), (0, 1, 1.0, False), (100, 101, 1.0, True), (100, 102, 1.0, False), (100, 0, 100.0, True)])
def test_tolerance(spark, s, t, tol, want):
    assert one(spark, sizing.within_tolerance(F.lit(s), F.lit(t), tol)) is want


HASHED = [
    ("map", "m map<string,double>", [({"a": 1.0, "b": None},), ({"a": None, "b": 1.0},), ({"a": 1.0},), (None,), ({},)]),
    ("array", "a array<int>", [([1, None],), ([None, 1],), ([1],), ([],), (None,), ([None],), ([-2147483648, None],), ([-2147483648],), ([None, -2147483648],)]),
    ("texts", "a array<string>", [(["a", None],), ([None, "a"],), (["a"],), (["a", ""],), (["\u0000"],), (["\u0000", None],)]),
    ("nested", "a array<array<int>>", [([[1], [2]],), ([[1, 2]],), ([[1, 2], []],), ([[1], [2, None]],)]),
    ("strings", "a string, b string", [("a|b", "c"), ("a", "b|c"), ("O", None), (None, "O"), ("__NULL__", "x"), (None, "x"), ("", None), (None, "")]),
    ("decimal", "d decimal(10,2)", [(1,), (2,), (None,)]),
    ("struct", "s struct<x:int,y:int>", [((1, None),), ((None, 1),), (None,), ((None, None),)]),
]


@pytest.mark.parametrize("name,schema,values", HASHED, ids=[h[0] for h in HASHED])
def test_different_rows_hash_apart(spark, name, schema, values):
    from decimal import Decimal

    if name == "decimal":
        values = [(None if v[0] is None else Decimal(v[0]),) for v in values]
    df = spark.createDataFrame(values, schema)
    hashes = df.select(hashing.row_hash(df), *hashing.row_hash_pair(df), hashing.row_md5(df)).collect()
    for i in range(4):
        assert len({h[i] for h in hashes}) == len(values), i


def test_equal_rows_hash_alike(spark):
    df = spark.createDataFrame([(0.0, [0.0, 1.0], {"a": 0.0, "b": 1.0}), (-0.0, [-0.0, 1.0], {"b": 1.0, "a": -0.0})],
                               "d double, a array<double>, m map<string,double>")
    out = df.select(hashing.row_hash(df), hashing.row_md5(df)).collect()
    assert out[0] == out[1]


def test_hash_sum_is_the_exact_sum(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("h"))
    exact = sum(r.h for r in df.collect())
    assert int(df.selectExpr(hashing.hash_sum_sql("h")).first()[0]) == exact
    assert df.where("false").selectExpr(hashing.hash_sum_sql("h")).first()[0] == 0
    edge = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (-1,)], "h long")
    assert int(edge.selectExpr(hashing.hash_sum_sql("h")).first()[0]) == -2
