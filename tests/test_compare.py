import pytest
from pyspark.sql import functions as F

from tabledger.operators import checks, compare

from . import frames


def test_copies_count(spark):
    a = spark.createDataFrame([(1, "x")] * 5 + [(2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x")] * 4 + [(2, None), (3, "y")], "k int, v string")
    out = compare.multiset_verdicts({"t": (a, b), "same": (a, a)}).collect()
    got = {r.table_name: (r.src_rows, r.tgt_rows, r.mismatches, r.passed) for r in out}
    assert got == {"t": (6, 6, 2, False), "same": (6, 6, 0, True)}
    rows = sorted(map(tuple, compare.diff_rows(a, b).collect()))
    assert rows == [(1, "x", 5, 4), (3, "y", 0, 1)]
    assert rows == sorted(map(tuple, compare.diff_rows_exact(a, b).collect()))
    sides = sorted(map(tuple, compare.lost_and_extra(a, b).collect()))
    assert sides == [(1, "x", "lost"), (3, "y", "extra")]


def test_empty_and_single_row_tables(spark):
    empty, single = frames.no_rows(spark), spark.range(1)
    out = {r.table_name: r for r in compare.multiset_verdicts({"e": (empty, empty), "s": (single, single)}).collect()}
    assert out["e"].passed and out["e"].src_rows == 0
    assert out["s"].passed and out["s"].src_rows == 1
    assert compare.checksum_verdicts({"e": (empty, empty)}).first().passed
    profile = {r.column_name: r for r in compare.column_profile(empty).collect()}
    assert profile["content"].value_count == 0 and profile["content"].min_value is None


def test_wide_and_nested_tables(spark):
    wide = frames.wide(spark, 200)
    assert len(wide.columns) == 121
    changed = wide.withColumn("v99", F.when(F.col("id") == 7, F.lit(None)).otherwise(F.col("v99")))
    out = compare.multiset_verdicts({"w": (wide, changed), "same": (wide, wide)})
    assert {r.table_name: r.mismatches for r in out.collect()} == {"w": 2, "same": 0}
    bad = compare.profile_compare(wide, changed).where("NOT passed").collect()
    assert [r.column_name for r in bad] == ["v99"]
    nested = frames.nested(spark, 100)
    other = nested.withColumn("pairs", F.map_concat("pairs", F.create_map(F.lit("new"), F.col("id").cast("string"))))
    verdicts = compare.checksum_verdicts({"n": (nested, other), "same": (nested, nested.repartition(3))})
    assert {r.table_name: r.passed for r in verdicts.collect()} == {"n": False, "same": True}


@pytest.mark.parametrize("percent", [1, 30, 100])
def test_samples_are_the_same_on_both_sides(spark, percent):
    a = spark.range(5000).withColumn("v", F.col("id") * 3)
    out = compare.multiset_verdicts({"t": (a.repartition(7), a.coalesce(1))}, percent).first()
    assert out.passed
    assert abs(out.src_rows - 50 * percent) <= 50 * percent * 0.3 + 20


def test_checksum_algorithms(spark):
    a = spark.range(100).withColumn("v", F.col("id").cast("string"))
    b = a.withColumn("v", F.when(F.col("id") == 5, "x").otherwise(F.col("v")))
    for algorithm in ("XXHASH64", "SHA256"):
        assert not compare.checksum_verdicts({"t": (a, b)}, algorithm=algorithm).first().passed
        assert compare.checksum_verdicts({"t": (a, b)}, {"t": ["id"]}, algorithm).first().passed
    with pytest.raises(ValueError):
        compare.checksum(a, algorithm="MD4")
    # a duplicate and a loss must not cancel out
    c = a.where("id <> 3").unionByName(a.where("id = 4"))
    assert not compare.checksum_verdicts({"t": (a, c)}).first().passed


def test_profile_values(spark):
    df = spark.createDataFrame(
        [(1.5, 2, "b", True), (None, -4, "a", False), (1e15, 2**62, None, None), (float("nan"), 2**62, "z", True)],
        "d double, n long, s string, f boolean")
    got = {r.column_name: r for r in compare.column_profile(df).collect()}
    assert (got["n"].min_value, got["n"].max_value) == ("-4", str(2**62))
    assert got["n"].avg_value == (2 * 2**62 - 2) / 4
    assert (got["s"].value_count, got["s"].null_count, got["s"].min_value, got["s"].max_value) == (3, 1, "a", "z")
    assert (got["d"].min_value, got["d"].max_value, got["d"].null_count, got["d"].nan_count) == ("1.5", "1.0E15", 1, 1)
    assert got["d"].avg_value == (1e15 + 1.5) / 2
    assert (got["f"].min_value, got["f"].max_value, got["f"].avg_value) == ("false", "true", None)
    exact = spark.createDataFrame([(0.1,)] * 10, "d double")
    assert compare.column_profile(exact).first().avg_value == pytest.approx(0.1)


@pytest.mark.parametrize("a, b, same", [
    ([1e33, 2e33], [2e33, 1e33], True), ([1e33, 1.5e33, 2e33], [1e33, 1.9e33, 2e33], False), ([1e-9], [2e-7], False),
    ([1.0, float("nan")], [1.0, 1.0], False), ([1.0, float("inf")], [1.0, 1.0], False), ([0.0], [-0.0], True),
    ([0.1, 0.2, 0.3], [0.3, 0.2, 0.1], True), ([1e308, 1e308], [1e308, 1.1e308], False), ([1e308, 1e308], [1e308, 1e308], True),
    ([5e-324, 1e-310], [1e-310, 5e-324], True), ([1e16, 1.0, -1e16], [-1e16, 1e16, 1.0], True), ([1e16, 1.0, -1e16], [1e16, 0.0, -1e16], False)])
def test_profiles_of_any_double(spark, a, b, same):
    x, y = (spark.createDataFrame([(v,) for v in values], "d double") for values in (a, b))
    assert compare.profile_compare(x, y).first().passed == same


def test_means_of_doubles_do_not_depend_on_the_order_of_rows(spark):
    import math
    import random

    r = random.Random(4)
    values = [r.uniform(-1, 1) * 2.0 ** r.randrange(-300, 300) for _ in range(3000)] + [2.0**k for k in range(-1074, 1023, 7)] + [0.0, -0.0]
    values += [math.nextafter(2.0**k, 0) for k in range(-1000, 1023, 11)]
    schema = "d double, f float, n decimal(38,4), m decimal(12,2)"
    rows = [(v, v if 1e-30 < abs(v) < 1e30 else 0.5, None, None) for v in values]
    a = spark.createDataFrame(rows, schema).repartition(1)
    b = spark.createDataFrame(r.sample(rows, len(rows)), schema).repartition(7)
    out = {x.column_name: x for x in compare.profile_compare(a, b).collect()}
    assert out["d"].passed and out["f"].passed
    assert out["d"].src_avg_value == pytest.approx(math.fsum(v / len(values) for v in values), rel=1e-14)
    huge = compare.column_profile(spark.createDataFrame([(1e308,), (1e308,)], "d double")).first()
    assert huge.avg_value == 1e308
    whole = spark.sql("SELECT CAST(id * 1234567890123456789.25 AS DECIMAL(38,4)) AS n, CAST(id / 4 AS DECIMAL(12,2)) AS m FROM range(1, 5)")
    got = {x.column_name: x.avg_value for x in compare.column_profile(whole).collect()}
    assert got["n"] == pytest.approx(1234567890123456789.25 * 2.5, rel=1e-14) and got["m"] == 0.625


def test_types_may_differ(spark):
    a, b = spark.range(50).select(F.col("id").cast("int").alias("k")), spark.range(50).select(F.col("id").alias("k"))
    assert compare.multiset_verdicts({"t": (a, b)}).first().passed
    text = b.select(F.when(F.col("k") == 3, "x").otherwise(F.col("k").cast("string")).alias("k"))
    assert sorted(map(tuple, compare.diff_rows(a, text).collect())) == [("3", 1, 0), ("x", 0, 1)]


def test_faithful_copies_and_repeated_rows(spark):
    a = spark.range(20_000).withColumn("v", F.col("id") * 3)
    assert compare.diff_rows(a, a.repartition(5)).count() == 0
    b = a.where("id <> 77").unionByName(a.where("id = 5")).unionByName(a.where("id = 5"))
    assert sorted(map(tuple, compare.lost_and_extra(a, b).collect())) == [(5, 15, "extra")] * 2 + [(77, 231, "lost")]


def test_schema_diff_ignores_order_and_nullability(spark):
    a = spark.createDataFrame([], "a int, b string, c decimal(10,2)")
    b = spark.createDataFrame([], "c decimal(12,2), d date, a int not null")
    rows = compare.schema_diff(compare.schema_rows({"t": a}), compare.schema_rows({"t": b})).collect()
    assert sorted((r.column_name, r.issue) for r in rows) == [
        ("b", "missing in target"), ("c", "type mismatch"), ("d", "extra in target")]
    same = spark.createDataFrame([], "c decimal(10,2), b string, a int not null")
    verdict = compare.schema_verdicts(compare.schema_rows({"t": a}), compare.schema_rows({"t": same})).first()
    assert (verdict.passed, verdict.detail) == (True, "3 cols match")


def test_parity_text_and_groups(spark):
    a, b = spark.range(1234), spark.range(2000)
    assert compare.row_count_parity({"t": (a, b)}).first().detail == "src=1,234 tgt=2,000 DELTA=+766"
    assert compare.row_count_parity({"t": (a, a)}).first().detail == "src=1,234 tgt=1,234"
    g = spark.createDataFrame([("x",), (None,)], "k string")
    out = {r.k: (r.src_rows, r.tgt_rows, r.passed) for r in compare.grouped_parity(g, g.where("k = 'x'"), ["k"]).collect()}
    assert out == {"x": (1, 1, True), None: (1, 0, False)}


def test_partition_and_history_checks(spark):
    s = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"]), ("c", [])], "table_name string, partition_columns array<string>")
    t = spark.createDataFrame([("a", ["y", "x"]), ("b", ["z"])], "table_name string, partition_columns array<string>")
    got = {r.table_name: (r.passed, r.detail) for r in compare.partition_columns_check(s, t).collect()}
    assert got["a"] == (True, "src=[x, y] tgt=[x, y]")
    assert got["b"] == (False, "src=[x] tgt=[z]")
    assert not got["c"][0]
    manifest = spark.createDataFrame([("a", 0, "CLONE"), ("a", 1, "WRITE")], "table_name string, version int, operation string")
    got = {r.table_name: (r.passed, r.detail) for r in compare.history_check(s, manifest).collect()}
    assert got == {"a": (True, "latest_op=WRITE"), "b": (False, "latest_op=n/a"), "c": (False, "latest_op=n/a")}


def test_count_error_fails_with_its_own_code(spark):
    rec = spark.createDataFrame([("m", "c", "s", "t", "d", "s", "t", None, None)],
                                "migration_id string, source_catalog string, source_schema string, source_table string,"
                                "target_catalog string, target_schema string, target_table string, source_version long, target_version long")
    detail = [spark.createDataFrame([(n, "DELTA", 100, 0, None)], "fqn string, format string, size_in_bytes long, num_files long, last_modified timestamp_ntz")
              for n in ("c.s.t", "d.s.t")]
    counts = spark.createDataFrame([("m", 5, None)], "migration_id string, source_row_count long, target_row_count long")
    out = checks.validation_verdicts(rec, *detail, counts).first()
    assert (out.verdict, out.verdict_code, out.row_count_matched) == ("VALIDATION_FAILED", "COUNT_ERROR", False)
    assert "✓ file_count: Both source and target have 0 files (empty table)" in out.message
    assert "✗ delta_version_present" in out.message
    out = checks.validation_verdicts(rec, *detail).first()
    assert (out.verdict, out.row_count_checked) == ("VALIDATED", False)
    counts = spark.createDataFrame([("m", 1500, 1500)], "migration_id string, source_row_count long, target_row_count long")
    out = checks.validation_verdicts(rec, *detail, counts).first()
    assert "✓ row_count: row_count src=1,500 tgt=1,500 (unversioned" in out.message


def test_advisory_checks_do_not_fail(spark):
    rec = spark.createDataFrame([("m", "c", "s", "t", "d", "s", "t", 1, 2)],
                                "migration_id string, source_catalog string, source_schema string, source_table string,"
                                "target_catalog string, target_schema string, target_table string, source_version long, target_version long")
    src = spark.createDataFrame([("c.s.t", "delta", 1000, 10, None)], "fqn string, format string, size_in_bytes long, num_files long, last_modified timestamp_ntz")
    tgt = spark.createDataFrame([("d.s.t", "parquet", 2000, 20, None)], "fqn string, format string, size_in_bytes long, num_files long, last_modified timestamp_ntz")
    out = checks.validation_verdicts(rec, src, tgt).first()
    assert out.verdict == "VALIDATED"
    assert "✗ target_format: Target format=PARQUET (expected DELTA)" in out.message
    assert "✗ size_bytes: size_bytes src=1,000 tgt=2,000 diff=100.00% (tol=1.0%) ✗ EXCEEDS TOLERANCE" in out.message
