import random

import pytest
from pyspark.sql import functions as F

from tabledger.operators import compare, request_checks
from tabledger.operators.requests import new_requests
from tabledger.operators.ledger import lit_time


def queue(spark, rows):
    """(id, scope, catalog, schema, table, mode, columns, tolerance, algorithm)"""
    names = ("onboarding_id string, scope_mode string, src_catalog string, src_schema string, src_table string, validation_mode string,"
             "validation_columns string, count_tolerance_pct double, checksum_algorithm string")
    return spark.createDataFrame(rows, names)


@pytest.fixture()
def pairs(spark):
    a = spark.range(1000).select("id", F.expr("concat('n', id)").alias("name"), F.expr("id / 7").alias("x"), F.lit(1).alias("d"), F.col("id").cast("decimal(12,2)").alias("m"))
    b = a.withColumn("x", F.when(F.col("id") == 5, 0.5).otherwise(F.col("x")))
    c = a.where("id <> 3")
    return {"p.a.same": (a, a.repartition(3)), "p.a.x": (a, b), "p.b.lost": (a, c)}


def test_each_request_has_its_own_columns_tolerance_and_algorithm(spark, pairs):
    requests = queue(spark, [
        ("1", "table", "p", "a", "p.a.x", "ALL", "id, name", 0.0, "SHA256"),
        ("2", "table", "p", "a", "p.a.x", "ALL", None, None, None),
        ("3", "schema", "p", "b", None, "COUNT", None, 0.05, None),
        ("4", "schema", "p", "b", None, "COUNT", None, 0.5, None),
        ("5", "catalog", "p", None, None, "CHECKSUM", "name", 0.0, "xxhash64"),
        ("6", "table", "p", "a", "p.a.gone", "COUNT", None, 0.0, None),
        ("7", "table", "p", "a", "p.a.x", "COLUMN_SAMPLE", "x,zz", 0.0, None),
        ("8", "table", "p", "a", "p.a.x", "CHECKSUM", "id", 0.0, "MD4"),
        ("9", "table", "p", "a", "p.a.x", "NONE", None, 0.0, None),
        ("10", "table", "p", "a", "p.a.x", "COLUMN_SAMPLE", "x,m", 0.0, None),
    ])
    got = {(r.onboarding_id, r.table_name, r.check_name): (r.passed, r.detail) for r in request_checks.run_request_checks(requests, pairs).collect()}
    passed = {k: v[0] for k, v in got.items()}
    assert passed == {
        ("1", "p.a.x", "COUNT"): True, ("1", "p.a.x", "CHECKSUM"): True, ("1", "p.a.x", "COLUMN_SAMPLE"): True,
        ("2", "p.a.x", "COUNT"): True, ("2", "p.a.x", "CHECKSUM"): False, ("2", "p.a.x", "COLUMN_SAMPLE"): False,
        ("3", "p.b.lost", "COUNT"): False, ("4", "p.b.lost", "COUNT"): True,
        ("5", "p.a.same", "CHECKSUM"): True, ("5", "p.a.x", "CHECKSUM"): True, ("5", "p.b.lost", "CHECKSUM"): False,
        ("6", "p.a.gone", "COUNT"): False, ("7", "p.a.x", "COLUMN_SAMPLE"): False, ("8", "p.a.x", "CHECKSUM"): False,
        ("10", "p.a.x", "COLUMN_SAMPLE"): False,
    }
    assert got["2", "p.a.x", "COLUMN_SAMPLE"][1] == "differing: x"
    assert got["3", "p.b.lost", "COUNT"][1] == "src=1,000 tgt=999 DELTA=-1"
    assert "zz" in got["7", "p.a.x", "COLUMN_SAMPLE"][1] and "MD4" in got["8", "p.a.x", "CHECKSUM"][1]
    assert got["6", "p.a.gone", "COUNT"][1] == "Error: no such pair of tables"
    for r in (compare.checksum_verdicts({"t": pairs["p.a.x"]}).first(),):
        assert got["2", "p.a.x", "CHECKSUM"][1] == f"src={r.src_checksum} tgt={r.tgt_checksum}"


def test_many_requests_take_one_scan_of_each_side(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).selectExpr("id", "concat('n', id) AS name", "id % 7 AS k").write.parquet(path)
    a, b = spark.read.parquet(path), spark.read.parquet(path)
    r = random.Random(1)
    requests = queue(spark, [
        (str(i), "table", "p", "a", "p.a.t", r.choice(["COUNT", "CHECKSUM", "COLUMN_SAMPLE", "ALL"]), r.choice([None, "id", "name,k", "k"]), 0.0, r.choice(["SHA256", "XXHASH64"]))
        for i in range(60)])
    out = request_checks.run_request_checks(requests, {"p.a.t": (a, b)})
    assert out.where("NOT passed").count() == 0 and out.count() >= 60
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2


def test_new_requests_can_be_run(spark, pairs):
    names = spark.createDataFrame([("p.a.x",)], "fqn string")
    rows = new_requests(names, "table", "r", "copy", "dr", "ops", lit_time("2025-01-01 00:00:00"), validation_mode="COUNT")
    assert [r.passed for r in request_checks.run_request_checks(rows, pairs).collect()] == [True]
    assert request_checks.run_request_checks(rows.limit(0), pairs).count() == 0
