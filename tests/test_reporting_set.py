from tabledger.operators import report

SCHEMA = ("batch_id string, status string, clone_type string, attempt_number int, validation_status string, source_row_count long, target_row_count long,"
          "size_in_bytes long, chunk_id int, error_code string, completed_at timestamp_ntz, duration_seconds long")


def rows(spark):
    import datetime

    at = datetime.datetime(2025, 1, 1, 5, 30)
    return spark.createDataFrame([
        ("a", "COMPLETED", "x", 1, None, 5, 5, 1 << 30, 1, None, at, 60), ("a", "FAILED", "x", 2, None, None, None, None, 1, "E1", None, None),
        ("a", "FAILED", None, 2, None, None, None, 1 << 40, None, None, None, None), (None, "QUEUED", "y", 0, None, None, None, 5, None, "E2", at, None)], SCHEMA)


def test_groups_agree_with_the_single_reports(spark):
    control = rows(spark)
    got = {(r.dataset, r.key): r for r in report.reporting_set(control).collect()}
    assert {d for d, _ in got} == set(report.REPORTING_SETS)
    for r in report.status_totals(control).collect():
        assert got["status_totals", r.status].tables == r.n and got["status_totals", r.status].total_bytes / 2**30 == r.total_gb
    for r in report.class_totals(control).collect():
        assert got["class_totals", r.workload_class].tables == r.n
    assert {k: r.tables for (d, k), r in got.items() if d == "fail_codes"} == {"E1": 1, "(none)": 1}
    assert {k: (r.tables, r.total_seconds) for (d, k), r in got.items() if d == "hourly_throughput"} == {"2025-01-01 05:00:00": (1, 60)}
    assert {k: r.tables for (d, k), r in got.items() if d == "chunk_fanout"} == {"a|1": 2}
    assert {k: r.tables for (d, k), r in got.items() if d == "status_by_batch"} == {"a|COMPLETED": 1, "a|FAILED": 2, "(none)|QUEUED": 1}
    assert (got["kpis", ""].tables, got["kpis", ""].done_tables) == (4, 1)


def test_one_scan(spark, tmp_path):
    path = str(tmp_path / "c")
    rows(spark).write.parquet(path)
    plan = report.reporting_set(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
