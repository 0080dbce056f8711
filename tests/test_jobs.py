"""Whole jobs end to end on files."""

import pytest
from pyspark.sql import functions as F

from tabledger.operators.ledger import lit_time
from tabledger.plans.copy import CopyFailed, run_batch, run_chunk
from tabledger.plans.inventory import Blocked, Inputs, Options, dry_run, run_inventory
from tabledger.plans.reports import REPORTS, run_report
from tabledger.plans.retry import run_retry
from tabledger.plans.validate import run_acceptance, run_validation
from tabledger.sources.ledger_store import Ledger
from tabledger.sources.mapping import read_mapping_csv
from tabledger.sources.versions import VersionStore, VersionTaken

from . import frames


def t(day):
    return lit_time(f"2025-03-0{day} 00:00:00")


OPT = Options(batch_id="b1", run_id="r1", required_format="PARQUET", max_chunks=2)


@pytest.fixture()
def world(spark, tmp_path):
    """A source store with a few tables, an empty target store, and a ledger."""
    source = VersionStore(spark, str(tmp_path / "src"))
    target = VersionStore(spark, str(tmp_path / "tgt"))
    for name, df in frames.store_tables(spark).items():
        source.write(df, name, t(1))
    source.write(frames.by_day(spark), "prod.a.pageviews", t(1), partition_by=("event_date", "event_type"))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.create(t(1))
    ledger.create(t(1))
    return source, target, ledger


def inputs(source, **kw):
    part = F.split("fqn", r"\.")
    listing = source.details().select(
        part[0].alias("table_catalog"), part[1].alias("table_schema"), part[2].alias("table_name"),
        F.lit("MANAGED").alias("table_type"), "format", "size_in_bytes", "num_files", "version", "location",
    )
    return Inputs(listing=listing, detail=listing, **kw)


def mapping(spark, tmp_path, text):
    path = tmp_path / "mapping.csv"
    path.write_text(text)
    return read_mapping_csv(spark, str(path))


TYPED = """clone_type,source_catalog,source_schema,source_table,target_catalog,target_schema,target_table,exclude_schemas,exclude_tables
catalog,prod,,,dr,,,,"['tmp_*','staging_*']"
table,prod,a,gone,dr,a,gone,,
"""


def test_inventory_copy_validate_retry(spark, tmp_path, world):
    source, target, ledger = world
    rules = mapping(spark, tmp_path, TYPED)
    plan = dry_run(ledger, rules, inputs(source), OPT)
    assert plan.count() == 8
    assert ledger.table().count() == 0

    stats = run_inventory(ledger, rules, inputs(source), OPT, t(1))
    assert (stats["total"], stats["inserted"], stats["failed"]) == (8, 7, 1)
    control = ledger.table()
    assert control.where("status = 'QUEUED' AND chunk_id > 0").count() == 7
    assert control.where("status = 'FAILED_PERMANENT'").count() == 1
    assert control.select("migration_id").distinct().count() == 8

    # a source written between inventory and copy: the copy records what it read
    more = frames.store_tables(spark)["prod.a.customers"]
    source.write(more.unionByName(more), "prod.a.customers", t(2))

    done = run_batch(ledger, source, target, "b1", t(2), run_id="r2")
    assert done == {"ok": 7, "fail": 0}
    control = ledger.table()
    assert control.where("status = 'COMPLETED'").count() == 7
    row = control.where("source_table = 'customers'").first()
    assert (row.source_version, row.target_version, row.attempt_number) == (1, 0, 1)
    assert target.read("dr.a.customers").count() == 200
    copied = target.entry("dr.a.pageviews")
    assert copied.partition_columns == ["event_date", "event_type"]
    assert target.read("dr.a.pageviews").schema == source.read("prod.a.pageviews").schema
    assert ledger.log("attempts").where("status = 'SUCCESS'").count() == 7

    # the source changes again after the copy; counts stay pinned to what was copied
    source.write(more, "prod.a.customers", t(3))
    result = run_validation(ledger, source, target, t(3), "b1", "r3")
    assert (result["passed"], result["failed"], result["row_count_checked"], result["row_count_matched"]) == (7, 0, 7, 7)
    history = ledger.log("validation_history")
    assert history.count() == 7
    message = history.where("source_table = 'customers'").first().message
    assert "row_count src=200 tgt=200 (src@v1, tgt@v0)" in message
    assert "row_count src=0 tgt=0" in history.where("source_table = 'empty_staging'").first().message
    control = ledger.table()
    assert control.where("status = 'VALIDATED'").count() == 7
    assert run_validation(ledger, source, target, t(3), "b1", "r3")["row_count_checked"] == 0

    # a second run over a finished batch changes nothing
    again = run_inventory(ledger, rules, inputs(source), OPT, t(3))
    assert (again["inserted"], again["skipped"]) == (0, 8)
    assert sorted(r.status for r in ledger.table().collect()) == sorted(r.status for r in control.collect())

    # another batch gets rows of its own
    run_inventory(ledger, rules, inputs(source), Options(batch_id="b2", run_id="r4", required_format="PARQUET"), t(3))
    assert ledger.table().where("batch_id = 'b1' AND status = 'VALIDATED'").count() == 7
    assert ledger.table().where("batch_id = 'b2'").count() == 8

    # permanent failures come back only on request
    assert run_retry(ledger, OPT, t(3))["eligible"] == 0
    stats = run_retry(ledger, OPT, t(3), reset_permanents=True)
    assert (stats["reset_permanent"], stats["requeued"]) == (1, 1)
    assert ledger.table().where("batch_id = 'b1' AND status = 'QUEUED' AND chunk_id > 0").count() == 1

    for name in REPORTS:
        assert run_report(ledger, name).columns
    assert run_report(ledger, "kpis", batches=["b1"]).first().total_tables == 8


def test_failed_copy_is_recorded(spark, tmp_path, world):
    source, target, ledger = world
    rules = mapping(spark, tmp_path, TYPED.replace(",a,gone,dr,a,gone", ",a,gone,dr,x,gone"))
    blind = inputs(source)
    blind.detail = None
    run_inventory(ledger, rules, blind, OPT, t(1))
    gone = ledger.table().where("source_table = 'gone'").first()
    assert (gone.status, gone.workload_class, gone.workload_weight, gone.size_in_bytes) == ("QUEUED", "UNKNOWN", 0, None)
    with pytest.raises(CopyFailed, match="ok=.*fail=1"):
        run_chunk(ledger, source, target, "b1", gone.chunk_id, t(2))
    row = ledger.table().where("source_table = 'gone'").first()
    assert (row.status, row.error_code, row.attempt_number) == ("FAILED_PERMANENT", "TABLE_OR_VIEW_NOT_FOUND", 1)
    failed = ledger.log("attempts").where("status = 'FAILED'").collect()
    assert [(r.error_code, r.attempt_number) for r in failed] == [("TABLE_OR_VIEW_NOT_FOUND", 1)]


def test_gate_blocks_after_writing(spark, tmp_path, world):
    source, _, ledger = world
    settings = spark.createDataFrame(
        [("catalog", "dr", "INHERIT"), ("schema", "dr.b", "ENABLE")], "level string, fqn string, value string")
    with pytest.raises(Blocked, match="3 target table"):
        run_inventory(ledger, mapping(spark, tmp_path, TYPED), inputs(source, settings=settings), OPT, t(1))
    by_status = {r.status: r["count"] for r in ledger.table().groupBy("status").count().collect()}
    assert by_status == {"PO_BLOCKED": 3, "QUEUED": 4, "FAILED_PERMANENT": 1}
    # the setting is switched off: blocked rows are queued by the next run
    off = settings.withColumn("value", F.lit("DISABLE"))
    run_inventory(ledger, mapping(spark, tmp_path, TYPED), inputs(source, settings=off), OPT, t(2))
    by_status = {r.status: r["count"] for r in ledger.table().groupBy("status").count().collect()}
    assert by_status == {"QUEUED": 7, "FAILED_PERMANENT": 1}


def test_exclusions_are_logged(spark, tmp_path, world):
    source, _, ledger = world
    rules = spark.createDataFrame(
        [(1, "table", "prod", "A", "cust*"), (2, "schema", "pro?", "b", "")],
        "seq bigint, exclude_type string, catalog string, schema_name string, table_name string")
    run_inventory(ledger, mapping(spark, tmp_path, TYPED), inputs(source, exclusions=rules), OPT, t(1))
    log = {r.source_table: r.exclusion_rule for r in ledger.log("exclusion_log").collect()}
    assert log == {
        "customers": "table:prod.A.cust*", "transactions": "schema:pro?.b", "risk_scores": "schema:pro?.b",
        "complex": "schema:pro?.b",
    }
    onboarded = {r.source_table for r in ledger.table().collect()}
    assert not onboarded & set(log)


def test_mismatch_and_missing_target_fail_validation(spark, tmp_path, world):
    source, target, ledger = world
    run_inventory(ledger, mapping(spark, tmp_path, TYPED), inputs(source), OPT, t(1))
    run_batch(ledger, source, target, "b1", t(2))
    # a later target version on record with fewer rows, and one target that has no version at all
    target.write(target.read("dr.b.transactions").limit(10), "dr.b.transactions", t(3))
    ledger.update(lambda c: c.withColumn("target_version", F.when(F.col("source_table") == "transactions", 1).otherwise(F.col("target_version")))
                  .withColumn("target_table", F.when(F.col("source_table") == "customers", F.lit("nowhere")).otherwise(F.col("target_table"))), t(3))
    result = run_validation(ledger, source, target, t(3), "b1")
    assert (result["passed"], result["failed"], result["row_count_mismatched"]) == (5, 2, 1)
    rows = {r.source_table: r for r in ledger.table().collect()}
    assert rows["transactions"].status == "VALIDATION_FAILED"
    assert (rows["transactions"].source_row_count, rows["transactions"].target_row_count) == (150, 10)
    assert rows["customers"].validation_message.startswith("TARGET_MISSING")
    assert rows["customers"].source_row_count is None


def test_acceptance_suite(spark, world):
    source, target, ledger = world
    from tabledger.sources.versions import copy_table

    names = [r.fqn for r in source.details().collect()]
    for n in names:
        copy_table(source, target, n, n, t(2))
    pairs = {n: (source.read(n), target.read(n)) for n in names}
    pairs["prod.a.customers"] = (source.read("prod.a.customers"), target.read("prod.a.customers").drop("tier").limit(99))
    audit = spark.createDataFrame([("e1", "SUCCESS")], "execution_id string, status string")
    types = spark.createDataFrame([(n, "MANAGED") for n in names], "table_name string, table_type string")

    def details(store):
        return store.details().select(F.col("fqn").alias("table_name"), "partition_columns")

    done = run_acceptance(
        ledger, pairs, audit, "e1", t(2), tables_per_job=5, expected_types=types, actual_types=types,
        source_details=details(source), target_details=details(target), manifest=target.manifest(), sample_percent=100)
    summary = {r.check_name: r for r in done.collect()}
    assert len(summary) == 7
    assert {n: r.checks for n, r in summary.items()} == {
        "audit_log_completeness": 1,
        **{n: len(names) for n in ("row_count_parity", "schema_match", "table_type_preserved", "data_hash_integrity",
                                   "partition_columns_match", "delta_table_valid")}}
    assert {n for n, r in summary.items() if not r.accepted} == {"row_count_parity", "schema_match", "data_hash_integrity"}
    results = ledger.log("check_results")
    lost = results.where("check_name = 'row_count_parity' AND NOT passed").first()
    assert lost.detail == "src=100 tgt=99 DELTA=-1"
    assert results.where("check_name = 'schema_match' AND NOT passed").first().detail == "missing in tgt: 1"
    assert results.where("check_name = 'data_hash_integrity' AND NOT passed").first().detail == "columns differ: tier"
    # a second run of the execution replaces its results
    again = run_acceptance(ledger, pairs, audit, "e1", t(3), tables_per_job=50, expected_types=types, actual_types=types)
    assert {r.check_name: r.checks for r in again.collect()} == {n: r.checks for n, r in summary.items()}


def test_a_table_that_cannot_be_read_is_one_failed_row(spark, world):
    source, _, ledger = world
    good, bad = source.read("prod.a.customers"), spark.range(9).select(F.raise_error(F.lit("lost file")).cast("bigint").alias("id"))
    audit = spark.createDataFrame([("e2", "SUCCESS")], "execution_id string, status string")
    run_acceptance(ledger, {"good": (good, good), "bad": (bad, bad)}, audit, "e2", t(2))
    rows = {(r.table_name, r.check_name): r for r in ledger.log("check_results").where("execution_id = 'e2'").collect()}
    assert rows["good", "data_hash_integrity"].passed
    failed = rows["bad", "data_hash_integrity"]
    assert not failed.passed and failed.detail.startswith("Error: ") and "lost file" in failed.detail


def test_every_check_of_a_lost_table_has_a_row_and_so_has_the_audit_log(spark, world, tmp_path):
    import shutil

    source, _, ledger = world
    path = str(tmp_path / "gone")
    spark.range(50).write.parquet(path)
    lost, good = spark.read.parquet(path), source.read("prod.a.customers")
    shutil.rmtree(path)
    audit = spark.createDataFrame([("e3", "SUCCESS")], "execution_id string, status string")
    types = spark.createDataFrame([("lost", "MANAGED"), ("good", "MANAGED")], "table_name string, table_type string")
    summary = run_acceptance(ledger, {"lost": (lost, lost), "good": (good, good)}, audit, "e3", t(2), expected_types=types, actual_types=types)
    assert {r.check_name: (r.checks, r.passed_checks) for r in summary.collect()} == {
        "row_count_parity": (2, 1), "schema_match": (2, 2), "data_hash_integrity": (2, 1), "table_type_preserved": (2, 2), "audit_log_completeness": (1, 1)}
    failed = ledger.log("check_results").where("execution_id = 'e3' AND NOT passed").collect()
    assert {(r.table_name, r.check_name) for r in failed} == {("lost", "row_count_parity"), ("lost", "data_hash_integrity")}
    assert all(r.detail.startswith("Error: ") for r in failed)


def test_counts_of_tables_with_odd_names(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path / "odd"))
    names = ["my table", "50% off", "a+b"]
    for n in names:
        store.write(spark.range(100), n, t(1))
    wanted = spark.createDataFrame([(n, None) for n in [*names, "nowhere"]], "table_name string, version bigint")
    assert {r.table_name: r.row_count for r in store.count_rows(wanted).collect()} == {**dict.fromkeys(names, 100), "nowhere": None}


def test_two_writers(spark, world):
    _, _, ledger = world
    base = ledger.store.latest("control")
    rows = ledger.table()
    ledger.store.write(rows, "control", t(2), base=base, partition_by=("batch_id",))
    with pytest.raises(VersionTaken):
        ledger.store.write(rows, "control", t(2), base=base, partition_by=("batch_id",))
    # the loser builds again on the new version
    assert ledger.update(lambda c: c, t(2)) == base + 2
