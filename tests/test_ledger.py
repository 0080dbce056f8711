import datetime

import pytest
from pyspark.sql import functions as F

from tabledger.operators import inventory, ledger, merge, requests
from tabledger.sources import schemas
from tabledger.sources.schemas import CONTROL, REQUESTS, STATUSES, conform

NOW = "2025-03-01 12:00:00"


def ts(minutes_ago):
    return datetime.datetime(2025, 3, 1, 12) - datetime.timedelta(minutes=minutes_ago)


@pytest.fixture()
def control(spark):
    rows = []
    for i, status in enumerate(STATUSES):
        for attempt in (0, 2, 3):
            for j, started in enumerate((None, 120, 121)):
                rows.append((
                    f"{status}-{attempt}-{j}", "b1" if j < 2 else "b2", 1 if j else 0, status, attempt, 3,
                    None if started is None else ts(started), "c", "s", f"t{i}_{attempt}_{j}"))
    df = spark.createDataFrame(
        rows, "migration_id string, batch_id string, chunk_id int, status string, attempt_number int, max_attempts int,"
        "started_at timestamp_ntz, source_catalog string, source_schema string, source_table string")
    return conform(df, CONTROL)


def by_id(df):
    return {r.migration_id: r for r in df.collect()}


def now():
    return ledger.lit_time(NOW)


def test_stale_needs_more_than_two_whole_hours(control):
    stale = {r.migration_id for r in ledger.stale(control, now()).collect()}
    assert stale == {f"{s}-{a}-{j}" for s in ("ASSIGNED", "IN_PROGRESS") for a in (0, 2, 3) for j in (0, 2)}
    after = by_id(ledger.reconcile_stale(control, now(), batch_id="b1"))
    changed = {i for i, r in after.items() if r.error_code == "STALE_EXECUTION"}
    assert changed == {i for i in stale if not i.endswith("-2")}
    assert all(after[i].status == "RETRY_PENDING" for i in changed)


def test_119_minutes_59_seconds_is_not_stale(spark, control):
    edge = control.limit(1).withColumns({"status": F.lit("ASSIGNED"), "started_at": F.lit("2025-03-01 09:59:01").cast("timestamp_ntz")})
    assert ledger.stale(edge, now()).count() == 0  # 120 min 59 s
    edge = edge.withColumn("started_at", F.lit("2025-03-01 09:59:00").cast("timestamp_ntz"))
    assert ledger.stale(edge, now()).count() == 1


def test_retry(control):
    coded = control.withColumn("error_code", F.when(F.col("migration_id").endswith("-1"), "permission_denied"))
    after, disposition = ledger.retry_run(coded, now())
    rows, actions = by_id(after), by_id(disposition)
    for status in ("FAILED", "RETRY_PENDING", "VALIDATION_FAILED"):
        assert rows[f"{status}-2-0"].status == "QUEUED"
        assert rows[f"{status}-2-0"].attempt_number == 2
        assert actions[f"{status}-2-0"].backoff_seconds == 60
        assert actions[f"{status}-0-0"].backoff_seconds == 0
        assert rows[f"{status}-3-0"].status == "FAILED_PERMANENT"
        assert rows[f"{status}-3-0"].error_message == "Max attempts (3) exhausted"
        assert rows[f"{status}-0-1"].error_message == "Non-retryable error: PERMISSION_DENIED"
    assert rows["FAILED_PERMANENT-0-0"].status == "FAILED_PERMANENT"
    assert rows["COMPLETED-0-0"].status == "COMPLETED"
    assert set(actions) == {i for i in rows if i.rsplit("-", 2)[0] in ("FAILED", "RETRY_PENDING", "VALIDATION_FAILED")}
    stats = ledger.retry_stats(coded, disposition).first()
    assert (stats.eligible, stats.requeued, stats.permanent, stats.reset_permanent) == (27, 12, 15, 0)


def test_reset_permanent_is_scoped_and_not_killed_again(control):
    coded = control.withColumn("error_code", F.lit("PERMISSION_DENIED"))
    after, disposition = ledger.retry_run(coded, now(), batch_id="b2", reset_permanents=True)
    rows = by_id(after)
    assert rows["FAILED_PERMANENT-3-2"].status == "QUEUED"
    assert rows["FAILED_PERMANENT-3-2"].attempt_number == 0
    assert rows["FAILED_PERMANENT-3-1"].status == "FAILED_PERMANENT"
    assert rows["FAILED-0-0"].status == "FAILED"
    assert ledger.retry_stats(coded, disposition, "b2", True).first().reset_permanent == 3


def test_outcomes_only_touch_rows_in_progress(spark, control):
    ids = [r.migration_id for r in control.select("migration_id").collect()]
    out = spark.createDataFrame(
        [(i, n % 2 == 0, 5, 1, 0, None, None if n % 2 == 0 else "CLONE_FAILED", "x" * 600) for n, i in enumerate(ids)],
        "migration_id string, success boolean, duration_seconds long, target_num_files long, target_version long,"
        "source_version long, error_code string, error_message string")
    known = control.withColumn("source_version", F.lit(7).cast("long"))
    rows = by_id(ledger.apply_outcomes(known, out, now()))
    before = by_id(known)
    for i, r in rows.items():
        if before[i].status != "IN_PROGRESS":
            assert r == before[i]
        elif r.status == "COMPLETED":
            assert (r.target_version, r.source_version, r.error_code) == (0, 7, None)
        else:
            assert r.status == ("RETRY_PENDING" if r.attempt_number < 3 else "FAILED")
            assert len(r.error_message) == 500


def test_validation_keeps_counts_that_were_not_taken(spark, control):
    counted = control.withColumn("source_row_count", F.lit(9).cast("long"))
    out = spark.createDataFrame(
        [("COMPLETED-0-0", "VALIDATED", "m" * 1200, None, 4), ("QUEUED-0-0", "VALIDATED", "m", 1, 1)],
        "migration_id string, status string, message string, source_row_count long, target_row_count long")
    rows = by_id(ledger.apply_validation(counted, out, now()))
    row = rows["COMPLETED-0-0"]
    assert (row.status, row.validation_status, row.source_row_count, row.target_row_count) == ("VALIDATED", "VALIDATED", 9, 4)
    assert len(row.validation_message) == 1000
    assert rows["QUEUED-0-0"].status == "QUEUED"


def test_submit_failure(control):
    after, log = ledger.submit_failed(control, "b1", 1, "no cluster", "r9", now())
    rows, attempts = by_id(after), by_id(log)
    assert rows["QUEUED-0-1"].status == "RETRY_PENDING"
    assert rows["ASSIGNED-2-1"].status == "FAILED"
    assert rows["QUEUED-0-2"].status == "QUEUED"
    assert attempts["QUEUED-0-1"].attempt_number == 1
    assert {r.error_code for r in attempts.values()} == {"SUBMIT_FAILED"}


def test_merge_rejects_two_changes_for_one_key(spark, control):
    twice = spark.createDataFrame([("QUEUED-0-0", 1), ("QUEUED-0-0", 2)], "migration_id string, chunk_id int")
    with pytest.raises(Exception, match="more than one change row for key QUEUED-0-0"):
        ledger.assign_chunks(control, twice, now()).collect()


def test_merge_keys(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v int")
    out = merge.merge(old, new, ["k"], {"v": F.col("s.v")}, {"k": F.col("s.k"), "v": F.col("s.v")})
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("a", 1), ("b", 20), ("c", 30), (None, 3), (None, 40)], key=repr)
    kept = merge.merge(old, new, ["k"], {"v": F.col("s.v")})
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([("a", 1), ("b", 20), (None, 3)], key=repr)


def selections(spark, names):
    return spark.createDataFrame([("c", "s", n, "d", "s", n) for n in names],
                                 "source_catalog string, source_schema string, source_table string,"
                                 "target_catalog string, target_schema string, target_table string")


def test_onboarding_many_rows_is_idempotent_and_isolated(spark):
    empty = schemas.empty(spark, CONTROL)
    sel = selections(spark, [f"t{i}" for i in range(250)])
    first = inventory.upsert_inventory(
        empty, inventory.inventory_outcomes(sel, empty, "b1"), "b1", "r1", "delta_share", now())
    rows = first.collect()
    assert len(rows) == 250 == len({r.migration_id for r in rows})
    assert {(r.status, r.workload_class, r.workload_weight, r.size_in_bytes, r.size_gb) for r in rows} == {("QUEUED", "UNKNOWN", 0, None, None)}
    done = first.withColumn("status", F.lit("VALIDATED"))
    again = inventory.inventory_outcomes(sel, done, "b1")
    assert {r.outcome for r in again.collect()} == {"ALREADY_DONE"}
    same = inventory.upsert_inventory(done, again, "b1", "r2", "delta_share", now())
    assert sorted(same.collect()) == sorted(done.collect())
    other = inventory.upsert_inventory(
        done, inventory.inventory_outcomes(sel, done, "b2"), "b2", "r3", "delta_share", now())
    assert sorted(other.where("batch_id = 'b1'").collect()) == sorted(done.collect())
    assert other.where("batch_id = 'b2'").count() == 250
    forced = inventory.inventory_outcomes(sel, done, "b1", force=True)
    rows = inventory.upsert_inventory(done, forced, "b1", "r4", "direct_adls", now()).collect()
    assert {(r.status, r.clone_type, r.run_id) for r in rows} == {("QUEUED", "direct_adls", "r4")}
    assert {r.migration_id for r in rows} == {r.migration_id for r in done.collect()}


def test_work_in_flight_is_not_onboarded_again(spark):
    empty = schemas.empty(spark, CONTROL)
    sel = selections(spark, ["t"])
    row = inventory.upsert_inventory(empty, inventory.inventory_outcomes(sel, empty, "b"), "b", "r", "x", now())
    for status, want in (("IN_PROGRESS", "ALREADY_DONE"), ("ASSIGNED", "ALREADY_DONE"), ("PO_BLOCKED", "QUEUED"),
                         ("FAILED", "QUEUED"), ("FAILED_PERMANENT", "ALREADY_DONE"), ("SKIPPED", "ALREADY_DONE")):
        out = inventory.inventory_outcomes(sel, row.withColumn("status", F.lit(status)), "b")
        assert out.first().outcome == want, status


def test_target_must_exist(spark):
    empty = schemas.empty(spark, CONTROL)
    sel = selections(spark, ["here", "gone"])
    there = spark.createDataFrame([("d", "s", "here", "MANAGED")], "table_catalog string, table_schema string, table_name string, table_type string")
    out = {r.source_table: r for r in inventory.inventory_outcomes(sel, empty, "b", target_listing=there, require_target=True).collect()}
    assert (out["here"].outcome, out["gone"].outcome, out["gone"].error_code) == ("QUEUED", "SKIPPED", "TARGET_NOT_PRECREATED")
    with pytest.raises(ValueError):
        inventory.inventory_outcomes(sel, empty, "b", require_target=True)


GATE = [
    # table, schema, catalog values ("-": no such object), type of the target, verdict
    ("ENABLE", "-", "-", "MANAGED", (True, "ENABLE", "TABLE", "PREDICTIVE_OPTIMIZATION_ENABLED")),
    ("INHERIT", "ENABLE", "-", "MANAGED", (True, "ENABLE", "SCHEMA", "PREDICTIVE_OPTIMIZATION_ENABLED")),
    ("INHERIT", "INHERIT", "ENABLE", "MANAGED", (True, "ENABLE", "CATALOG", "PREDICTIVE_OPTIMIZATION_ENABLED")),
    ("DISABLE", "ENABLE", "ENABLE", "MANAGED", (False, "DISABLE", None, "")),
    ("INHERIT", "DISABLE", "ENABLE", "MANAGED", (False, "DISABLE", None, "")),
    ("INHERIT", "INHERIT", "INHERIT", "MANAGED", (False, "DISABLE", None, "")),
    ("-", "-", "-", None, (False, None, None, "PREDICTIVE_OPTIMIZATION_SKIPPED")),
    (None, None, None, "MANAGED", (False, None, None, "PREDICTIVE_OPTIMIZATION_UNKNOWN")),
    ("ENABLE", "-", "-", "EXTERNAL", (False, None, None, "PREDICTIVE_OPTIMIZATION_SKIPPED")),
    ("ENABLE", "-", "-", "FOREIGN", (False, None, None, "PREDICTIVE_OPTIMIZATION_SKIPPED")),
    ("-", "ENABLE", "-", None, (True, "ENABLE", "SCHEMA", "PREDICTIVE_OPTIMIZATION_ENABLED")),
    ("-", "-", "ENABLE", None, (True, "ENABLE", "CATALOG", "PREDICTIVE_OPTIMIZATION_ENABLED")),
    ("-", "DISABLE", "ENABLE", None, (False, "DISABLE", None, "")),
]


@pytest.mark.parametrize("case", GATE, ids=[str(i) for i in range(len(GATE))])
def test_gate(spark, case):
    *values, kind, want = case
    names = ("d.s.t", "d.s", "d")
    rows = [(lv, n, v) for lv, n, v in zip(("table", "schema", "catalog"), names, values) if v != "-"]
    settings = spark.createDataFrame(rows, "level string, fqn string, value string")
    target = spark.createDataFrame([("d", "s", "t", kind)], "target_catalog string, target_schema string, target_table string, target_type string")
    out = inventory.gate_verdicts(target, settings).first()
    assert (out.gate_blocked, out.gate_value, out.gate_level, out.gate_code) == want
    strict = inventory.gate_verdicts(target, settings, unknown="block").first()
    assert strict.gate_blocked == (want[0] or want[3].endswith("UNKNOWN"))


def test_illegal_transitions_across_slices(spark):
    log = [("m", 1, "2025-01-01 00:59:59", "QUEUED"), ("m", 2, "2025-01-01 01:00:00", "ASSIGNED"),
           ("m", 3, "2025-01-01 05:00:00", "ASSIGNED"), ("m", 4, "2025-01-01 05:00:00", "COMPLETED"),
           ("m", 5, "2025-01-02 00:00:00", "QUEUED"), ("n", 6, "2025-01-01 00:00:00", "VALIDATED")]
    df = spark.createDataFrame(log, "migration_id string, seq long, changed_at string, status string")
    out = ledger.illegal_transitions(df.withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz")))
    assert sorted((r.seq, r.from_status, r.to_status) for r in out.collect()) == [
        (4, "ASSIGNED", "COMPLETED"), (5, "COMPLETED", "QUEUED")]


def test_additive_columns(spark):
    df = spark.createDataFrame([(1,)], "migration_id int")
    once = schemas.add_columns(df, schemas.ATTEMPTS)
    assert once.columns == schemas.add_columns(once, schemas.ATTEMPTS).columns
    assert once.schema["migration_id"].dataType.simpleString() == "int"


def test_requests(spark):
    names = spark.createDataFrame([("c.s.t1",), ("c.s.t2",)], "fqn string")
    rows = requests.new_requests(names, "table", "refresh", "path_resolution", "dr", "me", now(), 1, validation_mode="ALL", tags={"team": "ops"})
    assert rows.columns == REQUESTS.fieldNames()
    first = rows.collect()[0]
    assert (first.src_catalog, first.src_schema, first.tgt_schema, first.tags) == ("c", "s", "s", {"team": "ops"})
    assert requests.validation_plan(rows).count() == 6
    claimed = requests.claim(rows, "e1", now())
    assert requests.eligible(claimed, now()).count() == 0
    outcome = claimed.select("onboarding_id", F.lit("FAILED").alias("status"))
    failed = requests.finish(claimed, outcome, now())
    assert {r.status for r in failed.collect()} == {"FAILED"}
    back = requests.requeue(failed, [failed.first().onboarding_id], now())
    assert sorted(r.status for r in back.collect()) == ["FAILED", "PENDING"]
    stuck = requests.reset_stuck(claimed, ledger.lit_time("2025-03-04 00:00:00"))
    assert {(r.status, r.execution_id) for r in stuck.collect()} == {("PENDING", None)}
    with pytest.raises(ValueError):
        requests.new_requests(names, "table", "x", "y", "dr", "me", now(), validation_mode="SOME")


def test_remap_longest_prefix_wins(spark):
    tables = spark.createDataFrame([("a://x/y/1",), ("a://x/z",), ("b://q",), (None,)], "location string")
    prefixes = spark.createDataFrame([("a://x", "t://1"), ("a://x/y", "t://2")], "src_prefix string, tgt_prefix string")
    got = {r.location: (r.target_location, r.unmapped) for r in requests.remap_locations(tables, prefixes).collect()}
    assert got == {"a://x/y/1": ("t://2/1", False), "a://x/z": ("t://1/z", False), "b://q": (None, True), None: (None, False)}
