"""Reading the control table and moving its rows from state to state.

Every write takes the current snapshot and returns the next one. ``now`` is an
argument, so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sizing import backoff_seconds, whole_minutes
from ..functions.text import ERROR_CODE_CHARS, ERROR_MESSAGE_CHARS, VALIDATION_MESSAGE_CHARS, cut
from ..sources.schemas import ACTIVE, ALLOWED_EDGES, ATTEMPTS, PERMANENT_ERROR_CODES, RETRYABLE, conform
from .merge import merge, update_where


# Texts stored with a state change.
STALE_TEXT = "Record was IN_PROGRESS/ASSIGNED beyond stale threshold; requeued"
RESET_TEXT = "Reset from FAILED_PERMANENT by retry_permanent=true"
PERMANENT_TEXT = "Non-retryable error: "
EXHAUSTED_TEXT = ("Max attempts (", ") exhausted")


def null() -> Column:
    return F.lit(None)


def in_batch(df: DataFrame, batch_id: str = "") -> DataFrame:
    """Rows of one batch; an empty id means all batches."""
    return df.where(F.col("batch_id") == batch_id) if batch_id else df


def batch_guard(batch_id: str) -> Column:
    return F.col("batch_id") == batch_id if batch_id else F.lit(True)


# -- reads ---------------------------------------------------------------------


def queued(control: DataFrame, batch_id: str = "", limit: int | None = None) -> DataFrame:
    """Queued rows, by group and then largest first; ``limit`` keeps the top rows."""
    rows = in_batch(control.where(F.col("status") == "QUEUED"), batch_id)
    order = [F.col("chunk_id").asc_nulls_first()]
    order += [F.col(c).desc_nulls_last() for c in ("workload_weight", "size_in_bytes") if c in control.columns]
    rows = rows.orderBy(*order, F.col("migration_id"))
    return rows.limit(limit) if limit is not None else rows


def chunk_rows(control: DataFrame, batch_id: str, chunk_id: int) -> DataFrame:
    return control.where(
        (F.col("batch_id") == batch_id)
        & (F.col("chunk_id") == chunk_id)
        & F.col("status").isin("QUEUED", "ASSIGNED", "IN_PROGRESS")
    )


def active_chunks(control: DataFrame, batch_id: str = "") -> DataFrame:
    """Distinct chunk ids that still have work; 0 and NULL are unassigned."""
    return (
        in_batch(control, batch_id)
        .where(F.col("status").isin("QUEUED", "ASSIGNED", "IN_PROGRESS") & (F.coalesce("chunk_id", F.lit(0)) != 0))
        .select("chunk_id")
        .distinct()
    )


def in_flight(control: DataFrame, batch_id: str = "") -> DataFrame:
    return in_batch(control, batch_id).where(F.col("status").isin(*ACTIVE))


def completed(control: DataFrame, batch_id: str = "", unvalidated_only: bool = False) -> DataFrame:
    rows = in_batch(control, batch_id).where(F.col("status") == "COMPLETED")
    if unvalidated_only:
        rows = rows.where(~F.col("validation_status").eqNullSafe("VALIDATED"))
    return rows


def retryable(control: DataFrame, batch_id: str = "") -> DataFrame:
    """Failed rows with attempts left."""
    return in_batch(control, batch_id).where(
        F.col("status").isin(*RETRYABLE) & (F.col("attempt_number") < F.col("max_attempts"))
    )


def unplanned(control: DataFrame) -> DataFrame:
    """Queued rows without a group."""
    return control.where((F.col("status") == "QUEUED") & (F.coalesce("chunk_id", F.lit(0)) == 0))


def stale_guard(now: Column, minutes: int) -> Column:
    return F.col("status").isin(*ACTIVE) & (
        F.col("started_at").isNull() | (whole_minutes(F.col("started_at"), now) > minutes)
    )


def stale(control: DataFrame, now: Column, minutes: int = 120, batch_id: str = "") -> DataFrame:
    return in_batch(control, batch_id).where(stale_guard(now, minutes))


def work_counts(control: DataFrame, now: Column, minutes: int = 120) -> DataFrame:
    """One row: how many rows are stale, can be retried, are queued, lack a group."""
    can_retry = F.col("status").isin(*RETRYABLE) & (F.col("attempt_number") < F.col("max_attempts"))
    is_queued = F.col("status") == "QUEUED"
    return control.agg(
        F.count_if(stale_guard(now, minutes)).alias("stale"),
        F.count_if(can_retry).alias("retryable"),
        F.count_if(is_queued).alias("queued"),
        F.count_if(is_queued & (F.coalesce("chunk_id", F.lit(0)) == 0)).alias("unplanned"),
    )


def attempt_history(attempts: DataFrame, control: DataFrame, source_table: str | None = None) -> DataFrame:
    """Attempts with the table they belong to."""
    tables = control.select("migration_id", "batch_id", "source_catalog", "source_schema", "source_table")
    if source_table is not None:
        tables = tables.where(F.col("source_table") == source_table)
    return attempts.join(tables, "migration_id")


def orphan_attempts(attempts: DataFrame, control: DataFrame) -> DataFrame:
    return attempts.join(control.select("migration_id"), "migration_id", "left_anti")


def kept_attempts(attempts: DataFrame, control: DataFrame) -> DataFrame:
    return attempts.join(control.select("migration_id"), "migration_id", "left_semi")


def previous_status(status_log: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Adds ``from_status``, the state before each row of the same table.

    The history of a table is cut into slices of time that are ordered side by
    side; the first row of a slice takes the last state of the slice before. A
    table that holds a third of the log is thus ordered by many tasks. Rows
    without a time are a slice of their own, before all others.
    """
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("changed_at").cast("timestamp_ntz"))
    rows = status_log.withColumn("slice", F.floor(seconds / F.lit(slice_seconds)))
    inside = Window.partitionBy("migration_id", "slice").orderBy("changed_at", "seq")
    ends = rows.groupBy("migration_id", "slice").agg(
        F.max_by("status", F.struct("changed_at", "seq")).alias("last")
    )
    slices = Window.partitionBy("migration_id").orderBy("slice")
    before = ends.select(
        F.col("migration_id").alias("_id"), F.col("slice").alias("_slice"), F.lag("last").over(slices).alias("before"))
    same = (F.col("migration_id") == F.col("_id")) & F.col("slice").eqNullSafe(F.col("_slice"))
    return (
        rows.withColumns({"prev": F.lag("status").over(inside), "rn": F.row_number().over(inside)})
        .join(before, same)
        .withColumn("from_status", F.when(F.col("rn") == 1, F.col("before")).otherwise(F.col("prev")))
        .drop("slice", "prev", "rn", "before", "_id", "_slice")
    )


def illegal_transitions(status_log: DataFrame) -> DataFrame:
    """Consecutive states of one table that no declared edge allows.

    Expects migration_id, seq, changed_at and status. Staying in a state is no
    transition.
    """
    edge = F.concat_ws(">", "from_status", "to_status")
    return (
        previous_status(status_log)
        .select("migration_id", "seq", "changed_at", "from_status", F.col("status").alias("to_status"))
        .where(F.col("from_status").isNotNull() & (F.col("from_status") != F.col("to_status")))
        .where(~edge.isin(*[f"{a}>{b}" for a, b in ALLOWED_EDGES]))
    )


# -- retry rules ---------------------------------------------------------------


def permanent_code(code: Column) -> Column:
    return F.coalesce(F.upper(code).isin(*PERMANENT_ERROR_CODES), F.lit(False))


def end_reason() -> Column:
    """Why a failed row is not tried again."""
    limit = F.coalesce("max_attempts", F.lit(3)).cast("string")
    exhausted = F.concat(F.lit(EXHAUSTED_TEXT[0]), limit, F.lit(EXHAUSTED_TEXT[1]))
    named = F.concat(F.lit(PERMANENT_TEXT), F.upper("error_code"))
    return F.when(permanent_code(F.col("error_code")), named).otherwise(exhausted)


def retry_disposition(control: DataFrame, now: Column, base_seconds: int = 30, batch_id: str = "") -> DataFrame:
    """What a retry run does with each failed row, and not before when."""
    attempt = F.coalesce("attempt_number", F.lit(0))
    action = (
        F.when(permanent_code(F.col("error_code")), "PERMANENT_CODE")
        .when(attempt >= F.coalesce("max_attempts", F.lit(3)), "EXHAUSTED")
        .otherwise("REQUEUE")
    )
    wait = backoff_seconds(attempt, base_seconds)
    reason = F.when(F.col("action") != "REQUEUE", end_reason())
    requeue = F.col("action") == "REQUEUE"
    return (
        in_batch(control, batch_id)
        .where(F.col("status").isin(*RETRYABLE))
        .withColumn("action", action)
        .withColumn("reason", reason)
        .withColumn("backoff_seconds", F.when(requeue, wait))
        .withColumn("not_before", F.when(requeue, now + F.make_dt_interval(secs=wait)))
    )


# -- state changes -------------------------------------------------------------


def mark_assigned(control: DataFrame, cluster_id: str, now: Column, batch_id: str, chunk_id: int) -> DataFrame:
    """QUEUED to ASSIGNED for one group."""
    guard = (F.col("status") == "QUEUED") & (F.col("batch_id") == batch_id) & (F.col("chunk_id") == chunk_id)
    return update_where(
        control, guard, {"status": F.lit("ASSIGNED"), "assigned_cluster_id": F.lit(cluster_id), "updated_at": now}
    )


def mark_in_progress(control: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """To IN_PROGRESS. ``changes``: migration_id, attempt_number, started_at."""
    return merge(
        control, changes, ["migration_id"],
        {
            "status": F.lit("IN_PROGRESS"), "attempt_number": F.col("s.attempt_number"),
            "started_at": F.col("s.started_at"), "updated_at": now,
        },
        guard=F.col("t.status").isin("ASSIGNED", "QUEUED", "IN_PROGRESS"),
    )


def next_failed_status(code: Column, attempt: Column, max_attempts: Column) -> Column:
    """Where a failed attempt leads: permanent codes end it, else attempts decide."""
    return (
        F.when(permanent_code(code), "FAILED_PERMANENT")
        .when(attempt < max_attempts, "RETRY_PENDING")
        .otherwise("FAILED")
    )


def apply_outcomes(control: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """IN_PROGRESS rows to COMPLETED or to a failure state, in one write.

    ``outcomes``: migration_id, success, duration_seconds, target_num_files,
    target_version, source_version, error_code, error_message. A known source
    version is never replaced by null(), and version 0 is a version.
    """
    ok = F.col("s.success")
    code = cut(F.coalesce("s.error_code", F.lit("CLONE_FAILED")), ERROR_CODE_CHARS)
    failed_status = next_failed_status(code, F.col("t.attempt_number"), F.col("t.max_attempts"))

    def either(when_ok: Column, when_failed: Column) -> Column:
        return F.when(ok, when_ok).otherwise(when_failed)

    return merge(
        control, outcomes, ["migration_id"],
        {
            "status": either(F.lit("COMPLETED"), failed_status),
            "completed_at": either(now, F.col("t.completed_at")),
            "failed_at": either(F.col("t.failed_at"), now),
            "duration_seconds": F.col("s.duration_seconds"),
            "target_num_files": either(F.col("s.target_num_files"), F.col("t.target_num_files")),
            "target_version": either(F.col("s.target_version"), F.col("t.target_version")),
            "source_version": either(F.coalesce("s.source_version", "t.source_version"), F.col("t.source_version")),
            "error_code": either(null(), code),
            "error_message": either(null(), cut(F.coalesce("s.error_message", F.lit("")), ERROR_MESSAGE_CHARS)),
            "updated_at": now,
        },
        guard=F.col("t.status") == "IN_PROGRESS",
    )


def mark_permanent(control: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """To FAILED_PERMANENT from any state. ``changes``: migration_id, reason."""
    return merge(
        control, changes, ["migration_id"],
        {
            "status": F.lit("FAILED_PERMANENT"),
            "error_message": cut(F.col("s.reason"), ERROR_MESSAGE_CHARS),
            "updated_at": now,
        },
    )


def apply_validation(control: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """COMPLETED to VALIDATED or VALIDATION_FAILED.

    ``outcomes``: migration_id, status, message, source_row_count,
    target_row_count. Counts that were not taken leave the earlier ones.
    """
    return merge(
        control, outcomes, ["migration_id"],
        {
            "status": F.col("s.status"), "validation_status": F.col("s.status"),
            "validation_message": cut(F.col("s.message"), VALIDATION_MESSAGE_CHARS),
            "source_row_count": F.coalesce("s.source_row_count", "t.source_row_count"),
            "target_row_count": F.coalesce("s.target_row_count", "t.target_row_count"),
            "updated_at": now,
        },
        guard=F.col("t.status") == "COMPLETED",
    )


def assign_chunks(control: DataFrame, chunks: DataFrame, now: Column) -> DataFrame:
    """Group ids onto QUEUED rows. ``chunks``: migration_id, chunk_id."""
    return merge(
        control, chunks, ["migration_id"], {"chunk_id": F.col("s.chunk_id"), "updated_at": now},
        guard=F.col("t.status") == "QUEUED",
    )


def requeue_failed(control: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """Failed rows back to QUEUED. The attempt is counted once, when it starts."""
    return merge(
        control, changes, ["migration_id"], {"status": F.lit("QUEUED"), "queued_at": now, "updated_at": now},
        guard=F.col("t.status").isin(*RETRYABLE),
    )


def reset_permanent(control: DataFrame, now: Column, batch_id: str = "") -> DataFrame:
    """FAILED_PERMANENT back to RETRY_PENDING with a fresh attempt budget."""
    return update_where(
        control, (F.col("status") == "FAILED_PERMANENT") & batch_guard(batch_id),
        {
            "status": F.lit("RETRY_PENDING"), "attempt_number": F.lit(0), "error_code": null(),
            "error_message": F.lit(RESET_TEXT), "updated_at": now,
        },
    )


def reconcile_stale(control: DataFrame, now: Column, minutes: int = 120, batch_id: str = "") -> DataFrame:
    """Rows that hang in ASSIGNED or IN_PROGRESS to RETRY_PENDING."""
    return update_where(
        control, stale_guard(now, minutes) & batch_guard(batch_id),
        {
            "status": F.lit("RETRY_PENDING"), "error_code": F.lit("STALE_EXECUTION"),
            "error_message": F.lit(STALE_TEXT),
            "updated_at": now,
        },
    )


def requeue_batch(control: DataFrame, batch_id: str, now: Column) -> DataFrame:
    """Every row of a batch back to QUEUED with its history kept."""
    return update_where(
        control, F.col("batch_id") == batch_id,
        {
            "status": F.lit("QUEUED"), "attempt_number": F.lit(0), "error_code": null(), "error_message": null(),
            "started_at": null(), "completed_at": null(), "failed_at": null(),
            "validation_status": null(), "validation_message": null(), "queued_at": now, "updated_at": now,
        },
    )


def delete_batch(control: DataFrame, batch_id: str) -> DataFrame:
    return control.where(~F.col("batch_id").eqNullSafe(batch_id))


def retry_run(
    control: DataFrame, now: Column, base_seconds: int = 30, batch_id: str = "", reset_permanents: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(next control, disposition)`` of one retry pass.

    The disposition is a function of the row alone, so the pass is a projection.
    """
    rows = reset_permanent(control, now, batch_id) if reset_permanents else control
    disposition = retry_disposition(rows, now, base_seconds, batch_id)
    failed = F.col("status").isin(*RETRYABLE) & batch_guard(batch_id)
    attempt = F.coalesce("attempt_number", F.lit(0))
    limit = F.coalesce("max_attempts", F.lit(3))
    code = permanent_code(F.col("error_code"))
    ends = code | (attempt >= limit)
    values = {
        "status": F.when(ends, "FAILED_PERMANENT").otherwise("QUEUED"),
        "error_message": F.when(ends, cut(end_reason(), ERROR_MESSAGE_CHARS)).otherwise(F.col("error_message")),
        "queued_at": F.when(ends, F.col("queued_at")).otherwise(now),
        "updated_at": now,
    }
    return update_where(rows, failed, values), disposition


def retry_stats(before: DataFrame, disposition: DataFrame, batch_id: str = "", reset_permanents: bool = False) -> DataFrame:
    """One row: eligible, requeued, permanent, reset_permanent."""
    reset = in_batch(before, batch_id).where((F.col("status") == "FAILED_PERMANENT") & F.lit(reset_permanents))
    counted = disposition.select("action").unionByName(reset.select(F.lit("RESET").alias("action")))
    return counted.agg(
        F.count_if(F.col("action") != "RESET").alias("eligible"),
        F.count_if(F.col("action") == "REQUEUE").alias("requeued"),
        F.count_if(F.col("action").isin("PERMANENT_CODE", "EXHAUSTED")).alias("permanent"),
        F.count_if(F.col("action") == "RESET").alias("reset_permanent"),
    )


def attempt_rows(control: DataFrame, outcomes: DataFrame, run_id: str, cluster_id: str, now: Column) -> DataFrame:
    """Attempt-log rows for finished copies; the attempt number is the current one."""
    rows = outcomes.alias("o").join(
        control.select("migration_id", "attempt_number", "size_in_bytes").alias("c"), "migration_id", "left"
    )
    failed = ~F.col("o.success")
    extra = set(outcomes.columns)
    return conform(
        rows.select(
            F.lit(run_id).alias("run_id"),
            "migration_id",
            F.coalesce("c.attempt_number", F.lit(1)).alias("attempt_number"),
            F.lit(cluster_id).alias("cluster_id"),
            F.substring(F.sha2(F.concat_ws("|", F.lit(run_id), "migration_id"), 256), 1, 8).alias("worker_id"),
            (F.col("o.started_at") if "started_at" in extra else now).alias("started_at"),
            now.alias("completed_at"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.when(failed, cut(F.coalesce("o.error_code", F.lit("CLONE_FAILED")), ERROR_CODE_CHARS)).alias("error_code"),
            F.when(failed, cut(F.col("o.error_message"), ERROR_MESSAGE_CHARS)).alias("error_message"),
            F.col("o.duration_seconds").alias("duration_seconds"),
            F.coalesce("c.size_in_bytes", F.lit(0)).alias("source_size_bytes"),
            (F.col("o.target_size_bytes") if "target_size_bytes" in extra else F.lit(0)).alias("target_size_bytes"),
            now.alias("created_at"),
            *[f"o.{c}" for c in ("source_version", "rows_copied", "content_checksum") if c in extra],
        ),
        ATTEMPTS,
    )


def submit_failed(
    control: DataFrame, batch_id: str, chunk_id: int, message: str, run_id: str, now: Column
) -> tuple[DataFrame, DataFrame]:
    """``(next control, attempt rows)`` when a whole group could not be started.

    Each row counts one attempt and fails with SUBMIT_FAILED.
    """
    rows = chunk_rows(control, batch_id, chunk_id)
    attempt = F.coalesce("attempt_number", F.lit(0)) + 1
    guard = (
        (F.col("batch_id") == batch_id)
        & (F.col("chunk_id") == chunk_id)
        & F.col("status").isin("QUEUED", "ASSIGNED", "IN_PROGRESS")
    )
    code = F.lit("SUBMIT_FAILED")
    after = update_where(
        control, guard,
        {
            "attempt_number": attempt, "started_at": now, "failed_at": now, "duration_seconds": F.lit(0),
            "status": next_failed_status(code, attempt, F.col("max_attempts")),
            "error_code": code, "error_message": cut(F.lit(message), ERROR_MESSAGE_CHARS), "updated_at": now,
        },
    )
    log = conform(
        rows.select(
            F.lit(run_id).alias("run_id"), "migration_id", attempt.alias("attempt_number"),
            F.lit("").alias("cluster_id"), now.alias("started_at"), now.alias("completed_at"),
            F.lit("FAILED").alias("status"), code.alias("error_code"),
            cut(F.lit(message), ERROR_MESSAGE_CHARS).alias("error_message"),
            F.lit(0).alias("duration_seconds"), F.lit(0).alias("source_size_bytes"),
            F.lit(0).alias("target_size_bytes"), now.alias("created_at"),
        ),
        ATTEMPTS,
    )
    return after, log


def lit_time(text: str) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


