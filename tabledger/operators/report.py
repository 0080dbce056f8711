"""Progress, failure, throughput and audit reports.

Sizes are summed as bytes and turned into gibibytes once. Top lists end their
sort with an id, so equal rows always come in the same order. Hour and day
series are aggregated before any window runs over them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sizing import GIB, percent, workload_class
from ..sources.schemas import ACTIVE, DONE, FAILED, STATUSES


def _gib_sum(name: str = "size_in_bytes", digits: int | None = 2, when: Column | None = None) -> Column:
    value = F.col(name) if when is None else F.when(when, F.col(name))
    total = F.coalesce(F.sum(value), F.lit(0)) / F.lit(float(GIB))
    return F.round(total, digits) if digits is not None else total


def _status(*states: str) -> Column:
    return F.col("status").isin(*states)


def hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def cross_filter(
    control: DataFrame,
    batches: Sequence[str] | None = None,
    statuses: Sequence[str] | None = None,
    clone_types: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that pass every filter that is given."""
    for column, values in (("batch_id", batches), ("status", statuses), ("clone_type", clone_types)):
        if values is not None:
            control = control.where(F.col(column).isin(*values))
    return control


# -- the control table ---------------------------------------------------------


def row_count_status(control: DataFrame) -> DataFrame:
    """Adds NOT CHECKED, MATCH or MISMATCH."""
    s, t = F.col("source_row_count"), F.col("target_row_count")
    status = F.when(s.isNull() | t.isNull(), "NOT CHECKED").when(s == t, "MATCH").otherwise("MISMATCH")
    return control.withColumn("row_count_status", status)


def kpis(control: DataFrame) -> DataFrame:
    done = F.count_if(_status(*DONE))
    return control.agg(
        F.count("*").alias("total_tables"),
        done.alias("done_tables"),
        F.count_if(_status(*ACTIVE)).alias("active_tables"),
        F.count_if(_status("QUEUED")).alias("queued_tables"),
        F.count_if(_status(*FAILED)).alias("failed_tables"),
        percent(done, F.count("*")).alias("pct_complete"),
        _gib_sum().alias("total_gb"),
        _gib_sum(when=_status(*DONE)).alias("gb_done"),
    )


def _finished(control: DataFrame) -> DataFrame:
    return control.where(_status(*DONE) & F.col("completed_at").isNotNull())


def cumulative_done(control: DataFrame) -> DataFrame:
    """Running total of finished tables by hour.

    The hours are few, so the unpartitioned window runs over a small aggregate.
    """
    hours = _finished(control).groupBy(hour(F.col("completed_at")).alias("hour")).agg(F.count("*").alias("n"))
    running = Window.orderBy("hour").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return hours.select("hour", F.sum("n").over(running).alias("cumulative_done"))


def hourly_throughput(control: DataFrame) -> DataFrame:
    return (
        _finished(control)
        .groupBy(hour(F.col("completed_at")).alias("hour"))
        .agg(
            F.count("*").alias("tables_done"),
            _gib_sum().alias("gb_done"),
            F.round(F.avg("duration_seconds"), 1).alias("avg_duration_s"),
        )
    )


def fail_codes(control: DataFrame) -> DataFrame:
    return (
        control.where(_status(*FAILED))
        .groupBy(F.coalesce("error_code", F.lit("(none)")).alias("error_code"))
        .agg(F.count("*").alias("n"))
    )


def failed_rows(control: DataFrame) -> DataFrame:
    return control.where(_status(*FAILED)).orderBy(F.col("updated_at").desc(), "migration_id")


def recent_failures(control: DataFrame, top: int = 500) -> DataFrame:
    return failed_rows(control).limit(top)


def count_mismatches(control: DataFrame, top: int = 500) -> DataFrame:
    return (
        control.where(F.col("source_row_count") != F.col("target_row_count"))
        .orderBy(F.col("updated_at").desc(), "migration_id")
        .limit(top)
    )


def longest_copies(control: DataFrame, top: int = 50) -> DataFrame:
    return (
        control.where(F.col("duration_seconds").isNotNull())
        .orderBy(F.col("duration_seconds").desc(), "migration_id")
        .limit(top)
    )


def chunk_fanout(control: DataFrame) -> DataFrame:
    return (
        control.where(F.col("chunk_id").isNotNull())
        .groupBy("batch_id", "chunk_id")
        .agg(F.count("*").alias("tables"), _gib_sum().alias("gb"), F.count_if(_status(*DONE)).alias("done"))
    )


def status_totals(control: DataFrame, batch_id: str = "") -> DataFrame:
    rows = control.where(F.col("batch_id") == batch_id) if batch_id else control
    return rows.groupBy("status").agg(F.count("*").alias("n"), _gib_sum(digits=None).alias("total_gb"))


def class_totals(control: DataFrame) -> DataFrame:
    """Tables and size per workload class; the class follows from the size where the row has none."""
    return (
        _with_class(control)
        .groupBy("workload_class")
        .agg(F.count("*").alias("n"), _gib_sum(digits=None).alias("total_gb"))
    )


def _with_class(control: DataFrame) -> DataFrame:
    if "workload_class" in control.columns:
        return control
    return control.withColumn("workload_class", workload_class(F.col("size_in_bytes")))


def status_by_batch(control: DataFrame) -> DataFrame:
    """One row per batch, one column per state."""
    return control.groupBy("batch_id").agg(*[F.count_if(_status(s)).alias(s.lower()) for s in STATUSES])


def type_split(control: DataFrame) -> DataFrame:
    return control.groupBy("clone_type").agg(F.count("*").alias("tables"))


def avg_duration_by_class(control: DataFrame) -> DataFrame:
    return _with_class(control).groupBy("workload_class").agg(
        F.sum("duration_seconds").alias("total_seconds"),
        F.count("duration_seconds").alias("timed_tables"),
        F.avg("duration_seconds").alias("avg_duration_s"),
    )


def attempt_distribution(control: DataFrame) -> DataFrame:
    return control.groupBy("attempt_number").agg(F.count("*").alias("tables"))


def validation_split(control: DataFrame) -> DataFrame:
    return control.groupBy("validation_status").agg(F.count("*").alias("tables"))


def count_outcomes(control: DataFrame) -> DataFrame:
    return row_count_status(control).groupBy("row_count_status").agg(F.count("*").alias("tables"))


def size_histogram(control: DataFrame, width_gb: int = 100) -> DataFrame:
    """Tables per size bucket; a bucket is named by its lower bound."""
    bucket = F.floor(F.col("size_in_bytes") / F.lit(float(width_gb * GIB))) * F.lit(width_gb)
    return control.groupBy(bucket.cast("bigint").alias("from_gb")).agg(F.count("*").alias("tables"))


# The datasets of the reporting set over the control table: what each is grouped by.
REPORTING_SETS = {
    "kpis": (),
    "status_totals": ("status",),
    "class_totals": ("workload_class",),
    "status_by_batch": ("batch_id", "status"),
    "type_split": ("clone_type",),
    "attempt_distribution": ("attempt_number",),
    "validation_split": ("validation_status",),
    "count_outcomes": ("row_count_status",),
    "size_histogram": ("from_gb",),
    "chunk_fanout": ("batch_id", "chunk_id"),
    "batch_summary": ("batch_id", "chunk_id", "status"),
    "fail_codes": ("failed", "error_code"),
    "hourly_throughput": ("done", "completed_hour"),
}
NO_KEY = "(none)"


def reporting_set(control: DataFrame, width_gb: int = 100) -> DataFrame:
    """All groupings of the reporting set from one scan: ``dataset``, ``key`` (its key values joined by |), and the measures
    ``tables``, ``done_tables``, ``total_bytes``, ``total_seconds`` and ``timed_tables``.

    Rows are folded in every task before anything is shuffled; what is shuffled
    are groups, not tables. A key that is null reads (none). Failure codes are
    those of failed tables, hours those of finished ones.
    """
    columns = sorted({c for keys in REPORTING_SETS.values() for c in keys})
    rows = row_count_status(_with_class(control)).withColumns({
        "from_gb": (F.floor(F.col("size_in_bytes") / F.lit(float(width_gb * GIB))) * F.lit(width_gb)).cast("bigint"),
        "done": _status(*DONE), "failed": _status(*FAILED), "completed_hour": hour(F.col("completed_at")),
    }).select(*columns, F.col("done").alias("_is_done"), "size_in_bytes", "duration_seconds")
    grouped = rows.groupingSets([[F.col(c) for c in keys] for keys in REPORTING_SETS.values()], *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("tables"), F.count_if(F.col("_is_done")).alias("done_tables"),
        F.coalesce(F.sum("size_in_bytes"), F.lit(0)).alias("total_bytes"), F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("total_seconds"),
        F.count("duration_seconds").alias("timed_tables"))
    # a set's number has a one for every column that it leaves out, the last column lowest
    number = {name: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in keys) for name, keys in REPORTING_SETS.items()}
    named = F.create_map(*[x for name, n in number.items() for x in (F.lit(n).cast("bigint"), F.lit(name))])
    shown = {name: [k for k in keys if k not in ("done", "failed")] for name, keys in REPORTING_SETS.items()}
    text = F.lit("")
    for name, keys in shown.items():
        own = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit(NO_KEY)) for k in keys]) if keys else F.lit("")
        text = F.when(F.col("dataset") == name, own).otherwise(text)
    chosen = ((F.col("dataset") != "fail_codes") | F.col("failed")) & ((F.col("dataset") != "hourly_throughput") | (F.col("done") & F.col("completed_hour").isNotNull()))
    chosen = chosen & ((F.col("dataset") != "chunk_fanout") | F.col("chunk_id").isNotNull())
    return grouped.withColumn("dataset", F.element_at(named, F.col("_set").cast("bigint"))).where(chosen).select(
        "dataset", text.alias("key"), "tables", "done_tables", "total_bytes", "total_seconds", "timed_tables")


def batch_summary(control: DataFrame, batch_id: str = "") -> DataFrame:
    rows = control.where(F.col("batch_id") == batch_id) if batch_id else control
    keys = ["chunk_id", "status"] if batch_id else ["batch_id", "chunk_id", "status"]
    return rows.groupBy(*keys).agg(
        F.count("*").alias("tables"), _gib_sum().alias("total_gb"), F.avg("duration_seconds").alias("avg_duration_s")
    )


def run_metrics(control: DataFrame, batch_id: str = "") -> DataFrame:
    """One row: tables in every state, bytes and seconds."""
    rows = control.where(F.col("batch_id") == batch_id) if batch_id else control
    return rows.agg(
        F.count("*").alias("total"),
        *[F.count_if(_status(s)).alias(s.lower()) for s in STATUSES],
        F.coalesce(F.sum("size_in_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum(F.when(_status(*DONE), F.col("size_in_bytes"))), F.lit(0)).alias("bytes_done"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("total_duration_s"),
    )


def run_summary(metrics: DataFrame, tally: DataFrame | None = None, inventory: DataFrame | None = None, **labels: str) -> DataFrame:
    """One row for a finished run: metrics, row-count tally and labels such as mode and run_id.

    Inventory counts, when given, replace total, skipped, failed and queued.
    """
    parts = [metrics]
    if tally is not None:
        parts.append(tally)
    if inventory is not None:
        shown = {"total": "total", "skipped": "skipped", "failed": "failed", "queued": "inserted"}
        parts[0] = metrics.drop(*shown)
        parts.append(inventory.select(*[F.col(v).alias(k) for k, v in shown.items()]))
    out = single_row(*parts)
    if tally is None:
        out = out.withColumns({f"row_count_{x}": F.lit(0).cast("bigint") for x in ("checked", "matched", "mismatched")})
    return out.select(*[F.lit(v).alias(k) for k, v in labels.items()], "*")


def single_row(*parts: DataFrame) -> DataFrame:
    """The columns of several one-row frames in one row, without a join."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def signoff_rows(control: DataFrame, batch_id: str = "") -> DataFrame:
    """Queued rows as shown for sign-off."""
    rows = control.where(F.col("batch_id") == batch_id) if batch_id else control
    return rows.where(_status("QUEUED")).orderBy("chunk_id", F.col("size_in_bytes").desc_nulls_last(), "migration_id")


def table_snapshot(control: DataFrame, batch_id: str = "") -> DataFrame:
    """Final state per table with minutes of copy time."""
    rows = control.where(F.col("batch_id") == batch_id) if batch_id else control
    return rows.select(
        "migration_id", "batch_id", "source_schema", "source_table", "status",
        F.round(F.col("duration_seconds") / F.lit(60.0), 1).alias("duration_min"),
        "source_row_count", "target_row_count", "validation_status",
    )


# -- attempts, validations, exclusions -----------------------------------------


def _daily(log: DataFrame, ts: str) -> DataFrame:
    return log.groupBy(F.to_date(ts).alias("day"), F.coalesce("status", F.lit("(unknown)")).alias("status")).agg(
        F.count("*").alias("n")
    )


def attempts_daily(attempts: DataFrame) -> DataFrame:
    return _daily(attempts, "created_at")


def validations_daily(history: DataFrame) -> DataFrame:
    return _daily(history, "validated_at")


def validation_listing(history: DataFrame, batch_id: str = "") -> DataFrame:
    """Every validation attempt, latest first."""
    rows = history.where(F.col("batch_id") == batch_id) if batch_id else history
    return rows.orderBy(F.col("validated_at").desc(), "migration_id")


def exclusion_listing(exclusions: DataFrame, batch_id: str = "", top: int | None = None) -> DataFrame:
    """Excluded tables, latest first."""
    rows = exclusions.where(F.col("batch_id") == batch_id) if batch_id else exclusions
    rows = rows.orderBy(F.col("excluded_at").desc(), "source_catalog", "source_schema", "source_table")
    return rows.limit(top) if top is not None else rows


def exclusions_by_type(exclusions: DataFrame) -> DataFrame:
    return exclusions.groupBy("exclusion_type").agg(F.count("*").alias("n"))


def reconcile_onboarding(control: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Onboarded and excluded tables per batch, side by side."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        return df.select("batch_id", *[(one if name == c else zero).alias(c) for c in ("onboarded", "excluded")])

    both = counted(control, "onboarded").unionByName(counted(exclusions, "excluded"))
    return both.groupBy("batch_id").agg(F.sum("onboarded").alias("onboarded"), F.sum("excluded").alias("excluded"))


# -- the copy audit ------------------------------------------------------------


def _success() -> Column:
    return F.count_if(_status("SUCCESS"))


def _audit_failed() -> Column:
    return F.count_if(_status("FAILED"))


def of_execution(audit: DataFrame, execution_id: str = "") -> DataFrame:
    return audit.where(F.col("execution_id") == execution_id) if execution_id else audit


def cluster_breakdown(audit: DataFrame, execution_id: str = "") -> DataFrame:
    end = "end_time" if "end_time" in audit.columns else "run_timestamp"
    start = "start_time" if "start_time" in audit.columns else "run_timestamp"
    return of_execution(audit, execution_id).groupBy("cluster_id").agg(
        F.count("*").alias("tables_assigned"), _success().alias("done"), _audit_failed().alias("failed"),
        F.min(start).alias("started_at"), F.max(end).alias("last_update"),
    )


def live_progress(audit: DataFrame, execution_id: str = "") -> DataFrame:
    return of_execution(audit, execution_id).groupBy("status").agg(
        F.count("*").alias("table_count"),
        F.sum("records_cloned").alias("total_records"),
        (F.sum("size_bytes") / F.lit(1e9)).alias("total_gb"),
        F.round(F.avg("duration_seconds") / F.lit(60.0), 1).alias("avg_duration_min"),
    )


def execution_summary(audit: DataFrame, execution_id: str = "") -> DataFrame:
    return of_execution(audit, execution_id).agg(
        F.count("*").alias("total_tables"), _success().alias("succeeded"), _audit_failed().alias("failed"),
        F.sum("records_cloned").alias("total_records"),
        F.round(F.sum("size_bytes") / F.lit(1e9), 2).alias("total_gb"),
        F.round(F.avg("duration_seconds") / F.lit(60.0), 1).alias("avg_min_per_table"),
    )


def failed_tables(audit: DataFrame, execution_id: str = "") -> DataFrame:
    return of_execution(audit, execution_id).where(_status("FAILED"))


def execution_trend(audit: DataFrame) -> DataFrame:
    return audit.groupBy(F.to_date("run_timestamp").alias("run_date"), "execution_id").agg(
        F.count("*").alias("total_tables"),
        (F.sum("size_bytes") / F.lit(1e9)).alias("total_gb"),
        _audit_failed().alias("failures"),
    )


def execution_performance(audit: DataFrame, top: int = 10) -> DataFrame:
    """The latest executions with their outcome."""
    aggs = [
        F.count("*").alias("tables_attempted"), _success().alias("success"), _audit_failed().alias("failed"),
        F.round(F.sum("size_bytes") / F.lit(float(GIB)), 3).alias("total_gb"),
        F.sum("duration_seconds").alias("total_seconds"),
        F.min("run_timestamp").alias("started_at"),
    ]
    if "validation_status" in audit.columns:
        aggs += [
            F.count_if(F.col("validation_status") == "PASS").alias("val_pass"),
            F.count_if(F.col("validation_status") == "FAIL").alias("val_fail"),
        ]
    grouped = audit.groupBy("execution_id").agg(*aggs)
    return grouped.orderBy(F.col("started_at").desc(), "execution_id").limit(top)


def latest_execution(audit: DataFrame) -> DataFrame:
    """One row: the execution of the latest audit row."""
    latest = F.max_by("execution_id", F.struct("run_timestamp", "execution_id"))
    return audit.agg(latest.alias("execution_id"))


def latest_results(audit: DataFrame) -> DataFrame:
    """Rows of the latest execution, with throughput in MB/s."""
    rows = audit.where(F.col("execution_id") == latest_execution(audit).scalar())
    rate = F.round(F.col("size_bytes") / F.lit(1e6) / F.nullif(F.col("duration_seconds"), F.lit(0)), 3)
    return rows.withColumn("throughput_mbps", rate)
