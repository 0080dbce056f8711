"""Verdicts: from measured values to passed or failed, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import within_tolerance
from ..functions.text import VALIDATION_MESSAGE_CHARS, cut, quoted_fqn
from ..sources.schemas import VALIDATION_HISTORY, conform

# Allowed difference in percent.
SIZE_TOLERANCE_PCT = 1.0
FILE_TOLERANCE_PCT = 5.0

# Pass rate (percent) each acceptance check must reach.
REQUIRED_PASS_RATE = {
    "row_count_parity": 100.0,
    "schema_match": 100.0,
    "data_hash_integrity": 99.0,
    "table_type_preserved": 100.0,
    "partition_columns_match": 100.0,
    "audit_log_completeness": 100.0,
    "delta_table_valid": 100.0,
}


# Marks and texts of stored validation messages. {f} is the format that is required.
PASS_MARK, FAIL_MARK = "✓ ", "✗ "
LINE_SEPARATOR = " | "
SOURCE_GONE = "SOURCE_MISSING: source table not found after clone"
TARGET_GONE = "TARGET_MISSING: target table was not created"
NO_FILES = "Both source and target have 0 files (empty table)"
WRONG_FORMAT = " (expected {f})"
EMPTY_SOURCE = " (target non-zero when source is 0)"
WITHIN, BEYOND = " ✓", " ✗ EXCEEDS TOLERANCE"
UNVERSIONED = " (unversioned — live count; no source_version/target_version on record)"
COUNTS_DIFFER = " ✗ MISMATCH"


def _number(value: Column) -> Column:
    return F.format_number(value, 0)


def check_line(name: str, passed: Column, message: Column) -> Column:
    """One line of a validation message: mark, check, text."""
    return F.concat(F.when(passed, F.lit(PASS_MARK)).otherwise(F.lit(FAIL_MARK)), F.lit(f"{name}: "), message)


def metric_message(name: str, source: Column, target: Column, tolerance: float) -> Column:
    passed = within_tolerance(source, target, tolerance)
    both = [F.lit(f"{name} src="), _number(source), F.lit(" tgt="), _number(target)]
    diff = F.abs(source - target) / F.nullif(source, F.lit(0)) * 100.0
    return F.when(
        source == 0,
        F.concat(F.lit(f"{name} src=0 tgt="), target.cast("string"),
                 F.when(passed, "").otherwise(EMPTY_SOURCE)),
    ).otherwise(
        F.concat(*both, F.lit(" diff="), F.format_string("%.2f", diff), F.lit(f"% (tol={tolerance}%)"),
                 F.when(passed, WITHIN).otherwise(BEYOND))
    )


def row_count_message(source: Column, target: Column, source_version: Column, target_version: Column) -> Column:
    def version(v: Column) -> Column:
        return F.coalesce(v.cast("string"), F.lit("None"))

    unversioned = source_version.isNull() & target_version.isNull()
    note = F.when(unversioned, UNVERSIONED).otherwise(
        F.concat(F.lit(" (src@v"), version(source_version), F.lit(", tgt@v"), version(target_version), F.lit(")"))
    )
    return F.concat(
        F.lit("row_count src="), _number(source), F.lit(" tgt="), _number(target), note,
        F.when(source == target, "").otherwise(COUNTS_DIFFER),
    )


def tolerance_check(pairs: DataFrame, name: str, source: str, target: str, tolerance_pct: float) -> DataFrame:
    """Adds passed and message for one measured value of both sides."""
    s, t = F.col(source), F.col(target)
    return pairs.withColumns(
        {"passed": within_tolerance(s, t, tolerance_pct), "message": metric_message(name, s, t, tolerance_pct)}
    )


def validation_verdicts(
    records: DataFrame,
    source_detail: DataFrame,
    target_detail: DataFrame,
    counts: DataFrame | None = None,
    required_format: str = "DELTA",
    size_tolerance: float = SIZE_TOLERANCE_PCT,
    file_tolerance: float = FILE_TOLERANCE_PCT,
) -> DataFrame:
    """One verdict per copied table.

    ``records`` are control rows. A detail has fqn, format, size_in_bytes,
    num_files and last_modified. ``counts`` has migration_id, source_row_count
    and target_row_count; NULL counts there mean the count itself failed.

    Only a missing side, a count difference or a failed count fails the table;
    the other checks are advice in the message.
    """
    def detail(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            F.col("fqn").alias(f"{side}_fqn"), F.upper("format").alias(f"{side}_format"),
            F.coalesce("size_in_bytes", F.lit(0)).alias(f"{side}_bytes"),
            F.coalesce("num_files", F.lit(0)).alias(f"{side}_files"),
            F.col("last_modified").alias(f"{side}_modified"), F.lit(True).alias(f"{side}_found"),
        )

    sides = {"src": ("source_catalog", "source_schema", "source_table"),
             "tgt": ("target_catalog", "target_schema", "target_table")}
    rows = records
    for side, frame in (("src", source_detail), ("tgt", target_detail)):
        on = F.col(f"{side}_fqn") == F.concat_ws(".", *sides[side])
        rows = rows.join(detail(frame, side), on, "left")
    if counts is not None:
        taken = counts.select(
            "migration_id", F.col("source_row_count").alias("src_n"), F.col("target_row_count").alias("tgt_n"),
            F.lit(True).alias("counted"),
        )
        rows = rows.join(taken, "migration_id", "left")
    else:
        rows = rows.withColumns(
            {"src_n": F.lit(None).cast("bigint"), "tgt_n": F.lit(None).cast("bigint"), "counted": F.lit(None).cast("boolean")}
        )
    missing_source, missing_target = F.col("src_found").isNull(), F.col("tgt_found").isNull()
    gone = missing_source | missing_target
    checked = F.coalesce("counted", F.lit(False)) & ~gone
    matched = F.when(checked, F.coalesce(F.col("src_n") == F.col("tgt_n"), F.lit(False)))
    count_error = checked & (F.col("src_n").isNull() | F.col("tgt_n").isNull())

    src, tgt = quoted_fqn(*sides["src"]), quoted_fqn(*sides["tgt"])
    format_ok = F.coalesce(F.col("tgt_format") == required_format, F.lit(False))
    no_files = (F.col("src_files") == 0) & (F.col("tgt_files") == 0)
    lines = [
        check_line("source_exists", F.lit(True), F.concat(F.lit("Source "), src, F.lit(" exists"))),
        check_line("target_exists", F.lit(True), F.concat(F.lit("Target "), tgt, F.lit(" exists"))),
        check_line("target_format", format_ok,
                   F.concat(F.lit("Target format="), F.coalesce("tgt_format", F.lit("")),
                            F.when(format_ok, "").otherwise(WRONG_FORMAT.format(f=required_format)))),
        check_line("size_bytes", within_tolerance(F.col("src_bytes"), F.col("tgt_bytes"), size_tolerance),
                   metric_message("size_bytes", F.col("src_bytes"), F.col("tgt_bytes"), size_tolerance)),
        F.when(no_files, check_line("file_count", F.lit(True),
                                    F.lit(NO_FILES)))
        .otherwise(check_line("file_count", within_tolerance(F.col("src_files"), F.col("tgt_files"), file_tolerance),
                              metric_message("file_count", F.col("src_files"), F.col("tgt_files"), file_tolerance))),
        check_line("delta_version_present", F.col("tgt_modified").isNotNull(),
                   F.concat(F.lit("Target lastCommitTimestamp="),
                            F.coalesce(F.col("tgt_modified").cast("string"), F.lit("None")))),
        F.when(checked, check_line(
            "row_count", F.coalesce(matched, F.lit(False)),
            F.when(count_error, "row_count ERROR: COUNT_ERROR").otherwise(
                row_count_message(F.col("src_n"), F.col("tgt_n"), F.col("source_version"), F.col("target_version"))),
        )),
    ]
    message = (
        F.when(missing_source, SOURCE_GONE)
        .when(missing_target, TARGET_GONE)
        .otherwise(F.concat_ws(LINE_SEPARATOR, *lines))
    )
    failed = gone | (checked & ~F.coalesce(matched, F.lit(False)))
    return rows.select(
        *records.columns,
        F.when(failed, "VALIDATION_FAILED").otherwise("VALIDATED").alias("verdict"),
        message.alias("message"),
        F.when(missing_source, "SOURCE_MISSING").when(missing_target, "TARGET_MISSING")
        .when(count_error, "COUNT_ERROR").when(checked & ~matched, "COUNT_MISMATCH").alias("verdict_code"),
        checked.alias("row_count_checked"),
        F.when(checked, F.col("src_n")).alias("checked_source_rows"),
        F.when(checked, F.col("tgt_n")).alias("checked_target_rows"),
        matched.alias("row_count_matched"),
    )


def validation_changes(verdicts: DataFrame) -> DataFrame:
    """Verdicts in the shape the control update takes."""
    return verdicts.select(
        "migration_id", F.col("verdict").alias("status"), "message",
        F.col("checked_source_rows").alias("source_row_count"), F.col("checked_target_rows").alias("target_row_count"),
    )


def history_rows(verdicts: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Validation-history rows, one per verdict."""
    own = ("source_row_count", "target_row_count", "status", "message", "run_id", "created_at")
    shaped = verdicts.select(
        *[c for c in VALIDATION_HISTORY.fieldNames() if c in verdicts.columns and c not in own
          and c not in ("row_count_checked", "row_count_matched")],
        "row_count_checked", "row_count_matched",
        F.col("checked_source_rows").alias("source_row_count"),
        F.col("checked_target_rows").alias("target_row_count"),
        F.col("verdict").alias("status"),
        cut(F.col("message"), VALIDATION_MESSAGE_CHARS).alias("message"),
        F.lit(run_id).alias("run_id"), now.alias("validated_at"), now.alias("created_at"),
    )
    return conform(shaped, VALIDATION_HISTORY)


def row_count_tally(verdicts: DataFrame) -> DataFrame:
    """One row: how many counts were checked, matched, mismatched."""
    return verdicts.agg(
        F.count_if(F.col("row_count_checked")).alias("row_count_checked"),
        F.count_if(F.col("row_count_matched")).alias("row_count_matched"),
        F.count_if(~F.col("row_count_matched")).alias("row_count_mismatched"),
    )


def check_rows(results: DataFrame, check_name: str, execution_id: str, now: Column) -> DataFrame:
    """Results (table_name, passed, detail) of one check in the stored shape."""
    return results.select(
        F.lit(execution_id).alias("execution_id"), now.alias("validated_at"), F.lit(check_name).alias("check_name"),
        "table_name", "passed", "detail",
    )


def acceptance_summary(results: DataFrame) -> DataFrame:
    """Pass rate per check against the rate it must reach. A check without a rate needs all to pass."""
    required = F.lit(100.0)
    for name, rate in REQUIRED_PASS_RATE.items():
        required = F.when(F.col("check_name") == name, F.lit(rate)).otherwise(required)
    passed = F.count_if(F.col("passed"))
    return (
        results.groupBy("check_name")
        .agg(F.count("*").alias("checks"), passed.alias("passed_checks"))
        .withColumn("failed_checks", F.col("checks") - F.col("passed_checks"))
        .withColumn("pass_rate", F.lit(100.0) * F.col("passed_checks") / F.col("checks"))
        .withColumn("required_rate", required)
        .withColumn("accepted", F.col("pass_rate") >= F.col("required_rate"))
    )


def check_counts(results: DataFrame) -> DataFrame:
    """Checks by name and outcome."""
    return results.groupBy("check_name", "passed").agg(
        F.count("*").alias("check_count"), F.count_if(F.col("passed")).alias("passed_count")
    )


def audit_completeness(audit: DataFrame) -> DataFrame:
    """Per execution: does the audit log hold anything, and what, by state."""
    by_status = audit.groupBy("execution_id", "status").agg(F.count("*").alias("n"))
    parts = F.array_sort(F.collect_list(F.concat(F.coalesce("status", F.lit("(unknown)")), F.lit("="), F.col("n").cast("string"))))
    # one short entry per state
    return by_status.groupBy("execution_id").agg(F.sum("n").alias("total"), parts.alias("parts")).select(
        "execution_id",
        (F.col("total") > 0).alias("passed"),
        F.concat(F.lit("total="), F.col("total").cast("string"), F.lit(" "), F.array_join("parts", " | ")).alias("detail"),
    )


def copied_tables(audit: DataFrame, execution_id: str | None = None) -> DataFrame:
    """Distinct tables an execution copied; the latest execution by default."""
    done = audit.where(F.col("status") == "SUCCESS")
    if execution_id is not None:
        done = done.where(F.col("execution_id") == execution_id)
    return done.select("execution_id", "table_name", "table_type", "status").distinct()
