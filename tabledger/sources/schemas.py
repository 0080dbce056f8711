"""Ledger schemas and states.

Timestamps are kept without a zone (UTC by convention), so a result does not
change with the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    names = {
        "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
        "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(),
        "map": T.MapType(T.StringType(), T.StringType()), "strings": T.ArrayType(T.StringType()),
    }
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, names[kind]))
    return T.StructType(fields)


# Columns of the stored tables.
CONTROL = _schema(
    "migration_id string, run_id string, clone_type string, source_workspace string, target_workspace string,"
    "source_catalog string, source_schema string, source_table string,"
    "target_catalog string, target_schema string, target_table string,"
    "batch_id string, chunk_id int, source_path string, size_in_bytes bigint, size_gb double,"
    "workload_class string, workload_weight int, assigned_cluster_id string,"
    "status string, attempt_number int, max_attempts int,"
    "discovered_at timestamp, onboarded_at timestamp, queued_at timestamp, started_at timestamp,"
    "completed_at timestamp, failed_at timestamp, duration_seconds bigint,"
    "error_code string, error_message string,"
    "source_num_files bigint, target_num_files bigint, source_version bigint, target_version bigint,"
    "validation_status string, validation_message string, source_row_count bigint, target_row_count bigint,"
    "created_at timestamp, updated_at timestamp"
)

ATTEMPTS = _schema(
    "run_id string, migration_id string, attempt_number int, cluster_id string, worker_id string,"
    "started_at timestamp, completed_at timestamp, status string, error_code string, error_message string,"
    "duration_seconds bigint, source_size_bytes bigint, target_size_bytes bigint, created_at timestamp,"
    "source_version bigint, rows_copied bigint, content_checksum string"
)

VALIDATION_HISTORY = _schema(
    "run_id string, migration_id string, batch_id string,"
    "source_catalog string, source_schema string, source_table string,"
    "target_catalog string, target_schema string, target_table string,"
    "source_version bigint, target_version bigint, row_count_checked boolean,"
    "source_row_count bigint, target_row_count bigint, row_count_matched boolean,"
    "status string, message string, validated_at timestamp, created_at timestamp"
)

EXCLUSION_LOG = _schema(
    "run_id string, batch_id string, source_catalog string, source_schema string, source_table string,"
    "exclusion_type string, exclusion_rule string, excluded_at timestamp"
)

CHECK_RESULTS = _schema(
    "execution_id string, validated_at timestamp, check_name string, table_name string, passed boolean, detail string"
)

REQUESTS = _schema(
    "onboarding_id string, request_name string, scope_mode string, clone_mode string,"
    "src_catalog string, src_schema string, src_table string, tgt_catalog string, tgt_schema string,"
    "priority int, status string, requested_by string, requested_at timestamp, scheduled_for timestamp,"
    "execution_id string, completed_at timestamp, validation_mode string, validation_columns string,"
    "count_tolerance_pct double, checksum_algorithm string, notes string, tags map"
)

AUDIT = _schema(
    "execution_id string, onboarding_id string, batch_id string, batch_sequence int, retry_attempt int,"
    "run_timestamp timestamp, table_name string, src_catalog string, src_schema string,"
    "tgt_catalog string, tgt_schema string, table_type string, clone_mode string,"
    "src_location string, tgt_location string, records_cloned bigint, files_copied bigint, size_bytes bigint,"
    "throughput_mbps double, start_time timestamp, end_time timestamp, duration_seconds bigint,"
    "cluster_id string, status string, error_message string, validation_status string, validation_notes string"
)

DRY_RUN_PLANS = _schema("execution_id string, generated_at timestamp, blueprint_json string")

SELECTIONS = _schema(
    "source_catalog string, source_schema string, source_table string,"
    "target_catalog string, target_schema string, target_table string"
)

RULES = _schema(
    "seq bigint, rule_type string, source_catalog string, source_schema string, source_table string,"
    "target_catalog string, target_schema string, target_table string,"
    "exclude_schemas strings, exclude_tables strings"
)

EXCLUSION_RULES = _schema("seq bigint, exclude_type string, catalog string, schema_name string, table_name string")

# The states of a control row and the declared edges between them.
STATUSES = (
    "DISCOVERED", "ONBOARDED", "WAITING_FOR_LOAD", "QUEUED", "ASSIGNED", "IN_PROGRESS", "COMPLETED",
    "FAILED", "FAILED_PERMANENT", "RETRY_PENDING", "SKIPPED", "PO_BLOCKED", "VALIDATED", "VALIDATION_FAILED",
)

ALLOWED_EDGES = (
    ("DISCOVERED", "ONBOARDED"), ("DISCOVERED", "FAILED_PERMANENT"), ("DISCOVERED", "SKIPPED"),
    ("ONBOARDED", "WAITING_FOR_LOAD"),
    ("WAITING_FOR_LOAD", "QUEUED"),
    ("QUEUED", "ASSIGNED"), ("QUEUED", "SKIPPED"),
    ("ASSIGNED", "IN_PROGRESS"), ("ASSIGNED", "QUEUED"),
    ("IN_PROGRESS", "COMPLETED"), ("IN_PROGRESS", "FAILED"),
    ("COMPLETED", "VALIDATED"), ("COMPLETED", "VALIDATION_FAILED"),
    ("FAILED", "RETRY_PENDING"), ("FAILED", "FAILED_PERMANENT"),
    ("RETRY_PENDING", "QUEUED"),
    ("VALIDATION_FAILED", "RETRY_PENDING"), ("VALIDATION_FAILED", "FAILED_PERMANENT"),
    ("FAILED_PERMANENT", "RETRY_PENDING"), ("FAILED_PERMANENT", "QUEUED"),
)

DONE = ("COMPLETED", "VALIDATED")
ACTIVE = ("IN_PROGRESS", "ASSIGNED")
FAILED = ("FAILED", "FAILED_PERMANENT", "VALIDATION_FAILED")
RETRYABLE = ("FAILED", "RETRY_PENDING", "VALIDATION_FAILED")

# Failures that no retry can cure.
PERMANENT_ERROR_CODES = (
    "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "CATALOG_NOT_FOUND", "PERMISSION_DENIED",
    "DELTA_NOT_SUPPORTED", "NON_DELTA_SOURCE", "SOURCE_IS_VIEW", "FAILED_PERMANENT",
    "LOCATION_OVERLAP", "ANALYSIS_EXCEPTION",
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order, absent ones as typed NULLs, others kept last."""
    have = set(df.columns)
    cols = [
        f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ]
    return df.selectExpr(*cols, *[f"`{c}`" for c in df.columns if c not in schema.fieldNames()])


def add_columns(df: DataFrame, fields: T.StructType) -> DataFrame:
    """Additive evolution: columns that exist already are left alone."""
    have = {c.lower() for c in df.columns}
    new = {f.name: F.lit(None).cast(f.dataType) for f in fields.fields if f.name.lower() not in have}
    return df.withColumns(new) if new else df
