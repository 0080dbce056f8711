"""Derived views over the supplied tables.

Each text runs unchanged on Spark and on DuckDB, so a registered query and its
oracle read the same rows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import TimestampType

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {
    "control": """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS migration_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'batch-a' WHEN 1 THEN 'batch-b' WHEN 2 THEN 'batch-c' ELSE 'batch-d' END AS batch_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'direct_adls' ELSE 'delta_share' END AS clone_type,
  CASE WHEN o_custkey % 2 = 0 THEN 'cat_even' ELSE 'cat_odd' END AS source_catalog,
  CASE o_custkey % 5 WHEN 0 THEN 'finance' WHEN 1 THEN 'iot' WHEN 2 THEN 'marketing' WHEN 3 THEN 'ops' ELSE 'sales' END AS source_schema,
  concat(CASE WHEN o_orderkey % 2 = 0 THEN 'dim_' ELSE 'fact_' END, CAST(o_orderkey AS VARCHAR(20))) AS source_table,
  CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CAST(o_custkey % 8 AS INT) + 1 END AS chunk_id,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) * 4000000 END AS size_in_bytes,
  CASE CAST(o_orderkey % 14 AS INT) WHEN 0 THEN 'DISCOVERED' WHEN 1 THEN 'ONBOARDED' WHEN 2 THEN 'WAITING_FOR_LOAD' WHEN 3 THEN 'QUEUED'
    WHEN 4 THEN 'ASSIGNED' WHEN 5 THEN 'IN_PROGRESS' WHEN 6 THEN 'COMPLETED' WHEN 7 THEN 'FAILED' WHEN 8 THEN 'FAILED_PERMANENT'
    WHEN 9 THEN 'RETRY_PENDING' WHEN 10 THEN 'SKIPPED' WHEN 11 THEN 'PO_BLOCKED' WHEN 12 THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS status,
  CAST(o_custkey % 4 AS INT) AS attempt_number, 3 AS max_attempts,
  CASE WHEN o_orderkey % 14 IN (4,5) AND o_custkey % 9 = 0 THEN NULL ELSE o_orderdate END AS started_at,
  CASE WHEN o_orderkey % 14 IN (6,12,13) THEN o_orderdate + INTERVAL '1' SECOND * CAST((o_orderkey * 37) % 7200 AS INT) END AS completed_at,
  CASE WHEN o_orderkey % 14 IN (6,7,8,9,12,13) THEN (o_orderkey * 37) % 7200 END AS duration_seconds,
  CASE WHEN o_orderkey % 14 IN (7,8,9) THEN CASE o_custkey % 5 WHEN 0 THEN 'TABLE_OR_VIEW_NOT_FOUND' WHEN 1 THEN 'LOCATION_OVERLAP'
    WHEN 2 THEN 'PERMISSION_DENIED' WHEN 3 THEN 'CLONE_FAILED' END END AS error_code,
  CASE WHEN o_orderkey % 14 IN (12,13) AND o_custkey % 7 <> 0 THEN o_orderkey * 10 END AS source_row_count,
  CASE WHEN o_orderkey % 14 IN (12,13) AND o_custkey % 7 <> 0 THEN o_orderkey * 10 - CASE WHEN o_orderkey % 14 = 13 THEN 1 ELSE 0 END END AS target_row_count,
  CASE o_orderkey % 14 WHEN 12 THEN 'VALIDATED' WHEN 13 THEN 'VALIDATION_FAILED' END AS validation_status,
  o_orderdate AS updated_at
FROM orders
""",
    "attempts": """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS migration_id, l_linenumber AS attempt_number,
  concat('cluster-', CAST(l_suppkey % 8 AS VARCHAR(20))) AS cluster_id,
  l_shipdate AS started_at, l_shipdate + INTERVAL '1' SECOND * CAST((l_partkey * 13) % 3600 AS INT) AS completed_at,
  CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'O' THEN 'CLONE_FAILED' ELSE 'PERMISSION_DENIED' END END AS error_code,
  (l_partkey * 13) % 3600 AS duration_seconds,
  CAST(floor(l_extendedprice) AS BIGINT) * 1000 AS source_size_bytes, l_shipdate AS created_at
FROM lineitem
""",
    "validation_history": """
SELECT CAST(l_orderkey AS VARCHAR(20)) AS migration_id, CAST(l_linenumber AS BIGINT) AS source_version, CAST(l_linenumber AS BIGINT) + 1 AS target_version,
  l_tax > 0.02 AS row_count_checked,
  CASE WHEN l_tax > 0.02 THEN l_partkey * 10 END AS source_row_count,
  CASE WHEN l_tax > 0.02 THEN l_partkey * 10 - CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END END AS target_row_count,
  CASE WHEN l_tax > 0.02 THEN l_partkey % 50 <> 0 END AS row_count_matched,
  CASE WHEN l_tax > 0.02 AND l_partkey % 50 = 0 THEN 'VALIDATION_FAILED' ELSE 'VALIDATED' END AS status,
  l_shipdate AS validated_at
FROM lineitem
""",
    "listing": """
SELECT CASE WHEN p_partkey % 3 = 0 THEN 'bulk_02' WHEN p_partkey % 3 = 1 THEN 'bulk_03' ELSE 'system' END AS table_catalog,
  CASE p_size % 6 WHEN 0 THEN 'finance' WHEN 1 THEN 'hr' WHEN 2 THEN 'iot' WHEN 3 THEN 'ops' WHEN 4 THEN 'sales' ELSE 'information_schema' END AS table_schema,
  concat(CASE p_partkey % 5 WHEN 0 THEN 'tmp_' WHEN 1 THEN 'dim_' WHEN 2 THEN 'fact_' WHEN 3 THEN 'Stg_Lineage_' ELSE 'dim-' END, CAST(p_partkey AS VARCHAR(20))) AS table_name,
  CASE p_partkey % 7 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'EXTERNAL' WHEN 2 THEN 'FOREIGN' ELSE 'MANAGED' END AS table_type,
  CASE p_partkey % 11 WHEN 0 THEN 'PARQUET' ELSE 'DELTA' END AS format,
  CAST(floor(p_retailprice) AS BIGINT) * 1000000000 AS size_in_bytes, CAST(p_size AS BIGINT) * 3 AS num_files
FROM part
""",
    "tgt_lineitem": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_orderkey % 89 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  l_extendedprice, l_discount, l_tax, CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_orderkey % 97 <> 0
UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_orderkey % 83 = 0 AND l_orderkey % 97 <> 0
""",
    "exclusion_rules": """
SELECT * FROM (VALUES (1,'schema','bulk_02','iot',''), (2,'table','bulk_0?','finance','DIM_*'), (3,'catalog','sys*','',''))
  AS r(seq, exclude_type, catalog, schema_name, table_name)
""",
    "rules": """
SELECT * FROM (VALUES (1,'table','bulk_02','finance','dim_36','copy_02','finance','dim_36_copy','',''),
 (2,'schema','bulk_03','hr','','copy_03','hr_dr','','','[''stg_*'']'),
 (3,'catalog','bulk_02','','','copy_02','','','[''hr'']','[''*lineage*'',''tmp_*'']'))
 AS r(seq, rule_type, source_catalog, source_schema, source_table, target_catalog, target_schema, target_table, exclude_schemas, exclude_tables)
""",
    "settings": """
SELECT 'table' AS level, concat(table_catalog,'.',table_schema,'.',table_name) AS fqn,
  CASE WHEN num_files % 5 = 0 THEN 'ENABLE' WHEN num_files % 5 = 1 THEN 'DISABLE' ELSE 'INHERIT' END AS value FROM listing WHERE size_in_bytes % 4000000000 <> 0
UNION ALL SELECT DISTINCT 'schema', concat(table_catalog,'.',table_schema), CASE table_schema WHEN 'iot' THEN 'ENABLE' WHEN 'hr' THEN 'DISABLE' ELSE 'INHERIT' END FROM listing
UNION ALL SELECT DISTINCT 'catalog', table_catalog, CASE table_catalog WHEN 'bulk_03' THEN 'ENABLE' WHEN 'bulk_02' THEN 'DISABLE' END FROM listing
""",
    "requests": """
SELECT CAST(c_custkey AS VARCHAR(20)) AS onboarding_id, CASE c_custkey % 3 WHEN 0 THEN 'catalog' WHEN 1 THEN 'schema' ELSE 'table' END AS scope_mode,
  CASE WHEN c_custkey % 2 = 0 THEN 'path_resolution' ELSE 'delta_share' END AS clone_mode, CAST(c_nationkey % 3 AS INT) + 1 AS priority,
  CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'PENDING' WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'COMPLETED' WHEN 3 THEN 'FAILED' ELSE 'PENDING' END AS status,
  TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(c_custkey % 720 AS INT) AS requested_at,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(c_custkey % 1000 AS INT) END AS scheduled_for,
  CASE WHEN c_custkey % 5 IN (1,2,3) THEN concat('exec-', CAST(c_custkey % 20 AS VARCHAR(20))) END AS execution_id
FROM customer
""",
    "audit": """
SELECT concat('exec-', CAST(l_orderkey % 20 AS VARCHAR(20))) AS execution_id, concat('t_', CAST(l_partkey AS VARCHAR(20))) AS table_name,
  CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE l_linestatus WHEN 'O' THEN 'MANAGED' ELSE 'EXTERNAL' END AS table_type,
  concat('cluster-', CAST(l_suppkey % 8 AS VARCHAR(20))) AS cluster_id, CAST(floor(l_quantity) AS BIGINT) * 1000 AS records_cloned,
  CAST(floor(l_extendedprice) AS BIGINT) * 1000 AS size_bytes, (l_partkey * 13) % 3600 AS duration_seconds,
  l_shipdate AS run_timestamp, CASE WHEN l_returnflag = 'R' THEN concat('error ', CAST(l_partkey % 7 AS VARCHAR(20))) END AS error_message
FROM lineitem
""",
    "status_log": """
SELECT CAST(user_id AS VARCHAR(20)) AS migration_id, event_id AS seq, ts AS changed_at,
  CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'QUEUED' WHEN 1 THEN 'ASSIGNED' WHEN 2 THEN 'IN_PROGRESS' WHEN 3 THEN 'COMPLETED' ELSE 'FAILED' END AS status
FROM events
""",
}

# views that read another view
NEEDS = {"settings": ("listing",)}


def with_views(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for an oracle text."""
    ordered: list[str] = []
    for name in names:
        for dep in (*NEEDS.get(name, ()), name):
            if dep not in ordered:
                ordered.append(dep)
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in ordered) + "\n"


@lru_cache(maxsize=64)
def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the handle is kept, so its schema is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a lazy DataFrame over the parquet files."""
    text = with_views(name) + f"SELECT * FROM {name}"
    for table in BASE_TABLES:
        if f"FROM {table}" in text:
            base(spark, sf_dir, table).createOrReplaceTempView(table)
    rows = spark.sql(text)
    # timestamp literals carry the session zone in Spark; drop it again
    zoned = [f.name for f in rows.schema.fields if isinstance(f.dataType, TimestampType)]
    return rows.withColumns({c: rows[c].cast("timestamp_ntz") for c in zoned}) if zoned else rows
