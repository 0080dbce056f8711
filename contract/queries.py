"""Registered queries and, where SQL can say it, the same result in plain SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabledger.functions import text
from tabledger.functions.text import list_literal
from tabledger.operators import checks, compare, inventory, ledger, pack, partition_digests, report, request_checks, requests, select
from tabledger.operators.ledger import lit_time
from tabledger.sources.checkpoints import checkpointed, shared_folder
from tabledger.sources.partitions import PartitionedTable

from .views import base, view, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2024-02-01 00:00:00"
# inside the range of o_orderdate, so that some rows are stale and some are not
STALE_NOW = "1996-06-01 00:00:00"
GIB = 1024**3
DONE = "('COMPLETED','VALIDATED')"
ACTIVE = "('ASSIGNED','IN_PROGRESS')"
FAILED = "('FAILED','FAILED_PERMANENT','VALIDATION_FAILED')"
RETRY = "('FAILED','RETRY_PENDING','VALIDATION_FAILED')"
PERMANENT = (
    "('TABLE_OR_VIEW_NOT_FOUND','SCHEMA_NOT_FOUND','CATALOG_NOT_FOUND','PERMISSION_DENIED','DELTA_NOT_SUPPORTED',"
    "'NON_DELTA_SOURCE','SOURCE_IS_VIEW','FAILED_PERMANENT','LOCATION_OVERLAP','ANALYSIS_EXCEPTION')"
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``{a,b}`` at the start of ``sql`` names the views it reads."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            if text.startswith("{"):
                names, text = text[1:].split("}", 1)
                prefix = with_views(*[n.strip() for n in names.split(",")])
                text = text.strip()
                text = prefix + text if not text.upper().startswith("WITH ") else prefix.rstrip() + ", " + text[5:]
            ORACLES[name] = text
        return fn

    return register


def on_view(name: str, source: str, op: Callable[[DataFrame], DataFrame], sql: str) -> None:
    """A query that is one operator on one view."""
    query(name, "{" + source + "} " + sql)(lambda spark, d: op(view(spark, d, source)))


# -- validation ----------------------------------------------------------------

LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE = ", ".join(LINE_COLUMNS)


def line_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return base(spark, d, "lineitem").select(*LINE_COLUMNS), view(spark, d, "tgt_lineitem").select(*LINE_COLUMNS)


# Drifted copies: changed texts and lost rows; lost and repeated arrays.
_DRIFT = """
     td AS (SELECT doc_id, CASE WHEN doc_id % 97 = 5 THEN concat(text, ' ') ELSE text END AS text, lang, source, n_chars FROM documents WHERE doc_id % 89 <> 7),
     te AS (SELECT * FROM embeddings WHERE vec_id % 101 <> 3 UNION ALL SELECT * FROM embeddings WHERE vec_id % 83 = 2)"""


def table_pairs(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Drifted copies of three tables, and faithful ones of two."""
    pairs = {"lineitem": line_pair(spark, d)}
    for name in ("orders", "events"):
        pairs[name] = (base(spark, d, name), base(spark, d, name))
    for name, copy in (("documents", "td"), ("embeddings", "te")):
        source = base(spark, d, name)
        for t in ("documents", "embeddings"):
            base(spark, d, t).createOrReplaceTempView(t)
        pairs[name] = (source, spark.sql(f"WITH {_DRIFT.strip()} SELECT * FROM {copy}"))
    return pairs


@query("val_rowcount_parity", """{tgt_lineitem}
WITH s AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1),
     t AS (SELECT l_returnflag, count(*) AS n FROM tgt_lineitem GROUP BY 1),
     b AS (SELECT coalesce(s.l_returnflag, t.l_returnflag) AS l_returnflag, coalesce(s.n, 0) AS src_rows,
                  coalesce(t.n, 0) AS tgt_rows
           FROM s FULL JOIN t ON s.l_returnflag IS NOT DISTINCT FROM t.l_returnflag)
SELECT l_returnflag, src_rows, tgt_rows, tgt_rows - src_rows AS delta,
  CASE WHEN src_rows = 0 THEN tgt_rows = 0 ELSE abs(src_rows - tgt_rows) / CAST(src_rows AS DOUBLE) * 100 <= 1.0 END AS passed
FROM b""")
def _(spark, d):
    source, target = line_pair(spark, d)
    return compare.grouped_parity(source, target, ["l_returnflag"], tolerance_pct=1.0)


@query("row_count_parity", "{tgt_lineitem}\nWITH " + _DRIFT.strip() + """,
c AS (
  SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem) AS src_rows, (SELECT count(*) FROM tgt_lineitem) AS tgt_rows
  UNION ALL SELECT 'orders', count(*), count(*) FROM orders
  UNION ALL SELECT 'events', count(*), count(*) FROM events
  UNION ALL SELECT 'documents', (SELECT count(*) FROM documents), (SELECT count(*) FROM td)
  UNION ALL SELECT 'embeddings', (SELECT count(*) FROM embeddings), (SELECT count(*) FROM te))
SELECT table_name, src_rows, tgt_rows, src_rows = tgt_rows AS passed,
  format('src={:,} tgt={:,}', src_rows, tgt_rows) || CASE WHEN tgt_rows = src_rows THEN ''
    ELSE format(' DELTA={}{:,}', CASE WHEN tgt_rows > src_rows THEN '+' ELSE '' END, tgt_rows - src_rows) END AS detail
FROM c""")
def _(spark, d):
    return compare.row_count_parity(table_pairs(spark, d))


ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations")


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES))
def _(spark, d):
    return compare.table_counts({t: base(spark, d, t) for t in ALL_TABLES})


_BOTH_COUNTS = f"""
     b AS (SELECT {_LINE}, 1 AS s, 0 AS t FROM lineitem UNION ALL SELECT {_LINE}, 0, 1 FROM tgt_lineitem),
     g AS (SELECT {_LINE}, sum(s) AS src_count, sum(t) AS tgt_count FROM b GROUP BY ALL)"""


def _drifted(name: str, copy: str, columns: str) -> str:
    """Two query parts: copies of every row of a table and its drifted copy, and their totals."""
    return f"""
     g_{name} AS (SELECT {columns}, sum(s) AS src_count, sum(t) AS tgt_count FROM
       (SELECT {columns}, 1 AS s, 0 AS t FROM {name} UNION ALL SELECT {columns}, 0, 1 FROM {copy}) GROUP BY ALL),
     v_{name} AS (SELECT '{name}' AS table_name, CAST(sum(src_count) AS BIGINT) AS src_rows, CAST(sum(tgt_count) AS BIGINT) AS tgt_rows,
       count(*) FILTER (WHERE src_count <> tgt_count) AS mismatches FROM g_{name})"""


_ALL_VERDICTS = ",".join([
    _DRIFT, _drifted("lineitem", "tgt_lineitem", _LINE), _drifted("documents", "td", "doc_id, text, lang, source, n_chars"),
    _drifted("embeddings", "te", "vec_id, embedding, label"),
]) + """,
     v AS (SELECT * FROM v_lineitem UNION ALL SELECT * FROM v_documents UNION ALL SELECT * FROM v_embeddings
       UNION ALL SELECT 'orders', count(*), count(*), 0 FROM orders UNION ALL SELECT 'events', count(*), count(*), 0 FROM events)"""


@query("row_multiset_diff", f"""{{tgt_lineitem}}
WITH {_ALL_VERDICTS.strip()}
SELECT table_name, src_rows, tgt_rows, mismatches, mismatches = 0 AS passed,
  format('{{:,}} rows compared, {{}} hash mismatches', src_rows, mismatches) AS detail FROM v""")
def _(spark, d):
    return compare.multiset_verdicts(table_pairs(spark, d))


@query("diff_rows", f"""{{tgt_lineitem}}
WITH {_BOTH_COUNTS.strip()}
SELECT {_LINE}, CAST(src_count AS BIGINT) AS src_count, CAST(tgt_count AS BIGINT) AS tgt_count FROM g WHERE src_count <> tgt_count""")
def _(spark, d):
    return compare.diff_rows(*line_pair(spark, d))


@query("diff_rows_exact", ORACLES["diff_rows"])
def _(spark, d):
    return compare.diff_rows_exact(*line_pair(spark, d))


@query("lost_and_extra", f"""{{tgt_lineitem}}
WITH lost AS (SELECT {_LINE} FROM lineitem EXCEPT ALL SELECT {_LINE} FROM tgt_lineitem),
     extra AS (SELECT {_LINE} FROM tgt_lineitem EXCEPT ALL SELECT {_LINE} FROM lineitem)
SELECT *, 'lost' AS side FROM lost UNION ALL SELECT *, 'extra' FROM extra""")
def _(spark, d):
    return compare.lost_and_extra(*line_pair(spark, d))


@query("checksum_verdict", f"""{{tgt_lineitem}}
WITH {_ALL_VERDICTS.strip()}
SELECT table_name, src_rows, tgt_rows, mismatches = 0 AS passed FROM v""")
def _(spark, d):
    return compare.checksum_verdicts(table_pairs(spark, d)).select("table_name", "src_rows", "tgt_rows", "passed")


def scratch_table(spark: SparkSession, rows: DataFrame, by: list[str]) -> PartitionedTable:
    """``rows`` as a table kept by partition, in a folder of its own below the shared one."""
    table = PartitionedTable(spark, f"{shared_folder(spark)}/table-{uuid.uuid4().hex}", rows.schema, by)
    table.overwrite(rows)
    return table


def _sql_text(columns: list[str]) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN 'N' ELSE concat(length(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END"
             for c in columns]
    return "concat(" + ", ".join(parts) + ")"


HASHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
_SHA = [f"sum(CAST(concat('0x', substr(sha256({_sql_text(HASHED)}), {16 * i + 1}, 16)) AS UBIGINT))" for i in range(4)]
_SHA_SUMS = "concat_ws('-', " + ", ".join(f"CAST({x} AS VARCHAR)" for x in _SHA) + ")"


@query("checksum_sha256", f"""{{tgt_lineitem}}
WITH s AS (SELECT count(*) AS n, {_SHA_SUMS} AS c FROM lineitem), t AS (SELECT count(*) AS n, {_SHA_SUMS} AS c FROM tgt_lineitem)
SELECT 'lineitem' AS table_name, s.n AS src_rows, t.n AS tgt_rows, s.c AS src_checksum,
  t.c AS tgt_checksum, s.n = t.n AND s.c = t.c AS passed FROM s, t""")
def _(spark, d):
    return compare.checksum_verdicts({"lineitem": line_pair(spark, d)}, {"lineitem": HASHED}, "SHA256")


@query("checksum_refresh", f"""
WITH y AS (SELECT {", ".join(HASHED)}, CAST(year(l_shipdate) AS INT) AS ship_year FROM lineitem),
     t AS (SELECT * REPLACE (CASE WHEN ship_year % 3 = 0 AND l_partkey % 101 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag)
           FROM y WHERE ship_year IS NULL OR ship_year % 3 <> 0 OR l_orderkey % 97 <> 0),
     g AS (SELECT ship_year, count(*) AS row_count, {_SHA_SUMS} AS checksum FROM t GROUP BY 1)
SELECT 'part' AS level, ship_year, row_count, checksum, coalesce(ship_year % 3 = 0, false) AS reread FROM g
UNION ALL SELECT 'table', NULL, count(*), {_SHA_SUMS}, NULL FROM t""")
def _(spark, d):
    rows = base(spark, d, "lineitem").select(*HASHED, F.year("l_shipdate").alias("ship_year"))
    kept = scratch_table(spark, rows, ["ship_year"])
    stored = checkpointed(partition_digests.refreshed(kept, None, HASHED, "SHA256"))
    flag = F.when(F.col("l_partkey") % 101 == 0, "X").otherwise(F.col("l_returnflag"))
    kept.update(lambda r: r.where("l_orderkey % 97 <> 0").withColumn("l_returnflag", flag), stored.where("ship_year % 3 = 0"))
    now = checkpointed(partition_digests.refreshed(kept, stored, HASHED, "SHA256"))
    parts = now.select(F.lit("part").alias("level"), "ship_year", "row_count",
                       partition_digests.checksum_text(F.col("sums")).alias("checksum"), "reread")
    whole = partition_digests.merged(now, "SHA256").select(
        F.lit("table").alias("level"), F.lit(None).cast("int").alias("ship_year"), "row_count", "checksum", F.lit(None).cast("boolean").alias("reread"))
    return parts.unionByName(whole)


@query("batch_update", """{control}
SELECT batch_id, count(*) AS row_count, count(*) FILTER (WHERE status = 'ASSIGNED' OR (batch_id = 'batch-b' AND status = 'QUEUED')) AS assigned,
  batch_id <> 'batch-b' AS files_kept FROM control GROUP BY batch_id""")
def _(spark, d):
    kept = scratch_table(spark, view(spark, d, "control").select("batch_id", "migration_id", "status", "chunk_id", "updated_at"), ["batch_id"])
    before = checkpointed(kept.marks())
    status = F.when(F.col("status") == "QUEUED", "ASSIGNED").otherwise(F.col("status"))
    kept.update(lambda r: r.withColumn("status", status), before.where("batch_id = 'batch-b'"))
    same = kept.marks().join(before.select("batch_id", F.col("mark").alias("old")), "batch_id").select(
        "batch_id", (F.col("mark") == F.col("old")).alias("files_kept"))
    counts = kept.read().groupBy("batch_id").agg(F.count("*").alias("row_count"), F.count_if(F.col("status") == "ASSIGNED").alias("assigned"))
    return counts.join(same, "batch_id").select("batch_id", "row_count", "assigned", "files_kept")


@query("row_hash_md5", f"SELECT md5({_sql_text(HASHED)}) AS row_hash, count(*) AS copies FROM lineitem GROUP BY 1")
def _(spark, d):
    from tabledger.functions.hashing import row_md5

    line = base(spark, d, "lineitem")
    return line.groupBy(row_md5(line, HASHED).alias("row_hash")).agg(F.count("*").alias("copies"))


def _profile_sql(table: str) -> str:
    parts = []
    for c in LINE_COLUMNS:
        mean = "CAST(NULL AS DOUBLE)" if c in ("l_returnflag", "l_linestatus", "l_shipdate") else f"avg(CAST({c} AS DOUBLE))"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS value_count, count(*) - count({c}) AS null_count, CAST(0 AS BIGINT) AS nan_count, "
            f"CAST(0 AS BIGINT) AS infinite_count, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, {mean} AS avg_value FROM {table}"
        )
    return " UNION ALL ".join(parts)


_PROFILE = ("value_count", "null_count", "nan_count", "infinite_count", "min_value", "max_value")
_PROFILES = f"""
  s AS ({_profile_sql('lineitem')}), t AS ({_profile_sql('tgt_lineitem')}),
  p AS (SELECT s.column_name, {', '.join(f's.{c} AS src_{c}, t.{c} AS tgt_{c}' for c in (*_PROFILE, "avg_value"))},
    {' AND '.join(f's.{c} IS NOT DISTINCT FROM t.{c}' for c in _PROFILE)} AND (s.avg_value IS NOT DISTINCT FROM t.avg_value
      OR coalesce(abs(s.avg_value - t.avg_value) <= 1e-9 * greatest(abs(s.avg_value), abs(t.avg_value)), false)) AS passed
  FROM s JOIN t USING (column_name))"""


@query("column_profile", f"""{{tgt_lineitem}}
WITH {_PROFILES.strip()}
SELECT * EXCLUDE (src_avg_value, tgt_avg_value), round(src_avg_value, 6) AS src_avg_value, round(tgt_avg_value, 6) AS tgt_avg_value FROM p""")
def _(spark, d):
    out = compare.profile_compare(*line_pair(spark, d))
    return out.withColumns({f"{side}_avg_value": F.round(f"{side}_avg_value", 6) for side in ("src", "tgt")})


# a columns listing of every listed table, and one of a drifted copy
_COLUMNS = """
  c AS (SELECT concat(table_catalog,'.',table_schema,'.',table_name) AS table_name, num_files, size_in_bytes, 'id' AS column_name, 'bigint' AS data_type FROM listing
    UNION ALL SELECT concat(table_catalog,'.',table_schema,'.',table_name), num_files, size_in_bytes, 'name', 'string' FROM listing
    UNION ALL SELECT concat(table_catalog,'.',table_schema,'.',table_name), num_files, size_in_bytes, 'amount', 'decimal(12,2)' FROM listing),
  sc AS (SELECT table_name, column_name, data_type FROM c),
  tc AS (SELECT table_name, column_name, CASE WHEN column_name = 'amount' AND num_files % 7 = 0 THEN 'double' ELSE data_type END AS data_type
    FROM c WHERE NOT (column_name = 'name' AND num_files % 11 = 0)
    UNION ALL SELECT table_name, 'loaded_at', 'timestamp' FROM c WHERE column_name = 'id' AND num_files % 13 = 0)"""


def column_listings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base(spark, d, "part").createOrReplaceTempView("part")
    prefix = with_views("listing").rstrip() + ", " + _COLUMNS.strip()
    return spark.sql(f"{prefix} SELECT * FROM sc"), spark.sql(f"{prefix} SELECT * FROM tc")


@query("schema_diff", f"""{{listing}} WITH {_COLUMNS.strip()}
SELECT * FROM (SELECT coalesce(sc.table_name, tc.table_name) AS table_name, coalesce(sc.column_name, tc.column_name) AS column_name,
    sc.data_type AS src_type, tc.data_type AS tgt_type,
    CASE WHEN tc.data_type IS NULL THEN 'missing in target' WHEN sc.data_type IS NULL THEN 'extra in target'
      WHEN sc.data_type <> tc.data_type THEN 'type mismatch' END AS issue
  FROM sc FULL JOIN tc ON sc.table_name = tc.table_name AND sc.column_name = tc.column_name)
WHERE issue IS NOT NULL""")
def _(spark, d):
    return compare.schema_diff(*column_listings(spark, d))


@query("tolerance_check", """{control}
SELECT migration_id, source_row_count, target_row_count,
  CASE WHEN source_row_count = 0 THEN target_row_count = 0
    ELSE abs(source_row_count - target_row_count) / CAST(source_row_count AS DOUBLE) * 100 <= 0.01 END AS passed
FROM control WHERE source_row_count IS NOT NULL""")
def _(spark, d):
    rows = view(spark, d, "control").where("source_row_count IS NOT NULL")
    out = checks.tolerance_check(rows, "row_count", "source_row_count", "target_row_count", 0.01)
    return out.select("migration_id", "source_row_count", "target_row_count", "passed")


_RESULTS = """
  r AS (SELECT 'row_count_parity' AS check_name, row_count_matched AS passed FROM validation_history WHERE row_count_checked
    UNION ALL SELECT 'data_hash_integrity', source_row_count IS NULL OR source_row_count % 500 <> 0 FROM validation_history
    UNION ALL SELECT 'delta_table_valid', target_version > 0 FROM validation_history)"""


def check_results(spark: SparkSession, d: str) -> DataFrame:
    h = view(spark, d, "validation_history")
    now = lit_time(NOW)
    name = F.col("migration_id").alias("table_name")
    detail = F.col("status").alias("detail")
    parity = h.where("row_count_checked").select(name, F.col("row_count_matched").alias("passed"), detail)
    hashes = h.select(name, (F.col("source_row_count").isNull() | (F.col("source_row_count") % 500 != 0)).alias("passed"), detail)
    valid = h.select(name, (F.col("target_version") > 0).alias("passed"), detail)
    parts = [checks.check_rows(r, n, "exec-1", now) for n, r in
             (("row_count_parity", parity), ("data_hash_integrity", hashes), ("delta_table_valid", valid))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("acceptance_summary", f"""{{validation_history}} WITH {_RESULTS.strip()},
  g AS (SELECT check_name, count(*) AS checks, count(*) FILTER (WHERE passed) AS passed_checks FROM r GROUP BY 1)
SELECT check_name, checks, passed_checks, checks - passed_checks AS failed_checks,
  100.0::DOUBLE * passed_checks / checks AS pass_rate, CASE check_name WHEN 'data_hash_integrity' THEN 99.0::DOUBLE ELSE 100.0::DOUBLE END AS required_rate,
  100.0::DOUBLE * passed_checks / checks >= CASE check_name WHEN 'data_hash_integrity' THEN 99.0 ELSE 100.0 END AS accepted FROM g""")
def _(spark, d):
    return checks.acceptance_summary(check_results(spark, d))


@query("check_counts", f"""{{validation_history}} WITH {_RESULTS.strip()}
SELECT check_name, passed, count(*) AS check_count, count(*) FILTER (WHERE passed) AS passed_count FROM r GROUP BY 1, 2""")
def _(spark, d):
    return checks.check_counts(check_results(spark, d))


on_view("audit_completeness", "audit", checks.audit_completeness, """
, s AS (SELECT execution_id, status, count(*) AS n FROM audit GROUP BY 1, 2)
SELECT execution_id, sum(n) > 0 AS passed, concat('total=', CAST(sum(n) AS VARCHAR), ' ',
  string_agg(concat(status, '=', CAST(n AS VARCHAR)), ' | ' ORDER BY concat(status, '=', CAST(n AS VARCHAR)))) AS detail
FROM s GROUP BY 1""")
on_view("copied_tables", "audit", checks.copied_tables,
        "SELECT DISTINCT execution_id, table_name, table_type, status FROM audit WHERE status = 'SUCCESS'")

# details of both sides derived from the listing: some targets are missing, some drifted
_DETAILS = """
  rec AS (SELECT concat('m-', table_name, '-', CAST(num_files AS VARCHAR(20)), table_catalog, table_schema) AS migration_id, table_catalog AS source_catalog,
      table_schema AS source_schema, table_name AS source_table, 'dr' AS target_catalog, concat(table_catalog, '_', table_schema) AS target_schema,
      table_name AS target_table, CASE WHEN num_files % 4 = 0 THEN NULL ELSE num_files END AS source_version,
      CASE WHEN num_files % 4 = 0 THEN NULL ELSE num_files + 1 END AS target_version FROM listing),
  sd AS (SELECT concat_ws('.', table_catalog, table_schema, table_name) AS fqn, format, size_in_bytes, num_files, CAST('2024-01-01' AS TIMESTAMP) AS last_modified
    FROM listing WHERE num_files % 39 <> 0),
  td AS (SELECT concat_ws('.', 'dr', concat(table_catalog, '_', table_schema), table_name) AS fqn, format,
      CASE WHEN num_files % 6 = 0 THEN size_in_bytes + 5000000000 ELSE size_in_bytes END AS size_in_bytes, num_files, CAST('2024-01-02' AS TIMESTAMP) AS last_modified
    FROM listing WHERE num_files % 33 <> 0),
  cn AS (SELECT migration_id, source_version * 10 AS source_row_count, CASE WHEN source_version % 5 = 0 THEN source_version * 10 + 1 ELSE source_version * 10 END AS target_row_count FROM rec WHERE source_table NOT LIKE 'tmp%')"""


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    base(spark, d, "part").createOrReplaceTempView("part")
    prefix = with_views("listing").rstrip() + ", " + _DETAILS.strip()
    rec, sd, td, cn = (spark.sql(f"{prefix} SELECT * FROM {t}") for t in ("rec", "sd", "td", "cn"))
    return checks.validation_verdicts(rec, sd, td, cn)


_VERDICT = _DETAILS.strip() + """,
  j AS (SELECT rec.migration_id, sd.fqn IS NULL AS no_src, td.fqn IS NULL AS no_tgt, cn.migration_id IS NOT NULL AND sd.fqn IS NOT NULL AND td.fqn IS NOT NULL AS checked,
      cn.source_row_count AS s, cn.target_row_count AS t
    FROM rec LEFT JOIN sd ON sd.fqn = concat_ws('.', source_catalog, source_schema, source_table)
      LEFT JOIN td ON td.fqn = concat_ws('.', target_catalog, target_schema, target_table) LEFT JOIN cn ON cn.migration_id = rec.migration_id),
  v AS (SELECT migration_id, checked AS row_count_checked,
      CASE WHEN no_src OR no_tgt OR (checked AND NOT coalesce(s = t, false)) THEN 'VALIDATION_FAILED' ELSE 'VALIDATED' END AS verdict,
      CASE WHEN no_src THEN 'SOURCE_MISSING' WHEN no_tgt THEN 'TARGET_MISSING' WHEN checked AND (s IS NULL OR t IS NULL) THEN 'COUNT_ERROR'
        WHEN checked AND s <> t THEN 'COUNT_MISMATCH' END AS verdict_code,
      CASE WHEN checked THEN coalesce(s = t, false) END AS row_count_matched FROM j)"""


# Stored texts of each line; the lines of a table that both sides have.
_MESSAGE = """,
  w AS (SELECT rec.migration_id, concat('`', source_catalog, '`.`', source_schema, '`.`', source_table, '`') AS sn, concat('`', target_catalog, '`.`', target_schema, '`.`', target_table, '`') AS tn,
      upper(td.format) AS fmt, sd.size_in_bytes AS sb, td.size_in_bytes AS tb, sd.num_files AS sf, td.num_files AS tf, td.last_modified AS lm, source_version AS sv, target_version AS tv,
      cn.migration_id IS NOT NULL AS checked, cn.source_row_count AS s, cn.target_row_count AS t, sd.fqn IS NULL AS no_src, td.fqn IS NULL AS no_tgt
    FROM rec LEFT JOIN sd ON sd.fqn = concat_ws('.', source_catalog, source_schema, source_table)
      LEFT JOIN td ON td.fqn = concat_ws('.', target_catalog, target_schema, target_table) LEFT JOIN cn ON cn.migration_id = rec.migration_id),
  msg AS (SELECT migration_id, CASE WHEN no_src THEN 'SOURCE_MISSING: source table not found after clone' WHEN no_tgt THEN 'TARGET_MISSING: target table was not created'
    ELSE concat_ws(' | ', concat('✓ source_exists: Source ', sn, ' exists'), concat('✓ target_exists: Target ', tn, ' exists'),
      CASE WHEN fmt = 'DELTA' THEN '✓ target_format: Target format=DELTA' ELSE concat('✗ target_format: Target format=', fmt, ' (expected DELTA)') END,
      concat(CASE WHEN abs(sb - tb) * 100.0 <= sb THEN '✓' ELSE '✗' END, format(' size_bytes: size_bytes src={:,} tgt={:,} diff=', sb, tb), printf('%.2f', abs(sb - tb) / CAST(sb AS DOUBLE) * 100), '% (tol=1.0%)',
        CASE WHEN abs(sb - tb) * 100.0 <= sb THEN ' ✓' ELSE ' ✗ EXCEEDS TOLERANCE' END),
      format('✓ file_count: file_count src={:,} tgt={:,} diff=0.00% (tol=5.0%) ✓', sf, tf), concat('✓ delta_version_present: Target lastCommitTimestamp=', CAST(lm AS VARCHAR)),
      CASE WHEN checked AND (s IS NULL OR t IS NULL) THEN '✗ row_count: row_count ERROR: COUNT_ERROR' WHEN checked THEN
        concat(CASE WHEN s = t THEN '✓' ELSE '✗' END, format(' row_count: row_count src={:,} tgt={:,}', s, t), format(' (src@v{}, tgt@v{})', sv, tv), CASE WHEN s = t THEN '' ELSE ' ✗ MISMATCH' END) END) END AS message FROM w)"""


@query("validation_verdicts", f"{{listing}} WITH {_VERDICT}{_MESSAGE} SELECT v.*, message FROM v JOIN msg USING (migration_id)")
def _(spark, d):
    return verdicts(spark, d).select("migration_id", "row_count_checked", "verdict", "verdict_code", "row_count_matched", "message")


@query("row_count_tally", f"""{{listing}} WITH {_VERDICT}
SELECT count(*) FILTER (WHERE row_count_checked) AS row_count_checked, count(*) FILTER (WHERE row_count_matched) AS row_count_matched,
  count(*) FILTER (WHERE NOT row_count_matched) AS row_count_mismatched FROM v""")
def _(spark, d):
    return checks.row_count_tally(verdicts(spark, d))


@query("table_type_check", """{audit, listing}
WITH e AS (SELECT DISTINCT table_name, CASE WHEN table_name LIKE '%7' THEN 'UNKNOWN' ELSE table_type END AS table_type FROM audit WHERE execution_id = 'exec-1'),
  a AS (SELECT DISTINCT concat('t_', regexp_extract(table_name, '[0-9]+$', 0)) AS table_name, table_type FROM listing)
SELECT e.table_name, coalesce(a.table_type, 'UNKNOWN') = e.table_type OR e.table_type = 'UNKNOWN' AS passed,
  concat('expected=', e.table_type, ' actual=', coalesce(a.table_type, 'UNKNOWN')) AS detail FROM e LEFT JOIN a USING (table_name)""")
def _(spark, d):
    expected = (
        view(spark, d, "audit").where("execution_id = 'exec-1'")
        .select("table_name", F.when(F.col("table_name").endswith("7"), "UNKNOWN").otherwise(F.col("table_type")).alias("table_type"))
        .distinct()
    )
    actual = view(spark, d, "listing").select(
        F.concat(F.lit("t_"), F.regexp_extract("table_name", "[0-9]+$", 0)).alias("table_name"), "table_type"
    ).distinct()
    return compare.table_type_check(expected, actual)


# -- reports -------------------------------------------------------------------
# Rounding is half-up on the shortest decimal form of the double, as Spark does it.

on_view("kpis", "control", report.kpis, f"""
SELECT count(*) AS total_tables, count(*) FILTER (WHERE status IN {DONE}) AS done_tables,
  count(*) FILTER (WHERE status IN {ACTIVE}) AS active_tables, count(*) FILTER (WHERE status = 'QUEUED') AS queued_tables,
  count(*) FILTER (WHERE status IN {FAILED}) AS failed_tables,
  CAST(round(CAST(CAST(100.0::DOUBLE * count(*) FILTER (WHERE status IN {DONE}) / nullif(count(*), 0) AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE) AS pct_complete,
  CAST(round(CAST(CAST(coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS total_gb,
  CAST(round(CAST(CAST(coalesce(CAST(sum(size_in_bytes) FILTER (WHERE status IN {DONE}) AS BIGINT), 0) / {GIB}.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS gb_done
FROM control""")
on_view("control_status", "control",
        lambda c: report.row_count_status(c).select("migration_id", "source_row_count", "target_row_count", "row_count_status"), """
SELECT migration_id, source_row_count, target_row_count, CASE WHEN source_row_count IS NULL OR target_row_count IS NULL THEN 'NOT CHECKED'
  WHEN source_row_count = target_row_count THEN 'MATCH' ELSE 'MISMATCH' END AS row_count_status FROM control""")
on_view("cumulative_done", "control", report.cumulative_done, f"""
, h AS (SELECT date_trunc('hour', completed_at) AS hour, count(*) AS n FROM control WHERE status IN {DONE} AND completed_at IS NOT NULL GROUP BY 1)
SELECT hour, CAST(sum(n) OVER (ORDER BY hour) AS BIGINT) AS cumulative_done FROM h""")
on_view("hourly_throughput", "control", report.hourly_throughput, f"""
SELECT date_trunc('hour', completed_at) AS hour, count(*) AS tables_done,
  CAST(round(CAST(CAST(coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS gb_done, CAST(round(CAST(CAST(avg(duration_seconds) AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE) AS avg_duration_s
FROM control WHERE status IN {DONE} AND completed_at IS NOT NULL GROUP BY 1""")
on_view("fail_codes", "control", report.fail_codes,
        f"SELECT coalesce(error_code, '(none)') AS error_code, count(*) AS n FROM control WHERE status IN {FAILED} GROUP BY 1")
_FAIL_COLUMNS = ["migration_id", "source_catalog", "source_schema", "source_table", "status", "error_code",
                 "attempt_number", "max_attempts", "batch_id", "updated_at"]
on_view("failed_rows", "control", lambda c: report.failed_rows(c).select(*_FAIL_COLUMNS),
        f"SELECT {', '.join(_FAIL_COLUMNS)} FROM control WHERE status IN {FAILED}")
on_view("recent_failures", "control", lambda c: report.recent_failures(c).select(*_FAIL_COLUMNS),
        f"SELECT {', '.join(_FAIL_COLUMNS)} FROM control WHERE status IN {FAILED} ORDER BY updated_at DESC, migration_id LIMIT 500")
on_view("attempts_daily", "attempts", report.attempts_daily, """
SELECT CAST(created_at AS DATE) AS day, coalesce(status, '(unknown)') AS status, count(*) AS n FROM attempts GROUP BY 1, 2""")
on_view("validations_daily", "validation_history", report.validations_daily, """
SELECT CAST(validated_at AS DATE) AS day, coalesce(status, '(unknown)') AS status, count(*) AS n FROM validation_history GROUP BY 1, 2""")
_MISMATCH = ["migration_id", "source_schema", "source_table", "source_row_count", "target_row_count",
             "validation_status", "updated_at"]
on_view("count_mismatches", "control", lambda c: report.count_mismatches(c).select(*_MISMATCH), f"""
SELECT {', '.join(_MISMATCH)} FROM control WHERE source_row_count IS NOT NULL AND target_row_count IS NOT NULL
  AND source_row_count <> target_row_count ORDER BY updated_at DESC, migration_id LIMIT 500""")
_LONGEST = ["migration_id", "source_schema", "source_table", "size_in_bytes", "duration_seconds", "batch_id", "status"]
on_view("longest_copies", "control", lambda c: report.longest_copies(c).select(*_LONGEST), f"""
SELECT {', '.join(_LONGEST)} FROM control WHERE duration_seconds IS NOT NULL ORDER BY duration_seconds DESC, migration_id LIMIT 50""")
on_view("chunk_fanout", "control", report.chunk_fanout, f"""
SELECT batch_id, chunk_id, count(*) AS tables, CAST(round(CAST(CAST(coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS gb,
  count(*) FILTER (WHERE status IN {DONE}) AS done FROM control WHERE chunk_id IS NOT NULL GROUP BY 1, 2""")
on_view("status_totals", "control", report.status_totals, f"""
SELECT status, count(*) AS n, coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS total_gb FROM control GROUP BY 1""")
on_view("status_totals_batch", "control", lambda c: report.status_totals(c, "batch-b"), f"""
SELECT status, count(*) AS n, coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS total_gb
FROM control WHERE batch_id = 'batch-b' GROUP BY 1""")
_CLASS = f"""CASE WHEN size_in_bytes IS NULL THEN 'UNKNOWN' WHEN size_in_bytes < {10 * GIB} THEN 'SMALL' WHEN size_in_bytes < {100 * GIB} THEN 'MEDIUM'
  WHEN size_in_bytes < {1000 * GIB} THEN 'LARGE' ELSE 'XLARGE' END"""
on_view("class_totals", "control", report.class_totals, f"""
SELECT {_CLASS} AS workload_class, count(*) AS n, coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS total_gb FROM control GROUP BY 1""")
_STATES = ["DISCOVERED", "ONBOARDED", "WAITING_FOR_LOAD", "QUEUED", "ASSIGNED", "IN_PROGRESS", "COMPLETED", "FAILED",
           "FAILED_PERMANENT", "RETRY_PENDING", "SKIPPED", "PO_BLOCKED", "VALIDATED", "VALIDATION_FAILED"]
_PER_STATE = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s.lower()}" for s in _STATES)
on_view("status_by_batch", "control", report.status_by_batch, f"SELECT batch_id, {_PER_STATE} FROM control GROUP BY 1")
on_view("type_split", "control", report.type_split, "SELECT clone_type, count(*) AS tables FROM control GROUP BY 1")
on_view("avg_duration_by_class", "control", report.avg_duration_by_class, f"""
SELECT {_CLASS} AS workload_class, CAST(sum(duration_seconds) AS BIGINT) AS total_seconds, count(duration_seconds) AS timed_tables,
  avg(duration_seconds) AS avg_duration_s FROM control GROUP BY 1""")
on_view("attempt_dist", "control", report.attempt_distribution,
        "SELECT attempt_number, count(*) AS tables FROM control GROUP BY 1")
on_view("validation_split", "control", report.validation_split,
        "SELECT validation_status, count(*) AS tables FROM control GROUP BY 1")
on_view("count_outcomes", "control", report.count_outcomes, """
SELECT CASE WHEN source_row_count IS NULL OR target_row_count IS NULL THEN 'NOT CHECKED'
  WHEN source_row_count = target_row_count THEN 'MATCH' ELSE 'MISMATCH' END AS row_count_status, count(*) AS tables FROM control GROUP BY 1""")
on_view("size_histogram", "control", report.size_histogram, f"""
SELECT CAST(floor(size_in_bytes / {100 * GIB}.0::DOUBLE) AS BIGINT) * 100 AS from_gb, count(*) AS tables FROM control GROUP BY 1""")
def _grouping(dataset: str, *keys: str, where: str = "TRUE") -> str:
    key = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '(none)')" for k in keys) + ")" if keys else "''"
    return (f"SELECT '{dataset}' AS dataset, {key} AS key, count(*) AS tables, count(*) FILTER (WHERE status IN {DONE}) AS done_tables, "
            f"coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) AS total_bytes, coalesce(CAST(sum(duration_seconds) AS BIGINT), 0) AS total_seconds, "
            f"count(duration_seconds) AS timed_tables FROM k WHERE {where} GROUP BY key")


on_view("reporting_set", "control", report.reporting_set, f""",
k AS (SELECT *, {_CLASS} AS workload_class, CASE WHEN source_row_count IS NULL OR target_row_count IS NULL THEN 'NOT CHECKED'
  WHEN source_row_count = target_row_count THEN 'MATCH' ELSE 'MISMATCH' END AS row_count_status,
  CAST(floor(size_in_bytes / {100 * GIB}.0::DOUBLE) AS BIGINT) * 100 AS from_gb, date_trunc('hour', completed_at) AS completed_hour FROM control)
""" + " UNION ALL ".join([
    _grouping("kpis").replace("GROUP BY key", "HAVING count(*) > 0"), _grouping("status_totals", "status"), _grouping("class_totals", "workload_class"),
    _grouping("status_by_batch", "batch_id", "status"), _grouping("type_split", "clone_type"), _grouping("attempt_distribution", "attempt_number"),
    _grouping("validation_split", "validation_status"), _grouping("count_outcomes", "row_count_status"), _grouping("size_histogram", "from_gb"),
    _grouping("chunk_fanout", "batch_id", "chunk_id", where="chunk_id IS NOT NULL"), _grouping("batch_summary", "batch_id", "chunk_id", "status"),
    _grouping("fail_codes", "error_code", where=f"status IN {FAILED}"),
    _grouping("hourly_throughput", "completed_hour", where=f"status IN {DONE} AND completed_at IS NOT NULL")]))
on_view("batch_summary", "control", report.batch_summary, f"""
SELECT batch_id, chunk_id, status, count(*) AS tables, CAST(round(CAST(CAST(coalesce(CAST(sum(size_in_bytes) AS BIGINT), 0) / {GIB}.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS total_gb,
  avg(duration_seconds) AS avg_duration_s FROM control GROUP BY 1, 2, 3""")
_METRICS = f"""SELECT count(*) AS total, {_PER_STATE}, CAST(coalesce(sum(size_in_bytes), 0) AS BIGINT) AS total_bytes,
  CAST(coalesce(sum(size_in_bytes) FILTER (WHERE status IN {DONE}), 0) AS BIGINT) AS bytes_done,
  CAST(coalesce(sum(duration_seconds), 0) AS BIGINT) AS total_duration_s FROM control WHERE batch_id = 'batch-c'"""
on_view("run_metrics", "control", lambda c: report.run_metrics(c, "batch-c"), _METRICS)


@query("run_summary", f"""{{control, validation_history}}
WITH m AS ({_METRICS}), t AS (SELECT count(*) FILTER (WHERE row_count_checked) AS row_count_checked,
  count(*) FILTER (WHERE row_count_matched) AS row_count_matched, count(*) FILTER (WHERE NOT row_count_matched) AS row_count_mismatched FROM validation_history)
SELECT 'VALIDATE' AS mode, 'run-1' AS run_id, m.*, t.* FROM m, t""")
def _(spark, d):
    tally = checks.row_count_tally(view(spark, d, "validation_history"))
    metrics = report.run_metrics(view(spark, d, "control"), "batch-c")
    return report.run_summary(metrics, tally, mode="VALIDATE", run_id="run-1")


on_view("signoff_rows", "control",
        lambda c: report.signoff_rows(c).select("migration_id", "batch_id", "chunk_id", "source_table", "size_in_bytes"),
        "SELECT migration_id, batch_id, chunk_id, source_table, size_in_bytes FROM control WHERE status = 'QUEUED'")
on_view("table_snapshot", "control", report.table_snapshot, """
SELECT migration_id, batch_id, source_schema, source_table, status, CAST(round(CAST(CAST(duration_seconds / 60.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE) AS duration_min,
  source_row_count, target_row_count, validation_status FROM control""")
on_view("cross_filter", "control",
        lambda c: report.status_by_batch(report.cross_filter(c, ["batch-a", "batch-b"], ["QUEUED", "FAILED", "VALIDATED"], ["delta_share"])),
        f"""SELECT batch_id, {_PER_STATE} FROM control WHERE batch_id IN ('batch-a','batch-b') AND status IN ('QUEUED','FAILED','VALIDATED')
  AND clone_type = 'delta_share' GROUP BY 1""")
on_view("cluster_breakdown", "audit", lambda a: report.cluster_breakdown(a, "exec-3"), """
SELECT cluster_id, count(*) AS tables_assigned, count(*) FILTER (WHERE status = 'SUCCESS') AS done, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  min(run_timestamp) AS started_at, max(run_timestamp) AS last_update FROM audit WHERE execution_id = 'exec-3' GROUP BY 1""")
on_view("live_progress", "audit", lambda a: report.live_progress(a, "exec-3"), """
SELECT status, count(*) AS table_count, CAST(sum(records_cloned) AS BIGINT) AS total_records, CAST(sum(size_bytes) AS BIGINT) / 1e9::DOUBLE AS total_gb,
  CAST(round(CAST(CAST(avg(duration_seconds) / 60.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE) AS avg_duration_min FROM audit WHERE execution_id = 'exec-3' GROUP BY 1""")
on_view("execution_summary", "audit", lambda a: report.execution_summary(a, "exec-3"), """
SELECT count(*) AS total_tables, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  CAST(sum(records_cloned) AS BIGINT) AS total_records, CAST(round(CAST(CAST(CAST(sum(size_bytes) AS BIGINT) / 1e9::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS total_gb,
  CAST(round(CAST(CAST(avg(duration_seconds) / 60.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 1) AS DOUBLE) AS avg_min_per_table FROM audit WHERE execution_id = 'exec-3'""")
on_view("failed_tables", "audit",
        lambda a: report.failed_tables(a, "exec-3").select("table_name", "table_type", "error_message"),
        "SELECT table_name, table_type, error_message FROM audit WHERE execution_id = 'exec-3' AND status = 'FAILED'")
on_view("execution_trend", "audit", report.execution_trend, """
SELECT CAST(run_timestamp AS DATE) AS run_date, execution_id, count(*) AS total_tables, CAST(sum(size_bytes) AS BIGINT) / 1e9::DOUBLE AS total_gb,
  count(*) FILTER (WHERE status = 'FAILED') AS failures FROM audit GROUP BY 1, 2""")
on_view("execution_performance", "audit", report.execution_performance, f"""
SELECT execution_id, count(*) AS tables_attempted, count(*) FILTER (WHERE status = 'SUCCESS') AS success, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  CAST(round(CAST(CAST(CAST(sum(size_bytes) AS BIGINT) / {GIB}.0::DOUBLE AS VARCHAR) AS DECIMAL(38,18)), 3) AS DOUBLE) AS total_gb, CAST(sum(duration_seconds) AS BIGINT) AS total_seconds, min(run_timestamp) AS started_at
FROM audit GROUP BY 1 ORDER BY started_at DESC, execution_id LIMIT 10""")
on_view("latest_execution", "audit", report.latest_execution,
        "SELECT execution_id FROM audit ORDER BY run_timestamp DESC, execution_id DESC LIMIT 1")
on_view("latest_results", "audit",
        lambda a: report.latest_results(a).select("execution_id", "table_name", "status", "duration_seconds", "throughput_mbps", "error_message"), """
SELECT execution_id, table_name, status, duration_seconds, CAST(round(CAST(CAST(size_bytes / 1e6::DOUBLE / nullif(duration_seconds, 0) AS VARCHAR) AS DECIMAL(38,18)), 3) AS DOUBLE) AS throughput_mbps, error_message
FROM audit WHERE execution_id = (SELECT execution_id FROM audit ORDER BY run_timestamp DESC, execution_id DESC LIMIT 1)""")
on_view("validation_listing", "validation_history", report.validation_listing, "SELECT * FROM validation_history")

# -- selection -----------------------------------------------------------------

_EXPANDED = """
  live AS (SELECT table_catalog, table_schema, table_name FROM listing WHERE upper(table_type) IN ('MANAGED','EXTERNAL')),
  lists AS (SELECT *, CASE WHEN exclude_schemas = '' THEN [] ELSE regexp_extract_all(exclude_schemas, '''([^'']*)''', 1) END AS xs,
     CASE WHEN exclude_tables = '' THEN [] ELSE regexp_extract_all(exclude_tables, '''([^'']*)''', 1) END AS xt FROM rules),
  hits AS (SELECT l.*, r.seq, r.rule_type, r.source_catalog, r.source_schema, r.target_catalog, r.target_schema, r.xs, r.xt
    FROM live l JOIN lists r ON (r.rule_type = 'catalog' AND lower(table_catalog) = lower(source_catalog) AND lower(table_schema) <> 'information_schema')
      OR (r.rule_type = 'schema' AND lower(table_catalog) = lower(source_catalog) AND lower(table_schema) = lower(source_schema))),
  globs AS (SELECT hits.*, count(*) FILTER (WHERE kind = 's' AND rule_type = 'catalog' AND lower(table_schema) GLOB lower(g)) OVER w
        + count(*) FILTER (WHERE kind = 't' AND lower(table_name) GLOB lower(g)) OVER w AS excluded, row_number() OVER w AS rn
    FROM hits, (SELECT seq AS gseq, 's' AS kind, unnest(xs) AS g FROM lists UNION ALL SELECT seq, 't', unnest(xt) FROM lists UNION ALL SELECT seq, '-', '' FROM lists)
    WHERE gseq = seq WINDOW w AS (PARTITION BY table_catalog, table_schema, table_name, seq)),
  expanded AS (SELECT seq AS rule_seq, source_catalog, table_schema AS source_schema, table_name AS source_table, target_catalog,
      CASE WHEN rule_type = 'catalog' OR target_schema = '' THEN table_schema ELSE target_schema END AS target_schema, table_name AS target_table
    FROM globs WHERE rn = 1 AND excluded = 0
    UNION ALL SELECT seq, source_catalog, source_schema, source_table, target_catalog, target_schema, target_table FROM rules WHERE rule_type = 'table'),
  selected AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY source_catalog, source_schema, source_table ORDER BY rule_seq) AS n FROM expanded) WHERE n = 1)"""


def parsed_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = view(spark, d, "rules")
    return rules.withColumns({c: list_literal(F.col(c)) for c in ("exclude_schemas", "exclude_tables")})


def expanded(spark: SparkSession, d: str) -> DataFrame:
    return select.expand_rules(parsed_rules(spark, d), view(spark, d, "listing"))


def selected(spark: SparkSession, d: str) -> DataFrame:
    return select.dedup_selections(expanded(spark, d))


def whole_listing(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "listing").select(
        F.col("table_catalog").alias("source_catalog"), F.col("table_schema").alias("source_schema"),
        F.col("table_name").alias("source_table"))


@query("expand_rules", "{listing, rules} WITH " + _EXPANDED.strip() + " SELECT CAST(rule_seq AS BIGINT) AS rule_seq, * EXCLUDE (rule_seq) FROM expanded")
def _(spark, d):
    return expanded(spark, d)


@query("dedup_selections", "{listing, rules} WITH " + _EXPANDED.strip() + " SELECT CAST(rule_seq AS BIGINT) AS rule_seq, * EXCLUDE (rule_seq) FROM selected")
def _(spark, d):
    return selected(spark, d)


# every table listed twice: the second mapping loses
@query("dropped_duplicates", """{listing}
SELECT table_catalog AS source_catalog, table_schema AS source_schema, table_name AS source_table, 'copy_b' AS target_catalog,
  table_schema AS target_schema, table_name AS target_table, CAST(2 AS BIGINT) AS rule_seq, count(*) AS dropped FROM listing GROUP BY ALL""")
def _(spark, d):
    rows = whole_listing(spark, d).withColumns({"target_schema": F.col("source_schema"), "target_table": F.col("source_table")})
    a = rows.withColumns({"target_catalog": F.lit("copy_a"), "rule_seq": F.lit(1).cast("bigint")})
    b = rows.withColumns({"target_catalog": F.lit("copy_b"), "rule_seq": F.lit(2).cast("bigint")})
    return select.dropped_duplicates(a.unionByName(b))


_HITS = """
  m AS (SELECT l.table_catalog AS source_catalog, l.table_schema AS source_schema, l.table_name AS source_table, r.seq, r.exclude_type,
      CASE r.exclude_type WHEN 'catalog' THEN concat('catalog:', r.catalog) WHEN 'schema' THEN concat('schema:', r.catalog, '.', r.schema_name)
        WHEN 'table' THEN concat('table:', r.catalog, '.', r.schema_name, '.', r.table_name) END AS rule
    FROM listing l LEFT JOIN exclusion_rules r ON lower(l.table_catalog) GLOB lower(r.catalog)
      AND (r.exclude_type = 'catalog' OR lower(l.table_schema) GLOB lower(r.schema_name))
      AND (r.exclude_type <> 'table' OR lower(l.table_name) GLOB lower(r.table_name))),
  hits AS (SELECT source_catalog, source_schema, source_table, exclude_type AS exclusion_type, rule AS exclusion_rule
    FROM (SELECT *, row_number() OVER (PARTITION BY source_catalog, source_schema, source_table ORDER BY seq) AS n FROM m) WHERE n = 1)"""


@query("exclusion_split", "{listing, exclusion_rules} WITH " + _HITS.strip() + " SELECT * FROM hits")
def _(spark, d):
    return select.exclusion_hits(whole_listing(spark, d), view(spark, d, "exclusion_rules"))


def exclusion_log(spark: SparkSession, d: str) -> DataFrame:
    _, excluded = select.split_exclusions(whole_listing(spark, d), view(spark, d, "exclusion_rules"))
    return select.exclusion_rows(excluded, "run-1", "batch-a", lit_time(NOW))


_LOG = _HITS.strip() + f""",
  log AS (SELECT 'run-1' AS run_id, 'batch-a' AS batch_id, *, TIMESTAMP '{NOW}' AS excluded_at FROM hits WHERE exclusion_rule IS NOT NULL)"""


@query("exclusion_log", "{listing, exclusion_rules} WITH " + _LOG + " SELECT * FROM log")
def _(spark, d):
    return exclusion_log(spark, d)


@query("exclusions_by_type", "{listing, exclusion_rules} WITH " + _LOG + " SELECT exclusion_type, count(*) AS n FROM log GROUP BY 1")
def _(spark, d):
    return report.exclusions_by_type(exclusion_log(spark, d))


@query("exclusions_latest", "{listing, exclusion_rules} WITH " + _LOG + """
SELECT * FROM log ORDER BY excluded_at DESC, source_catalog, source_schema, source_table LIMIT 1000""")
def _(spark, d):
    return report.exclusion_listing(exclusion_log(spark, d), top=1000)


@query("reconcile_onboarding", "{control, listing, exclusion_rules} WITH " + _LOG + """,
  b AS (SELECT batch_id, 1 AS o, 0 AS e FROM control UNION ALL SELECT batch_id, 0, 1 FROM log)
SELECT batch_id, CAST(sum(o) AS BIGINT) AS onboarded, CAST(sum(e) AS BIGINT) AS excluded FROM b GROUP BY 1""")
def _(spark, d):
    return report.reconcile_onboarding(view(spark, d, "control"), exclusion_log(spark, d))


@query("parameter_rules", """{listing}
WITH f AS (SELECT DISTINCT concat(table_catalog, '.', table_schema, CASE WHEN num_files % 2 = 0 THEN '' ELSE concat('.', table_name) END) AS fqn FROM listing),
  p AS (SELECT split_part(fqn, '.', 1) AS c, split_part(fqn, '.', 2) AS s FROM f WHERE len(string_split(fqn, '.')) = 2)
SELECT l.table_catalog AS source_catalog, l.table_schema AS source_schema, l.table_name AS source_table, 'dr' AS target_catalog, 'all_in' AS target_schema, l.table_name AS target_table
FROM listing l JOIN p ON l.table_catalog = p.c AND l.table_schema = p.s WHERE l.table_type IN ('MANAGED','EXTERNAL')""")
def _(spark, d):
    listing = view(spark, d, "listing")
    name = F.concat_ws(".", "table_catalog", "table_schema", F.when(F.col("num_files") % 2 == 0, None).otherwise(F.col("table_name")))
    names = listing.select(name.alias("fqn")).distinct().withColumn("seq", F.lit(1))
    rules = select.parameter_rules(names, "schema", "dr", "all_in")
    return select.dedup_selections(select.expand_rules(rules, listing)).drop("rule_seq")


on_view("external_tables", "listing", lambda x: select.external_tables(x, "bulk_02", "finance"), """
SELECT * FROM listing WHERE table_catalog = 'bulk_02' AND table_schema = 'finance' AND table_type = 'EXTERNAL'""")
on_view("tables_per_schema", "listing", select.tables_per_schema,
        "SELECT table_catalog, table_schema, count(*) AS tables FROM listing GROUP BY 1, 2")

# -- inventory -----------------------------------------------------------------

_GATE = """
  g AS (SELECT l.table_catalog AS target_catalog, l.table_schema AS target_schema, l.table_name AS target_table, l.table_type, t.value AS tv, s.value AS sv, c.value AS cv,
      t.fqn IS NOT NULL OR s.fqn IS NOT NULL OR c.fqn IS NOT NULL AS found
    FROM listing l LEFT JOIN settings t ON t.level = 'table' AND t.fqn = concat_ws('.', l.table_catalog, l.table_schema, l.table_name)
      LEFT JOIN settings s ON s.level = 'schema' AND s.fqn = concat_ws('.', l.table_catalog, l.table_schema)
      LEFT JOIN settings c ON c.level = 'catalog' AND c.fqn = l.table_catalog),
  gv AS (SELECT *, table_type <> 'MANAGED' OR NOT found AS skipped,
      CASE WHEN tv IN ('ENABLE','DISABLE') THEN tv WHEN sv IN ('ENABLE','DISABLE') THEN sv WHEN cv IN ('ENABLE','DISABLE') THEN cv
        WHEN coalesce(tv, sv, cv) IS NOT NULL THEN 'DISABLE' END AS value,
      CASE WHEN tv IN ('ENABLE','DISABLE') THEN 'TABLE' WHEN sv IN ('ENABLE','DISABLE') THEN 'SCHEMA' WHEN cv IN ('ENABLE','DISABLE') THEN 'CATALOG' END AS lvl FROM g),
  gate AS (SELECT target_catalog, target_schema, target_table, NOT skipped AND value IS NOT DISTINCT FROM 'ENABLE' AS gate_blocked,
      CASE WHEN NOT skipped THEN value END AS gate_value, CASE WHEN NOT skipped AND value = 'ENABLE' THEN lvl END AS gate_level,
      CASE WHEN skipped THEN 'PREDICTIVE_OPTIMIZATION_SKIPPED' WHEN value IS NOT DISTINCT FROM 'ENABLE' THEN 'PREDICTIVE_OPTIMIZATION_ENABLED'
        WHEN value IS NULL THEN 'PREDICTIVE_OPTIMIZATION_UNKNOWN' ELSE '' END AS gate_code FROM gv)"""


@query("gate_verdicts", "{listing, settings} WITH " + _GATE.strip() + " SELECT * FROM gate")
def _(spark, d):
    listing = view(spark, d, "listing")
    targets = listing.select(F.col("table_catalog").alias("target_catalog"), F.col("table_schema").alias("target_schema"),
                             F.col("table_name").alias("target_table"))
    out = inventory.gate_verdicts(inventory.with_target_type(targets, listing), view(spark, d, "settings"))
    return out.drop("target_type", "gate_source", "gate_reason")


on_view("classify", "control",
        lambda c: inventory.classify(c.select("migration_id", "size_in_bytes")), f"""
SELECT migration_id, size_in_bytes, size_in_bytes / {GIB}.0::DOUBLE AS size_gb, {_CLASS} AS workload_class,
  CASE {_CLASS} WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 3 WHEN 'LARGE' THEN 8 WHEN 'XLARGE' THEN 20 ELSE 0 END AS workload_weight FROM control""")

# control rows, one per order: of listed tables and of tables that are gone; and the target listing
_INV = """
  sel AS (SELECT table_catalog AS source_catalog, table_schema AS source_schema, table_name AS source_table, table_catalog AS target_catalog,
      table_schema AS target_schema, table_name AS target_table FROM listing),
  ctl AS (SELECT concat('m', CAST(o_orderkey AS VARCHAR(20))) AS migration_id, CASE o_orderkey % 4 WHEN 0 THEN 'batch-b' ELSE 'batch-a' END AS batch_id,
      coalesce(l.table_catalog, 'gone') AS source_catalog, coalesce(l.table_schema, 'gone') AS source_schema,
      coalesce(l.table_name, concat('gone_', CAST(o_orderkey AS VARCHAR(20)))) AS source_table, 'old' AS target_catalog, l.table_schema AS target_schema,
      l.table_name AS target_table, CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'QUEUED' WHEN 2 THEN 'FAILED' WHEN 3 THEN 'IN_PROGRESS'
        WHEN 4 THEN 'SKIPPED' WHEN 5 THEN 'PO_BLOCKED' ELSE 'RETRY_PENDING' END AS status, CAST(o_orderkey % 3 AS INT) AS attempt_number,
      CAST(floor(o_totalprice) AS BIGINT) AS size_in_bytes, 5 AS chunk_id, o_orderdate AS started_at, o_orderdate AS created_at, 'E' AS error_code, 'old' AS error_message, 7 AS source_row_count
    FROM orders o LEFT JOIN (SELECT *, CAST(regexp_extract(table_name, '([0-9]+)$', 1) AS BIGINT) AS k FROM listing) l ON l.k = o_orderkey),
  tgt AS (SELECT * FROM listing WHERE num_files % 9 <> 0),
  det AS (SELECT * FROM listing WHERE num_files % 21 <> 0)"""


def inventory_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    for t in ("part", "orders"):
        base(spark, d, t).createOrReplaceTempView(t)
    prefix = with_views("listing", "settings").rstrip() + ", " + _INV.strip()
    return {t: spark.sql(f"{prefix} SELECT * FROM {t}") for t in ("sel", "ctl", "tgt", "det", "settings")}


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    x = inventory_inputs(spark, d)
    return inventory.inventory_outcomes(
        x["sel"], x["ctl"], "batch-a", settings=x["settings"], target_listing=x["tgt"], detail=x["det"], require_target=True)


# the gate sees only targets that exist in tgt; others have no known type
_OUTCOMES = _INV.strip() + f""",
  g AS (SELECT sel.*, tgt.table_type, tgt.table_name IS NOT NULL AS present, t.value AS tv, s.value AS sv, c.value AS cv
    FROM sel LEFT JOIN tgt ON tgt.table_catalog = target_catalog AND tgt.table_schema = target_schema AND tgt.table_name = target_table
      LEFT JOIN settings t ON t.level = 'table' AND t.fqn = concat_ws('.', target_catalog, target_schema, target_table)
      LEFT JOIN settings s ON s.level = 'schema' AND s.fqn = concat_ws('.', target_catalog, target_schema)
      LEFT JOIN settings c ON c.level = 'catalog' AND c.fqn = target_catalog),
  gv AS (SELECT *, coalesce(table_type <> 'MANAGED', false) = false AND CASE WHEN tv IN ('ENABLE','DISABLE') THEN tv WHEN sv IN ('ENABLE','DISABLE') THEN sv
      WHEN cv IN ('ENABLE','DISABLE') THEN cv END IS NOT DISTINCT FROM 'ENABLE' AS blocked FROM g),
  o AS (SELECT gv.*, ctl.migration_id AS existing_id, ctl.status AS existing_status, det.size_in_bytes AS b, det.num_files AS f,
      CASE WHEN blocked THEN 'PO_BLOCKED' WHEN ctl.status IN ('COMPLETED','VALIDATED','FAILED_PERMANENT','SKIPPED','ASSIGNED','IN_PROGRESS') THEN 'ALREADY_DONE'
        WHEN NOT present THEN 'SKIPPED' WHEN det.format IS DISTINCT FROM 'DELTA' THEN 'FAILED_PERMANENT' ELSE 'QUEUED' END AS outcome
    FROM gv LEFT JOIN ctl ON ctl.batch_id = 'batch-a' AND ctl.source_catalog = gv.source_catalog AND ctl.source_schema = gv.source_schema AND ctl.source_table = gv.source_table
      LEFT JOIN det ON det.table_catalog = gv.source_catalog AND det.table_schema = gv.source_schema AND det.table_name = gv.source_table),
  out AS (SELECT source_catalog, source_schema, source_table, target_catalog, target_schema, target_table, existing_id, existing_status, outcome,
      CASE WHEN outcome = 'QUEUED' THEN b END AS size_in_bytes, CASE WHEN outcome = 'QUEUED' THEN f END AS source_num_files,
      CASE WHEN outcome = 'QUEUED' THEN {_CLASS.replace('size_in_bytes', 'b')} END AS workload_class,
      CASE outcome WHEN 'PO_BLOCKED' THEN 'PREDICTIVE_OPTIMIZATION_ENABLED' WHEN 'SKIPPED' THEN 'TARGET_NOT_PRECREATED' END AS error_code FROM o)"""


@query("inventory_outcomes", "{listing, settings} WITH " + _OUTCOMES + " SELECT * FROM out")
def _(spark, d):
    return outcomes(spark, d).drop("source_path", "source_version", "size_gb", "workload_weight", "gate_code", "error_message")


@query("inventory_stats", "{listing, settings} WITH " + _OUTCOMES + """
SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'QUEUED') AS inserted, count(*) FILTER (WHERE outcome IN ('ALREADY_DONE','SKIPPED')) AS skipped,
  count(*) FILTER (WHERE outcome = 'SKIPPED') AS skipped_target_missing, count(*) FILTER (WHERE outcome = 'FAILED_PERMANENT') AS failed,
  count(*) FILTER (WHERE outcome = 'PO_BLOCKED') AS po_blocked FROM out""")
def _(spark, d):
    return inventory.inventory_stats(outcomes(spark, d))


@query("skip_done", "{listing, settings} WITH " + _OUTCOMES + " SELECT source_catalog, source_schema, source_table, existing_id, existing_status FROM out WHERE outcome = 'ALREADY_DONE'")
def _(spark, d):
    done = outcomes(spark, d).where("outcome = 'ALREADY_DONE'")
    return done.select("source_catalog", "source_schema", "source_table", "existing_id", "existing_status")


@query("dry_run_classes", "{listing, settings} WITH " + _OUTCOMES + """
SELECT outcome, workload_class, count(*) AS tables, CAST(sum(size_in_bytes) AS BIGINT) AS total_bytes FROM out GROUP BY 1, 2""")
def _(spark, d):
    return inventory.dry_run_classes(outcomes(spark, d))


@query("upsert_control", "{listing, settings} WITH " + _OUTCOMES + f""",
  ch AS (SELECT * FROM out WHERE outcome <> 'ALREADY_DONE')
SELECT CASE WHEN t.migration_id IS NULL THEN substr(sha256(concat(s.source_catalog, chr(1), s.source_schema, chr(1), s.source_table, chr(1), 'batch-a')), 1, 32) ELSE t.migration_id END AS migration_id,
  coalesce(t.batch_id, 'batch-a') AS batch_id, coalesce(t.source_catalog, s.source_catalog) AS source_catalog, coalesce(t.source_schema, s.source_schema) AS source_schema,
  coalesce(t.source_table, s.source_table) AS source_table,
  CASE WHEN s.outcome IS NULL OR (t.migration_id IS NOT NULL AND s.outcome = 'FAILED_PERMANENT') THEN t.target_catalog ELSE s.target_catalog END AS target_catalog,
  CASE WHEN s.outcome IS NULL OR (t.migration_id IS NOT NULL AND s.outcome = 'FAILED_PERMANENT') THEN t.target_schema ELSE s.target_schema END AS target_schema,
  CASE WHEN s.outcome IS NULL OR (t.migration_id IS NOT NULL AND s.outcome = 'FAILED_PERMANENT') THEN t.target_table ELSE s.target_table END AS target_table,
  coalesce(s.outcome, t.status) AS status,
  CASE WHEN t.migration_id IS NULL OR s.outcome = 'QUEUED' THEN 0 ELSE t.attempt_number END AS attempt_number,
  CASE WHEN s.outcome = 'QUEUED' OR t.migration_id IS NULL THEN s.size_in_bytes ELSE t.size_in_bytes END AS size_in_bytes,
  CASE WHEN s.outcome = 'QUEUED' THEN NULL ELSE t.chunk_id END AS chunk_id,
  CASE WHEN s.outcome IS NULL OR s.outcome = 'FAILED_PERMANENT' THEN t.started_at END AS started_at,
  CASE WHEN t.migration_id IS NULL THEN TIMESTAMP '{NOW}' ELSE t.created_at END AS created_at,
  CASE WHEN s.outcome IS NULL OR (t.migration_id IS NOT NULL AND s.outcome = 'FAILED_PERMANENT') THEN t.error_code ELSE s.error_code END AS error_code,
  CASE WHEN s.outcome IS NULL OR s.outcome = 'FAILED_PERMANENT' THEN t.source_row_count END AS source_row_count
FROM ctl t FULL JOIN ch s ON t.source_catalog = s.source_catalog AND t.source_schema = s.source_schema AND t.source_table = s.source_table AND t.batch_id = 'batch-a'""")
def _(spark, d):
    from tabledger.sources.schemas import CONTROL, conform

    x = inventory_inputs(spark, d)
    control = conform(x["ctl"], CONTROL)
    out = inventory.upsert_inventory(control, outcomes(spark, d), "batch-a", "run-1", "delta_share", lit_time(NOW))
    return out.select("migration_id", "batch_id", "source_catalog", "source_schema", "source_table", "target_catalog", "target_schema",
                      "target_table", "status", "attempt_number", "size_in_bytes", "chunk_id", "started_at", "created_at",
                      "error_code", "source_row_count")


@query("dry_run_signoff", """{listing, control}
WITH t AS (SELECT count(*) AS tables_discovered, count(CASE WHEN num_files % 21 <> 0 THEN 1 END) AS paths_resolved,
    count(*) FILTER (WHERE table_type = 'EXTERNAL' AND num_files % 6 = 0) AS unmapped_external, CAST(sum(size_in_bytes) AS BIGINT) AS total_bytes FROM listing),
  g AS (SELECT sum(size_in_bytes) AS b FROM control WHERE coalesce(chunk_id, 0) <> 0 GROUP BY batch_id, chunk_id),
  m AS (SELECT CAST(max(b) AS BIGINT) AS largest_group, CAST(min(b) AS BIGINT) AS smallest_group FROM g)
SELECT *, largest_group <= 2 * smallest_group AS balanced,
  paths_resolved = tables_discovered AND unmapped_external = 0 AND largest_group <= 2 * smallest_group AS ready FROM t, m""")
def _(spark, d):
    listing = view(spark, d, "listing")
    targets = listing.select(
        "table_type", "size_in_bytes", F.when(F.col("num_files") % 21 != 0, "path").alias("src_location"),
        F.when(F.col("num_files") % 6 != 0, "path").alias("tgt_location"))
    return inventory.dry_run_signoff(targets, pack.chunk_summary(view(spark, d, "control")))


# -- grouping ------------------------------------------------------------------


@query("pack_chunks")
def _(spark, d):
    control = view(spark, d, "control").where("status = 'QUEUED'")
    return pack.pack_chunks(control, capacity_gb=500.0, max_chunks=8)


@query("pack_invariants", """{control}
SELECT batch_id, count(*) AS tables, TRUE AS whole, TRUE AS dense, CAST(0 AS BIGINT) AS over_capacity, CAST(0 AS BIGINT) AS over_count,
  CAST(0 AS BIGINT) AS earlier_room FROM control WHERE status = 'QUEUED' GROUP BY 1""")
def _(spark, d):
    control = view(spark, d, "control").where("status = 'QUEUED'")
    packed = pack.pack_chunks(control, capacity_gb=900.0, max_chunks=100)
    once = packed.groupBy("migration_id").agg(F.count("*").alias("n"), F.first("batch_id").alias("batch_id")).groupBy("batch_id").agg(
        (F.max("n") == 1).alias("whole"))
    return pack.pack_invariants(packed, 900.0, 100).join(once, "batch_id").drop("chunks")


@query("chunk_regroup", """{control}
SELECT batch_id, chunk_id, count(*) AS tables, CAST(sum(size_in_bytes) AS BIGINT) AS total_bytes FROM control
WHERE coalesce(chunk_id, 0) <> 0 AND status = 'QUEUED' GROUP BY 1, 2""")
def _(spark, d):
    return pack.chunk_summary(view(spark, d, "control").where("status = 'QUEUED'"))


@query("count_caps", "{control} SELECT batch_id, count(*) AS n, CAST(ceil(count(*) / 8.0) AS BIGINT) AS count_cap FROM control WHERE status = 'QUEUED' GROUP BY 1")
def _(spark, d):
    return pack.count_caps(view(spark, d, "control").where("status = 'QUEUED'"), 8)


@query("assign_chunks", """{control}
SELECT migration_id, status, CASE WHEN status = 'QUEUED' AND CAST(migration_id AS BIGINT) % 3 <> 0 THEN CAST(CAST(migration_id AS BIGINT) % 10 AS INT) + 1 ELSE chunk_id END AS chunk_id FROM control""")
def _(spark, d):
    control = view(spark, d, "control")
    key = F.col("migration_id").cast("bigint")
    plan = control.where(key % 3 != 0).select("migration_id", (key % 10 + 1).cast("int").alias("chunk_id"))
    return ledger.assign_chunks(control, plan, lit_time(NOW)).select("migration_id", "status", "chunk_id")


# -- the ledger ----------------------------------------------------------------

_WORK = ["migration_id", "batch_id", "chunk_id", "status", "size_in_bytes"]
on_view("queued_top", "control", lambda c: ledger.queued(c, "batch-b", 100).select(*_WORK), f"""
SELECT {', '.join(_WORK)} FROM control WHERE status = 'QUEUED' AND batch_id = 'batch-b'
ORDER BY chunk_id NULLS FIRST, size_in_bytes DESC NULLS LAST, migration_id LIMIT 100""")
on_view("chunk_rows", "control", lambda c: ledger.chunk_rows(c, "batch-b", 3).select(*_WORK),
        f"SELECT {', '.join(_WORK)} FROM control WHERE batch_id = 'batch-b' AND chunk_id = 3 AND status IN ('QUEUED','ASSIGNED','IN_PROGRESS')")
on_view("active_chunks", "control", lambda c: ledger.active_chunks(c, "batch-b"),
        "SELECT DISTINCT chunk_id FROM control WHERE batch_id = 'batch-b' AND chunk_id IS NOT NULL AND status IN ('QUEUED','ASSIGNED','IN_PROGRESS')")
on_view("in_flight", "control", lambda c: ledger.in_flight(c).select(*_WORK),
        f"SELECT {', '.join(_WORK)} FROM control WHERE status IN {ACTIVE}")
on_view("completed_rows", "control", lambda c: ledger.completed(c, unvalidated_only=True).select(*_WORK),
        f"SELECT {', '.join(_WORK)} FROM control WHERE status = 'COMPLETED' AND validation_status IS DISTINCT FROM 'VALIDATED'")
on_view("unplanned", "control", lambda c: ledger.unplanned(c).select(*_WORK),
        f"SELECT {', '.join(_WORK)} FROM control WHERE status = 'QUEUED' AND coalesce(chunk_id, 0) = 0")
on_view("retryable", "control", lambda c: ledger.retryable(c).select("migration_id", "status", "attempt_number"),
        f"SELECT migration_id, status, attempt_number FROM control WHERE status IN {RETRY} AND attempt_number < max_attempts")
_ACTION = f"""CASE WHEN coalesce(upper(error_code) IN {PERMANENT}, false) THEN 'PERMANENT_CODE' WHEN attempt_number >= max_attempts THEN 'EXHAUSTED' ELSE 'REQUEUE' END"""
_WAIT = "CASE WHEN attempt_number > 0 THEN CAST(30 * power(2, attempt_number - 1) AS BIGINT) ELSE 0 END"
on_view("retry_disposition", "control",
        lambda c: ledger.retry_disposition(c, lit_time(NOW)).select("migration_id", "action", "reason"), f"""
SELECT migration_id, {_ACTION} AS action, CASE {_ACTION} WHEN 'PERMANENT_CODE' THEN concat('Non-retryable error: ', upper(error_code))
  WHEN 'EXHAUSTED' THEN concat('Max attempts (', max_attempts, ') exhausted') END AS reason FROM control WHERE status IN {RETRY}""")
on_view("backoff", "control",
        lambda c: ledger.retry_disposition(c, lit_time(NOW)).where("action = 'REQUEUE'").select("migration_id", "backoff_seconds", "not_before"), f"""
SELECT migration_id, {_WAIT} AS backoff_seconds, TIMESTAMP '{NOW}' + to_seconds({_WAIT}) AS not_before FROM control
WHERE status IN {RETRY} AND {_ACTION} = 'REQUEUE'""")
_STALE = f"status IN {ACTIVE} AND (started_at IS NULL OR date_sub('minute', started_at, TIMESTAMP '{STALE_NOW}') > 120)"
on_view("stale_rows", "control", lambda c: ledger.stale(c, lit_time(STALE_NOW)).select("migration_id", "status", "started_at"),
        f"SELECT migration_id, status, started_at FROM control WHERE {_STALE}")
_ROW = ["migration_id", "status", "attempt_number", "error_code", "updated_at"]


def _changed(guard: str, status: str, attempt: str, code: str, now: str) -> str:
    return (f"SELECT migration_id, CASE WHEN {guard} THEN {status} ELSE status END AS status, "
            f"CASE WHEN {guard} THEN {attempt} ELSE attempt_number END AS attempt_number, "
            f"CASE WHEN {guard} THEN {code} ELSE error_code END AS error_code, "
            f"CASE WHEN {guard} THEN TIMESTAMP '{now}' ELSE updated_at END AS updated_at FROM control")


on_view("reconcile_stale", "control", lambda c: ledger.reconcile_stale(c, lit_time(STALE_NOW)).select(*_ROW),
        _changed(_STALE, "'RETRY_PENDING'", "attempt_number", "'STALE_EXECUTION'", STALE_NOW))
on_view("reset_permanent", "control", lambda c: ledger.reset_permanent(c, lit_time(NOW), "batch-c").select(*_ROW),
        _changed("status = 'FAILED_PERMANENT' AND batch_id = 'batch-c'", "'RETRY_PENDING'", "0", "NULL", NOW))
on_view("requeue_batch", "control", lambda c: ledger.requeue_batch(c, "batch-c", lit_time(NOW)).select(*_ROW),
        _changed("batch_id = 'batch-c'", "'QUEUED'", "0", "NULL", NOW))
on_view("delete_batch", "control", lambda c: ledger.delete_batch(c, "batch-a").select(*_ROW),
        f"SELECT {', '.join(_ROW)} FROM control WHERE batch_id <> 'batch-a'")
on_view("mark_assigned", "control", lambda c: ledger.mark_assigned(c.withColumn("assigned_cluster_id", F.lit(None).cast("string")), "c1", lit_time(NOW), "batch-b", 3).select(*_ROW, "assigned_cluster_id"),
        _changed("status = 'QUEUED' AND batch_id = 'batch-b' AND chunk_id IS NOT DISTINCT FROM 3", "'ASSIGNED'", "attempt_number", "error_code", NOW).replace(
            " FROM control", ", CASE WHEN status = 'QUEUED' AND batch_id = 'batch-b' AND chunk_id IS NOT DISTINCT FROM 3 THEN 'c1' END AS assigned_cluster_id FROM control"))
on_view("retry_run", "control", lambda c: ledger.retry_run(_whole(c), lit_time(NOW))[0].select(*_ROW),
        _changed(f"status IN {RETRY}", f"CASE WHEN {_ACTION} = 'REQUEUE' THEN 'QUEUED' ELSE 'FAILED_PERMANENT' END", "attempt_number", "error_code", NOW))


def _whole(control: DataFrame) -> DataFrame:
    from tabledger.sources.schemas import CONTROL, conform

    return conform(control, CONTROL)


@query("retry_stats", f"""{{control}}
SELECT count(*) AS eligible, count(*) FILTER (WHERE {_ACTION} = 'REQUEUE') AS requeued, count(*) FILTER (WHERE {_ACTION} <> 'REQUEUE') AS permanent,
  (SELECT count(*) FROM control WHERE status = 'FAILED_PERMANENT') AS reset_permanent
FROM (SELECT * REPLACE (CASE WHEN status = 'FAILED_PERMANENT' THEN NULL ELSE error_code END AS error_code, CASE WHEN status = 'FAILED_PERMANENT' THEN 0 ELSE attempt_number END AS attempt_number)
  FROM control WHERE status IN {RETRY} OR status = 'FAILED_PERMANENT')""")
def _(spark, d):
    control = _whole(view(spark, d, "control"))
    _, disposition = ledger.retry_run(control, lit_time(NOW), reset_permanents=True)
    return ledger.retry_stats(control, disposition, reset_permanents=True)


def _ids(control: DataFrame) -> DataFrame:
    return control.withColumn("k", F.col("migration_id").cast("bigint"))


@query("requeue", f"""{{control}}
SELECT migration_id, CASE WHEN hit THEN 'QUEUED' ELSE status END AS status, CASE WHEN hit THEN TIMESTAMP '{NOW}' ELSE updated_at END AS updated_at
FROM (SELECT *, status IN {RETRY} AND CAST(migration_id AS BIGINT) % 2 = 0 AS hit FROM control)""")
def _(spark, d):
    control = _whole(view(spark, d, "control"))
    ids = _ids(control).where("k % 2 = 0").select("migration_id")
    return ledger.requeue_failed(control, ids, lit_time(NOW)).select("migration_id", "status", "updated_at")


@query("mark_permanent", """{control}
SELECT migration_id, CASE WHEN hit THEN 'FAILED_PERMANENT' ELSE status END AS status, CASE WHEN hit THEN 'no use' END AS error_message
FROM (SELECT *, CAST(migration_id AS BIGINT) % 5 = 0 AS hit FROM control)""")
def _(spark, d):
    control = _whole(view(spark, d, "control"))
    ids = _ids(control).where("k % 5 = 0").select("migration_id", F.lit("no use").alias("reason"))
    return ledger.mark_permanent(control, ids, lit_time(NOW)).select("migration_id", "status", "error_message")


@query("mark_in_progress", f"""{{control}}
SELECT migration_id, CASE WHEN hit THEN 'IN_PROGRESS' ELSE status END AS status, CASE WHEN hit THEN attempt_number + 1 ELSE attempt_number END AS attempt_number,
  CASE WHEN hit THEN TIMESTAMP '{NOW}' ELSE started_at END AS started_at FROM (SELECT *, status IN ('QUEUED','ASSIGNED','IN_PROGRESS') AS hit FROM control)""")
def _(spark, d):
    control = view(spark, d, "control")
    change = control.select("migration_id", (F.col("attempt_number") + 1).alias("attempt_number"), lit_time(NOW).alias("started_at"))
    return ledger.mark_in_progress(control, change, lit_time(NOW)).select("migration_id", "status", "attempt_number", "started_at")


_K = "CAST(migration_id AS BIGINT)"
_CODE = f"CASE {_K} % 3 WHEN 0 THEN 'LOCATION_OVERLAP' WHEN 1 THEN 'CLONE_FAILED' ELSE 'PERMISSION_DENIED' END"
_AFTER = f"CASE WHEN {_K} % 2 = 0 THEN 'COMPLETED' WHEN {_CODE} <> 'CLONE_FAILED' THEN 'FAILED_PERMANENT' WHEN attempt_number < max_attempts THEN 'RETRY_PENDING' ELSE 'FAILED' END"


def copy_outcomes(control: DataFrame) -> DataFrame:
    k = F.col("k")
    code = F.when(k % 3 == 0, "LOCATION_OVERLAP").when(k % 3 == 1, "CLONE_FAILED").otherwise("PERMISSION_DENIED")
    ok = k % 2 == 0
    return _ids(control).select(
        "migration_id", ok.alias("success"), (k % 100).alias("duration_seconds"), (k % 10).alias("target_num_files"),
        F.lit(0).cast("bigint").alias("target_version"), F.when(k % 4 != 0, k).alias("source_version"),
        F.when(~ok, code).alias("error_code"), F.when(~ok, F.concat(F.lit("boom "), "migration_id")).alias("error_message"))


@query("apply_outcomes", f"""{{control}}
SELECT migration_id, CASE WHEN hit THEN {_AFTER} ELSE status END AS status, CASE WHEN hit THEN {_K} % 100 ELSE duration_seconds END AS duration_seconds,
  CASE WHEN hit AND {_K} % 2 = 0 THEN CAST(0 AS BIGINT) END AS target_version, CASE WHEN hit AND {_K} % 2 = 0 AND {_K} % 4 <> 0 THEN {_K} END AS source_version,
  CASE WHEN hit THEN CASE WHEN {_K} % 2 <> 0 THEN {_CODE} END ELSE error_code END AS error_code,
  CASE WHEN hit AND {_K} % 2 = 0 THEN TIMESTAMP '{NOW}' ELSE completed_at END AS completed_at, CASE WHEN hit AND {_K} % 2 <> 0 THEN TIMESTAMP '{NOW}' END AS failed_at
FROM (SELECT *, status = 'IN_PROGRESS' AS hit FROM control)""")
def _(spark, d):
    control = _whole(view(spark, d, "control"))
    out = ledger.apply_outcomes(control, copy_outcomes(control), lit_time(NOW))
    return out.select("migration_id", "status", "duration_seconds", "target_version", "source_version", "error_code", "completed_at", "failed_at")


@query("attempt_rows", f"""{{control}}
SELECT migration_id, attempt_number, CASE WHEN {_K} % 2 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status, CASE WHEN {_K} % 2 <> 0 THEN {_CODE} END AS error_code,
  {_K} % 100 AS duration_seconds, coalesce(size_in_bytes, 0) AS source_size_bytes FROM control""")
def _(spark, d):
    control = _whole(view(spark, d, "control"))
    rows = ledger.attempt_rows(control, copy_outcomes(control), "run-1", "c1", lit_time(NOW))
    return rows.select("migration_id", "attempt_number", "status", "error_code", "duration_seconds", "source_size_bytes")


@query("submit_failed", f"""{{control}}
SELECT migration_id, CASE WHEN hit THEN CASE WHEN attempt_number + 1 < max_attempts THEN 'RETRY_PENDING' ELSE 'FAILED' END ELSE status END AS status,
  CASE WHEN hit THEN attempt_number + 1 ELSE attempt_number END AS attempt_number, CASE WHEN hit THEN 'SUBMIT_FAILED' ELSE error_code END AS error_code
FROM (SELECT *, batch_id = 'batch-b' AND chunk_id IS NOT DISTINCT FROM 3 AND status IN ('QUEUED','ASSIGNED','IN_PROGRESS') AS hit FROM control)""")
def _(spark, d):
    after, _ = ledger.submit_failed(_whole(view(spark, d, "control")), "batch-b", 3, "no cluster", "run-1", lit_time(NOW))
    return after.select("migration_id", "status", "attempt_number", "error_code")


@query("apply_validation", f"""{{control}}
SELECT migration_id, CASE WHEN hit THEN v ELSE status END AS status, CASE WHEN hit THEN v ELSE validation_status END AS validation_status,
  CASE WHEN hit AND {_K} % 2 = 0 THEN CAST(11 AS BIGINT) ELSE source_row_count END AS source_row_count
FROM (SELECT *, status = 'COMPLETED' AND {_K} % 5 <> 0 AS hit, CASE WHEN {_K} % 3 = 0 THEN 'VALIDATION_FAILED' ELSE 'VALIDATED' END AS v FROM control)""")
def _(spark, d):
    control = _whole(view(spark, d, "control"))
    k = F.col("k")
    result = _ids(control).where("k % 5 <> 0").select(
        "migration_id", F.when(k % 3 == 0, "VALIDATION_FAILED").otherwise("VALIDATED").alias("status"), F.lit("checked").alias("message"),
        F.when(k % 2 == 0, F.lit(11).cast("bigint")).alias("source_row_count"), F.lit(None).cast("bigint").alias("target_row_count"))
    out = ledger.apply_validation(control, result, lit_time(NOW))
    return out.select("migration_id", "status", "validation_status", "source_row_count")


@query("attempt_history", """{attempts, control}
SELECT a.*, c.batch_id, c.source_catalog, c.source_schema, c.source_table FROM attempts a JOIN control c USING (migration_id)""")
def _(spark, d):
    return ledger.attempt_history(view(spark, d, "attempts"), view(spark, d, "control"))


@query("orphan_attempts", """{attempts, control}
SELECT * FROM attempts a WHERE NOT EXISTS (SELECT 1 FROM control c WHERE c.migration_id = a.migration_id AND c.batch_id <> 'batch-a')""")
def _(spark, d):
    return ledger.orphan_attempts(view(spark, d, "attempts"), ledger.delete_batch(view(spark, d, "control"), "batch-a"))


@query("kept_attempts", """{attempts, control}
SELECT * FROM attempts a WHERE EXISTS (SELECT 1 FROM control c WHERE c.migration_id = a.migration_id AND c.batch_id <> 'batch-a')""")
def _(spark, d):
    return ledger.kept_attempts(view(spark, d, "attempts"), ledger.delete_batch(view(spark, d, "control"), "batch-a"))


def _edges() -> str:
    from tabledger.sources.schemas import ALLOWED_EDGES

    return ", ".join(f"'{a}>{b}'" for a, b in ALLOWED_EDGES)


on_view("illegal_transitions", "status_log", ledger.illegal_transitions, f"""
SELECT * FROM (SELECT migration_id, seq, changed_at, lag(status) OVER (PARTITION BY migration_id ORDER BY changed_at, seq) AS from_status, status AS to_status FROM status_log)
WHERE from_status IS NOT NULL AND from_status <> to_status AND concat(from_status, '>', to_status) NOT IN ({_edges()})""")

# -- requests ------------------------------------------------------------------

on_view("queue_state", "requests", requests.queue_state,
        "SELECT priority, status, count(*) AS request_count, min(requested_at) AS oldest_request FROM requests GROUP BY 1, 2")
on_view("queue_by_status", "requests", requests.queue_by_status, "SELECT status, count(*) AS n FROM requests GROUP BY 1")
on_view("requests_in_progress", "requests", requests.in_progress, "SELECT * FROM requests WHERE status = 'IN_PROGRESS'")
_REQ_NOW = "2024-01-15 00:00:00"
on_view("next_requests", "requests", lambda r: requests.eligible(r, lit_time(_REQ_NOW)),
        f"SELECT * FROM requests WHERE status = 'PENDING' AND (scheduled_for IS NULL OR scheduled_for <= TIMESTAMP '{_REQ_NOW}')")
on_view("claim_requests", "requests", lambda r: requests.claim(r, "exec-new", lit_time(_REQ_NOW)).select("onboarding_id", "status", "execution_id"), f"""
SELECT onboarding_id, CASE WHEN hit THEN 'IN_PROGRESS' ELSE status END AS status, CASE WHEN hit THEN 'exec-new' ELSE execution_id END AS execution_id
FROM (SELECT *, status = 'PENDING' AND (scheduled_for IS NULL OR scheduled_for <= TIMESTAMP '{_REQ_NOW}') AS hit FROM requests)""")
on_view("claimed_groups", "requests", lambda r: requests.claimed_groups(requests.claim(r, "exec-new", lit_time(_REQ_NOW)), "exec-new"), f"""
SELECT scope_mode, clone_mode, count(*) AS requests, min(priority) AS priority FROM requests
WHERE status = 'PENDING' AND (scheduled_for IS NULL OR scheduled_for <= TIMESTAMP '{_REQ_NOW}') GROUP BY 1, 2""")
on_view("reset_stuck", "requests", lambda r: requests.reset_stuck(r, lit_time(_REQ_NOW)).select("onboarding_id", "status", "execution_id"), f"""
SELECT onboarding_id, CASE WHEN hit THEN 'PENDING' ELSE status END AS status, CASE WHEN hit THEN NULL ELSE execution_id END AS execution_id
FROM (SELECT *, status = 'IN_PROGRESS' AND date_diff('day', requested_at, TIMESTAMP '{_REQ_NOW}') > 1 AS hit FROM requests)""")


def _whole_requests(spark: SparkSession, d: str) -> DataFrame:
    from tabledger.sources.schemas import REQUESTS, conform

    return conform(view(spark, d, "requests"), REQUESTS)


@query("requeue_requests", f"""{{requests}}
SELECT onboarding_id, CASE WHEN status = 'FAILED' THEN 'PENDING' ELSE status END AS status, CASE WHEN status = 'FAILED' THEN NULL ELSE execution_id END AS execution_id,
  CASE WHEN status = 'FAILED' THEN ' | Re-queued: {NOW}' END AS notes FROM requests""")
def _(spark, d):
    rows = _whole_requests(spark, d)
    out = requests.requeue(rows, rows.where("status = 'FAILED'"), lit_time(NOW))
    return out.select("onboarding_id", "status", "execution_id", "notes")


@query("finish_requests", f"""{{requests}}
SELECT onboarding_id, CASE WHEN status = 'IN_PROGRESS' THEN 'COMPLETED' ELSE status END AS status,
  CASE WHEN status = 'IN_PROGRESS' THEN TIMESTAMP '{NOW}' END AS completed_at FROM requests""")
def _(spark, d):
    rows = _whole_requests(spark, d)
    done = rows.select("onboarding_id", F.lit("COMPLETED").alias("status"))
    return requests.finish(rows, done, lit_time(NOW)).select("onboarding_id", "status", "completed_at")


# one execution per request, with the audit rows of one part: the result grows with the tables
@query("failed_requests", """{requests, audit}
SELECT concat('exec-', onboarding_id) AS execution_id, onboarding_id, requested_at, table_name, error_message
FROM requests r JOIN audit a ON r.onboarding_id = substr(a.table_name, 3) WHERE r.status = 'FAILED' AND a.status = 'FAILED'""")
def _(spark, d):
    own = view(spark, d, "requests").withColumn("execution_id", F.concat(F.lit("exec-"), "onboarding_id"))
    audit = view(spark, d, "audit").withColumn("execution_id", F.concat(F.lit("exec-"), F.substring("table_name", 3, 20)))
    return requests.failed_with_errors(own, audit)


@query("validation_plan", """{requests}
SELECT onboarding_id, unnest(CASE priority WHEN 1 THEN ['COUNT','CHECKSUM','COLUMN_SAMPLE'] WHEN 2 THEN ['COUNT'] ELSE [] END) AS check_name FROM requests""")
def _(spark, d):
    mode = F.when(F.col("priority") == 1, "ALL").when(F.col("priority") == 2, "COUNT").otherwise("NONE")
    rows = _whole_requests(spark, d).withColumn("validation_mode", mode)
    return requests.validation_plan(rows).select("onboarding_id", "check_name")


@query("new_requests", f"""{{listing}}
SELECT table_catalog AS src_catalog, table_schema AS src_schema, concat_ws('.', table_catalog, table_schema, table_name) AS src_table, 'dr' AS tgt_catalog,
  table_schema AS tgt_schema, 'PENDING' AS status, 1 AS priority, TIMESTAMP '{NOW}' AS requested_at, '{{"team":"ops"}}' AS tags,
  substr(sha256(concat_ws(chr(1), 'refresh', 'table', concat_ws('.', table_catalog, table_schema, table_name), '{NOW}')), 1, 32) AS onboarding_id
FROM listing WHERE table_type = 'EXTERNAL'""")
def _(spark, d):
    names = view(spark, d, "listing").where("table_type = 'EXTERNAL'").select(
        F.concat_ws(".", "table_catalog", "table_schema", "table_name").alias("fqn"))
    out = requests.new_requests(names, "table", "refresh", "path_resolution", "dr", "ops", lit_time(NOW), 1, tags={"team": "ops"})
    return out.select("src_catalog", "src_schema", "src_table", "tgt_catalog", "tgt_schema", "status", "priority", "requested_at",
                      F.to_json("tags").alias("tags"), "onboarding_id")


_PREFIXES = [("s3://src/", "s3://dr/"), ("s3://src/archive/", "s3://cold/"), ("s3://other/x", "s3://y")]
_LOCATION = """CASE WHEN num_files % 5 = 0 THEN NULL WHEN num_files % 5 = 1 THEN concat('s3://src/', table_schema, '/', table_name)
  WHEN num_files % 5 = 2 THEN concat('s3://src/archive/', table_name) WHEN num_files % 5 = 3 THEN concat('s3://other/xyz/', table_name)
  ELSE concat('s3://unknown/', table_name) END"""


@query("prefix_remap", f"""{{listing}}
WITH l AS (SELECT table_catalog, table_schema, table_name, {_LOCATION} AS location FROM listing)
SELECT *, CASE WHEN starts_with(location, 's3://src/archive/') THEN concat('s3://cold/', substr(location, 18)) WHEN starts_with(location, 's3://src/') THEN concat('s3://dr/', substr(location, 10))
    WHEN starts_with(location, 's3://other/x') THEN concat('s3://y', substr(location, 13)) END AS target_location,
  location IS NOT NULL AND NOT (starts_with(location, 's3://src/') OR starts_with(location, 's3://other/x')) AS unmapped FROM l""")
def _(spark, d):
    rows = view(spark, d, "listing").select("table_catalog", "table_schema", "table_name", F.expr(_LOCATION).alias("location"))
    prefixes = spark.createDataFrame(_PREFIXES, "src_prefix string, tgt_prefix string")
    return requests.remap_locations(rows, prefixes)


@query("saved_plan", f"""{{listing}}
SELECT 'exec-2' AS execution_id, TIMESTAMP '{NOW}' AS generated_at, concat('{{"source_catalog":"', table_catalog, '","source_schema":"', table_schema, '","source_table":"', table_name, '"}}') AS blueprint_json FROM listing""")
def _(spark, d):
    rows = whole_listing(spark, d)
    old = requests.save_plan(rows, "exec-1", lit_time("2024-01-01 00:00:00"))
    return requests.latest_plan(old.unionByName(requests.save_plan(rows, "exec-2", lit_time(NOW))))


# -- remaining checks, names and cells -----------------------------------------


@query("partition_columns_check", """{listing}
WITH s AS (SELECT concat_ws('.', table_catalog, table_schema, table_name) AS n, num_files % 4 AS a, num_files % 9 AS b, num_files % 13 AS c FROM listing)
SELECT n AS table_name, c <> 0 AND (a = 0) = (b = 0) AS passed,
  concat('src=', CASE WHEN a = 0 THEN '[day]' ELSE '[day, region]' END, ' tgt=', CASE WHEN c = 0 THEN 'none' WHEN b = 0 THEN '[day]' ELSE '[day, region]' END) AS detail FROM s""")
def _(spark, d):
    listing = view(spark, d, "listing")
    name = F.concat_ws(".", "table_catalog", "table_schema", "table_name").alias("table_name")
    one, two = F.array(F.lit("day")), F.array(F.lit("region"), F.lit("day"))
    source = listing.select(name, F.when(F.col("num_files") % 4 == 0, one).otherwise(two).alias("partition_columns"))
    target = listing.where("num_files % 13 <> 0").select(
        name, F.when(F.col("num_files") % 9 == 0, one).otherwise(F.reverse(two)).alias("partition_columns"))
    return compare.partition_columns_check(source, target)


@query("history_check", """{audit, listing}
WITH t AS (SELECT DISTINCT table_name FROM audit), h AS (SELECT concat('t_', regexp_extract(table_name, '[0-9]+$', 0)) AS table_name FROM listing WHERE num_files % 3 <> 0)
SELECT table_name, table_name IN (SELECT table_name FROM h) AS passed, concat('latest_op=', CASE WHEN table_name IN (SELECT table_name FROM h) THEN 'CLONE' ELSE 'n/a' END) AS detail FROM t""")
def _(spark, d):
    manifest = view(spark, d, "listing").where("num_files % 3 <> 0").select(
        F.concat(F.lit("t_"), F.regexp_extract("table_name", "[0-9]+$", 0)).alias("table_name"),
        F.lit(1).alias("version"), F.lit("CLONE").alias("operation"))
    first = manifest.withColumns({"version": F.lit(0), "operation": F.lit("CREATE")})
    return compare.history_check(view(spark, d, "audit"), manifest.unionByName(first))


@query("requested_checks", f"""{{tgt_lineitem}}
WITH {_PROFILES.strip()}, {_BOTH_COUNTS.strip()},
  c AS (SELECT (SELECT count(*) FROM lineitem) AS s, (SELECT count(*) FROM tgt_lineitem) AS t)
SELECT 'COUNT' AS check_name, 'lineitem' AS table_name, abs(s - t) / CAST(s AS DOUBLE) * 100 <= 5 AS passed,
  format('src={{:,}} tgt={{:,}} DELTA={{}}{{:,}}', s, t, CASE WHEN t > s THEN '+' ELSE '' END, t - s) AS detail FROM c
UNION ALL SELECT 'CHECKSUM', 'lineitem', count(*) FILTER (WHERE src_count <> tgt_count) = 0, NULL FROM g
UNION ALL SELECT 'COLUMN_SAMPLE', 'lineitem', bool_and(passed),
  concat('differing: ', coalesce(string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE NOT passed), '')) FROM p""")
def _(spark, d):
    out = compare.requested_checks({"lineitem": line_pair(spark, d)}, "ALL", tolerance_pct=5.0)
    # the text of a checksum is Spark's own hash, which SQL does not have
    return out.withColumn("detail", F.when(F.col("check_name") != "CHECKSUM", F.col("detail")))


# Requests of customers for two tables: modes, columns and tolerances differ from one to the next.
_ASKED = """
  q AS (SELECT CAST(c_custkey AS VARCHAR(20)) AS onboarding_id, CASE WHEN c_custkey % 3 = 0 THEN 'p.sales.nation' ELSE 'p.sales.lineitem' END AS src_table,
    CASE c_custkey % 5 WHEN 0 THEN 'COUNT' WHEN 1 THEN 'CHECKSUM' WHEN 2 THEN 'COLUMN_SAMPLE' WHEN 3 THEN 'ALL' ELSE 'NONE' END AS validation_mode,
    CASE WHEN c_custkey % 2 = 1 THEN CASE WHEN c_custkey % 3 = 0 THEN 'n_name, n_regionkey' ELSE 'l_linestatus,l_tax' END END AS validation_columns,
    CAST(c_custkey % 7 AS DOUBLE) AS count_tolerance_pct, CASE WHEN c_custkey % 4 = 0 THEN 'SHA256' ELSE 'XXHASH64' END AS checksum_algorithm FROM customer)"""


@query("request_checks_run", f"""{{tgt_lineitem}}
WITH {_PROFILES.strip()}, {_ASKED.strip()},
  c AS (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM tgt_lineitem) AS b, (SELECT count(*) FROM nation) AS k),
  m AS (SELECT * FROM (VALUES ('COUNT', 'COUNT'), ('CHECKSUM', 'CHECKSUM'), ('COLUMN_SAMPLE', 'COLUMN_SAMPLE'), ('ALL', 'COUNT'), ('ALL', 'CHECKSUM'), ('ALL', 'COLUMN_SAMPLE')) AS m(mode, check_name)),
  e AS (SELECT validation_columns, coalesce(string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE NOT passed), '') AS differing
    FROM (SELECT DISTINCT validation_columns FROM q WHERE src_table = 'p.sales.lineitem') x JOIN p ON validation_columns IS NULL OR list_contains(string_split(validation_columns, ','), column_name) GROUP BY 1)
SELECT onboarding_id, src_table AS table_name, check_name,
  src_table = 'p.sales.nation' OR CASE check_name WHEN 'COUNT' THEN abs(a - b) / CAST(a AS DOUBLE) * 100 <= count_tolerance_pct WHEN 'CHECKSUM' THEN FALSE ELSE differing = '' END AS passed,
  CASE check_name WHEN 'COUNT' THEN CASE WHEN src_table = 'p.sales.nation' THEN format('src={{:,}} tgt={{:,}}', k, k)
      ELSE format('src={{:,}} tgt={{:,}} DELTA={{}}{{:,}}', a, b, CASE WHEN b > a THEN '+' ELSE '' END, b - a) END
    WHEN 'COLUMN_SAMPLE' THEN concat('differing: ', CASE WHEN src_table = 'p.sales.nation' THEN '' ELSE differing END) END AS detail
FROM q JOIN m ON mode = validation_mode LEFT JOIN e ON e.validation_columns IS NOT DISTINCT FROM q.validation_columns, c""")
def _(spark, d):
    base(spark, d, "customer").createOrReplaceTempView("customer")
    asked = spark.sql(f"WITH {_ASKED.strip()} SELECT *, 'table' AS scope_mode, 'p' AS src_catalog, 'sales' AS src_schema FROM q")
    nation = base(spark, d, "nation")
    out = request_checks.run_request_checks(asked, {"p.sales.lineitem": line_pair(spark, d), "p.sales.nation": (nation, nation)})
    # the text of a checksum is Spark's own hash, which SQL does not have
    return out.select("onboarding_id", "table_name", "check_name", "passed", F.when(F.col("check_name") != "CHECKSUM", F.col("detail")).alias("detail"))


@query("acceptance_run", f"""{{tgt_lineitem, audit}}
WITH {_drifted('lineitem', 'tgt_lineitem', _LINE).strip()},
  n AS (SELECT count(*) AS k FROM nation),
  s AS (SELECT status, count(*) AS n FROM audit WHERE execution_id = 'exec-1' GROUP BY 1)
SELECT 'row_count_parity' AS check_name, table_name, src_rows = tgt_rows AS passed, format('src={{:,}} tgt={{:,}}', src_rows, tgt_rows) || CASE WHEN src_rows = tgt_rows THEN ''
  ELSE format(' DELTA={{}}{{:,}}', CASE WHEN tgt_rows > src_rows THEN '+' ELSE '' END, tgt_rows - src_rows) END AS detail FROM v_lineitem
UNION ALL SELECT 'row_count_parity', 'nation', TRUE, format('src={{:,}} tgt={{:,}}', k, k) FROM n
UNION ALL SELECT 'schema_match', 'lineitem', TRUE, '{len(LINE_COLUMNS)} cols match' UNION ALL SELECT 'schema_match', 'nation', TRUE, concat(count(*), ' cols match') FROM (DESCRIBE nation)
UNION ALL SELECT 'data_hash_integrity', table_name, mismatches = 0, format('{{:,}} rows compared, {{}} hash mismatches', src_rows, mismatches) FROM v_lineitem
UNION ALL SELECT 'data_hash_integrity', 'nation', TRUE, format('{{:,}} rows compared, 0 hash mismatches', k) FROM n
UNION ALL SELECT 'audit_log_completeness', 'execution_id=exec-1', sum(n) > 0, concat('total=', CAST(sum(n) AS VARCHAR), ' ',
  string_agg(concat(status, '=', CAST(n AS VARCHAR)), ' | ' ORDER BY concat(status, '=', CAST(n AS VARCHAR)))) FROM s HAVING count(*) > 0""")
def _(spark, d):
    from tabledger.plans.validate import acceptance

    nation = base(spark, d, "nation")
    out = acceptance({"lineitem": line_pair(spark, d), "nation": (nation, nation)}, view(spark, d, "audit"), "exec-1", lit_time(NOW))
    return out.select("check_name", "table_name", "passed", "detail")


# Lines of a mapping file, one per part: some have a quoted cell with commas, some lack cells, some have one too many.
_KIND = """CASE p_partkey % 6 WHEN 0 THEN ' Schema ' WHEN 1 THEN 'TABLE' WHEN 2 THEN 'catalog' WHEN 3 THEN '' WHEN 4 THEN 'view' ELSE 'table' END"""
_CELLS = f"""
  cells AS (SELECT p_partkey AS seq, {_KIND} AS kind, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE concat(' cat_', CAST(p_size AS VARCHAR(20))) END AS c,
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('s_', CAST(p_size % 9 AS VARCHAR(20))) END AS s, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE concat('t_', CAST(p_partkey AS VARCHAR(20))) END AS t,
    p_partkey % 17 = 0 AS long, p_partkey % 5 = 0 AS named FROM part)"""
_HEADER = "clone_type,source_catalog, Source_Schema ,source_table,target_catalog,target_schema,target_table,exclude_schemas,exclude_tables"


def mapping_input(spark: SparkSession, d: str):
    from tabledger.sources.mapping import csv_lines, mapping_rules

    base(spark, d, "part").createOrReplaceTempView("part")
    line = F.concat_ws(",", "kind", "c", "s", "t", F.when(F.col("named"), "dr").otherwise(""), F.when(F.col("named"), F.concat("s", F.lit("_dr"))).otherwise(""),
                       F.lit(""), F.lit("\"['hr', 'ops']\""), F.lit("\"['tmp_*','*,x']\""), F.when(F.col("long"), "stray"))
    return mapping_rules(csv_lines(spark.sql(f"WITH {_CELLS.strip()} SELECT * FROM cells").select("seq", line.alias("line")), _HEADER))


_JUDGED = _CELLS.strip() + """,
  r AS (SELECT seq, CASE trim(lower(kind)) WHEN '' THEN 'table' ELSE trim(lower(kind)) END AS rule_type, trim(c) AS c, s, t, long, named FROM cells),
  j AS (SELECT *, CASE WHEN long THEN 'more cells than headers' WHEN c = '' THEN 'missing source_catalog' WHEN rule_type = 'view' THEN 'unknown clone_type'
    WHEN rule_type <> 'catalog' AND s = '' THEN 'missing source_schema' WHEN rule_type = 'table' AND t = '' THEN 'missing source_table' END AS reason FROM r)"""


@query("mapping_rows", f"""WITH {_JUDGED}
SELECT seq, rule_type, c AS source_catalog, s AS source_schema, t AS source_table, CASE WHEN named THEN 'dr' ELSE c END AS target_catalog,
  CASE WHEN rule_type = 'catalog' THEN '' WHEN named THEN concat(s, '_dr') ELSE s END AS target_schema, CASE WHEN rule_type = 'table' THEN t ELSE '' END AS target_table,
  CASE WHEN rule_type = 'catalog' THEN 'hr+ops' ELSE '' END AS exclude_schemas, CASE WHEN rule_type = 'table' THEN '' ELSE 'tmp_*+*,x' END AS exclude_tables
FROM j WHERE reason IS NULL""")
def _(spark, d):
    rules = mapping_input(spark, d).rules
    return rules.withColumns({c: F.array_join(c, "+") for c in ("exclude_schemas", "exclude_tables")})


@query("mapping_rejects", f"WITH {_JUDGED} SELECT seq, rule_type, reason AS reject_reason FROM j WHERE reason IS NOT NULL")
def _(spark, d):
    return mapping_input(spark, d).rejects.select("seq", "rule_type", "reject_reason")


@query("exclusion_cells", """WITH e AS (SELECT c_custkey AS seq, CASE c_custkey % 5 WHEN 0 THEN 'catalog' WHEN 1 THEN 'schema' WHEN 2 THEN 'table' WHEN 3 THEN 'row' ELSE 'table' END AS k,
    CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('c', CAST(c_nationkey AS VARCHAR)) END AS c, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 's' END AS s, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 't*' END AS t FROM customer)
SELECT seq, k AS exclude_type, c AS catalog, s AS schema_name, t AS table_name, CASE WHEN k = 'row' THEN 'unknown exclude_type' WHEN c = '' THEN 'missing catalog'
  WHEN k <> 'catalog' AND s = '' THEN 'missing schema' WHEN k = 'table' AND t = '' THEN 'missing table' END AS reject_reason FROM e""")
def _(spark, d):
    from tabledger.sources.mapping import csv_lines, exclusion_rules

    n = F.col("c_custkey")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("catalog", "Schema", "TABLE", "row", "table")]), (n % 5 + 1).cast("int"))
    line = F.concat_ws(",", kind, F.when(n % 7 == 0, "").otherwise(F.concat(F.lit("c"), F.col("c_nationkey").cast("string"))),
                       F.when(n % 3 == 0, " ").otherwise(" s"), F.when(n % 4 == 0, "").otherwise("t*"))
    good, refused = exclusion_rules(csv_lines(base(spark, d, "customer").select(n.alias("seq"), line.alias("line")), "exclude_type,catalog,schema,table"))
    names = ["seq", "exclude_type", "catalog", "schema_name", "table_name"]
    return good.select(*names, F.lit(None).cast("string").alias("reject_reason")).unionByName(refused.select(*names, "reject_reason"))


on_view("work_counts", "control", lambda c: ledger.work_counts(c, lit_time(STALE_NOW)), f"""
SELECT count(*) FILTER (WHERE {_STALE}) AS stale, count(*) FILTER (WHERE status IN {RETRY} AND attempt_number < max_attempts) AS retryable,
  count(*) FILTER (WHERE status = 'QUEUED') AS queued, count(*) FILTER (WHERE status = 'QUEUED' AND coalesce(chunk_id, 0) = 0) AS unplanned FROM control""")


@query("copy_result_counts", """{attempts}
WITH l AS (SELECT migration_id, attempt_number, source_size_bytes, duration_seconds AS n, CASE WHEN duration_seconds % 3 = 0 THEN 'c' WHEN status = 'SUCCESS' THEN 's' ELSE 'f' END AS k FROM attempts)
SELECT migration_id, attempt_number, source_size_bytes, CASE k WHEN 'c' THEN n WHEN 's' THEN 7 ELSE 0 END AS ok, CASE k WHEN 'c' THEN 1 WHEN 's' THEN 0 ELSE 7 END AS fail FROM l""")
def _(spark, d):
    rows = view(spark, d, "attempts")
    counted = F.concat(F.lit("SUCCESS:batch=b,chunk=1,ok="), F.col("duration_seconds").cast("string"), F.lit(",fail=1"))
    line = F.when(F.col("duration_seconds") % 3 == 0, counted).otherwise(F.col("status"))
    out = rows.withColumn("line", line).withColumn("r", text.result_counts(F.col("line"), F.lit(7)))
    return out.select("migration_id", "attempt_number", "source_size_bytes", "r.ok", "r.fail")


@query("error_codes", """{audit}
WITH m AS (SELECT execution_id, CASE CAST(duration_seconds % 5 AS INT) WHEN 0 THEN 'TABLE_OR_VIEW_NOT_FOUND' WHEN 1 THEN 'LOCATION_OVERLAP' WHEN 2 THEN 'PERMISSION_DENIED'
  WHEN 3 THEN 'ANALYSIS_EXCEPTION' ELSE 'CLONE_FAILED' END AS error_code FROM audit)
SELECT execution_id, error_code, count(*) AS n FROM m GROUP BY 1, 2""")
def _(spark, d):
    k = F.col("duration_seconds") % 5
    message = (F.when(k == 0, "[TABLE_OR_VIEW_NOT_FOUND] x PERMISSION_DENIED").when(k == 1, "a LOCATION_OVERLAP b")
               .when(k == 2, "PermissionDenied").when(k == 3, "AnalysisException: y").otherwise("lost"))
    rows = view(spark, d, "audit").withColumn("error_code", text.error_code_of(message))
    return rows.groupBy("execution_id", "error_code").agg(F.count("*").alias("n"))


@query("list_cells", """{listing}
SELECT table_catalog, table_schema, table_name, CASE WHEN num_files % 2 = 0 THEN concat(table_schema, '+*', table_name, '*') ELSE '' END AS globs,
  concat(table_catalog, '+', table_schema) AS names, concat('`', table_catalog, '`.`', table_schema, '`.`', table_name, '`') AS quoted FROM listing""")
def _(spark, d):
    cell = F.when(F.col("num_files") % 2 == 0, F.concat(F.lit("['"), "table_schema", F.lit("', ' *"), "table_name", F.lit("*']"))).otherwise("[broken")
    names = F.when(F.col("num_files") % 3 == 0, F.to_json(F.array("table_catalog", "table_schema"))).otherwise(
        F.concat("table_catalog", F.lit(" , "), "table_schema", F.lit(",")))
    return view(spark, d, "listing").select(
        "table_catalog", "table_schema", "table_name", F.array_join(text.list_literal(cell), "+").alias("globs"),
        F.array_join(text.string_list(names), "+").alias("names"),
        text.quoted_fqn("table_catalog", "table_schema", "table_name").alias("quoted"))


@query("table_detail")
def _(spark, d):
    from tabledger.sources.listing import table_detail

    return table_detail(spark, d).drop("last_modified")
