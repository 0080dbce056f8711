"""Validation of completed copies and the acceptance suite."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ERROR_MESSAGE_CHARS
from ..operators import checks, compare
from ..operators import ledger as states
from ..sources.checkpoints import checkpointed
from ..sources.ledger_store import Ledger
from ..sources.versions import VersionStore

_SIDES = {
    "source": ("source_catalog", "source_schema", "source_table", "source_version"),
    "target": ("target_catalog", "target_schema", "target_table", "target_version"),
}


# Spark's own errors, and those that arrive without being translated.
_FAILURES = (PySparkException, Py4JJavaError)


def copied_counts(attempts: DataFrame) -> DataFrame:
    """What copies counted on their way, per table and source version: the last that succeeded (ties: the higher count)."""
    done = attempts.where("status = 'SUCCESS' AND rows_copied IS NOT NULL")
    last = F.max_by("rows_copied", F.struct("completed_at", "attempt_number", "rows_copied"))
    return done.groupBy("migration_id", "source_version").agg(last.alias("rows_copied"))


def _counts(records: DataFrame, source: VersionStore, target: VersionStore, copied: DataFrame | None = None) -> DataFrame:
    """Row counts of both sides, each at the version on record; those in ``copied`` are not counted again."""
    if copied is not None:
        keys = ["migration_id", "source_version"]
        known = checkpointed(records.join(copied, keys, "left"))
        target_only = _counts(known.where("rows_copied IS NOT NULL").withColumn("source_version", F.lit(-1).cast("bigint")), source, target)
        known_counts = target_only.drop("source_row_count").join(known.select("migration_id", "rows_copied"), "migration_id")
        return known_counts.select("migration_id", F.col("rows_copied").alias("source_row_count"), "target_row_count").unionByName(
            _counts(known.where("rows_copied IS NULL"), source, target))
    out = records.select("migration_id", *[c for side in _SIDES.values() for c in side])
    for side, store in (("source", source), ("target", target)):
        *name, version = _SIDES[side]
        fqn = F.concat_ws(".", *name)
        wanted = records.select(fqn.alias("table_name"), F.col(version).alias("version"))
        counted = store.count_rows(wanted).select(
            F.col("table_name").alias(f"{side}_fqn"), F.col("version").alias(f"{side}_v"),
            F.col("row_count").alias(f"{side}_row_count"),
        )
        out = out.join(
            counted, (fqn == F.col(f"{side}_fqn")) & F.col(version).eqNullSafe(F.col(f"{side}_v")), "left"
        ).drop(f"{side}_fqn", f"{side}_v")
    return out.select("migration_id", "source_row_count", "target_row_count")


def run_validation(
    ledger: Ledger, source: VersionStore, target: VersionStore, now: Column, batch_id: str = "",
    run_id: str = "", count_rows: bool = True, copied_rows: bool = False,
) -> dict[str, int]:
    """Checks every completed copy that is not validated yet; a failed check never fails the run.

    With ``copied_rows`` the source is not counted where its copy has counted the same version on its way.
    """
    records = states.completed(ledger.table(), batch_id, unvalidated_only=True)
    copied = copied_counts(ledger.log("attempts")) if copied_rows else None
    counts = _counts(records, source, target, copied) if count_rows else None
    verdicts = checkpointed(
        checks.validation_verdicts(
            records, source.details(), target.details(), counts, required_format=target.data_format.upper()
        )
    )
    changes = checks.validation_changes(verdicts)
    ledger.update(lambda c: states.apply_validation(c, changes, now), now, operation="VALIDATE")
    ledger.append("validation_history", checks.history_rows(verdicts, run_id, now))
    tally = checks.row_count_tally(verdicts).first().asDict()
    states_count = verdicts.agg(
        F.count_if(F.col("verdict") == "VALIDATED").alias("passed"),
        F.count_if(F.col("verdict") == "VALIDATION_FAILED").alias("failed"),
    ).first().asDict()
    return states_count | tally


def acceptance_checks(
    pairs: compare.Pairs, expected_types: DataFrame | None = None, actual_types: DataFrame | None = None,
    source_details: DataFrame | None = None, target_details: DataFrame | None = None,
    manifest: DataFrame | None = None, sample_percent: int = 100,
) -> dict[str, Callable[[], DataFrame]]:
    """Per check that has its inputs, what builds its results (table_name, passed, detail).

    Details have table_name and partition_columns, types table_name and table_type.
    """
    def spark():
        return next(iter(pairs.values()))[0].sparkSession

    def schemas() -> DataFrame:
        return compare.schema_verdicts(*[compare.schema_rows({n: p[i] for n, p in pairs.items()}) for i in range(2)])

    def hashes() -> DataFrame:
        unlike = {n: sorted({*s.columns} ^ {*t.columns}) for n, (s, t) in pairs.items()}
        same = {n: p for n, p in pairs.items() if not unlike[n]}
        rows = [(n, False, "columns differ: " + ", ".join(names)) for n, names in unlike.items() if names]
        failed = spark().createDataFrame(rows, "table_name string, passed boolean, detail string")
        return failed.unionByName(compare.multiset_verdicts(same, sample_percent).select(*failed.columns)) if same else failed

    def history() -> DataFrame:
        return compare.history_check(spark().createDataFrame([(n,) for n in pairs], "table_name string"), manifest)

    out = {"row_count_parity": lambda: compare.row_count_parity(pairs), "schema_match": schemas, "data_hash_integrity": hashes}
    if expected_types is not None and actual_types is not None:
        out["table_type_preserved"] = lambda: compare.table_type_check(expected_types, actual_types)
    if source_details is not None and target_details is not None:
        out["partition_columns_match"] = lambda: compare.partition_columns_check(source_details, target_details)
    if manifest is not None:
        out["delta_table_valid"] = history
    return out


def audit_result(audit: DataFrame, execution_id: str, now: Column) -> DataFrame:
    """The result of the check of the audit log, which belongs to no table."""
    found = checks.audit_completeness(audit.where(F.col("execution_id") == execution_id)).withColumn(
        "table_name", F.concat(F.lit("execution_id="), F.col("execution_id")))
    return checks.check_rows(found, "audit_log_completeness", execution_id, now)


def acceptance(pairs: compare.Pairs, audit: DataFrame, execution_id: str, now: Column, **inputs) -> DataFrame:
    """Results of the seven acceptance checks in stored shape; checks whose inputs are not given are left out."""
    out = audit_result(audit, execution_id, now)
    for name, build in acceptance_checks(pairs, **inputs).items():
        out = out.unionByName(checks.check_rows(build(), name, execution_id, now))
    return out


def run_acceptance(
    ledger: Ledger, pairs: compare.Pairs, audit: DataFrame, execution_id: str, now: Column,
    tables_per_job: int = 100, **inputs,
) -> DataFrame:
    """Runs the acceptance checks, stores their results and returns the pass rates.

    Many tables are checked in several jobs, so that no plan grows with the
    number of tables; each job appends its results when it is done. Where a job
    fails, its tables are checked one by one and check by check, and each check
    that fails leaves a failed row of its own.
    """
    names = list(pairs)
    ledger.append("check_results", audit_result(audit, execution_id, now))

    def built(group: dict) -> dict[str, Callable[[], DataFrame]]:
        # inputs that list every table are cut down to the tables of this job
        own = {
            k: v.where(F.col("table_name").isin(*group)) if isinstance(v, DataFrame) else v for k, v in inputs.items()
        }
        return acceptance_checks(group, **own)

    def stored(check: str, rows: DataFrame) -> DataFrame:
        return checks.check_rows(rows, check, execution_id, now)

    for start in range(0, len(names), tables_per_job):
        group = {n: pairs[n] for n in names[start : start + tables_per_job]}
        try:
            results = [stored(check, build()) for check, build in built(group).items()]
            ledger.append("check_results", reduce(DataFrame.unionByName, results))
        except _FAILURES:
            for name in group:
                for check, build in built({name: group[name]}).items():
                    try:
                        ledger.append("check_results", stored(check, build()))
                    except _FAILURES as e:
                        reason = f"Error: {str(e)[:ERROR_MESSAGE_CHARS]}"
                        row = audit.sparkSession.createDataFrame([(name, False, reason)], "table_name string, passed boolean, detail string")
                        ledger.append("check_results", stored(check, row))
    return checks.acceptance_summary(latest_results(ledger.log("check_results")).where(F.col("execution_id") == execution_id))


def latest_results(results: DataFrame) -> DataFrame:
    """Of several runs of one execution, the last result per check and table."""
    rest = [c for c in results.columns if c not in ("execution_id", "check_name", "table_name")]
    last = results.groupBy("execution_id", "check_name", "table_name").agg(F.max_by(F.struct(*rest), "validated_at").alias("r"))
    return last.select("execution_id", "check_name", "table_name", "r.*")
