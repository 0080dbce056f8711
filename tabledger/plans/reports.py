"""The reporting set: every dataset by name, over one ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import report
from ..sources.ledger_store import Ledger

# name -> (input table, function)
REPORTS = {
    "control_status": ("control", report.row_count_status),
    "kpis": ("control", report.kpis),
    "cumulative_done": ("control", report.cumulative_done),
    "hourly_throughput": ("control", report.hourly_throughput),
    "fail_codes": ("control", report.fail_codes),
    "recent_failures": ("control", report.recent_failures),
    "attempts_daily": ("attempts", report.attempts_daily),
    "validations_daily": ("validation_history", report.validations_daily),
    "count_mismatches": ("control", report.count_mismatches),
    "longest_copies": ("control", report.longest_copies),
    "chunk_fanout": ("control", report.chunk_fanout),
    "exclusions": ("exclusion_log", lambda rows: report.exclusion_listing(rows, top=1000)),
    "status_totals": ("control", report.status_totals),
    "class_totals": ("control", report.class_totals),
    "status_by_batch": ("control", report.status_by_batch),
    "type_split": ("control", report.type_split),
    "avg_duration_by_class": ("control", report.avg_duration_by_class),
    "attempt_distribution": ("control", report.attempt_distribution),
    "validation_split": ("control", report.validation_split),
    "count_outcomes": ("control", report.count_outcomes),
    "size_histogram": ("control", report.size_histogram),
    "exclusions_by_type": ("exclusion_log", report.exclusions_by_type),
    "reporting_set": ("control", report.reporting_set),
}


def run_report(
    ledger: Ledger, name: str, batches: Sequence[str] | None = None, statuses: Sequence[str] | None = None,
    clone_types: Sequence[str] | None = None,
) -> DataFrame:
    """One report; the filters apply to reports over the control table."""
    table, build = REPORTS[name]
    if table != "control":
        return build(ledger.log(table))
    return build(report.cross_filter(ledger.table(), batches, statuses, clone_types))
