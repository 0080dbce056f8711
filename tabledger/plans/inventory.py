"""From rules to queued, grouped rows, and the dry run of the same."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import inventory as ops
from ..operators import ledger as states
from ..operators.pack import pack_chunks
from ..operators.select import dedup_selections, exclusion_rows, expand_rules, split_exclusions
from ..sources.checkpoints import checkpointed
from ..sources.ledger_store import Ledger
from ..sources.mapping import MappingInput


class Blocked(RuntimeError):
    """The gate blocked at least one table; everything else was written first."""


@dataclass
class Options:
    batch_id: str
    run_id: str
    clone_type: str = "delta_share"
    force: bool = False
    require_target: bool = False
    required_format: str = "DELTA"
    unknown_setting: str = "allow"
    capacity_gb: float = 50.0
    max_chunks: int | None = 3
    max_attempts: int = 3
    stale_minutes: int = 120
    stale_all_batches: bool = True


@dataclass
class Inputs:
    """What an inventory reads besides the rules."""

    listing: DataFrame
    exclusions: DataFrame | None = None
    settings: DataFrame | None = None
    target_listing: DataFrame | None = None
    detail: DataFrame | None = None


def resolve(mapping: MappingInput, inputs: Inputs) -> tuple[DataFrame, DataFrame | None]:
    """``(selections, excluded)`` after expansion, de-duplication and exclusion."""
    rows = dedup_selections(
        expand_rules(
            mapping.rules, inputs.listing,
            global_catalogs=mapping.global_catalogs,
            global_schema_globs=mapping.global_schema_globs,
            global_table_globs=mapping.global_table_globs,
        )
    ).drop("rule_seq")
    if inputs.exclusions is None:
        return rows, None
    return split_exclusions(rows, inputs.exclusions)


def _outcomes(selections: DataFrame, control: DataFrame, inputs: Inputs, opt: Options) -> DataFrame:
    return ops.inventory_outcomes(
        selections, control, opt.batch_id, inputs.settings, inputs.target_listing, inputs.detail,
        opt.required_format, opt.force, opt.require_target, opt.unknown_setting,
    )


def dry_run(ledger: Ledger, mapping: MappingInput, inputs: Inputs, opt: Options) -> DataFrame:
    """Outcome per selected table, with real sizes. Nothing is written."""
    selections, _ = resolve(mapping, inputs)
    return _outcomes(selections, ledger.table(), inputs, opt)


def plan_batch(ledger: Ledger, opt: Options, now: Column, only_unplanned: bool = False) -> None:
    """Groups the queued rows of a batch and writes the group ids."""
    queued = ledger.table().where((F.col("status") == "QUEUED") & (F.col("batch_id") == opt.batch_id))
    if only_unplanned and states.unplanned(queued).isEmpty():
        return
    chunks = checkpointed(pack_chunks(queued, opt.capacity_gb, opt.max_chunks).select("migration_id", "chunk_id"))
    ledger.update(lambda control: states.assign_chunks(control, chunks, now), now, operation="PLAN")


def run_inventory(ledger: Ledger, mapping: MappingInput, inputs: Inputs, opt: Options, now: Column) -> dict[str, int]:
    """Onboards the selected tables and groups them; returns the counts.

    Raises :class:`Blocked` at the end when the gate stopped a table; all rows
    are written by then.
    """
    selections, excluded = resolve(mapping, inputs)
    scope = "" if opt.stale_all_batches else opt.batch_id
    current = states.reconcile_stale(ledger.table(), now, opt.stale_minutes, scope)
    outcomes = checkpointed(_outcomes(selections, current, inputs, opt))

    def build(control: DataFrame) -> DataFrame:
        fresh = states.reconcile_stale(control, now, opt.stale_minutes, scope)
        return ops.upsert_inventory(
            fresh, outcomes, opt.batch_id, opt.run_id, opt.clone_type, now, opt.max_attempts
        )

    ledger.update(build, now, operation="INVENTORY")
    if excluded is not None:
        ledger.append("exclusion_log", exclusion_rows(excluded, opt.run_id, opt.batch_id, now))
    plan_batch(ledger, opt, now)
    stats = ops.inventory_stats(outcomes).first().asDict()
    if stats["po_blocked"]:
        first = outcomes.where("outcome = 'PO_BLOCKED'").limit(10).collect()
        names = "; ".join(f"{r.source_catalog}.{r.source_schema}.{r.source_table} ({r.error_code})" for r in first)
        raise Blocked(f"{stats['po_blocked']} target table(s) blocked by the gate: {names}")
    return stats
