"""What happens to each selected table: gated, skipped, failed or queued."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import gib, workload_class, workload_weight
from ..functions.text import ERROR_MESSAGE_CHARS, cut, fqn
from .merge import CONTROL_KEY, merge
from .report import single_row

SOURCE = ("source_catalog", "source_schema", "source_table")
TARGET = ("target_catalog", "target_schema", "target_table")

# Verdict codes of the inherited-setting gate.
GATE_ENABLED = "PREDICTIVE_OPTIMIZATION_ENABLED"
GATE_UNKNOWN = "PREDICTIVE_OPTIMIZATION_UNKNOWN"
GATE_SKIPPED = "PREDICTIVE_OPTIMIZATION_SKIPPED"


def with_target_type(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Adds ``target_type``, NULL where the target table does not exist."""
    types = listing.select(
        F.col("table_catalog").alias(TARGET[0]), F.col("table_schema").alias(TARGET[1]),
        F.col("table_name").alias(TARGET[2]), F.coalesce(F.upper("table_type"), F.lit("")).alias("target_type"),
    )
    return rows.join(types, list(TARGET), "left")


def gate_verdicts(targets: DataFrame, settings: DataFrame, unknown: str = "allow") -> DataFrame:
    """Effective inherited setting per target table and whether it blocks the copy.

    ``targets``: target_catalog, target_schema, target_table and, if the type
    of existing targets is known, target_type; further columns are kept.
    ``settings``: level (table, schema, catalog), fqn, value (ENABLE, DISABLE,
    INHERIT or NULL), one row per level and name.

    The nearest explicit value counts. A table without any level, or of a type
    the setting does not apply to, is skipped; all levels INHERIT means
    DISABLE; no readable value is unknown.
    """

    def level(name: str) -> DataFrame:
        rows = settings.where(F.col("level") == name)
        return rows.select(F.col("fqn").alias(f"{name}_fqn"), F.col("value").alias(f"{name}_value"),
                           F.lit(True).alias(f"{name}_found"))

    out = targets
    for name, parts in (("table", 3), ("schema", 2), ("catalog", 1)):
        out = out.join(level(name), F.col(f"{name}_fqn") == fqn(*TARGET[:parts]), "left")
    kind = F.nullif(F.col("target_type"), F.lit("")) if "target_type" in targets.columns else F.lit(None).cast("string")

    def explicit(name: str) -> Column:
        value = F.col(f"{name}_value")
        return F.when(value.isin("ENABLE", "DISABLE"), value)

    names = ("table", "schema", "catalog")
    found = F.coalesce(*[F.col(f"{n}_found") for n in names], F.lit(False))
    any_value = F.coalesce(*[F.col(f"{n}_value") for n in names])
    inherits = F.when(any_value.isNotNull(), "DISABLE")
    value = F.coalesce(*[explicit(n) for n in names], inherits)
    where = F.when(explicit("table").isNotNull(), "TABLE").when(explicit("schema").isNotNull(), "SCHEMA").when(
        explicit("catalog").isNotNull(), "CATALOG"
    )
    not_managed = F.coalesce(kind != "MANAGED", F.lit(False))
    skipped = ~found | not_managed
    enabled = value.eqNullSafe("ENABLE")
    block_unknown = F.lit(unknown == "block")
    blocked = ~skipped & (enabled | (value.isNull() & block_unknown))
    code = (
        F.when(skipped, GATE_SKIPPED)
        .when(enabled, GATE_ENABLED)
        .when(value.isNull(), GATE_UNKNOWN)
        .otherwise("")
    )
    source = F.when(where == "SCHEMA", fqn(*TARGET[:2])).when(where == "CATALOG", F.col(TARGET[0]))
    reason = (
        F.when(not_managed, F.concat(F.lit("Target is a "), kind, F.lit(" table; setting not applicable, skipped.")))
        .when(~found, "Target does not exist yet; setting not applicable, skipped.")
        .when(enabled, F.concat(F.lit("Predictive optimization is ENABLED on the target ("),
                                F.concat_ws(" ", F.lower(where), source), F.lit("), disable it before copying.")))
        .when(value.isNull(), "Status could not be confirmed, continuing.")
        .otherwise("Predictive optimization disabled.")
    )
    return out.select(
        *targets.columns,
        blocked.alias("gate_blocked"),
        F.when(~skipped, value).alias("gate_value"),
        F.when(blocked & enabled, where).alias("gate_level"),
        F.when(blocked & enabled, source).alias("gate_source"),
        code.alias("gate_code"),
        reason.alias("gate_reason"),
    )


def classify(sized: DataFrame) -> DataFrame:
    """Adds size_gb, workload_class and workload_weight for ``size_in_bytes``."""
    return sized.withColumns(
        {"size_gb": gib(F.col("size_in_bytes")), "workload_class": workload_class(F.col("size_in_bytes"))}
    ).withColumn("workload_weight", workload_weight(F.col("workload_class")))


# Rows in these states are not onboarded again without force. Work
# in flight is left alone too.
DONE_STATES = ("COMPLETED", "VALIDATED", "FAILED_PERMANENT", "SKIPPED", "ASSIGNED", "IN_PROGRESS")


def existing_rows(selections: DataFrame, control: DataFrame, batch_id: str) -> DataFrame:
    """Selections with the id and state of their row in this batch, if there is one."""
    own = control.where(F.col("batch_id") == batch_id).select(
        *SOURCE, F.col("migration_id").alias("existing_id"), F.col("status").alias("existing_status")
    )
    return selections.join(own, list(SOURCE), "left")


def inventory_outcomes(
    selections: DataFrame,
    control: DataFrame,
    batch_id: str,
    settings: DataFrame | None = None,
    target_listing: DataFrame | None = None,
    detail: DataFrame | None = None,
    required_format: str = "DELTA",
    force: bool = False,
    require_target: bool = False,
    unknown_setting: str = "allow",
) -> DataFrame:
    """One row per selection with its outcome.

    Outcomes, tested in this order: PO_BLOCKED (gate), ALREADY_DONE, SKIPPED
    (target must exist and does not), FAILED_PERMANENT (source missing or of
    another format), QUEUED. ``detail`` holds size and format per source table
    (table_catalog, table_schema, table_name, format, size_in_bytes, num_files
    and optionally location, version); without it nothing is measured and the
    class is UNKNOWN.
    """
    rows = existing_rows(selections, control, batch_id)
    if target_listing is not None:
        rows = with_target_type(rows, target_listing)
    elif require_target:
        raise ValueError("require_target needs a target listing")
    if settings is not None:
        rows = gate_verdicts(rows, settings, unknown_setting)
    else:
        rows = rows.withColumns(
            {"gate_blocked": F.lit(False), "gate_code": F.lit(""), "gate_reason": F.lit("")}
        )
    target_missing = F.col("target_type").isNull() if require_target else F.lit(False)
    measured = ("size_in_bytes", "source_num_files", "source_path", "source_version")
    if detail is not None:
        have = set(detail.columns)
        found = detail.select(
            F.col("table_catalog").alias(SOURCE[0]), F.col("table_schema").alias(SOURCE[1]),
            F.col("table_name").alias(SOURCE[2]),
            F.upper("format").alias("_format"),
            F.coalesce("size_in_bytes", F.lit(0)).cast("bigint").alias("size_in_bytes"),
            F.coalesce("num_files", F.lit(0)).cast("bigint").alias("source_num_files"),
            (F.col("location") if "location" in have else F.lit(None)).cast("string").alias("source_path"),
            (F.col("version") if "version" in have else F.lit(None)).cast("bigint").alias("source_version"),
        )
        rows = rows.join(found, list(SOURCE), "left")
        usable = F.coalesce(F.col("_format") == required_format.upper(), F.lit(False))
    else:
        types = ("bigint", "bigint", "string", "bigint")
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in zip(measured, types)})
        usable = F.lit(True)
    done = F.coalesce(F.col("existing_status").isin(*DONE_STATES), F.lit(False)) & F.lit(not force)
    outcome = (
        F.when(F.col("gate_blocked"), "PO_BLOCKED")
        .when(done, "ALREADY_DONE")
        .when(target_missing, "SKIPPED")
        .when(~usable, "FAILED_PERMANENT")
        .otherwise("QUEUED")
    )
    rows = rows.withColumn("outcome", outcome)
    queued = F.col("outcome") == "QUEUED"
    rows = rows.withColumns({c: F.when(queued, F.col(c)) for c in measured})
    rows = classify(rows).withColumns(
        {
            "workload_class": F.when(queued, F.col("workload_class")),
            "workload_weight": F.when(queued, F.col("workload_weight")),
        }
    )
    code = F.when(F.col("outcome") == "PO_BLOCKED", F.col("gate_code")).when(
        F.col("outcome") == "SKIPPED", "TARGET_NOT_PRECREATED"
    )
    message = (
        F.when(F.col("outcome") == "PO_BLOCKED", F.col("gate_reason"))
        .when(F.col("outcome") == "SKIPPED",
              F.concat(F.lit("Target table "), fqn(*TARGET), F.lit(" does not exist yet; create it first.")))
        .when(F.col("outcome") == "FAILED_PERMANENT",
              F.concat(F.lit("Source table not found or not a "), F.lit(required_format.upper()), F.lit(" table")))
    )
    return rows.select(
        *selections.columns, "existing_id", "existing_status", "outcome",
        *measured, "size_gb", "workload_class", "workload_weight", "gate_code",
        code.alias("error_code"), cut(message, ERROR_MESSAGE_CHARS).alias("error_message"),
    )


def upsert_inventory(
    control: DataFrame,
    outcomes: DataFrame,
    batch_id: str,
    run_id: str,
    clone_type: str,
    now: Column,
    max_attempts: int = 3,
    source_workspace: str = "",
    target_workspace: str = "",
) -> DataFrame:
    """New control snapshot after an inventory, all outcomes in one write.

    A queued row starts afresh: counts, errors, times and everything else left
    by an earlier run is cleared. Blocked and skipped rows keep their
    measurements, failed rows change state and message only. Rows of other
    batches are never touched.
    """
    changes = (
        outcomes.where(F.col("outcome") != "ALREADY_DONE")
        .withColumnRenamed("outcome", "status")
        .withColumn("batch_id", F.lit(batch_id))
    )
    status = F.col("s.status")
    queued = status == "QUEUED"
    failed = status == "FAILED_PERMANENT"

    def fresh(name: str) -> Column:
        """Measured value for queued rows, the old value for the others."""
        return F.when(queued, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))

    def cleared(name: str) -> Column:
        """NULL unless only the state changes."""
        return F.when(failed, F.col(f"t.{name}"))

    def cleared_if_queued(name: str) -> Column:
        return F.when(~queued, F.col(f"t.{name}"))

    matched = {
        "status": status,
        "error_message": F.col("s.error_message"),
        "error_code": F.when(failed, F.col("t.error_code")).otherwise(F.col("s.error_code")),
        "run_id": F.when(failed | (status == "SKIPPED"), F.col("t.run_id")).otherwise(F.lit(run_id)),
        "clone_type": F.when(queued, F.lit(clone_type)).otherwise(F.col("t.clone_type")),
        "attempt_number": F.when(queued, F.lit(0)).otherwise(F.col("t.attempt_number")),
        "max_attempts": F.when(queued, F.lit(max_attempts)).otherwise(F.col("t.max_attempts")),
        "onboarded_at": F.when(queued, now).otherwise(F.col("t.onboarded_at")),
        "queued_at": F.when(queued, now).otherwise(F.col("t.queued_at")),
        "updated_at": now,
    }
    for name in TARGET:
        matched[name] = F.when(failed, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
    for name in ("source_path", "size_in_bytes", "size_gb", "workload_class", "workload_weight",
                 "source_num_files", "source_version"):
        matched[name] = fresh(name)
    for name in ("started_at", "completed_at", "failed_at", "validation_status",
                 "source_row_count", "target_row_count"):
        matched[name] = cleared(name)
    for name in ("chunk_id", "duration_seconds", "target_version", "target_num_files",
                 "validation_message", "assigned_cluster_id"):
        matched[name] = cleared_if_queued(name)

    insert = {name: F.col(f"s.{name}") for name in (*SOURCE, *TARGET, "batch_id", "status", "error_code",
                                                   "error_message", "source_path", "size_in_bytes", "size_gb",
                                                   "workload_class", "workload_weight", "source_num_files",
                                                   "source_version")}
    # the id follows from the key, so a recomputed task yields the same row
    key = F.concat_ws("\u0001", *[F.col(f"s.{k}") for k in CONTROL_KEY])
    insert |= {
        "migration_id": F.substring(F.sha2(key, 256), 1, 32),
        "run_id": F.lit(run_id), "clone_type": F.lit(clone_type),
        "source_workspace": F.lit(source_workspace), "target_workspace": F.lit(target_workspace),
        "attempt_number": F.lit(0), "max_attempts": F.lit(max_attempts),
        "discovered_at": now, "created_at": now, "updated_at": now,
        "onboarded_at": F.when(queued, now), "queued_at": F.when(queued, now),
    }
    return merge(control, changes, CONTROL_KEY, matched, insert)


def inventory_stats(outcomes: DataFrame) -> DataFrame:
    """One row: total, inserted, skipped, skipped_target_missing, failed, po_blocked."""

    def n(*states: str) -> Column:
        return F.count_if(F.col("outcome").isin(*states))

    return outcomes.agg(
        F.count("*").alias("total"),
        n("QUEUED").alias("inserted"),
        n("ALREADY_DONE", "SKIPPED").alias("skipped"),
        n("SKIPPED").alias("skipped_target_missing"),
        n("FAILED_PERMANENT").alias("failed"),
        n("PO_BLOCKED").alias("po_blocked"),
    )


def dry_run_classes(outcomes: DataFrame) -> DataFrame:
    """Tables and bytes per outcome and workload class of a dry run."""
    return outcomes.groupBy("outcome", "workload_class").agg(
        F.count("*").alias("tables"), F.sum("size_in_bytes").alias("total_bytes")
    )


def dry_run_signoff(targets: DataFrame, groups: DataFrame) -> DataFrame:
    """Checks before a live run, one row.

    ``targets``: table_type, src_location, tgt_location, size_in_bytes per
    table; ``groups``: chunk_id and total_bytes per group.
    """
    external = F.upper("table_type") == "EXTERNAL"
    found = targets.agg(
        F.count("*").alias("tables_discovered"),
        F.count("src_location").alias("paths_resolved"),
        F.count_if(external & F.col("tgt_location").isNull()).alias("unmapped_external"),
        F.sum("size_in_bytes").alias("total_bytes"),
    )
    balance = groups.agg(
        F.max("total_bytes").alias("largest_group"), F.min("total_bytes").alias("smallest_group")
    )
    joined = single_row(found, balance)
    balanced = F.coalesce(F.col("largest_group") <= 2 * F.col("smallest_group"), F.lit(True))
    return joined.select(
        "*",
        balanced.alias("balanced"),
        (
            (F.col("paths_resolved") == F.col("tables_discovered"))
            & (F.col("unmapped_external") == 0)
            & balanced
        ).alias("ready"),
    )
