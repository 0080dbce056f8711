"""The request queue and where requested tables go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fqn_part
from ..sources.schemas import REQUESTS, conform
from .compare import VALIDATION_MODES
from .merge import merge, update_where


def null() -> Column:
    return F.lit(None)


def new_requests(
    names: DataFrame, scope: str, name: str, clone_mode: str, target_catalog: str, requested_by: str, now: Column,
    priority: int = 2, notes: str | None = None, tags: Mapping[str, str] | None = None,
    validation_mode: str = "COUNT", deterministic: bool = True,
) -> DataFrame:
    """Queue rows, one per name in column ``fqn`` (catalog, schema or table names)."""
    if validation_mode not in VALIDATION_MODES:
        raise ValueError(f"unknown validation mode {validation_mode}")
    key = F.sha2(F.concat_ws("\u0001", F.lit(name), F.lit(scope), "fqn", now.cast("string")), 256)
    label = {
        "onboarding_id": F.substring(key, 1, 32) if deterministic else F.uuid(),
        "request_name": F.lit(name), "scope_mode": F.lit(scope), "clone_mode": F.lit(clone_mode),
        "src_catalog": fqn_part(F.col("fqn"), 0),
        "src_schema": fqn_part(F.col("fqn"), 1) if scope != "catalog" else null(),
        "src_table": F.col("fqn") if scope == "table" else null(),
        "tgt_catalog": F.lit(target_catalog),
        "tgt_schema": fqn_part(F.col("fqn"), 1) if scope != "catalog" else null(),
        "priority": F.lit(priority), "status": F.lit("PENDING"), "requested_by": F.lit(requested_by),
        "requested_at": now, "validation_mode": F.lit(validation_mode),
        "count_tolerance_pct": F.lit(0.0), "checksum_algorithm": F.lit("XXHASH64"), "notes": F.lit(notes),
        "tags": F.create_map(*[F.lit(x) for kv in (tags or {}).items() for x in kv]) if tags else null(),
    }
    return conform(names.select(*[v.alias(k) for k, v in label.items()]), REQUESTS)


def eligible(requests: DataFrame, now: Column) -> DataFrame:
    """Pending requests whose time has come, in the order they run."""
    due = F.col("scheduled_for").isNull() | (F.col("scheduled_for") <= now)
    return requests.where((F.col("status") == "PENDING") & due).orderBy("priority", "requested_at", "onboarding_id")


def in_progress(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("status") == "IN_PROGRESS")


def queue_state(requests: DataFrame) -> DataFrame:
    return requests.groupBy("priority", "status").agg(
        F.count("*").alias("request_count"), F.min("requested_at").alias("oldest_request")
    )


def queue_by_status(requests: DataFrame) -> DataFrame:
    return requests.groupBy("status").agg(F.count("*").alias("n"))


def failed_with_errors(requests: DataFrame, audit: DataFrame) -> DataFrame:
    """Failed requests next to the failed tables of their execution."""
    r = requests.where(F.col("status") == "FAILED").select("execution_id", "onboarding_id", "requested_at")
    a = audit.where(F.col("status") == "FAILED").select("execution_id", "table_name", "error_message")
    return r.join(a, "execution_id")


def claim(requests: DataFrame, execution_id: str, now: Column) -> DataFrame:
    """Due requests to IN_PROGRESS under one execution."""
    due = F.col("scheduled_for").isNull() | (F.col("scheduled_for") <= now)
    return update_where(
        requests, (F.col("status") == "PENDING") & due,
        {"status": F.lit("IN_PROGRESS"), "execution_id": F.lit(execution_id)},
    )


def claimed_groups(requests: DataFrame, execution_id: str) -> DataFrame:
    """Claimed requests by scope and copy mode."""
    own = requests.where((F.col("execution_id") == execution_id) & (F.col("status") == "IN_PROGRESS"))
    return own.groupBy("scope_mode", "clone_mode").agg(
        F.count("*").alias("requests"), F.min("priority").alias("priority")
    )


def finish(requests: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Terminal states back into the queue. ``outcomes``: onboarding_id, status."""
    return merge(
        requests, outcomes, ["onboarding_id"], {"status": F.col("s.status"), "completed_at": now},
        guard=F.col("t.status") == "IN_PROGRESS",
    )


def requeue(requests: DataFrame, ids: Sequence[str] | DataFrame, now: Column) -> DataFrame:
    """Requests back to PENDING; the notes say when."""
    note = F.concat(F.coalesce("t.notes", F.lit("")), F.lit(" | Re-queued: "), now.cast("string"))
    if not isinstance(ids, DataFrame):
        ids = requests.sparkSession.createDataFrame([(i,) for i in ids], "onboarding_id string")
    return merge(
        requests, ids.select("onboarding_id"), ["onboarding_id"],
        {"status": F.lit("PENDING"), "execution_id": null(), "completed_at": null(), "notes": note},
    )


def reset_stuck(requests: DataFrame, now: Column, days: int = 1) -> DataFrame:
    """Requests in progress for more than ``days`` days back to PENDING."""
    stuck = (F.col("status") == "IN_PROGRESS") & (F.datediff(now, "requested_at") > days)
    return update_where(requests, stuck, {"status": F.lit("PENDING"), "execution_id": null()})


def validation_plan(requests: DataFrame) -> DataFrame:
    """One row per request and check to run; mode NONE runs nothing."""
    checks = F.create_map(*[x for mode, names in VALIDATION_MODES.items() if names
                            for x in (F.lit(mode), F.array(*[F.lit(n) for n in names]))])
    columns = F.filter(F.transform(F.split("validation_columns", ","), lambda c: F.trim(c)), lambda c: c != "")
    return requests.select(
        "onboarding_id", F.explode(F.try_element_at(checks, F.upper("validation_mode"))).alias("check_name"),
        columns.alias("columns"), F.coalesce("count_tolerance_pct", F.lit(0.0)).alias("count_tolerance_pct"),
        F.coalesce("checksum_algorithm", F.lit("XXHASH64")).alias("checksum_algorithm"),
    )


def remap_locations(tables: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Target location of each table by the longest source prefix that fits.

    ``tables`` has a ``location``; ``prefixes`` has src_prefix and tgt_prefix.
    A location meets prefixes by equality, and only those of the lengths that
    occur, so no location is compared with every prefix. Without a prefix the target
    location is NULL and ``unmapped`` is true. A prefix that is listed twice has the
    smaller of its targets.
    """
    rules = prefixes.groupBy("src_prefix").agg(F.min("tgt_prefix").alias("tgt_prefix"))
    lengths = rules.agg(F.collect_set(F.length("src_prefix"))).scalar()
    best = (
        tables.select("location")
        .distinct()
        .withColumn("lengths", lengths)
        .withColumn("n", F.explode(F.filter("lengths", lambda n: n <= F.length("location"))))
        .withColumn("src_prefix", F.substring("location", F.lit(1), F.col("n")))
        .join(rules, "src_prefix")
        .groupBy("location")
        .agg(F.max_by(F.struct("src_prefix", "tgt_prefix"), F.length("src_prefix")).alias("m"))
        .select("location", F.concat(F.col("m.tgt_prefix"), F.col("location").substr(F.length("m.src_prefix") + 1, F.length("location"))).alias("target_location"))
    )
    flat = [F.lit(0)] + [F.col(f.name) for f in tables.schema.fields if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))]
    # tables without a location match nothing; spread them instead of sending them to one task
    spread = F.concat(F.lit("\u0001"), F.pmod(F.xxhash64(*flat), F.lit(1000)).cast("string"))
    keyed = tables.withColumn("_key", F.coalesce("location", spread))
    return (
        keyed.join(best.withColumnRenamed("location", "_key"), "_key", "left")
        .drop("_key")
        .withColumn("unmapped", F.col("location").isNotNull() & F.col("target_location").isNull())
    )


def save_plan(plan: DataFrame, execution_id: str, now: Column) -> DataFrame:
    """A dry-run plan as stored rows, one per planned table."""
    return plan.select(
        F.lit(execution_id).alias("execution_id"), now.alias("generated_at"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("blueprint_json"),
    )


def latest_plan(plans: DataFrame) -> DataFrame:
    """The rows of the plan that was generated last."""
    key = F.struct("generated_at", "execution_id")
    return plans.where(key == plans.agg(F.max(key)).scalar())
