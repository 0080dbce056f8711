"""Copying the tables of a group and recording what happened."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import error_code_of
from ..operators import ledger as states
from ..sources.checkpoints import checkpointed
from ..sources.ledger_store import Ledger
from ..sources.versions import VersionStore, copy_table

_OUTCOME = (
    "migration_id string, success boolean, duration_seconds bigint, target_num_files bigint, target_version bigint,"
    "source_version bigint, target_size_bytes bigint, rows_copied bigint, content_checksum string,"
    "error_text string, error_message string"
)


class CopyFailed(RuntimeError):
    """At least one table of the group failed; all outcomes are recorded."""


def run_chunk(
    ledger: Ledger, source: VersionStore, target: VersionStore, batch_id: str, chunk_id: int, now: Column,
    run_id: str = "", cluster_id: str = "local", parallel_tables: int = 4, target_root: str | None = None,
    raise_on_failure: bool = True,
) -> dict[str, int]:
    """Copies every table of one group.

    The driver handles names only; each copy is a distributed read and write,
    and a few run side by side. State changes are three writes per group,
    however many tables it has.
    """
    ledger.update(lambda c: states.mark_assigned(c, cluster_id, now, batch_id, chunk_id), now, operation="ASSIGN")
    work = states.chunk_rows(ledger.table(), batch_id, chunk_id)
    attempts = checkpointed(
        work.select("migration_id", (F.coalesce("attempt_number", F.lit(0)) + 1).alias("attempt_number"),
                    now.cast("timestamp_ntz").alias("started_at"))
    )
    ledger.update(lambda c: states.mark_in_progress(c, attempts, now), now, operation="START")
    names = work.select(
        "migration_id",
        F.concat_ws(".", "source_catalog", "source_schema", "source_table").alias("source"),
        F.concat_ws(".", "target_catalog", "target_schema", "target_table").alias("target"),
    )

    def copy(row) -> tuple:
        began = time.monotonic()
        location = None if target_root is None else f"{target_root.rstrip('/')}/{row.target}"
        try:
            done = copy_table(source, target, row.source, row.target, now, location)
        except Exception as e:  # a failed table must not stop the others
            text = f"{type(e).__name__}: {e}"
            return (row.migration_id, False, int(time.monotonic() - began), *[None] * 6, text, text[:500])
        return (
            row.migration_id, True, int(time.monotonic() - began), done["target_num_files"], done["target_version"],
            done["source_version"], done["target_size_bytes"], done["rows_copied"], done["content_checksum"], None, None,
        )

    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        results = list(pool.map(copy, names.toLocalIterator()))
    outcomes = ledger.spark.createDataFrame(results, _OUTCOME)
    outcomes = outcomes.withColumn("error_code", F.when(~F.col("success"), error_code_of(F.col("error_text"))))
    ledger.update(lambda c: states.apply_outcomes(c, outcomes, now), now, operation="OUTCOMES")
    ledger.append("attempts", states.attempt_rows(ledger.table(), outcomes, run_id, cluster_id, now))
    ok = sum(1 for r in results if r[1])
    failed = len(results) - ok
    if failed and raise_on_failure:
        raise CopyFailed(f"PARTIAL_FAILURE:batch={batch_id},chunk={chunk_id},ok={ok},fail={failed}")
    return {"ok": ok, "fail": failed}


def run_batch(
    ledger: Ledger, source: VersionStore, target: VersionStore, batch_id: str, now: Column, **options
) -> dict[str, int]:
    """Copies every group of a batch that still has work, one after the other."""
    total = {"ok": 0, "fail": 0}
    chunks = [r.chunk_id for r in states.active_chunks(ledger.table(), batch_id).orderBy("chunk_id").toLocalIterator()]
    for chunk in chunks:
        done = run_chunk(ledger, source, target, batch_id, chunk, now, raise_on_failure=False, **options)
        total = {k: total[k] + done[k] for k in total}
    if total["fail"]:
        raise CopyFailed(f"PARTIAL_FAILURE:batch={batch_id},ok={total['ok']},fail={total['fail']}")
    return total
