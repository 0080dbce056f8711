"""The ledger on disk: a versioned control table and append-only logs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from .schemas import (
    ATTEMPTS, AUDIT, CHECK_RESULTS, CONTROL, DRY_RUN_PLANS, EXCLUSION_LOG, REQUESTS, VALIDATION_HISTORY, conform, empty,
)
from .versions import VersionStore, VersionTaken, path_exists

LOGS = {
    "attempts": ATTEMPTS,
    "validation_history": VALIDATION_HISTORY,
    "exclusion_log": EXCLUSION_LOG,
    "check_results": CHECK_RESULTS,
    "audit": AUDIT,
    "dry_run_plans": DRY_RUN_PLANS,
}
TABLES = {"control": (CONTROL, ("batch_id",)), "requests": (REQUESTS, ())}


class Ledger:
    """Control table, request queue and logs below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.store = VersionStore(spark, f"{self.root}/tables")

    def create(self, now: Column) -> None:
        """Creates what does not exist yet; running it again changes nothing."""
        for name, (schema, partition_by) in TABLES.items():
            if self.store.latest(name) is None:
                self.store.write(empty(self.spark, schema), name, now, "CREATE", None, partition_by)

    def table(self, name: str = "control", version: int | None = None) -> DataFrame:
        """A table of the ledger; columns added since it was written are NULL."""
        return conform(self.store.read(name, version), TABLES[name][0])

    def update(
        self, build: Callable[[DataFrame], DataFrame], now: Column, name: str = "control",
        operation: str = "MERGE", tries: int = 5,
    ) -> int:
        """Writes ``build(current)`` as the next version.

        When another writer is faster, the change is built again on its result.
        """
        for attempt in range(tries):
            base = self.store.latest(name)
            try:
                rows = build(self.table(name, base))
                return self.store.write(rows, name, now, operation, base, TABLES[name][1])
            except VersionTaken:
                if attempt == tries - 1:
                    raise
                time.sleep(0.5 * 2**attempt)
        raise AssertionError("unreachable")

    def log(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, path):
            return empty(self.spark, LOGS[name])
        return self.spark.read.schema(LOGS[name]).parquet(path)

    def append(self, name: str, rows: DataFrame) -> None:
        conform(rows, LOGS[name]).select(*LOGS[name].fieldNames()).write.mode("append").parquet(f"{self.root}/{name}")
