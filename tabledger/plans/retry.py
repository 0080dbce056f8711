"""Requeueing failed rows."""

from __future__ import annotations

from pyspark.sql import Column

from ..operators import ledger as states
from ..sources.ledger_store import Ledger
from .inventory import Options, plan_batch


def run_retry(
    ledger: Ledger, opt: Options, now: Column, base_seconds: int = 30, reset_permanents: bool = False
) -> dict[str, int]:
    """Requeues what can be retried, ends what cannot, and groups rows that have no group.

    No task waits: the back-off is the ``not_before`` column of the disposition.
    """
    before = ledger.table()
    _, disposition = states.retry_run(before, now, base_seconds, opt.batch_id, reset_permanents)
    stats = states.retry_stats(before, disposition, opt.batch_id, reset_permanents).first().asDict()
    ledger.update(
        lambda c: states.retry_run(c, now, base_seconds, opt.batch_id, reset_permanents)[0], now, operation="RETRY"
    )
    plan_batch(ledger, opt, now, only_unplanned=True)
    return stats
