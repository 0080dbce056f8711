"""Counts and checksums that a copy takes on its way."""

import subprocess
import sys
from pathlib import Path

from tabledger.functions.observed import observed
from tabledger.operators import compare
from tabledger.operators.ledger import lit_time
from tabledger.plans.copy import run_batch
from tabledger.plans.inventory import run_inventory
from tabledger.plans.validate import run_validation
from tabledger.sources.versions import VersionStore, copy_table

from . import frames
from .test_jobs import OPT, TYPED, inputs, mapping, t, world  # noqa: F401


def test_observed_equals_a_scan(spark, tmp_path):
    for name, df in {**frames.store_tables(spark), "wide": frames.wide(spark, 500)}.items():
        rows, seen = observed(df)
        assert rows.columns == df.columns
        rows.write.parquet(str(tmp_path / name))
        want = compare.checksum(df).first()
        assert seen() == {"row_count": want.row_count, "checksum": want.checksum}, name


def test_copy_reports_what_it_read(spark, tmp_path):
    source, target = VersionStore(spark, str(tmp_path / "s")), VersionStore(spark, str(tmp_path / "t"))
    now = lit_time("2025-03-01 00:00:00")
    df = frames.by_day(spark)
    source.write(df, "a.b.c", now, partition_by=("event_date",))
    done = copy_table(source, target, "a.b.c", "x.y.z", now)
    want = compare.checksum(target.read("x.y.z")).first()
    assert (done["rows_copied"], done["content_checksum"]) == (120, want.checksum)


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from tabledger.functions.observed import observed
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
def flaky(batches):
    for k, batch in enumerate(batches):
        yield batch
        if k == 2 and TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")
rows, seen = observed(spark.range(0, 200, 1, 4).mapInPandas(flaky, "id long"))
rows.write.parquet(sys.argv[1])
assert seen()["row_count"] == 200 == spark.read.parquet(sys.argv[1]).count(), seen()
print("counted once")
"""


def test_a_task_that_is_tried_again_counts_once(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run([sys.executable, "-c", RETRIED, str(tmp_path / "out")], cwd=root, capture_output=True, text=True, timeout=180)
    assert "counted once" in done.stdout, done.stderr[-2000:]


def test_validation_takes_the_counts_of_copies(spark, tmp_path, world, monkeypatch):
    source, target, ledger = world
    run_inventory(ledger, mapping(spark, tmp_path, TYPED), inputs(source), OPT, t(1))
    run_batch(ledger, source, target, "b1", t(2), run_id="r2")
    attempts = ledger.log("attempts").where("status = 'SUCCESS'")
    assert attempts.where("rows_copied IS NULL OR content_checksum IS NULL OR source_version IS NULL").count() == 0
    scanned = []
    count = VersionStore.count_rows
    monkeypatch.setattr(VersionStore, "count_rows", lambda self, wanted: scanned.append((self.root, wanted.where("version >= 0").count())) or count(self, wanted))
    done = run_validation(ledger, source, target, t(3), "b1", copied_rows=True)
    assert done["failed"] == 0 and done["row_count_matched"] == done["passed"] == attempts.count()
    assert sum(n for root, n in scanned if root == source.root) == 0
    rows = {r.source_table: r for r in ledger.log("validation_history").collect()}
    assert (rows["customers"].source_row_count, rows["empty_staging"].source_row_count) == (100, 0)
