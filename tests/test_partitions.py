"""Writes by partition, and checksums that read only what changed."""

import pytest
from pyspark.sql import functions as F

from tabledger.operators import compare, partition_digests
from tabledger.sources.partitions import PartitionedTable

from .frames import numbered


def batches(spark, path, rows=3000):
    """Three batches and rows without one; the first batch holds half of all rows."""
    df = numbered(spark, rows, name="concat('t', id)", status="'QUEUED'", amount="id / 7.0D",
                  batch_id="CASE WHEN id % 2 = 0 THEN 'b1' WHEN id % 5 = 0 THEN NULL WHEN id % 3 = 0 THEN 'b 2/x' ELSE '003' END")
    table = PartitionedTable(spark, str(path / "table"), df.schema, ("batch_id",))
    assert table.read().count() == 0 and table.marks().count() == 0
    table.overwrite(df)
    return table, df


def key(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(table):
    return {r.path: (r.batch_id, r.length, r.modificationTime) for r in table.files().collect()}


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "batch_id string")


def test_a_change_leaves_files_of_other_batches(spark, tmp_path):
    table, df = batches(spark, tmp_path)
    assert key(table.read()) == key(df)
    before = files(table)
    assert {v[0] for v in before.values()} == {"b1", "b 2/x", "003", None}
    for value in ("b 2/x", None, "003"):
        done = table.update(lambda rows: rows.withColumn("status", F.lit("ASSIGNED")), names(spark, value))
        assert done == 1
        after = files(table)
        other = {p: v for p, v in before.items() if v[0] != value}
        assert other and other == {p: v for p, v in after.items() if v[0] != value}
        assert not {p for p, v in before.items() if v[0] == value} & set(after)
        before = after
    want = df.withColumn("status", F.when(F.col("batch_id") == "b1", "QUEUED").otherwise("ASSIGNED"))
    assert key(table.read()) == key(want)
    assert "PartitionFilters: [" in table.read([("b1",)])._jdf.queryExecution().toString()


def test_partitions_that_become_empty_or_new(spark, tmp_path):
    table, df = batches(spark, tmp_path)
    assert table.update(lambda rows: rows.where("batch_id = '003'"), names(spark, "b1", "003")) == 2
    assert key(table.read()) == key(df.where("batch_id IS NULL OR batch_id <> 'b1'"))
    more = df.limit(3).withColumn("batch_id", F.lit("new"))
    assert table.update(lambda rows: rows.unionByName(more), names(spark, "new")) == 1
    assert table.read([("new",)]).count() == 3
    assert table.update(lambda rows: rows, names(spark)) == 0


def test_rows_for_another_partition_replace_nothing(spark, tmp_path):
    table, df = batches(spark, tmp_path)
    before = files(table)
    with pytest.raises(Exception, match="outside of the partitions"):
        table.update(lambda rows: rows.withColumn("batch_id", F.lit("b1")), names(spark, "003"))
    assert files(table) == before and key(table.read()) == key(df)


def test_a_large_batch_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "16k")
    try:
        table, _ = batches(spark, tmp_path, 60_000)
    finally:
        spark.conf.unset(size)
    assert table.marks().where("batch_id = 'b1'").first().files > 1


def test_two_columns(spark, tmp_path):
    df = numbered(spark, 100, a="id % 3", b="CASE WHEN id % 2 = 0 THEN DATE '2025-01-01' END")
    table = PartitionedTable(spark, str(tmp_path / "two"), df.schema, ("a", "b"))
    table.overwrite(df)
    one = df.where("a = 1 AND b IS NULL").select("a", "b").limit(1)
    table.update(lambda rows: rows.limit(1), one)
    assert table.read().count() == 100 - df.where("a = 1 AND b IS NULL").count() + 1
    assert table.read(table.names(one)).count() == 1


@pytest.mark.parametrize("algorithm", ["XXHASH64", "SHA256"])
def test_refreshed_checksum_equals_the_full_one(spark, tmp_path, algorithm):
    table, _ = batches(spark, tmp_path)
    first = partition_digests.refreshed(table, algorithm=algorithm)
    first.write.parquet(str(tmp_path / "digests"))
    stored = spark.read.parquet(str(tmp_path / "digests"))
    assert stored.where("reread").count() == 4
    same = partition_digests.refreshed(table, stored, algorithm=algorithm)
    assert same.where("reread").count() == 0 and same.count() == 4

    table.update(lambda rows: rows.where("id % 10 <> 3"), names(spark, "003"))
    table.update(lambda rows: rows.limit(0), names(spark, "b 2/x"))
    table.update(lambda rows: rows.withColumn("amount", F.col("amount") + 1), names(spark, None))
    again = partition_digests.refreshed(table, stored, algorithm=algorithm)
    assert sorted((str(r.batch_id), r.reread) for r in again.collect()) == [("003", True), ("None", True), ("b1", False)]
    full = compare.checksum(table.read(), algorithm=algorithm).first()
    got = partition_digests.merged(again, algorithm).first()
    assert (got.row_count, got.checksum) == (full.row_count, full.checksum)
    # what a refresh opens: the files of the two changed partitions
    changed = [n for n in table.names(again.where("reread"))]
    opened = {r.f for r in table.read(changed).select(F.input_file_name().alias("f")).distinct().collect()}
    assert 0 < len(opened) < table.files().count() and not any("batch_id=b1" in f for f in opened)


def test_empty_table_and_unknown_algorithm(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "none"), numbered(spark, 1, b="id").schema, ("b",))
    none = partition_digests.refreshed(table)
    assert none.count() == 0
    assert tuple(partition_digests.merged(none).first()) == tuple(compare.checksum(table.read()).first()) == (0, "0")
    with pytest.raises(ValueError):
        partition_digests.digests(table.read(), ["b"], algorithm="CRC")
