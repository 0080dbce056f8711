"""Small tables for tests; every value follows from the row number."""

from pyspark.sql import functions as F


def numbered(spark, rows, **columns):
    return spark.range(rows).select("id", *[F.expr(sql).alias(name) for name, sql in columns.items()])


def store_tables(spark):
    """Dotted names of the tables of a small store; two of them are excluded by the mapping of the tests."""
    return {
        "prod.a.customers": numbered(spark, 100, name="concat('c', id)", tier="CASE id % 2 WHEN 0 THEN 'low' ELSE 'high' END"),
        "prod.a.orders": numbered(spark, 200, amount="CAST(id * 1.5 AS DECIMAL(10,2))"),
        "prod.a.tmp_notes": numbered(spark, 1, note="'left out'"),
        "prod.b.transactions": numbered(spark, 150, value="id / 7.0"),
        "prod.b.risk_scores": numbered(spark, 80, score="id % 10"),
        "prod.b.staging_load": numbered(spark, 1, note="'left out'"),
        "prod.a.empty_staging": no_rows(spark),
        "prod.b.complex": nested(spark, 50),
    }


def by_day(spark, rows=120):
    return numbered(spark, rows, hits="id * 3", event_date="date_add(DATE '2025-01-01', CAST(id % 3 AS INT))",
                    event_type="CASE id % 2 WHEN 0 THEN 'view' ELSE 'click' END")


def no_rows(spark):
    return spark.createDataFrame([], "load string, content string, at timestamp_ntz")


def wide(spark, rows):
    """One key, 100 numbers and 20 flags."""
    return numbered(spark, rows, **{f"v{i}": f"id % {i + 7} * 0.5D" for i in range(100)}, **{f"f{i}": f"id % {i + 2} = 0" for i in range(20)})


def nested(spark, rows):
    return numbered(spark, rows, pairs="map('k', concat('v', id % 10))", items="transform(sequence(0, id % 5), x -> concat('i', x))",
                    points="array(id * 0.1D, id * 0.2D)")


def table_names(schemas, per_kind=13):
    """(schema, table): per schema as many tables of one kind as of the other."""
    return [(s, f"{kind}_{s}_{i:02d}") for s in schemas for kind in ("dim", "fact") for i in range(1, per_kind + 1)]
