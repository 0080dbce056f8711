"""Runs registered queries next to their SQL on DuckDB: ``python -m contract.check [dir] [names...]``."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

from .views import BASE_TABLES


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.12g}")
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr), sorted(columns)


def run(spark, sf_dir, names=()):
    from .queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = []
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            got, got_cols = multiset(df.columns, [tuple(r) for r in df.collect()])
        except Exception as e:  # report and go on with the next query
            bad.append(name)
            print(f"FAIL {name}: spark: {str(e)[:700]}")
            continue
        took = time.time() - began
        if name not in ORACLES:
            print(f"rows {name}: {len(got)} rows {took:.1f}s")
            continue
        try:
            cur = con.execute(ORACLES[name])
            cols = [c[0] for c in cur.description]
            want, want_cols = multiset(cols, cur.fetchall())
        except Exception as e:
            bad.append(name)
            print(f"FAIL {name}: duckdb: {str(e)[:700]}")
            continue
        types = {c[0]: str(c[1]) for c in cur.description}
        wide = [c for c, t in types.items() if "HUGEINT" in t]
        if got_cols != want_cols or got != want or wide:
            bad.append(name)
            print(f"FAIL {name}: {len(got)} vs {len(want)} rows; cols {got_cols == want_cols} {wide}")
            if got_cols != want_cols:
                print("   ", got_cols, want_cols)
            else:
                missing = [r for r in want if r not in got][:2] if len(want) < 20000 else want[:1]
                extra = [r for r in got if r not in want][:2] if len(got) < 20000 else got[:1]
                print("    cols ", got_cols, "\n    spark", extra, "\n    duck ", missing)
        else:
            print(f"ok   {name}: {len(got)} rows {took:.1f}s")
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.001"
    sys.exit(1 if run(session, folder, args[1:]) else 0)
