"""The checks that requests ask for, each with its own columns, tolerance and algorithm.

Many requests may ask about one table. All that they need from it is measured
together: one scan of each side gives its row count, every checksum and every
profile that any request wants (columns of doubles, whose exact sums are grouped
by size, take a scan of these columns alone). The results are then dealt back to
the requests by equality on what they asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_sum_sql, row_hash, row_sha256
from ..functions.sizing import within_tolerance
from . import compare
from .requests import validation_plan

ALGORITHMS = ("XXHASH64", "SHA256")
_RESULT = "table_name string, check_name string, spec string, src_rows long, tgt_rows long, passed boolean, detail string"


@dataclass
class Wanted:
    """What all requests together want to know of one table; keys are how requests name it."""

    count: bool = False
    checksums: dict[str, tuple[tuple[str, ...], str]] = field(default_factory=dict)
    samples: dict[str, tuple[str, ...]] = field(default_factory=dict)
    faults: dict[tuple[str, str], str] = field(default_factory=dict)


def requested_tables(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Requests with the tables they cover: ``table_name`` of ``names`` (catalog.schema.table) by table, schema or catalog.
    A table request whose table is not there keeps its own name."""
    parts = F.split("table_name", r"\.")
    known = names.select("table_name", F.get(parts, 0).alias("_c"), F.get(parts, 1).alias("_s")).distinct()
    by_table = requests.where("scope_mode = 'table'").withColumn("table_name", F.col("src_table"))
    by_schema = requests.where("scope_mode = 'schema'").join(known, (F.col("src_catalog") == F.col("_c")) & (F.col("src_schema") == F.col("_s")))
    by_catalog = requests.where("scope_mode = 'catalog'").join(known, F.col("src_catalog") == F.col("_c"))
    return by_table.unionByName(by_schema.drop("_c", "_s")).unionByName(by_catalog.drop("_c", "_s"))


def _spec() -> Column:
    """What a check needs besides its table, as a text: equal texts are measured once."""
    columns = F.coalesce(F.array_join("columns", ","), F.lit(""))
    return (F.when(F.col("check_name") == "COUNT", "").when(F.col("check_name") == "CHECKSUM", F.concat_ws("|", F.upper("checksum_algorithm"), columns))
            .otherwise(columns))


def _wanted(asked: list, pairs: compare.Pairs) -> dict[str, Wanted]:
    out: dict[str, Wanted] = {}
    for row in asked:
        if row.table_name not in pairs:
            continue
        one = out.setdefault(row.table_name, Wanted())
        own = pairs[row.table_name]
        columns = tuple(row.columns or ()) or tuple(own[0].columns)
        missing = [c for c in columns if any(c not in df.columns for df in own)]
        if row.check_name == "COUNT":
            one.count = True
        elif missing:
            one.faults[row.check_name, row.spec] = f"Error: no such columns on both sides: {', '.join(missing)}"
        elif row.check_name == "CHECKSUM" and (row.checksum_algorithm or "").upper() not in ALGORITHMS:
            one.faults[row.check_name, row.spec] = f"Error: unknown algorithm {row.checksum_algorithm}"
        elif row.check_name == "CHECKSUM":
            one.checksums[row.spec] = (columns, row.checksum_algorithm.upper())
        else:
            one.samples[row.spec] = columns
    return out


def _sums(df: DataFrame, wanted: Wanted) -> tuple[list[Column], list[str]]:
    """Columns to add to every row, and the aggregates that make the checksums of them, in the order of ``wanted.checksums``."""
    extra, sums = [], []
    for k, (columns, algorithm) in enumerate(wanted.checksums.values()):
        if algorithm == "XXHASH64":
            extra.append(row_hash(df, columns).alias(f"_h{k}"))
            sums.append(f"CAST({hash_sum_sql(f'_h{k}')} AS STRING) AS k{k}")
        else:
            extra += [w.alias(f"_h{k}_{i}") for i, w in enumerate(row_sha256(df, columns))]
            words = ", ".join(f"CAST(coalesce(sum(_h{k}_{i}), 0) AS STRING)" for i in range(4))
            sums.append(f"concat_ws('-', {words}) AS k{k}")
    return extra, sums


def _measured(df: DataFrame, wanted: Wanted) -> DataFrame:
    """One row of one side: ``n``, ``sums`` and ``profiles`` (one struct per column that any sample names)."""
    fields = [f for f in df.schema.fields if any(f.name in columns for columns in wanted.samples.values())]
    doubles = compare.floating(fields)
    plain = [f for f in fields if f not in doubles]
    extra, sums = _sums(df, wanted)
    aggs, shapes = compare.profile_parts(plain)
    keys = ", ".join(f"k{k}" for k in range(len(sums)))
    profiles = f"array({', '.join(shapes)})" if shapes else f"CAST(array() AS array<{compare.PROFILE_TYPE}>)"
    one = df.select("*", *extra).selectExpr("count(*) AS n", *sums, *aggs).selectExpr(
        "n", f"CAST(array({keys}) AS array<string>) AS sums", f"CAST({profiles} AS array<{compare.PROFILE_TYPE}>) AS profiles")
    if not doubles:
        return one
    more = compare.double_profiles(df, doubles)
    listed = more.agg(F.collect_list(F.struct(*more.columns)).cast(f"array<{compare.PROFILE_TYPE}>").alias("_more"))  # a row per column
    # both have exactly one row
    return one.withColumn("_one", F.lit(1)).join(listed.withColumn("_one", F.lit(1)), "_one").select(
        "n", "sums", F.concat("profiles", "_more").alias("profiles"))


def _results(name: str, source: DataFrame, target: DataFrame, wanted: Wanted) -> DataFrame:
    source, target = compare.aligned_on(source, target, {c for columns in [x for x, _ in wanted.checksums.values()] + [*wanted.samples.values()] for c in columns})
    sides = [_measured(df, wanted).select(F.lit(name).alias("table_name"), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "sums", "profiles")])
             for side, df in (("src", source), ("tgt", target))]
    both = sides[0].join(sides[1], "table_name")
    same = F.col("src_n") == F.col("tgt_n")
    none = F.lit(None)
    found = []
    if wanted.count:
        found.append(("COUNT", "", none, none))
    for k, spec in enumerate(wanted.checksums):
        a, b = F.get("src_sums", F.lit(k)), F.get("tgt_sums", F.lit(k))
        found.append(("CHECKSUM", spec, same & (a == b), F.concat(F.lit("src="), a, F.lit(" tgt="), b)))
    for spec, columns in wanted.samples.items():
        own = lambda side: F.array_sort(F.filter(f"{side}_profiles", lambda p: p["column_name"].isin(*columns)))  # noqa: E731, B023
        pairs = F.arrays_zip(own("src").alias("s"), own("tgt").alias("t"))
        differing = F.transform(F.filter(pairs, lambda p: ~p["s"].eqNullSafe(p["t"])), lambda p: p["s"]["column_name"])
        found.append(("COLUMN_SAMPLE", spec, F.size(differing) == 0, F.concat(F.lit("differing: "), F.array_join(differing, ", "))))
    rows = F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(spec).alias("spec"), passed.cast("boolean").alias("passed"), detail.cast("string").alias("detail"))
        for check, spec, passed, detail in found
    ])
    return both.withColumn("_r", F.explode(rows)).select(
        "table_name", "_r.check_name", "_r.spec", F.col("src_n").alias("src_rows"), F.col("tgt_n").alias("tgt_rows"), "_r.passed", "_r.detail")


def run_request_checks(requests: DataFrame, pairs: compare.Pairs) -> DataFrame:
    """One row per request, table and check: ``onboarding_id, table_name, check_name, columns, passed, detail``.

    ``requests`` are rows of the queue, ``pairs`` the tables by full name. Counts are held against the tolerance of each
    request. A check that names columns or an algorithm that are not there, or a table without a pair, fails and says
    so; mode NONE asks for nothing. Only the distinct wishes (names) come to the driver, never rows of a table.
    """
    spark: SparkSession = requests.sparkSession
    names = spark.createDataFrame([(n,) for n in pairs], "table_name string")
    covered = requested_tables(requests, names)
    plan = validation_plan(requests).join(covered.select("onboarding_id", "table_name"), "onboarding_id").withColumn("spec", _spec()).distinct()
    asked = plan.select("table_name", "check_name", "spec", "columns", "checksum_algorithm").distinct().collect()
    wanted = _wanted(asked, pairs)
    faults = [(t, check, spec, None, None, False, why) for t, w in wanted.items() for (check, spec), why in w.faults.items()]
    results = spark.createDataFrame(faults, _RESULT)
    for name, one in wanted.items():
        if one.count or one.checksums or one.samples:
            results = results.unionByName(_results(name, *pairs[name], one))
    counted = F.col("check_name") == "COUNT"
    delta = F.col("tgt_rows") - F.col("src_rows")
    allowed = within_tolerance(F.col("src_rows"), F.col("tgt_rows"), F.col("count_tolerance_pct"))
    return plan.join(results, ["table_name", "check_name", "spec"], "left").select(
        "onboarding_id", "table_name", "check_name", "columns",
        F.coalesce(F.when(counted, allowed).otherwise(F.col("passed")), F.lit(False)).alias("passed"),
        F.coalesce(F.when(counted & F.col("src_rows").isNotNull(), compare.count_detail(delta)).otherwise(F.col("detail")),
                   F.lit("Error: no such pair of tables")).alias("detail"),
    )
