"""Is the copy the same as the source? Counts, schemas, rows, checksums, profiles.

Each comparison of many table pairs is one job. Rows of both sides go through
one shared aggregate (+1 for the source, +1 for the target in its own column)
instead of two aggregates and a join: one shuffle, folded map-side, so a value
that fills a third of a table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_sum_sql, quoted, row_hash, row_hash_pair, row_sha256
from ..functions.sizing import within_tolerance
from . import digest_tree

Pairs = Mapping[str, tuple[DataFrame, DataFrame]]


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sides(pairs: Pairs, rows) -> DataFrame:
    """Union of both sides of all pairs; ``rows(df, name, is_source)`` shapes one side."""
    return _union([rows(df, name, side == 0) for name, pair in pairs.items() for side, df in enumerate(pair)])


def _marks(is_source: bool) -> list[Column]:
    return [
        (_one() if is_source else _zero()).alias("src_count"),
        (_zero() if is_source else _one()).alias("tgt_count"),
    ]


# -- counts --------------------------------------------------------------------


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; each scan reads no column."""
    return _union([
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])


def row_count_parity(pairs: Pairs, tolerance_pct: float = 0.0) -> DataFrame:
    """Source and target row counts of every pair, with the difference spelled out."""

    def rows(df: DataFrame, name: str, is_source: bool) -> DataFrame:
        n = df.agg(F.count("*").alias("n"))
        return n.select(
            F.lit(name).alias("table_name"),
            (F.col("n") if is_source else _zero()).alias("src_rows"),
            (_zero() if is_source else F.col("n")).alias("tgt_rows"),
        )

    counted = _sides(pairs, rows).groupBy("table_name").agg(
        F.sum("src_rows").alias("src_rows"), F.sum("tgt_rows").alias("tgt_rows")
    )
    delta = F.col("tgt_rows") - F.col("src_rows")
    return counted.select(
        "table_name", "src_rows", "tgt_rows",
        within_tolerance(F.col("src_rows"), F.col("tgt_rows"), tolerance_pct).alias("passed"), count_detail(delta).alias("detail"),
    )


def count_detail(delta: Column) -> Column:
    """Text of a count check over columns ``src_rows`` and ``tgt_rows``."""
    signed = F.concat(F.when(delta > 0, "+").otherwise(""), F.format_number(delta, 0))
    return F.concat(
        F.lit("src="), F.format_number("src_rows", 0), F.lit(" tgt="), F.format_number("tgt_rows", 0),
        F.when(delta != 0, F.concat(F.lit(" DELTA="), signed)).otherwise(""),
    )


def grouped_parity(
    source: DataFrame, target: DataFrame, keys: Sequence[str], tolerance_pct: float = 0.0
) -> DataFrame:
    """Row counts of both sides per key, NULL keys included, within a tolerance."""
    both = source.select(*keys, *_marks(True)).unionByName(target.select(*keys, *_marks(False)))
    return (
        both.groupBy(*keys)
        .agg(F.sum("src_count").alias("src_rows"), F.sum("tgt_count").alias("tgt_rows"))
        .withColumn("delta", F.col("tgt_rows") - F.col("src_rows"))
        .withColumn("passed", within_tolerance(F.col("src_rows"), F.col("tgt_rows"), tolerance_pct))
    )


# -- schemas -------------------------------------------------------------------


def schema_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, data_type, position, nullable`` of the given tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (name, f.name, f.dataType.simpleString(), i, f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, position int, nullable boolean"
    )


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns that are missing, extra or of another type, per table.

    Both inputs: table_name, column_name, data_type. Order and nullability do
    not count.
    """
    s = source.select("table_name", "column_name", F.col("data_type").alias("src_type"))
    t = target.select("table_name", "column_name", F.col("data_type").alias("tgt_type"))
    issue = (
        F.when(F.col("tgt_type").isNull(), "missing in target")
        .when(F.col("src_type").isNull(), "extra in target")
        .when(F.col("src_type") != F.col("tgt_type"), "type mismatch")
    )
    return s.join(t, ["table_name", "column_name"], "full").withColumn("issue", issue).where("issue IS NOT NULL")


def schema_verdicts(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per table: does the schema match, and a short account of what does not."""
    diff = schema_diff(source, target)
    counts = diff.groupBy("table_name").agg(
        F.count_if(F.col("issue") == "missing in target").alias("missing"),
        F.count_if(F.col("issue") == "extra in target").alias("extra"),
        F.count_if(F.col("issue") == "type mismatch").alias("mismatched"),
    )
    columns = source.groupBy("table_name").agg(F.count("*").alias("columns"))
    joined = columns.join(counts, "table_name", "full")
    bad = [
        F.when(F.col(name) > 0, F.concat(F.lit(f"{text}: "), F.col(name).cast("string")))
        for name, text in (("missing", "missing in tgt"), ("extra", "extra in tgt"), ("mismatched", "type mismatches"))
    ]
    passed = F.col("missing").isNull()
    return joined.select(
        "table_name",
        passed.alias("passed"),
        F.when(passed, F.concat(F.col("columns").cast("string"), F.lit(" cols match")))
        .otherwise(F.concat_ws("; ", *bad)).alias("detail"),
    )


# -- rows ----------------------------------------------------------------------


def aligned(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the same columns in one order, and equal types: where they differ, the common type that a union
    would give, else text. A change of type alone is a finding of the schema check, not of the row check."""
    names = source.columns
    target = target.select(*[F.col(quoted(c)) for c in names])
    kinds = [source.schema[c].dataType for c in names], [target.schema[c].dataType for c in names]

    def common(c: str, s: T.DataType, t: T.DataType) -> T.DataType:
        if s == t:
            return s
        if not (isinstance(s, T.NumericType) and isinstance(t, T.NumericType)):
            return T.StringType()
        one = [df.select(F.col(quoted(c))).limit(0) for df in (source, target)]
        return one[0].unionByName(one[1]).schema[c].dataType

    want = [common(c, s, t) for c, s, t in zip(names, *kinds, strict=True)]
    if want == kinds[0] == kinds[1]:
        return source, target
    return tuple(df.select(*[F.col(quoted(c)).cast(w).alias(c) for c, w in zip(names, want, strict=True)]) for df in (source, target))


def aligned_on(source: DataFrame, target: DataFrame, columns: set[str]) -> tuple[DataFrame, DataFrame]:
    """:func:`aligned` for the given columns alone; both sides have them."""
    names = [c for c in source.columns if c in columns]
    return aligned(*[df.select(*[F.col(quoted(c)) for c in names]) for df in (source, target)])


def multiset_diff(pairs: Pairs, sample_percent: int = 100) -> DataFrame:
    """Row hashes whose number of copies differs between the sides.

    Equal buckets of rows are told by their digests; only the 16-byte hashes of
    rows in differing buckets are shuffled, never the row. A sample keeps the
    same rows on both sides.
    """
    return _union([
        digest_tree.compared(*aligned(*p), sample_percent).differing.select(F.lit(n).alias("table_name"), "h1", "h2", "src_count", "tgt_count")
        for n, p in pairs.items()
    ])


def multiset_verdicts(pairs: Pairs, sample_percent: int = 100) -> DataFrame:
    """One row per pair: rows compared, distinct rows that differ, verdict. An empty pair passes."""

    def verdict(name: str, source: DataFrame, target: DataFrame) -> DataFrame:
        found = digest_tree.compared(*aligned(source, target), sample_percent)
        rows = found.totals.select("src_rows", "tgt_rows", F.lit(0).cast("bigint").alias("mismatches"))
        bad = found.differing.agg(F.count("*").alias("mismatches")).select(_zero().alias("src_rows"), _zero().alias("tgt_rows"), "mismatches")
        return rows.unionByName(bad).agg(*[F.sum(c).alias(c) for c in rows.columns]).withColumn("table_name", F.lit(name))

    return _union([verdict(n, *p) for n, p in pairs.items()]).select(
        "table_name", "src_rows", "tgt_rows", "mismatches",
        (F.col("mismatches") == 0).alias("passed"),
        F.concat(
            F.format_number("src_rows", 0), F.lit(" rows compared, "),
            F.col("mismatches").cast("string"), F.lit(" hash mismatches"),
        ).alias("detail"),
    )


def diff_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """The rows that differ, with their number of copies on each side.

    Rows are hashed first; whole rows are read again only in buckets that
    differ, and only for the hashes that differ.
    """
    source, target = aligned(source, target)
    found = digest_tree.compared(source, target)

    def side(df: DataFrame) -> DataFrame:
        first, second = row_hash_pair(df)
        return found.near(df.withColumns({"h1": first, "h2": second}))

    columns = source.columns
    rows = side(source).unionByName(side(target)).join(found.differing, ["h1", "h2"])
    # a key of its own: copies of one row are folded where the join finds them, before
    # they meet, so Spark may split a join key that holds a third of all rows
    key = F.concat_ws(":", "h1", "h2")
    keep = [F.any_value(F.col(quoted(c))).alias(c) for c in (*columns, "src_count", "tgt_count")]
    return rows.groupBy(key.alias("_key")).agg(*keep).drop("_key")


def diff_rows_exact(source: DataFrame, target: DataFrame) -> DataFrame:
    """As :func:`diff_rows`, comparing values instead of hashes (no map columns)."""
    columns = source.columns
    both = source.select(*columns, *_marks(True)).unionByName(target.select(*columns, *_marks(False)))
    return (
        both.groupBy(*columns)
        .agg(F.sum("src_count").alias("src_count"), F.sum("tgt_count").alias("tgt_count"))
        .where(F.col("src_count") != F.col("tgt_count"))
    )


def lost_and_extra(source: DataFrame, target: DataFrame) -> DataFrame:
    """Multiset difference both ways: every lost and every extra row, with its side."""
    diff = diff_rows(source, target)
    delta = F.col("src_count") - F.col("tgt_count")
    side = F.when(delta > 0, "lost").otherwise("extra").alias("side")
    each = diff.withColumn("_copies", F.array_repeat(F.lit(0), F.abs(delta).cast("int"))).withColumn("side", side)
    return each.withColumn("_copy", F.explode("_copies")).select(*[F.col(quoted(c)) for c in source.columns], "side")


# -- checksums -----------------------------------------------------------------


def checksum(df: DataFrame, columns: Sequence[str] | None = None, algorithm: str = "XXHASH64") -> DataFrame:
    """One row: ``row_count`` and an order-independent ``checksum`` of the rows as text: the sum of all 64-bit hashes, or
    for SHA256 the sums of the four 64-bit words of each digest."""
    if algorithm.upper() == "XXHASH64":
        hashed = df.select(row_hash(df, columns).alias("h"))
        return hashed.selectExpr("count(*) AS row_count", f"CAST({hash_sum_sql('h')} AS STRING) AS checksum")
    if algorithm.upper() != "SHA256":
        raise ValueError(f"unknown checksum algorithm {algorithm}")
    words = df.select(*[w.alias(f"w{i}") for i, w in enumerate(row_sha256(df, columns))])
    sums = ", ".join(f"CAST(coalesce(sum(w{i}), 0) AS STRING)" for i in range(4))
    return words.selectExpr("count(*) AS row_count", f"concat_ws('-', {sums}) AS checksum")


def checksum_verdicts(
    pairs: Pairs, columns: Mapping[str, Sequence[str]] | None = None, algorithm: str = "XXHASH64"
) -> DataFrame:
    """One row per pair: both checksums and whether they agree. No row is shuffled."""

    def rows(df: DataFrame, name: str, is_source: bool) -> DataFrame:
        one = checksum(df, (columns or {}).get(name), algorithm)
        none = F.lit(None).cast("string")
        return one.select(
            F.lit(name).alias("table_name"),
            (F.col("row_count") if is_source else _zero()).alias("src_rows"),
            (_zero() if is_source else F.col("row_count")).alias("tgt_rows"),
            (F.col("checksum") if is_source else none).alias("src_checksum"),
            (none if is_source else F.col("checksum")).alias("tgt_checksum"),
        )

    merged = _sides({n: aligned(*p) for n, p in pairs.items()}, rows).groupBy("table_name").agg(
        F.sum("src_rows").alias("src_rows"), F.sum("tgt_rows").alias("tgt_rows"),
        F.max("src_checksum").alias("src_checksum"), F.max("tgt_checksum").alias("tgt_checksum"),
    )
    same = (F.col("src_rows") == F.col("tgt_rows")) & (F.col("src_checksum") == F.col("tgt_checksum"))
    return merged.withColumn("passed", same)


# -- column profiles -----------------------------------------------------------

# Columns measured by one aggregate; more would not fit into compiled code.
PROFILE_GROUP = 8
# Classes of doubles besides the powers of two: null, NaN, infinite, zero, and a mark for a column without rows.
_NULL, _NAN, _INFINITE, _ZERO, _NO_ROWS = -5000, -5001, -5002, -5003, -5004


def profile_parts(fields: Sequence[T.StructField]) -> tuple[list[str], list[str]]:
    """Aggregates of the given columns (no doubles), and from them the profile of each, as SQL text over ``n`` (rows)."""
    # SQL text: building thousands of Column objects would take longer than the job
    aggs, shapes = [], []
    for i, field in enumerate(fields):
        value, dtype = quoted(field.name), field.dataType
        low = high = "CAST(NULL AS STRING)"
        mean = "CAST(NULL AS DOUBLE)"
        aggs.append(f"count({value}) AS c{i}")
        if not isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.NullType)):
            aggs += [f"min({value}) AS l{i}", f"max({value}) AS h{i}"]
            low, high = f"CAST(l{i} AS STRING)", f"CAST(h{i} AS STRING)"
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            aggs.append(f"CAST({hash_sum_sql(f'CAST({value} AS BIGINT)')} AS DOUBLE) AS s{i}")
            mean = f"s{i} / nullif(c{i}, 0)"
        elif isinstance(dtype, T.DecimalType):
            # sums of up to 28 digits are exact in 38; of longer ones their upper and lower halves are
            unit = f"CAST({value} AS DECIMAL(38,{dtype.scale}))"
            aggs += [f"sum(CAST(floor({unit} / 1000000000) AS DECIMAL(28,0))) AS s{i}",
                     f"sum(CAST({unit} - floor({unit} / 1000000000) * 1000000000 AS DECIMAL(28,{min(dtype.scale, 18)}))) AS r{i}"]
            mean = f"(CAST(s{i} AS DOUBLE) * 1e9D + CAST(r{i} AS DOUBLE)) / nullif(c{i}, 0)"
            if dtype.precision <= 28:
                aggs[-2:] = [f"sum({value}) AS s{i}"]
                mean = f"CAST(s{i} AS DOUBLE) / nullif(c{i}, 0)"
        shapes.append(
            f"named_struct('column_name', {_literal(field.name)}, 'value_count', c{i}, 'null_count', n - c{i}, 'nan_count', 0L, "
            f"'infinite_count', 0L, 'min_value', {low}, 'max_value', {high}, 'avg_value', {mean})"
        )
    return aggs, shapes


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _profile_pass(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    aggs, shapes = profile_parts(fields)
    return df.selectExpr("count(*) AS n", *aggs).selectExpr(f"inline(array({', '.join(shapes)}))")


def _power(exponent: str) -> str:
    """Times two to this power, in two steps, so that no step leaves the range of doubles."""
    half = f"floor(({exponent}) / 2)"
    return f"* pow(2D, {half}) * pow(2D, ({exponent}) - {half})"


def _double_pass(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Profiles of columns of one floating type, whose sums do not depend on the order of rows.

    A value is a whole number of up to 55 bits times a power of two. Values of one power are a class, and the upper and
    lower halves of their whole numbers are summed exactly. Only these sums, in the order of the powers and already
    divided by the count, are put together as doubles.
    """
    values = ", ".join(quoted(f.name) for f in fields)
    wide = "CAST(v AS DOUBLE)"
    kind = (f"CASE WHEN v IS NULL THEN {_NULL} WHEN isnan(v) THEN {_NAN} WHEN abs({wide}) = double('Infinity') THEN {_INFINITE} "
            f"WHEN v = 0 THEN {_ZERO} ELSE CAST(floor(log2(abs({wide}))) AS INT) - 1 END AS e")
    whole = f"CASE WHEN e > {_NULL} THEN CAST({wide} {_power('52 - e')} AS BIGINT) ELSE 0L END AS m"
    classes = (
        df.selectExpr(f"posexplode(array({values})) AS (i, v)").selectExpr("i", "v", kind).selectExpr("i", "v", "e", whole)
        .groupBy("i", "e").agg(
            F.count("*").alias("n"), F.expr("sum(shiftright(m, 28))").alias("hi"), F.expr("sum(m & 268435455L)").alias("lo"),
            F.expr("min(v + CAST(0 AS FLOAT))").alias("low"), F.expr("max(v + CAST(0 AS FLOAT))").alias("high"))
    )
    # a class without rows for each column, so that an empty table has profiles as well
    none = df.sparkSession.range(len(fields)).selectExpr(
        "CAST(id AS INT) AS i", f"{_NO_ROWS} AS e", "0L AS n", "0L AS hi", "0L AS lo", *[
            f"CAST(NULL AS {fields[0].dataType.simpleString()}) AS {c}" for c in ("low", "high")])
    names = ", ".join(_literal(f.name) for f in fields)
    known = f"e <> {_NULL} AND e <> {_NAN}"
    total = classes.unionByName(none).groupBy("i").agg(
        F.expr(f"sum(n) FILTER (WHERE e <> {_NULL})").alias("value_count"),
        *[F.expr(f"coalesce(sum(n) FILTER (WHERE e = {k}), 0L)").alias(name)
          for k, name in ((_NULL, "null_count"), (_NAN, "nan_count"), (_INFINITE, "infinite_count"))],
        F.expr(f"CAST(min(low) FILTER (WHERE {known}) AS STRING)").alias("min_value"),
        F.expr(f"CAST(max(high) FILTER (WHERE {known}) AS STRING)").alias("max_value"),
        F.expr(f"sum(n) FILTER (WHERE e > {_NULL} OR e = {_ZERO})").alias("finite"),
        F.expr(f"array_sort(collect_list(struct(e, hi, lo)) FILTER (WHERE e > {_NULL}))").alias("sums"),
    )
    mean = f"CASE WHEN finite > 0 THEN aggregate(sums, 0D, (a, p) -> a + (p.hi * 268435456D + p.lo) / finite {_power('p.e - 52')}) END AS avg_value"
    return total.selectExpr(f"element_at(array({names}), i + 1) AS column_name", "value_count", "null_count", "nan_count", "infinite_count",
                            "min_value", "max_value", mean)


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Counts, minimum, maximum and average of every column, one row per column.

    Of doubles, NaN and infinite values are counted; minimum and maximum are exact
    and leave out NaN, the average leaves out both. Averages do not depend on the
    order of rows. Nested columns have counts only.

    Every column is read once: texts and numbers are measured by separate
    aggregates, since one text would take all numbers out of the compiled path,
    and so are groups of columns of a wide table.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    doubles = floating(fields)
    parts = _plain_passes(df, [f for f in fields if f not in doubles])
    return _union([*parts, double_profiles(df, doubles)] if doubles else parts)


def floating(fields: Sequence[T.StructField]) -> list[T.StructField]:
    return [f for f in fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def double_profiles(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Profiles of columns of doubles and floats."""
    kinds = [[f for f in fields if isinstance(f.dataType, kind)] for kind in (T.DoubleType, T.FloatType)]
    return _union([_double_pass(df, kind) for kind in kinds if kind])


def _plain_passes(df: DataFrame, rest: Sequence[T.StructField]) -> list[DataFrame]:
    texts = [f for f in rest if isinstance(f.dataType, T.StringType)]
    others = [f for f in rest if not isinstance(f.dataType, T.StringType)]
    groups = [kind[i : i + PROFILE_GROUP] for kind in (others, texts) for i in range(0, len(kind), PROFILE_GROUP)]
    return [_profile_pass(df, group) for group in groups]


PROFILE_TYPE = ("struct<column_name:string,value_count:bigint,null_count:bigint,nan_count:bigint,infinite_count:bigint,"
                "min_value:string,max_value:string,avg_value:double>")
PROFILE = ("value_count", "null_count", "nan_count", "infinite_count", "min_value", "max_value", "avg_value")


def profile_compare(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Profiles of both sides next to each other, with a verdict per column: all equal."""
    s = column_profile(source, columns).select("column_name", *[F.col(c).alias(f"src_{c}") for c in PROFILE])
    t = column_profile(target, columns).select("column_name", *[F.col(c).alias(f"tgt_{c}") for c in PROFILE])
    same = reduce(lambda a, b: a & b, [F.col(f"src_{c}").eqNullSafe(F.col(f"tgt_{c}")) for c in PROFILE])
    return s.join(t, "column_name", "full").withColumn("passed", F.coalesce(same, F.lit(False)))


# -- checks by request ---------------------------------------------------------

# What each validation mode checks.
VALIDATION_MODES = {
    "NONE": (),
    "COUNT": ("COUNT",),
    "CHECKSUM": ("CHECKSUM",),
    "COLUMN_SAMPLE": ("COLUMN_SAMPLE",),
    "ALL": ("COUNT", "CHECKSUM", "COLUMN_SAMPLE"),
}


def requested_checks(
    pairs: Pairs, mode: str, columns: Sequence[str] | None = None, tolerance_pct: float = 0.0,
    algorithm: str = "XXHASH64",
) -> DataFrame | None:
    """Results (check_name, table_name, passed, detail) of one validation mode; None for NONE."""
    results = []
    for check in VALIDATION_MODES[mode.upper()]:
        if check == "COUNT":
            rows = row_count_parity(pairs, tolerance_pct)
        elif check == "CHECKSUM":
            chosen = {name: columns for name in pairs} if columns else None
            rows = checksum_verdicts(pairs, chosen, algorithm).withColumn(
                "detail", F.concat(F.lit("src="), F.col("src_checksum"), F.lit(" tgt="), F.col("tgt_checksum")))
        else:
            per_table = [profile_compare(s, t, columns).withColumn("table_name", F.lit(n)) for n, (s, t) in pairs.items()]
            differing = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("column_name"))))
            rows = _union([p.select("table_name", "column_name", "passed") for p in per_table]).groupBy("table_name").agg(
                F.every("passed").alias("passed"), F.concat(F.lit("differing: "), F.array_join(differing, ", ")).alias("detail"))
        results.append(rows.select(F.lit(check).alias("check_name"), "table_name", "passed", "detail"))
    return _union(results) if results else None


# -- table properties ----------------------------------------------------------


def table_type_check(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Is the type of each copied table the expected one? UNKNOWN expects nothing.

    Both inputs: table_name, table_type.
    """
    want = expected.select("table_name", F.col("table_type").alias("expected"))
    have = actual.select("table_name", F.upper("table_type").alias("actual"))
    found = F.coalesce("actual", F.lit("UNKNOWN"))
    return want.join(have, "table_name", "left").select(
        "table_name",
        ((found == F.col("expected")) | (F.col("expected") == "UNKNOWN")).alias("passed"),
        F.concat(F.lit("expected="), F.col("expected"), F.lit(" actual="), found).alias("detail"),
    )


def partition_columns_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """Same partition columns, in any order? Both inputs: table_name, partition_columns."""
    s = source.select("table_name", F.array_sort("partition_columns").alias("s"))
    t = target.select("table_name", F.array_sort("partition_columns").alias("t"))
    show = [F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]")) for c in ("s", "t")]
    return s.join(t, "table_name", "left").select(
        "table_name",
        F.col("s").eqNullSafe(F.col("t")).alias("passed"),
        F.concat(F.lit("src="), show[0], F.lit(" tgt="), F.coalesce(show[1], F.lit("none"))).alias("detail"),
    )


def history_check(tables: DataFrame, manifest: DataFrame) -> DataFrame:
    """Does each copied table have a committed version? ``tables``: table_name."""
    latest = manifest.groupBy("table_name").agg(F.max_by("operation", "version").alias("op"))
    return tables.select("table_name").distinct().join(latest, "table_name", "left").select(
        "table_name",
        F.col("op").isNotNull().alias("passed"),
        F.concat(F.lit("latest_op="), F.coalesce("op", F.lit("n/a"))).alias("detail"),
    )
