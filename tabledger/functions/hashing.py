"""Row hashes that tell apart every pair of different rows.

The built-in hash skips NULLs, ignores NULL array elements and does not see
array boundaries, so each value is hashed with its NULL flag and each
collection with its length. Zero is normalised so that -0.0 equals 0.0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)

# The expressions are written as SQL text: for a table of a hundred columns one
# text is built far faster than a thousand Column objects.


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _flagged(value: str, dtype: T.DataType, depth: int) -> str:
    return f"named_struct('n', {value} IS NULL, 'v', {canonical(value, dtype, depth)})"


def canonical(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """A value rewritten so that equal rows, and only those, hash alike."""
    x = f"x{depth}"
    if isinstance(dtype, _FLOATS):
        return f"({value} + CAST(0 AS {dtype.simpleString()}))"
    if isinstance(dtype, T.ArrayType):
        items = f"transform({value}, {x} -> {_flagged(x, dtype.elementType, depth + 1)})"
        return f"named_struct('size', size({value}), 'items', {items})"
    if isinstance(dtype, T.MapType):
        key = canonical(f"{x}.key", dtype.keyType, depth + 1)
        entry = f"named_struct('k', {key}, 'v', {_flagged(f'{x}.value', dtype.valueType, depth + 1)})"
        items = f"array_sort(transform(map_entries({value}), {x} -> {entry}))"
        return f"named_struct('size', size({value}), 'items', {items})"
    if isinstance(dtype, T.StructType):
        fields = [f"'f{i}', {_flagged(f'{value}.{quoted(f.name)}', f.dataType, depth)}" for i, f in enumerate(dtype.fields)]
        return f"named_struct({', '.join(fields)})"
    return value


def _fields(df: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    return [df.schema[c] for c in (columns or df.columns)]


# A value that arrays rarely hold; finding it only costs the fast path.
_PROBES = {
    T.FloatType: "-3.4E38", T.DoubleType: "-1.7E308", T.StringType: "\u0001-",
    T.ByteType: str(-(2**7)), T.ShortType: str(-(2**15)), T.IntegerType: str(-(2**31)), T.LongType: str(-(2**63)),
}


def _hash_form(value: str, dtype: T.DataType) -> str:
    """As :func:`canonical`, for the built-in hash, which treats zeros alike already.

    The hash walks a flat array itself. Only the places of NULL elements are
    added, and only for arrays that hold any: looking for a value that is not
    there yields NULL exactly then.
    """
    if isinstance(dtype, _FLOATS):
        return value
    if isinstance(dtype, T.ArrayType) and type(dtype.elementType) in _PROBES:
        probe = f"CAST('{_PROBES[type(dtype.elementType)]}' AS {dtype.elementType.simpleString()})"
        full = f"(array_contains({value}, {probe}) <=> false)"
        places = f"CASE WHEN NOT {full} THEN transform({value}, x -> x IS NULL) END"
        return f"named_struct('size', size({value}), 'full', {full}, 'nulls', {places}, 'items', {value})"
    return canonical(value, dtype)


def _hash(df: DataFrame, columns: Sequence[str] | None, *first: str) -> Column:
    fields = _fields(df, columns)
    values = [_hash_form(quoted(f.name), f.dataType) for f in fields]
    flags = [f"{quoted(f.name)} IS NULL" for f in fields]
    return F.expr(f"xxhash64({', '.join([*first, *values, *flags])})")


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash of the given columns (all by default)."""
    return _hash(df, columns)


def row_hash_pair(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: a 128-bit key, safe for 10^12 rows."""
    return _hash(df, columns), _hash(df, columns, "'second'")


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One string per row: ``length:value`` per field and ``N`` for NULL."""

    def field(f: T.StructField) -> str:
        name = quoted(f.name)
        value = canonical(name, f.dataType)
        if isinstance(f.dataType, _NESTED):
            text = f"to_json(named_struct('v', {value}), map('ignoreNullFields', 'false'))"
        elif isinstance(f.dataType, T.BinaryType):
            text = f"hex({value})"
        else:
            text = f"CAST({value} AS STRING)"
        return f"CASE WHEN {name} IS NULL THEN 'N' ELSE concat(CAST(length({text}) AS STRING), ':', {text}) END"

    return F.expr(f"concat({', '.join(field(f) for f in _fields(df, columns))})")


def row_md5(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    return F.md5(row_text(df, columns))


def hash_sum_sql(value: str) -> str:
    """Exact SQL ``SUM`` of 64-bit numbers as a decimal, order independent.

    Three 22-bit slices are summed as longs and put together once per group, so
    the per-row work stays on primitive longs and cannot overflow below 2^41
    rows per group.
    """
    slices = (f"{value} & 4194303", f"shiftright({value}, 22) & 4194303", f"shiftright({value}, 44)")
    parts = [
        f"CAST(coalesce(sum({part}), 0) AS DECIMAL(19,0)) * CAST({1 << bits}L AS DECIMAL(14,0))"
        for part, bits in zip(slices, (0, 22, 44))
    ]
    return f"CAST({' + '.join(parts)} AS DECIMAL(38,0))"


def row_sha256(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """The four 64-bit words of each row's SHA-256, as numbers that sum exactly."""
    digest = F.sha2(row_text(df, columns), 256)
    return [F.conv(F.substring(digest, 16 * i + 1, 16), 16, 10).cast("decimal(28,0)") for i in range(4)]


def in_sample(hash64: Column, percent: int) -> Column:
    """Keep about ``percent`` of all rows, the same rows on both sides."""
    return F.pmod(hash64, F.lit(100)) < F.lit(percent)
