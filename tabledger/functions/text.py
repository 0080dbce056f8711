"""Names, patterns and small text parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest text kept in each ledger column.
ERROR_CODE_CHARS = 50
ERROR_MESSAGE_CHARS = 500
VALIDATION_MESSAGE_CHARS = 1000

# One glob token: a bracket class, or any single character.
_GLOB_TOKEN = r"(?s)\[!?\]?[^\]]*\]|."


def glob_tokens(glob: Column) -> Column:
    return F.regexp_extract_all(glob, F.lit(_GLOB_TOKEN), F.lit(0))


def glob_body(glob: Column, barrier: str = "") -> Column:
    """Regular expression, without anchors, for a shell glob held in a column.

    ``*``, ``?``, ``[seq]`` and ``[!seq]`` are special; an unclosed bracket and
    every other character stand for themselves. No wildcard matches ``barrier``.
    """
    some = f"[^{barrier}]" if barrier else "."

    def literal(text: Column) -> Column:
        return F.regexp_replace(text, r"([\\.^$|?*+(){}\[\]&~#-])", r"\\$1")

    def token(t: Column) -> Column:
        negated = F.substring(t, 2, 1) == "!"
        members = F.when(negated, t.substr(F.lit(3), F.length(t) - 3)).otherwise(
            t.substr(F.lit(2), F.length(t) - 2)
        )
        # keep '-' as a range mark inside a class
        members = F.regexp_replace(members, r"([\\^\[\]&~])", r"\\$1")
        char_class = F.concat(F.when(negated, F.lit(f"[^{barrier}")).otherwise(F.lit("[")), members, F.lit("]"))
        return (
            F.when(t == "*", F.lit(f"{some}*"))
            .when(t == "?", F.lit(some))
            .when((F.length(t) > 1) & t.startswith("["), char_class)
            .otherwise(literal(t))
        )

    return F.array_join(F.transform(glob_tokens(glob), lambda t: token(t)), "")


def glob_regex(*globs: Column, between: str = "") -> Column:
    """Anchored regular expression for globs, each on its own, that stand next to each other."""
    parts = [F.concat(F.lit("(?:"), glob_body(g), F.lit(")")) for g in globs]
    return F.concat(F.lit(r"(?s)\A"), F.concat_ws(between, *parts), F.lit(r"\z"))


def glob_match(value: Column, glob: Column) -> Column:
    """Case-insensitive whole-name glob match."""
    return F.rlike(F.lower(value), glob_regex(F.lower(glob)))


def any_glob_match(value: Column, globs: Column) -> Column:
    """True when any glob of an array column matches; false for an empty list."""
    return F.coalesce(F.exists(globs, lambda g: glob_match(value, g)), F.lit(False))


def is_glob(text: Column) -> Column:
    return F.rlike(text, F.lit(r"[*?\[]"))


def regex_full_match(value: Column, pattern: str) -> Column:
    """Case-insensitive whole-name regular-expression match."""
    return value.rlike(rf"(?i)\A(?:{pattern})\z")


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def first_filled(*texts: Column) -> Column:
    """First text that is not blank, trimmed."""
    return F.coalesce(*[blank_to_null(t) for t in texts])


_QUOTED = r"""(?:'[^']*'|"[^"]*")"""


def list_literal(cell: Column) -> Column:
    """A cell such as ``['a', '*b*']`` as an array of trimmed strings.

    One bare quoted or numeric literal is a list of one; blank or malformed
    cells are an empty list.
    """
    text = F.coalesce(F.trim(cell), F.lit(""))
    number = r"-?\d+(?:\.\d+)?"
    item = rf"(?:{_QUOTED}|{number})"
    shape = rf"(?s)\A(?:\[\s*(?:{item}\s*(?:,\s*{item}\s*)*,?\s*)?\]|\(\s*(?:{item}\s*(?:,\s*{item}\s*)*,?\s*)?\)|{item})\z"
    items = F.regexp_extract_all(text, F.lit(item), F.lit(0))
    bare = F.transform(items, lambda x: F.trim(F.regexp_replace(x, r"""(?s)\A['"]|['"]\z""", "")))
    return F.when(text.rlike(shape), bare).otherwise(F.array().cast("array<string>"))


def string_list(cell: Column) -> Column:
    """A JSON array or a comma list as an array of trimmed, non-empty strings."""
    parsed = F.coalesce(F.from_json(cell, "array<string>"), F.split(cell, ","))
    trimmed = F.transform(F.coalesce(parsed, F.array().cast("array<string>")), lambda x: F.trim(x))
    return F.filter(trimmed, lambda x: x.isNotNull() & (x != ""))


def fqn(*parts: Column | str) -> Column:
    return F.concat_ws(".", *parts)


def quoted_fqn(*parts: Column | str) -> Column:
    """Back-quoted name, safe for names that hold dots, dashes or back-quotes."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws(".", *[F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`")) for c in cols])


def fqn_part(name: Column, index: int) -> Column:
    return F.get(F.split(name, r"\."), index)


def fqn_size(name: Column) -> Column:
    return F.size(F.split(name, r"\."))


def cut(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def error_code_of(message: Column) -> Column:
    """Error code named in a failure message; the first that matches wins."""
    # Fixed values, in matching order.
    return (
        F.when(F.contains(message, F.lit("TABLE_OR_VIEW_NOT_FOUND")), "TABLE_OR_VIEW_NOT_FOUND")
        .when(F.contains(message, F.lit("LOCATION_OVERLAP")), "LOCATION_OVERLAP")
        .when(message.rlike("PERMISSION_DENIED|PermissionDenied"), "PERMISSION_DENIED")
        .when(F.contains(message, F.lit("AnalysisException")), "ANALYSIS_EXCEPTION")
        .otherwise("CLONE_FAILED")
    )


def rule_text(kind: Column, catalog: Column, schema: Column, table: Column) -> Column:
    """``kind:catalog[.schema[.table]]`` for an exclusion rule."""
    name = (
        F.when(kind == "catalog", catalog)
        .when(kind == "schema", F.concat_ws(".", catalog, schema))
        .otherwise(F.concat_ws(".", catalog, schema, table))
    )
    return F.concat(kind, F.lit(":"), name)


def result_counts(line: Column, total: Column) -> Column:
    """``{ok, fail}`` from a result line such as ``SUCCESS:batch=b,chunk=1,ok=3,fail=0``.

    Without counts, a line that starts with SUCCESS means all succeeded and any
    other line means none did.
    """
    pairs = F.str_to_map(line, F.lit(","), F.lit("="))
    total = total.cast("long")
    ok = F.try_element_at(pairs, F.lit("ok")).try_cast("long")
    fail = F.try_element_at(pairs, F.lit("fail")).try_cast("long")
    whole = F.contains(line, F.lit("ok=")) & F.contains(line, F.lit("fail=")) & ok.isNotNull() & fail.isNotNull()
    success = line.startswith("SUCCESS")
    zero = F.lit(0).cast("long")
    return F.struct(
        F.when(whole, ok).when(success, total).otherwise(zero).alias("ok"),
        F.when(whole, fail).when(success, zero).otherwise(total).alias("fail"),
    )


def generated_id(prefix: str, now: Column, key: Column | None = None, pattern: str = "yyyyMMdd") -> Column:
    """``prefix-<time>-<6 hex>``; with a key the same key always gets the same id."""
    tail = F.uuid() if key is None else F.sha2(key.cast("string"), 256)
    return F.concat_ws("-", F.lit(prefix), F.date_format(now, pattern), F.substring(F.replace(tail, F.lit("-")), 1, 6))
