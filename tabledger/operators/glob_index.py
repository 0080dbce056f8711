"""Many names against many globs, without trying every glob on every name.

Every glob is taken apart once, on the side of the rules: its literal fragments
between wildcards, and a regular expression where these do not settle a match.
The longest fragment that a name can be looked up by is the glob's key: the text
before its first wildcard, the text after its last one, or the first letters of
the longest fragment in between. A name has a few keys of each kind and size that
is in use, and meets by equality only the globs that share one; wildcards in
front do not matter, since such globs have their key at the end or in the
middle. What meets is tested on fragments, or with the expression made before.

A name may have several parts (catalog, schema, table), joined by a separator
that no wildcard crosses; fragments can then reach over parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import glob_body, glob_tokens

SEPARATOR = "\u0001"
_WILD = "\u0002"
# Keys of fragments in the middle are their first letters, at most so many; longer ones at the ends are cut to a multiple.
_GRAM = 4
_COLUMNS = ("g_kind", "g_size", "g_key", "g_prefix", "g_suffix", "g_simple", "g_exact", "g_regex")


def joined(*parts: Column | str) -> Column:
    """A name of several parts, in lower case."""
    return F.lower(F.concat_ws(SEPARATOR, *parts))


def _rounded(n: Column) -> Column:
    return F.when(n < _GRAM, n).otherwise(n - n % _GRAM)


def compiled(globs: DataFrame, *parts: str) -> DataFrame:
    """``globs`` with the columns of its index; the named columns hold the parts of each glob and are not null."""
    literal = lambda t: F.when((t == "*") | (t == "?") | ((F.length(t) > 1) & t.startswith("[")), F.lit(_WILD)).otherwise(t)
    lower = [F.lower(F.col(p)) for p in parts]
    text = F.concat_ws(SEPARATOR, *[F.array_join(F.transform(glob_tokens(p), literal), "") for p in lower])
    marks = F.length(F.regexp_replace(F.concat_ws("", *lower), r"[^*]", ""))
    out = globs.withColumn("_f", F.split(text, _WILD))
    out = out.withColumns({
        "g_exact": F.size("_f") == 1,
        "g_prefix": F.element_at("_f", 1), "g_suffix": F.element_at("_f", -1),
        "_m": F.array_max(F.transform(F.slice("_f", 2, F.greatest(F.size("_f") - 2, F.lit(0))), lambda f: F.struct(F.length(f).alias("n"), f.alias("f")))),
        # one star and nothing else: both ends settle the match, and all separators are in them
        "g_simple": (F.size("_f") == 2) & (marks == 1) & ~F.rlike(F.concat_ws("", *lower), F.lit(r"[?\[]")),
        "g_regex": F.concat(F.lit(r"(?s)\A"), F.concat_ws(SEPARATOR, *[F.concat(F.lit("(?:"), glob_body(p, SEPARATOR), F.lit(")")) for p in lower]), F.lit(r"\z")),
    })
    p, s = _rounded(F.length("g_prefix")), _rounded(F.length("g_suffix"))
    m = F.least(F.coalesce(F.col("_m.n"), F.lit(0)), F.lit(_GRAM))
    kind = (F.when(F.col("g_exact"), "exact").when((p > 0) & (p >= s) & (p >= m), "prefix").when((s > 0) & (s >= m), "suffix")
            .when(m > 0, "middle").otherwise("any"))
    size = F.when(kind == "prefix", p).when(kind == "suffix", s).when(kind == "middle", m).otherwise(0)
    key = (F.when(kind == "exact", F.col("g_prefix")).when(kind == "prefix", F.left("g_prefix", p)).when(kind == "suffix", F.right("g_suffix", s))
           .when(kind == "middle", F.left("_m.f", m)).otherwise(""))
    return out.withColumns({"g_kind": kind, "g_size": size.cast("int"), "g_key": key}).drop("_f", "_m")


_KEYS = """
  flatten(transform(_used, u -> CASE u.g_kind
    WHEN 'prefix' THEN IF(length({n}) >= u.g_size, array(named_struct('g_kind', u.g_kind, 'g_size', u.g_size, 'g_key', left({n}, u.g_size))), array())
    WHEN 'suffix' THEN IF(length({n}) >= u.g_size, array(named_struct('g_kind', u.g_kind, 'g_size', u.g_size, 'g_key', right({n}, u.g_size))), array())
    WHEN 'middle' THEN IF(length({n}) >= u.g_size, transform(array_distinct(transform(sequence(1, length({n}) - u.g_size + 1), i -> substring({n}, i, u.g_size))),
        k -> named_struct('g_kind', u.g_kind, 'g_size', u.g_size, 'g_key', k)), array())
    WHEN 'exact' THEN array(named_struct('g_kind', u.g_kind, 'g_size', u.g_size, 'g_key', {n}))
    ELSE array(named_struct('g_kind', u.g_kind, 'g_size', u.g_size, 'g_key', '')) END))"""


def matching(names: DataFrame, name: str, globs: DataFrame) -> DataFrame:
    """Every pair of a row of ``names`` and a row of ``globs`` (from :func:`compiled`) whose glob matches the whole of
    column ``name`` (from :func:`joined`, with as many parts), with the columns of both."""
    used = globs.agg(F.collect_set(F.struct("g_kind", "g_size"))).scalar()
    keyed = names.withColumn("_used", used).withColumn("_k", F.explode(F.expr(_KEYS.format(n=f"`{name}`")))).select(
        *names.columns, *[F.col(f"_k.{c}").alias(c) for c in ("g_kind", "g_size", "g_key")])
    n, prefix, suffix = F.col(name), F.col("g_prefix"), F.col("g_suffix")
    ends = F.startswith(n, prefix) & F.endswith(n, suffix) & (F.length(n) >= F.length(prefix) + F.length(suffix))
    # regexp_instr keeps its last pattern; rlike would compile one for each row
    hit = F.col("g_exact") | F.when(F.col("g_simple"), ends).otherwise(ends & (F.regexp_instr(n, F.col("g_regex")) > 0))
    return keyed.join(globs, ["g_kind", "g_size", "g_key"]).where(hit).drop(*_COLUMNS)


def list_matches(names: DataFrame, name: str, lists: DataFrame, globs: str) -> DataFrame:
    """Distinct pairs of a name (column ``name``, in lower case) and a list of globs (array column ``globs``) of which one matches it."""
    each = lists.select(globs).distinct().withColumn("_glob", F.explode(globs)).where("_glob IS NOT NULL")
    known = names.select(name).distinct()
    return matching(known, name, compiled(each, "_glob")).select(globs, name).distinct()
