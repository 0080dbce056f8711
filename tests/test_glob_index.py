import fnmatch
import random

from pyspark.sql import functions as F

from tabledger.operators import glob_index, select

GLOBS = ["*", "?", "**", "a*", "*a", "a*b", "*ab*", "*abc*", "*a*b*", "ab?", "?b*", "[ab]*", "[!a]*", "*[0-9]", "tmp_*", "*_tmp", "*_stg_*",
         "dim_*_v?", "[", "[]a]*", "a[", "*[", "ab", "a.b", "x+y", "*(1)*", "dim-*", "*é*", "a*a", "ab*ba", "*?a", "???*", "fact_2024*", "*2024_q[1-4]"]
NAMES = ["a", "b", "ab", "aa", "aba", "abba", "abc", "xabcx", "tmp_1", "x_tmp", "a_stg_b", "dim_x_v1", "dim_x_v12", "[", "]a", "a[", "]", "a.b", "axb", "x+y",
         "f(1)", "dim-1", "é", "café", "fact_2024_q1", "fact_2024_q5", "9", "zz9", "TMP_2", "Ab"]


def test_every_form_of_glob(spark):
    globs = spark.createDataFrame([(g,) for g in GLOBS], "g string")
    names = spark.createDataFrame([(n,) for n in NAMES], "n string").withColumn("k", glob_index.joined("n"))
    got = {(r.n, r.g) for r in glob_index.matching(names, "k", glob_index.compiled(globs, "g")).collect()}
    assert got == {(n, g) for n in NAMES for g in GLOBS if fnmatch.fnmatchcase(n.lower(), g.lower())}


def test_parts_do_not_run_into_each_other(spark):
    r = random.Random(7)
    parts = ["a", "ab", "b", "ba", "a[b", "x]"]
    globs = [(r.choice(["*", "a*", "*b", "?", "[ab]", "[!a]", "ab", "*a*", "a["]), r.choice(["*", "b*", "*a", "?a", "x]", "*b*"])) for _ in range(60)]
    names = [(a, b) for a in parts for b in parts]
    g = spark.createDataFrame(globs, "p string, q string").distinct()
    n = spark.createDataFrame(names, "a string, b string").withColumn("k", glob_index.joined("a", "b"))
    got = {(x.a, x.b, x.p, x.q) for x in glob_index.matching(n, "k", glob_index.compiled(g, "p", "q")).collect()}
    assert got == {(a, b, p, q) for a, b in names for p, q in set(globs) if fnmatch.fnmatchcase(a, p) and fnmatch.fnmatchcase(b, q)}


def ten_thousand(r):
    """Rules of every form; most begin with a wildcard."""
    out = []
    for i in range(10_000):
        form = r.choice(["*_{}", "tbl_{}", "*t{}_*", "tbl_{}*", "*{}?", "tbl_[0-9]{}"])
        out.append((i, "table", r.choice(["cat", "c*", "*"]), r.choice(["s1", "*", "s?"]), form.format(r.randrange(3000))))
    return out


def test_ten_thousand_rules(spark):
    r = random.Random(2)
    rules = ten_thousand(r)
    names = [("cat", f"s{r.randrange(4)}", f"tbl_{r.randrange(3000)}") for _ in range(400)]
    df = spark.createDataFrame(sorted(set(names)), "source_catalog string, source_schema string, source_table string")
    rdf = spark.createDataFrame(rules, "seq int, exclude_type string, catalog string, schema_name string, table_name string")
    got = {(x[0], x[1], x[2]): x.exclusion_rule for x in select.exclusion_hits(df, rdf).collect()}
    for name in set(names):
        first = next((x for x in rules if all(fnmatch.fnmatchcase(n, g) for n, g in zip(name, x[2:], strict=True))), None)
        assert got[name] == (first and "table:" + ".".join(first[2:])), name


def test_a_name_meets_few_rules(spark):
    """Globs are met by their longest fragment: of 10,000 rules a name is held against those that share it."""
    rules = spark.createDataFrame([(g[4],) for g in ten_thousand(random.Random(2))], "g string").distinct()
    compiled = glob_index.compiled(rules, "g")
    assert compiled.where("g_kind = 'any'").count() == 0
    most = compiled.groupBy("g_kind", "g_size", "g_key").count().agg(F.max("count")).first()[0]
    assert most < rules.count() / 2
    names = spark.range(300).select(F.concat(F.lit("tbl_"), F.col("id").cast("string")).alias("n"))
    plan = glob_index.matching(names, "n", compiled)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "RLIKE" not in plan.split("Project")[0]


def test_lists_of_globs(spark):
    lists = spark.createDataFrame([(["a*", "*b"],), (["zz"],), ([],), (None,), (["a*", "*b"],)], "g array<string>")
    names = spark.createDataFrame([(n,) for n in ("ax", "xb", "ab", "zz", "q")], "n string")
    got = sorted((tuple(r.g), r.n) for r in glob_index.list_matches(names, "n", lists, "g").collect())
    assert got == [(("a*", "*b"), "ab"), (("a*", "*b"), "ax"), (("a*", "*b"), "xb"), (("zz",), "zz")]
