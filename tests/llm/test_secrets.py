import random
import re
import string

from pyspark.sql import functions as F

from tabledger.llm import secrets

from .helpers import ODD, prose, table

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, e, k in sorted(out)]


R = random.Random(9)
TOKENS = ["".join(R.choices(string.ascii_letters + string.digits, k=40)) for _ in range(60)]
TEXTS = [
    "secret=token:abcdefgh", "secret=abc token='abcdefg' API_KEY : x.y/z=1", "paſſword=abcdef toKen=abcdefgh", "𝒳é password = \"hunter22\" " + "a1" * 15,
    "AKIAAKIA" + "Z" * 15 + " AKIA" + "Q" * 16 + " AKIAQQ", "password=" + "deadbeef" * 4, "token:=abcdefgh", "passwordpassword=123456",
]


def test_base_spans_against_regular_expressions(spark):
    texts = TEXTS + ODD + [prose(1, 30) + " secret: " + t for t in TOKENS[:5]]
    out = {r.doc_id: r for r in secrets.scan(table(spark, texts)).collect()}
    for i, t in enumerate(texts):
        found = [tuple(s) for s in out[i].spans if s.kind != "markov"]
        assert found == base(t or ""), t
        assert [s.start for s in out[i].spans] == sorted(s.start for s in out[i].spans)
    assert secrets.scan(table(spark, texts).limit(0)).count() == 0


def test_random_runs_are_added_and_words_are_not(spark):
    plain = [" ".join("".join(R.choices(["tion", "er", "ing", "the", "con", "pro"], k=7)) for _ in range(30)) for _ in range(60)]
    labelled = [p + " token=" + t for p, t in zip(plain, TOKENS)]
    fresh = "".join(R.choices(string.ascii_letters + string.digits, k=40))
    texts = labelled + ["key " + fresh + " end", plain[0] + "".join(["tion", "ing"] * 6)]
    out = {r.doc_id: r for r in secrets.scan(table(spark, texts)).collect()}
    assert [tuple(s) for s in out[60].spans] == [("markov", 4, 44)]
    assert out[61].spans == []


def test_redaction(spark):
    texts = ["x password=hunter22 y " + "ab12" * 8 + " z", "nothing", "password=" + "deadbeef" * 4, "", "é token=abcdef"]
    docs = table(spark, texts).withColumnRenamed("spans", "other")
    found = secrets.with_spans(docs, docs, "text").select("doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("t"))
    got = [r.t for r in found.orderBy("doc_id").collect()]
    assert got == ["x [SECRET] y [SECRET] z", "nothing", "[SECRET]", "", "é [SECRET]"]


def test_labelled_secrets_outside_the_sample_train_the_model(spark):
    plain = [" ".join("".join(R.choices(["tion", "er", "ing", "the", "con", "pro"], k=7)) for _ in range(30)) for _ in range(400)]
    fresh = "".join(R.choices(string.ascii_letters + string.digits, k=40))
    sampled = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(20 / 401 * (1 << 20))
    labelled = table(spark, [p + " token=" + t for p, t in zip(plain, TOKENS[:12])]).where(~sampled)
    docs = labelled.unionByName(table(spark, [(100 + k, p) for k, p in enumerate(plain[12:])] + [(1000, "key " + fresh + " end")]))
    assert labelled.count() > 5 and docs.where(sampled).count() > 5
    out = {r.doc_id: r for r in secrets.scan(docs, sample_docs=20).collect()}
    assert [tuple(s) for s in out[1000].spans] == [("markov", 4, 44)]
    assert sum(len(out[k].spans) for k in out if 100 <= k < 1000) == 0
