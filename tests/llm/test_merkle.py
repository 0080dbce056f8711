from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tabledger.llm import merkle

from .helpers import ODD, prose, table


def test_equal_texts_and_edits():
    a = "\n".join(prose(i, 30) for i in range(12))
    b = a.replace(a.split("\n")[7], "another line of words")
    f, g, h = merkle.fingerprints(pa.array([a, b, a]))
    assert f == h and merkle.likeness(f, h) == 1.0 and merkle.edits(f, h) == []
    assert 0.7 < merkle.likeness(f, g) < 1.0 and 1 <= len(merkle.edits(f, g)) <= 2
    assert merkle.likeness(f, merkle.fingerprints(pa.array([prose(99, 200)]))[0]) < 0.1


def test_different_texts_have_different_roots():
    texts = ["", " ", "  ", "a", "a ", " a", "a\nb", "a\n\nb", "a b", "ab", "A", "é", "e"] + [prose(i, 50) for i in range(50)]
    assert len({f[:32] for f in merkle.fingerprints(pa.array(texts))}) == len(texts)


def test_structured_texts_do_not_collide():
    a = "a"
    while len(a) < 1 << 14:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    f, g = merkle.fingerprints(pa.array([a, b]))
    assert f[:32] != g[:32] and merkle.likeness(f, g) == 0.0


def test_ids_of_any_type_and_hot_ids_are_split(spark):
    texts = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, prose(i, 60)) for i in range(400)]
    for kind in ("string", "bigint", "decimal(20,2)"):
        docs = table(spark, texts, 5).withColumn("doc_id", F.col("doc_id").cast(kind))
        out = merkle.chained(docs, part_bytes=8_000).collect()
        ordered = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda x: x[0] is not None and (1, x[0]) or (0,), reverse=True)
        assert Counter((r.doc_id, r.n_chars) for r in out) == Counter((i, len(t)) for i, t in ordered)
        parts = merkle.neighbours(docs, part_bytes=8_000).where("NOT halo")
        sizes = [r["n"] for r in parts.groupBy("part").agg(F.sum(F.octet_length("text")).alias("n")).collect()]
        assert len(sizes) > 8 and max(sizes) < 24_000
        tasks = parts.groupBy(F.spark_partition_id().alias("t")).agg(F.count_distinct("part").alias("n")).collect()
        assert all(r["n"] == 1 for r in tasks)


def test_chained_against_plain_python(spark):
    texts = [(i, prose(i, 40 + i)) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, texts_7 := prose(7, 47)), (7, texts_7)]
    docs = table(spark, texts, 5)
    for size in (merkle.PART_BYTES, 20_000):
        out = merkle.chained(docs, part_bytes=size).collect()
        ordered = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0)))
        want = Counter()
        for (i, t), (_, n) in zip(ordered, ordered[1:] + ordered[:1]):
            t, n = t or "", n or ""
            want[i, len(t), t[: len(t) - len(t) // 3] + n[: len(t) // 3]] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited) for r in out) == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    one = merkle.chained(table(spark, ["lone"])).collect()
    assert (one[0].edited, one[0].near_next) == ("lonl", 1.0)
    assert merkle.chained(docs.limit(0)).count() == 0
    assert merkle.with_fingerprint(docs).columns == [*docs.columns, "fingerprint"]
