"""Small document tables, and the plain ways to get the results that operators are held against."""

import os
import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"
has_tables = os.path.isdir(SF)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, kept int"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lowered(text))


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" + ("." if r.random() < 0.1 else "") + ("\n" if r.random() < 0.05 else "") for _ in range(n))


def table(spark, texts, partitions=3):
    """Documents with extra columns whose names operators use themselves; ``texts`` holds texts or (id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", "s", len(t or ""), "extra", 1) for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


ODD = [None, "", " \n ", "one", "É Ñandú ÀB 𝒳 straße", "x" * 200_000, "word " * 30_000, "tie tie tie", "tie tie tie"]
