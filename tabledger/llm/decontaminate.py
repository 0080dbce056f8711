"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Every 4-gram of words has a hash. Over each 7 consecutive 4-grams (10 words) the
smallest hash is kept, so two texts that share 10 words keep a common hash. The
kept hashes of documents meet those of benchmark windows, and every hit is
extended along the windows around it, word by word. Documents are read once;
their texts are not shuffled as long as the benchmark's windows, which do not
grow with the corpus, are few enough to be broadcast (checked by a count).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, folded, small, written

WINDOW = 10
GRAM = 4
REACH = WINDOW - GRAM
LONGEST = 1 << 30


def words_of(text: Column) -> Column:
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(folded(text), F.lit(WORD), F.lit(0)))


def _over(array: str, by: int, f: Callable[[Column, Column], Column], other: str | None = None) -> Column:
    """f(array[i], other[i + by]) for all i; the last ``by`` values lack a partner and are cut off by the caller."""
    return F.zip_with(F.col(array), F.slice(other or array, by + 1, LONGEST), f)


def _cut(array: str, window: int) -> Column:
    return F.slice(array, F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(0)))


def grams(df: DataFrame, length: int, cut: bool = True) -> DataFrame:
    """Adds ``grams``: the hash of each run of ``length`` words, built by doubling."""
    df = df.withColumn("g1", F.transform("words", lambda w: F.xxhash64(w)))
    have = 1
    while have < length:
        step = max(b for b in (1, 2, 4, 8) if b <= have and b <= length - have)
        df = df.withColumn(f"g{have + step}", _over(f"g{have}", have, lambda a, b: F.xxhash64(a, b), f"g{step}"))
        have += step
    return df.withColumn("grams", _cut(f"g{length}", length) if cut else F.col(f"g{length}"))


def kept(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``kept``: for each window of words, the smallest hash among its 4-grams."""
    df = grams(df, GRAM, cut=False)
    width, have, at = window - GRAM + 1, 1, "grams"
    while have < width:
        step = min(have, width - have)
        df = df.withColumn(f"m{have + step}", _over(at, step, lambda a, b: F.least(a, b)))
        have, at = have + step, f"m{have + step}"
    return df.withColumn("kept", _cut(at, window))


def _spread(df: DataFrame, at: str, length: int, keep: tuple[str, ...], outer: bool = False, changes: bool = False) -> DataFrame:
    """One row per position of the array ``at``: ``keep``, ``i``, ``hash``, and ``length`` words from there on (``near``).
    What is exploded holds these words only, so a long text costs rows times ``length`` and not rows times its length.
    ``changes``: only where the hash changes, and at every seventh window, so that long repeats stay within reach."""
    every = F.transform(at, lambda _, i: i)
    if changes:
        every = F.filter(every, lambda i: (i % (REACH + 1) == 0) | (F.get(at, i) != F.get(at, i - 1)))
    cut = F.transform(every, lambda i: F.struct(
        i.alias("i"), F.get(at, i).alias("hash"), F.slice("words", i + 1, length).alias("near")))
    # Always the outer form: of the other, Spark derives filters that repeat the whole expression.
    out = df.select(*keep, cut.alias("cut")).select(*keep, F.explode_outer("cut").alias("at")).select(*keep, "at.i", "at.hash", "at.near")
    return out if outer else out.where("i IS NOT NULL")


def _windows(items: DataFrame, length: int) -> DataFrame:
    """One row per window of ``length`` words: its hash, its text, and the sorted ids of the items that hold it."""
    hashed = kept(items) if length == WINDOW else grams(items, length).withColumnRenamed("grams", "kept")
    return (
        _spread(hashed, "kept", length, ("item_id",)).select("item_id", "hash", F.array_join("near", " ").alias("window"))
        .groupBy("hash", "window").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )


def _hits(df: DataFrame, index: DataFrame, length: int, names: tuple[str, ...], own: bool) -> DataFrame:
    """Hits as rows of ``names``, ``span`` (start, length) and ``item_ids``: the windows among the words ``near`` a kept hash
    (the first is word ``i``) that equal one of the benchmark's, word by word. Rows first meet the kept hashes alone, so
    a hash of many windows does not widen them. ``own``: each document gives one row with ``own`` 1, hit or not."""
    def first(at: str) -> Column:
        return F.coalesce(F.col(at) == 0, F.lit(True)) if own else F.lit(False)

    met = df.join(index.select("hash").distinct().withColumn("met", F.lit(True)), "hash", "left").where(F.col("met") | first("i"))
    steps = F.sequence(F.lit(0), F.greatest(F.size("near") - length, F.lit(0)))
    tries = F.when(F.col("met"), F.transform(steps, lambda s: F.struct(
        (F.col("i") + s).alias("start"), F.array_join(F.slice("near", s + 1, length), " ").alias("window"))))
    tried = met.select(*names, F.explode_outer(tries).alias("at")).select(*names, "at.start", "at.window")
    hit = F.col("item_ids").isNotNull()
    return tried.join(index.select("window", "item_ids"), "window", "left").where(hit | first("start")).select(
        *names, first("start").cast("long").alias("own"), F.when(hit, F.struct("start", F.lit(length).alias("length"))).alias("span"), "item_ids")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """What each document shares with benchmark items.

    Returns per document ``doc_id``, ``text_hash``, ``n_words``, ``spans`` (sorted distinct (start, length) in words of
    occurrences of a window of 10 item words, or of a whole item of fewer) and ``item_ids`` (sorted distinct).

    A null or wordless text has no words and no spans; items without words match nothing; an empty benchmark leaves
    all documents clean. Repeated rows come back as often as they stand there; null ids are kept. No other column is
    read.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col).cast("string")).alias("words"))
    items = items.where(F.size("words") > 0)
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW))).distinct().collect())
    text = F.col(text_col).cast("string")
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("words")
    )
    n_words = F.size("words").cast("long").alias("n_words")
    names = ("doc_id", "text_hash", "n_words")
    if WINDOW in lengths:
        index = small(_windows(items.where(F.size("words") >= WINDOW), WINDOW))
        wide = _spread(kept(base).withColumn("n_words", n_words), "kept", WINDOW + REACH, names, outer=True, changes=True)
        rows = _hits(wide, index, WINDOW, names, own=True)
    else:
        none = F.lit(None).cast("array<%s>" % items.schema["item_id"].dataType.simpleString())
        rows = base.select("doc_id", "text_hash", n_words, F.lit(1).cast("long").alias("own"),
                           F.lit(None).cast("struct<start:int,length:int>").alias("span"), none.alias("item_ids"))
    for length in (x for x in lengths if x < WINDOW):
        index = small(_windows(items.where(F.size("words") == length), length))
        narrow = _spread(grams(base, length).withColumn("n_words", n_words), "grams", length, names)
        rows = rows.unionByName(_hits(narrow, index, length, names, own=False))
    merged = rows.groupBy(*names).agg(
        F.sum("own").alias("copies"),
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
    )
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies")


def n_hit(spans: Column) -> Column:
    """How many words lie inside any of the spans."""
    inside = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    return F.size(F.array_distinct(inside)).cast("long")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that share no window with the benchmark."""
    found = overlaps(docs, benchmark, id_col, text_col).where(F.size("spans") > 0)
    marked = small(written(found.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "leaks"))
    same = docs[id_col].eqNullSafe(F.col("_bad_id")) & (F.xxhash64(docs[text_col].cast("string")) == F.col("_bad_hash"))
    return docs.join(marked, same, "left_anti")
