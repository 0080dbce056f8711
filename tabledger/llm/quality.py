"""Quality by hierarchical empirical Bayes: what a text shows, and where it stands.

A text gives evidence: binned features, each with a log-likelihood ratio learned
from labelled rows by grouped counts, calibrated on their sum. A site gives a
prior: the mean quality of a path is shrunk towards that of its host, this
towards the global one, with strengths estimated from how much hosts (and paths
within hosts) differ beyond chance. A document's own share is taken out of the
sums of its site before they are used for it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SOLID_MASK, SpanHasher, columns_of, slices, utf8, word_bounds, written
from .jaccard import FOLD

FEATURES = ("upper", "symbol", "digit", "repeat", "distinct", "word_length", "line_length", "words")
BINS = 16
SUM_BINS = 24
_b = np.arange(256)
UPPER = (_b >= 65) & (_b <= 90)
DIGIT = (_b >= 48) & (_b <= 57)
SYMBOL = np.isin(_b, [ord(c) for c in "!#$%&*|<>{}[]=~^_@\\+/"])


def features(texts: pa.Array) -> np.ndarray:
    """A bin (0 to 15) for each text and feature. An empty text is in the lowest bins."""
    data, offsets = utf8(texts)
    starts, ends, first = word_bounds(data, offsets, SOLID_MASK)
    size = np.maximum(1, np.diff(offsets))
    count = np.diff(first)
    words = np.maximum(1, count)
    doc = np.repeat(np.arange(len(texts)), count)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask[data], out=sums[1:])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    h = SpanHasher(data, FOLD)(starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((h, doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(texts))
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=lines[1:])
    n_lines = lines[offsets[1:]] - lines[offsets[:-1]] + 1
    log = lambda x, top: np.log1p(x) / math.log1p(top)
    small_share = lambda x: np.sqrt(np.clip(x, 0, 1))
    raw = (
        small_share(share(UPPER)), small_share(share(SYMBOL)), small_share(share(DIGIT)),
        small_share(np.bincount(doc[again], minlength=len(texts)) / words),
        distinct / words * log(words, 30_000) + (1 - log(words, 30_000)) * (count > 0),
        np.bincount(doc, (ends - starts).astype(float), len(texts)) / words / 24,
        log(size / n_lines, 20_000), log(count, 30_000),
    )
    return np.stack([np.clip(x * BINS, 0, BINS - 1).astype(np.int8) for x in raw], axis=1)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep`` and ``bins`` (one small number per feature); one pass, no shuffle."""
    from pyspark.sql.types import ArrayType, ByteType, StructType

    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).cast("string").alias("text"))
    schema = StructType([f for f in rows.schema.fields if f.name != "text"]).add("bins", ArrayType(ByteType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bins = features(columns_of(batch, "text"))
            ends = np.arange(len(bins) + 1, dtype=np.int32) * len(FEATURES)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[*batch.schema.names[:-1], "bins"])

    return rows.mapInArrow(run, schema)


def evidence_model(described_rows: DataFrame, labels: DataFrame, label_col: str = "label") -> tuple[list[float], list[float], float]:
    """Log-likelihood ratios (good over bad) per feature and bin; the calibrated evidence per bin of their sum; the share
    of good rows. Learned by grouped counts over all labelled rows; without both labels all evidence is 0."""
    known = described_rows.join(labels.where(F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).alias("label")), "doc_id")
    counts = known.select("label", F.posexplode("bins").alias("f", "b")).groupBy("label", "f", "b").agg(F.count("*").alias("n")).collect()
    n = np.zeros((2, len(FEATURES), BINS))
    for r in counts:
        n[r["label"], r["f"], r["b"]] = r["n"]
    bad, good = n[0, 0].sum(), n[1, 0].sum()
    flat = [0.0] * (len(FEATURES) * BINS)
    if not bad or not good:
        return flat, [0.0] * SUM_BINS, float((good + 1) / (good + bad + 2))
    rate = (n + 0.5) / (n.sum(axis=2, keepdims=True) + 0.5 * BINS)
    flat = np.log(rate[1] / rate[0]).ravel().tolist()
    sums = known.select("label", sum_bin(flat).alias("s")).groupBy("label", "s").agg(F.count("*").alias("n")).collect()
    m = np.full((2, SUM_BINS), 0.25)
    for r in sums:
        m[r["label"], r["s"]] += r["n"]
    weight = m.sum(axis=0)
    llr = np.log((m[1] / m[1].sum()) / (m[0] / m[0].sum()))
    # More of the sum never means less: pool neighbours that disagree.
    blocks: list[list[float]] = []
    for value, w in zip(llr, weight, strict=True):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v, x, k = blocks.pop()
            u, y, j = blocks.pop()
            blocks.append([(u * y + v * x) / (x + y), x + y, j + k])
    return flat, [float(v) for v, _, k in blocks for _ in range(int(k))], float(good / (good + bad))


def raw_sum(flat: list[float]):
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in flat)), ",").cast("array<double>")
    return F.aggregate(F.transform("bins", lambda b, i: F.element_at(table, i * BINS + b.cast("int") + 1)), F.lit(0.0), lambda a, x: a + x)


def sum_bin(flat: list[float]):
    return F.least(F.greatest(F.floor(raw_sum(flat)) + SUM_BINS // 2, F.lit(0)), F.lit(SUM_BINS - 1)).cast("int")


def strength(groups: DataFrame, n: str, mean: str, toward: str, least: float = 2.0, most: float = 1000.0) -> float:
    """How many observations the prior of a level is worth, by moments: the variance between groups beyond chance."""
    p, q = F.col(mean), F.col(toward)
    row = groups.where(F.col(n) >= 2).agg(
        F.sum(F.col(n) * (p - q) ** 2).alias("between"), F.sum(q * (1 - q)).alias("chance"), F.sum(q * (1 - q) * F.col(n)).alias("all")).first()
    if not row["all"]:
        return most
    spread = max(1e-9, (row["between"] - row["chance"]) / row["all"])  # 1 / (strength + 1)
    return float(min(most, max(least, 1 / spread - 1)))


def posteriors(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "host",
               path_col: str = "path", label_col: str = "label") -> DataFrame:
    """Per row ``doc_id``, ``host``, ``path``, ``evidence`` (log-odds of the text alone), ``host_mean``, ``path_mean`` (shrunk
    means without the document itself) and ``score``, the posterior probability that the document is good.

    Null or empty texts have the evidence of the lowest bins; documents without a host or path share one of their own;
    a site with one document has its parent's mean. Repeated rows come back as often as they stand there. Sums per host
    and path are added up before they are shuffled, so a site may hold any share of the rows.
    """
    site = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), site(host_col)("host"), site(path_col)("path"))
    return posteriors_of(described(rows, keep=("host", "path")), labels, label_col)


def posteriors_of(described_rows: DataFrame, labels: DataFrame, label_col: str = "label") -> DataFrame:
    """As :func:`posteriors`, from rows of ``doc_id``, ``host``, ``path`` and ``bins``; so sites can be joined to documents
    after these have shed their texts."""
    site = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    found = written(described_rows.select("doc_id", site("host"), site("path"), "bins"), "features")
    flat, calibrated, base = evidence_model(found, labels, label_col)
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in calibrated)), ",").cast("array<double>")
    judged = found.select("doc_id", "host", "path", F.element_at(table, sum_bin(flat) + 1).alias("evidence"))
    prior = math.log(base / (1 - base))
    judged = judged.withColumn("p", 1 / (1 + F.exp(-(F.col("evidence") + prior))))
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n_path"), F.sum("p").alias("s_path"))
    hosts = paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"))
    sites = written(paths.join(hosts, "host"), "sites")
    every = sites.select("host", "n_host", "s_host").distinct()
    mean = float(judged.agg(F.avg("p").alias("m")).first()["m"] or base)
    k_host = strength(every.select("n_host", (F.col("s_host") / F.col("n_host")).alias("m"), F.lit(mean).alias("t")), "n_host", "m", "t")
    shrunk_host = (F.col("s_host") + k_host * mean) / (F.col("n_host") + k_host)
    k_path = strength(sites.select("n_path", (F.col("s_path") / F.col("n_path")).alias("m"), shrunk_host.alias("t")), "n_path", "m", "t")
    host_mean = (F.col("s_host") - F.col("p") + k_host * mean) / (F.col("n_host") - 1 + k_host)
    path_mean = (F.col("s_path") - F.col("p") + k_path * F.col("host_mean")) / (F.col("n_path") - 1 + k_path)
    out = judged.join(sites, ["host", "path"]).withColumn("host_mean", host_mean).withColumn("path_mean", path_mean)
    odds = F.col("evidence") + F.ln(F.col("path_mean") / (1 - F.col("path_mean")))
    return out.select("doc_id", "host", "path", "evidence", "host_mean", "path_mean", (1 / (1 + F.exp(-odds))).alias("score"))
