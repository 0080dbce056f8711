"""Toxicity by a factorization machine over hashed terms.

A document's terms are its distinct words and the first four bytes of each, in
lower case, hashed into 2^20 buckets. The machine scores them by a weight each
and, through the inner products of learned factors, by each pair that meets in
a text. It is trained on a bounded sample of labelled rows: executors reduce
each sampled text to its set of buckets, and only these sets reach the driver.
Scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import WORD_BYTES, WORD_MASK, SpanHasher, columns_of, slices, utf8, word_bounds

BUCKETS = 1 << 20
SAMPLE_ROWS = 12_000
TERMS = 4096
FACTORS = 8
# Hashing holds several 64-bit numbers for each byte of these.
HASHED_BYTES = 1 << 19
COUNTED_SETS = 512


def term_buckets(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The text (row of the batch) and bucket of every term; a term comes as often as it stands there."""
    data, offsets = utf8(columns_of(batch, name))
    starts, ends, first = word_bounds(data, offsets, WORD_MASK)
    hashes = SpanHasher(data, WORD_BYTES)
    row = np.repeat(np.arange(batch.num_rows), np.diff(first))
    words = hashes(starts, ends)
    heads = hashes(starts, np.minimum(starts + 4, ends)) ^ np.uint64(0x5BD1E9955BD1E995)
    both = np.concatenate([words, heads]) >> np.uint64(44)
    return np.concatenate([row, row]), both.astype(np.int32)


@dataclass(frozen=True)
class Machine:
    """``place`` maps a bucket to its row in ``linear`` and ``factors``, or to -1."""

    bias: float
    place: np.ndarray
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, row: np.ndarray, at: np.ndarray, rows: int) -> np.ndarray:
        """From distinct (row, place) pairs."""
        out = np.full(rows, self.bias)
        out += np.bincount(row, self.linear[at], rows)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            out += 0.5 * (np.bincount(row, v, rows) ** 2 - np.bincount(row, v * v, rows))
        return out

    def score(self, batch: pa.RecordBatch, name: str = "text") -> np.ndarray:
        row, bucket = term_buckets(batch, name)
        at = self.place[bucket]
        known = at >= 0
        pairs = np.unique(row[known].astype(np.int64) * len(self.linear) + at[known]) if len(self.linear) else np.zeros(0, np.int64)
        width = max(1, len(self.linear))
        return 1 / (1 + np.exp(-np.clip(self.logits(pairs // width, pairs % width, batch.num_rows), -30, 30)))


def fit(sets: list[np.ndarray], labels: np.ndarray, terms: int = TERMS, factors: int = FACTORS, passes: int = 30,
        penalty: float = 2e-5, seed: int = 7) -> Machine:
    """Trains on sets of buckets. Buckets are screened first: those in at least three texts whose rate differs most,
    by the chi-square statistic, between the labels. Without both labels the score is the (smoothed) share of ones."""
    place = np.full(BUCKETS, -1, np.int32)
    ones = int(labels.sum())
    share = (ones + 0.5) / (len(labels) + 1)
    if not len(labels) or ones in (0, len(labels)):
        return Machine(float(np.log(share / (1 - share))), place, np.zeros(0), np.zeros((0, factors)))
    one, every = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for lo in range(0, len(sets), COUNTED_SETS):  # a few sets at a time: all of them as 64-bit numbers take much memory
        some = slice(lo, lo + COUNTED_SETS)
        bucket, label = np.concatenate(sets[some]), np.repeat(labels[some], [len(s) for s in sets[some]])
        one += np.bincount(bucket[label == 1], minlength=BUCKETS)
        every += np.bincount(bucket, minlength=BUCKETS)
    expected = every * ones / len(labels)
    chi = (one - expected) ** 2 / np.maximum(expected, 1e-9) / (1 - ones / len(labels))
    chi[every < 3] = 0
    chosen = np.argsort(-chi, kind="stable")[:terms]
    chosen = chosen[chi[chosen] > 10.8]  # one in a thousand by chance
    place[chosen] = np.arange(len(chosen))
    kept = [at[at >= 0] for at in (place[s] for s in sets)]
    at = np.concatenate(kept)
    rng = np.random.default_rng(seed)
    linear = np.zeros(len(chosen))
    latent = rng.normal(0, 0.02, (len(chosen), factors))
    bias = float(np.log(share / (1 - share)))
    begin = np.cumsum([0, *map(len, kept)])
    seen = [np.full(len(chosen), 1e-6), np.full(latent.shape, 1e-6), 1e-6]
    for _ in range(passes):
        order = rng.permutation(len(sets))
        for lo in range(0, len(order), 64):
            some = order[lo : lo + 64]
            counts = begin[some + 1] - begin[some]
            pos = np.repeat(begin[some] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            a, r = at[pos], np.repeat(np.arange(len(some)), counts)
            v = latent[a]
            total = np.zeros((len(some), factors))
            np.add.at(total, r, v)
            squares = np.zeros((len(some), factors))
            np.add.at(squares, r, v * v)
            logit = bias + np.bincount(r, linear[a], len(some)) + 0.5 * (total**2 - squares).sum(1)
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[some]
            g_linear = np.bincount(a, error[r], len(chosen)) / len(some) + penalty * linear
            g_latent = np.zeros_like(latent)
            np.add.at(g_latent, a, error[r][:, None] * (total[r] - v))
            g_latent = g_latent / len(some) + penalty * latent
            g_bias = error.mean()
            seen[0] += g_linear**2
            seen[1] += g_latent**2
            seen[2] += g_bias**2
            linear -= 0.2 * g_linear / np.sqrt(seen[0])
            latent -= 0.02 * g_latent / np.sqrt(seen[1])
            bias -= 0.2 * g_bias / np.sqrt(seen[2])
    return Machine(bias, place, linear, latent)


def train(labelled: DataFrame, label_col: str = "label", text_col: str = "text", key_col: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Trains on at most about ``sample_rows`` of the rows of ``labelled`` whose label is 0 or 1, chosen by a hash of
    their key. Executors send the distinct buckets of each chosen text."""
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(
        F.col(key_col).alias("key"), F.col(label_col).cast("int").alias("label"), F.col(text_col).cast("string").alias("text"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=HASHED_BYTES):
            row, bucket = term_buckets(batch)
            pairs = np.unique(row.astype(np.int64) * BUCKETS + bucket)
            cuts = np.searchsorted(pairs // BUCKETS, np.arange(batch.num_rows + 1))
            values = (pairs % BUCKETS).astype("<i4")
            sets = [values[cuts[i] : cuts[i + 1]].tobytes() for i in range(batch.num_rows)]
            yield pa.record_batch([columns_of(batch, "label"), pa.array(sets, pa.binary())], names=["label", "set"])

    got = rows.select("label", "text").mapInArrow(reduce, "label int, set binary").toArrow()
    sets = [np.frombuffer(s.as_buffer(), "<i4") for c in got.column("set").chunks for s in c]
    order = sorted(range(len(sets)), key=lambda i: (sets[i].tobytes()))
    labels = got.column("label").to_numpy()
    return fit([sets[i] for i in order], labels[order] if len(order) else np.zeros(0, int))


def sampled_labels(labels: DataFrame, label_col: str, key_col: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``sample_rows`` of the rows with a label of 0 or 1, chosen by hash (all where there are fewer)."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(key_col, F.col(label_col).alias("label"))
    share = min(1.0, sample_rows / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64(F.col(key_col), F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))


def scores(docs: DataFrame, machine: Machine, text_col: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of ``docs``, and the score (0 to 1) of the whole text in a new column ``name``.

    Null and empty texts have no terms and get the score of the bias. Rows are independent of each other, so repeated
    rows and null ids need no care; a column ``name`` that is already there is replaced.
    """
    docs = docs.drop(name)
    kept_names = docs.columns
    # A text that is a string already travels once, in its own column.
    own = (text_col, "string") in docs.dtypes
    texts, read = (docs, text_col) if own else (docs.withColumn("_text", F.col(text_col).cast("string")), "_text")

    shared = docs.sparkSession.sparkContext.broadcast(astuple(machine))  # a few MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Machine(*shared.value)
        for batch in slices(batches, read, HASHED_BYTES):
            score = here.score(batch, read)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept_names)], pa.array(score)], names=[*kept_names, name])

    schema = StructType([*docs.schema.fields]).add(name, DoubleType())
    return texts.mapInArrow(run, schema)
