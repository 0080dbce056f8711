"""What the operators share: reading tables, cutting lineage, words of whole batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLICE_BYTES = 2 << 20
BROADCAST_ROWS = 1 << 20
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset and Spark is local."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="tabledger-llm-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once, kept as a table in the shared folder, and read from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast where a count proves that it has at most ``rows`` narrow rows; else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on the session sends rows to Python in batches of about ``most`` bytes, unless its limit is smaller yet.
    Spark's own limit is 64 MB, which a task holds several times over on both sides; the rows are the same."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.match(r"(\d+)([kmgtp]?)", spark.conf.get(key).strip().lower()).groups()
    if int(number) << 10 * " kmgtp".index(unit or " ") > most:
        spark.conf.set(key, str(most))


def folded(text) -> "F.Column":
    """A-Z in lower case and nothing else; a text of ASCII alone takes the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def columns_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins and ends in them; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``most`` bytes of text, so that arrays made from one stay small."""
    for batch in batches:
        _, offsets = utf8(columns_of(batch, name))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def alphabet(pattern_bytes: np.ndarray) -> np.ndarray:
    """A table that maps each byte to itself in lower case where it is part of a word, else to 0."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    return np.where(pattern_bytes, fold, 0).astype(np.uint8)


_b = np.arange(256)
WORD_BYTES = alphabet((_b >= 128) | ((_b >= 48) & (_b <= 57)) | ((_b >= 65) & (_b <= 90)) | ((_b >= 97) & (_b <= 122)))
SOLID_BYTES = alphabet(~np.isin(_b, [32, 9, 10, 11, 12, 13]))
# NUL is a word of its own in SOLID_BYTES; 0 there would mean "not part of a word".
SOLID_MASK = ~np.isin(_b, [32, 9, 10, 11, 12, 13])
WORD_MASK = WORD_BYTES > 0


def word_bounds(data: np.ndarray, offsets: np.ndarray, mask_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of all words, and for each text the index of its first word (one more at the end)."""
    mask = mask_of[data]
    before = np.empty_like(mask)
    before[1:] = mask[:-1]
    after = np.empty_like(mask)
    after[:-1] = mask[1:]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    if len(data):
        before[0] = False
        before[edge] = False
        after[-1] = False
        last = offsets[1:][offsets[1:] > 0] - 1
        after[last] = False
    starts = np.flatnonzero(mask & ~before)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_rng = np.random.default_rng(20240607)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class SpanHasher:
    """64-bit hashes of byte spans of a buffer: equal bytes, equal hash, wherever they stand."""

    def __init__(self, data: np.ndarray, fold: np.ndarray):
        n = len(data)
        codes = BYTE_CODES[fold[data]] * powers(BASE, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes, out=self.sums[1:])
        self.inverse = powers(INVERSE, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the information of each value over all its bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
