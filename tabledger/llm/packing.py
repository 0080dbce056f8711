"""Packing by concatenating and cutting.

All documents stand, in their order of storage, in one stream of tokens. A first
pass counts the tokens of each partition; a prefix sum over these totals gives
every partition, and so every document, its global offset. A second pass cuts
the stream at multiples of the window. No token moves between tasks: the only
shuffle is one number per partition.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, small, written

WINDOW = 2048
END = 1
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Ids that the tokenizers library gives without special tokens around them. A byte-level BPE whose ids follow its
    merges runs on tiktoken's engine, which gives the same ids several times faster; texts that hold the literal of an
    added token, and any other file, run on the tokenizers library itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.size = max([*model["vocab"].values(), *(x["id"] for x in added)]) + 1
        self.path, self.fast, self._slow = path, None, None
        self.literals = [x["content"] for x in added]
        if (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                and not pre.get("add_prefix_space") and not spec.get("normalizer")):
            ranks = self._ranks(model, set(self.literals))
            if ranks:
                import public_tokenizers
                import tiktoken

                self.fast = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def slow(self):
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
        return self._slow

    @staticmethod
    def _ranks(model: dict, special: set[str]) -> dict[bytes, int] | None:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        to_byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        ranks = {bytes(to_byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        return ranks if ids == sorted(ids) and len(ranks) == len(ids) + 256 else None

    def __call__(self, text: str) -> list[int]:
        if self.fast is not None and not any(x in text for x in self.literals):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of each text, its number of tokens, and where it stands in its partition's stream.

    A null text is empty. ``ids`` holds 16-bit numbers where the vocabulary allows it, else 32-bit ones.
    """
    kind = "<u2" if encoder(tokenizer).size <= 1 << 16 and end_id < 1 << 16 else "<u4"
    schema = pa.schema([("ids", pa.binary()), ("n", pa.int64()), ("part", pa.int64()), ("part_start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                ids, counts = [], []
                for text in columns_of(piece, "text").to_pylist():
                    got = encode(text or "")
                    got.append(end_id)
                    ids.append(np.array(got, kind).tobytes())
                    counts.append(len(got))
                n = np.array(counts, np.int64)
                start = at + np.concatenate([[0], np.cumsum(n)])
                at = int(start[-1])
                yield pa.record_batch(
                    [columns_of(piece, "doc_id"), pa.array(ids, pa.binary()), n, np.full(len(n), part), start[:-1]],
                    names=["doc_id", *schema.names],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {key}, ids binary, n long, part long, part_start long")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens; only the very last sequence can be shorter.

    Returns one row per piece: ``doc_id``, ``start`` (the document's tokens before it), ``length``, ``ids``
    (little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset`` (in its sequence), and the
    boundary records ``opens`` and ``closes`` (whether the document begins, or ends, in this piece).

    Each document ends with ``end_id``, so an empty or null text is one token. Repeated rows are packed as
    often as they stand there, a null id stays null, an empty table gives no piece, other columns are not read.
    """
    kind = "<u2" if encoder(tokenizer).size <= 1 << 16 and end_id < 1 << 16 else "<u4"
    tokens = written(tokenized(docs, tokenizer, end_id, id_col, text_col), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = tokens.join(small(bases), "part").select("doc_id", "ids", "n", (F.col("base") + F.col("part_start")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                n, at = (columns_of(batch, c).to_numpy() for c in ("n", "at"))
                first, last = at // window, (at + n - 1) // window
                count = last - first + 1
                row = np.repeat(np.arange(len(n)), count)
                sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = np.maximum(sequence * window, at[row])
                stop = np.minimum((sequence + 1) * window, at[row] + n[row])
                start = begin - at[row]
                ids = columns_of(batch, "ids")
                wide = [np.frombuffer(ids[r].as_buffer(), kind) for r in range(len(n))]
                cuts = [wide[r][s : s + k].astype("<u4").tobytes() for r, s, k in zip(row, start, stop - begin, strict=True)]
                yield pa.record_batch(
                    [columns_of(batch, "doc_id").take(pa.array(row)), start, stop - begin, pa.array(cuts, pa.binary()), n[row],
                     sequence, begin - sequence * window, start == 0, stop == at[row] + n[row]],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "opens", "closes"],
                )

    key = tokens.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(
        cut, f"doc_id {key}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long,"
        " opens boolean, closes boolean",
    )
