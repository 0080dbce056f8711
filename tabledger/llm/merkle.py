"""Document fingerprints: a hash tree over sections, paragraphs and pieces of paragraphs.

A piece ends where the content says so (a hash of two neighbouring words), at
every 32nd word of a paragraph, and with the paragraph; a paragraph is a line; a
section ends at a blank line or after a paragraph whose hash says so. The
fingerprint is written as ``root/section/section...``, a section as its
paragraphs joined by ``-``, a paragraph as the 8 hex digits of each piece. The
root is a hash over hashes of sections, these over hashes of paragraphs, these
over 64-bit digests (BLAKE2b) of the bytes of pieces: equal roots mean equal
texts, and the branches that differ tell where an edit lies.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SOLID_MASK, SpanHasher, columns_of, mixed, slices, utf8, word_bounds

PART_BYTES = 16 << 20
MOST_PARTS = 1 << 16
SAMPLED_KEYS = 20
SAME = np.arange(256, dtype=np.uint8)


def fingerprints(texts: pa.Array) -> list[str]:
    """One per text; null is empty."""
    data, offsets = utf8(texts)
    starts, ends, first = word_bounds(data, offsets, SOLID_MASK)
    words = SpanHasher(data, SAME)(starts, ends)  # these only say where pieces end
    lines = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=lines[1:])
    line = lines[starts]
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    n = len(words)
    new_line = np.ones(n, bool)  # the word opens a paragraph
    new_line[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(n)
    in_line = at - np.maximum.accumulate(np.where(new_line, at, 0))
    cut = np.zeros(n, bool)  # a piece ends before the word
    cut[1:] = mixed(words[1:] + words[:-1] * np.uint64(3)) % np.uint64(6) == 0
    opens = np.flatnonzero(new_line | cut | (in_line % 32 == 0)) if n else np.zeros(0, np.int64)
    begin = starts[opens] if n else np.zeros(0, np.int64)
    piece_doc = doc[opens]
    leading = np.ones(len(opens), bool)
    leading[1:] = piece_doc[1:] != piece_doc[:-1]
    begin = np.where(leading, offsets[piece_doc], begin)
    stop = np.append(begin[1:], len(data)) if len(begin) else begin
    trailing = np.append(leading[1:], True) if len(begin) else leading
    stop = np.where(trailing, offsets[piece_doc + 1], stop)
    whole = data.tobytes()
    leaves = [hashlib.blake2b(whole[a:b], digest_size=8).digest() for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
    raw = b"".join(leaves)
    digits = b"".join([x[:4] for x in leaves]).hex()
    opens_line = new_line[opens] if n else leading
    gap = np.zeros(len(opens), np.int64)
    if len(opens):
        gap[1:] = line[opens[1:]] - line[opens[:-1]]
    blank = opens_line & (gap > 1)
    bounds = np.searchsorted(piece_doc, np.arange(len(texts) + 1))
    out = []
    for d in range(len(texts)):
        lo, hi = bounds[d], bounds[d + 1]
        if lo == hi:  # no word: all of the text is one piece
            body = data[offsets[d] : offsets[d + 1]].tobytes()
            root = hashlib.blake2b(b"blank" + body, digest_size=16).hexdigest()
            out.append(root + ("/" + hashlib.blake2b(body, digest_size=4).hexdigest() if body else ""))
            continue
        heads = [lo, *(lo + 1 + np.flatnonzero(opens_line[lo + 1 : hi])), hi]
        sections, paragraphs, tree = [], [], []
        for a, b in zip(heads, heads[1:], strict=False):
            if paragraphs and blank[a]:
                sections.append(tree)
                paragraphs, tree = [], []
            node = hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest()
            paragraphs.append(node)
            tree.append((node, digits[8 * a : 8 * b]))
            if node[0] & 7 == 0:
                sections.append(tree)
                paragraphs, tree = [], []
        if tree:
            sections.append(tree)
        nodes = [hashlib.blake2b(b"".join(node for node, _ in s), digest_size=8).digest() for s in sections]
        root = hashlib.blake2b(b"".join(nodes), digest_size=16).hexdigest()
        out.append("/".join([root, *("-".join(p for _, p in s) for s in sections)]))
    return out


def pieces_of(fingerprint: str) -> list[str]:
    body = fingerprint[33:].replace("/", "").replace("-", "")
    return [body[i : i + 8] for i in range(0, len(body), 8)]


def likeness(a: str, b: str) -> float:
    """From 0 to 1: 1 for equal roots, else the share of pieces that both have (Dice, counting repeats)."""
    if a[:32] == b[:32]:
        return 1.0
    x, y = Counter(pieces_of(a)), Counter(pieces_of(b))
    total = x.total() + y.total()
    return 2.0 * (x & y).total() / total if total else 0.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``b`` that no equal branch of ``a`` covers: sections first, then paragraphs of the rest."""
    if a[:32] == b[:32]:
        return []
    old = Counter(a.split("/")[1:])
    rest, found = [], []
    for i, s in enumerate(b.split("/")[1:]):
        if old[s] > 0:
            old[s] -= 1
        else:
            rest.append((i, s))
    left = Counter(p for s, k in old.items() for p in s.split("-") * k)
    for i, s in rest:
        for j, p in enumerate(s.split("-")):
            if left[p] > 0:
                left[p] -= 1
            else:
                found.append((i, j))
    return found


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """All rows and columns, and the fingerprint of the whole text; one pass, no shuffle. A null text is empty."""
    from pyspark.sql.types import StringType, StructType

    docs = docs.drop(name)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fingerprints(columns_of(batch, "_text")), pa.string())], names=[*names, name])

    schema = StructType([*docs.schema.fields]).add(name, StringType())
    return docs.withColumn("_text", F.col(text_col).cast("string")).mapInArrow(run, schema)


def _parts(rows: DataFrame, part_bytes: int) -> list[tuple]:
    """Bounds between parts of about ``part_bytes`` in the order of (id, hash of the text), found on a sample of keys
    (about 20 a part, at most 1.3 million, with their bytes). The sample decides sizes of parts, never results."""
    seen = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("b"), F.count("*").alias("n")).first()
    parts = int(min(MOST_PARTS, (seen["b"] or 0) // part_bytes + 1))
    if parts == 1:
        return []
    share = min(1.0, SAMPLED_KEYS * parts / seen["n"])
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = drawn.select("doc_id", "tie", F.octet_length("text").alias("b")).collect()
    keys = sorted((_key(r["doc_id"], r["tie"]), r["b"]) for r in drawn)
    at = np.cumsum([b for _, b in keys])
    cuts = np.searchsorted(at, [at[-1] * k / parts for k in range(1, parts)]) if keys else []
    return [keys[k][0] for k in sorted({int(c) for c in cuts})]


def _key(doc_id, tie: int) -> tuple:
    return (doc_id is not None, 0 if doc_id is None else doc_id, tie)


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Every document with the text that follows it in descending order of ids (ties by a hash of the text, null ids
    last), arranged so that a single pass over each partition meets both.

    Returns ``part``, ``halo``, ``doc_id``, ``text`` partitioned and sorted by part; each part ends with a halo row,
    a copy of the first document of the next part (of the first part, after the last). One shuffle of the texts, in
    which a part is a partition. Ids are of any type whose values have an order (numbers, texts, times); unlike texts
    of one id, or without an id, may stand in several parts.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    bounds = _parts(rows, part_bytes)

    @F.arrow_udf("int")
    def part_of(ids: pa.Array, ties: pa.Array) -> pa.Array:
        keys = map(_key, ids.to_pylist(), ties.to_pylist())
        return pa.array([len(bounds) - bisect_right(bounds, k) for k in keys], pa.int32())

    placed = rows.withColumn("part", part_of("doc_id", "tie") if bounds else F.lit(0))
    heads = placed.groupBy("part").agg(F.max(F.struct("doc_id", "tie")).alias("head")).orderBy("part")
    first = [(r["part"], r["head"]["doc_id"], r["head"]["tie"]) for r in heads.collect()]
    before = [(p, i, t, first[k - 1][0]) for k, (p, i, t) in enumerate(first)]
    schema = rows.select(F.lit(0).alias("h_part"), F.col("doc_id").alias("h_id"), F.col("tie").alias("h_tie"),
                         F.lit(0).alias("to")).schema
    halos = F.broadcast(docs.sparkSession.createDataFrame(before, schema))  # one row per part, at most MOST_PARTS
    at_head = (F.col("part") == F.col("h_part")) & F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("tie") == F.col("h_tie"))
    spots = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("halo")))
    more = F.array(F.struct(F.col("to").alias("part"), F.lit(True).alias("halo")))
    sent = placed.join(halos, at_head, "left").withColumn(
        "spot", F.explode(F.when(F.col("to").isNull(), spots).otherwise(F.concat(spots, more)))
    ).select("spot.part", "spot.halo", "doc_id", "tie", "text")
    dealt = sent.repartitionById(len(bounds) + 1, F.col("part"))
    return dealt.sortWithinPartitions("part", "halo", F.desc_nulls_last("doc_id"), F.desc("tie")).drop("tie")


def chained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 3, part_bytes: int = PART_BYTES) -> DataFrame:
    """Compares each document with its edited text and with the next document.

    The edited text has its last floor(n_chars / ``share``) code points replaced by the first as many (or all) of the
    next document's. Returns ``doc_id``, ``n_chars``, ``edited`` (text), ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``, ``edits`` (how many paragraphs of the edited text differ).

    A null text is empty; a lone document is its own next one; repeated rows follow each other; an empty table gives
    no row; other columns are not read.
    """
    ordered = neighbours(docs, id_col, text_col, part_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row before, of which the next one is still to come
        for batch in slices(batches):
            part, halo, ids = (columns_of(batch, c).to_pylist() for c in ("part", "halo", "doc_id"))
            texts = columns_of(batch, "text").to_pylist()
            prints = fingerprints(columns_of(batch, "text"))
            done, edited = [], []
            for p, h, i, t, f in zip(part, halo, ids, texts, prints, strict=True):
                if last is not None and last[0] == p and not last[1]:
                    n = len(last[3])
                    edited.append(last[3][: n - n // share] + t[: n // share])
                    done.append((last[2], n, last[4], f))
                last = (p, h, i, t, f)
            if not done:
                continue
            later = fingerprints(pa.array(edited, pa.large_string()))
            own = [d[2] for d in done]
            yield pa.record_batch(
                [pa.array([d[0] for d in done], batch.schema.field("doc_id").type), pa.array([d[1] for d in done], pa.int64()),
                 pa.array(edited, pa.string()), pa.array(own), pa.array(later),
                 pa.array([likeness(a, b) for a, b in zip(own, later, strict=True)]),
                 pa.array([likeness(a, d[3]) for a, d in zip(own, done, strict=True)]),
                 pa.array([len(edits(a, b)) for a, b in zip(own, later, strict=True)], pa.int64())],
                names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edits"],
            )

    key = ordered.schema["doc_id"].dataType.simpleString()
    return ordered.mapInArrow(
        run, f"doc_id {key}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double,"
        " near_next double, edits long",
    )
