"""Hard negatives for anchors, from exact integer scores by the Four-Russians method.

A component is a whole number, and a candidate is stored as bit planes: plane p
holds bit p of all its components, eight dimensions to a byte, the top plane
being the sign. For a block of anchors and every group of eight dimensions a
table holds the sum of each of the 256 subsets of the anchors' components. A
byte of a plane is an index into that table; a score is the tables' entries
added over the groups and shifted over the planes, without a multiplication,
and exact.

Anchors are a stated set of queries, held against all rows in blocks: rows and
anchors are dealt by hash into blocks of bounded size, and one group is one
block of each, so no label, however frequent, is one group. The first round
scores rows of the anchor's label and keeps each anchor's best as positives; the
second scores rows of other labels and keeps the best inside each positive's
band. Every block answers with a few rows per anchor before anything is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, written

SCALE = 256
ROWS_HELD, ANCHORS_HELD, ANCHORS_AT_ONCE = 1024, 2048, 128


def _clean(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    whole = lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")
    found = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    found = found.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(F.forall("v", finite))
    one = found.select("id", F.struct("label", F.transform("v", whole).alias("v")).alias("r")).groupBy("id").agg(F.min("r").alias("r"))
    return one.select("id", "r.label", "r.v")


def planes_of(v: np.ndarray, bits: int) -> np.ndarray:
    """Bytes by row, plane and group of eight dimensions; the last plane is the sign of two's complement."""
    wide = np.zeros((len(v), -(-v.shape[1] // 8) * 8), np.int64)
    wide[:, : v.shape[1]] = v
    return np.stack([np.packbits(((wide >> p) & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(bits)], axis=1)


def whole_of(planes: np.ndarray) -> np.ndarray:
    """The components that :func:`planes_of` packed."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    last = planes.shape[1] - 1
    return sum(bits[:, p] << p for p in range(last)) - (bits[:, last] << last)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """By group of eight dimensions, subset and anchor: the sum of the anchor's components in that subset."""
    groups = anchors.reshape(len(anchors), -1, 8).transpose(1, 2, 0).astype(kind)
    out = np.zeros((len(groups), 256, len(anchors)), kind)
    for d in range(8):
        out[:, 1 << d : 2 << d] = out[:, : 1 << d] + groups[:, d : d + 1]
    return out


def scores(planes: np.ndarray, anchors: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """Inner products by anchor and candidate: table entries, added over groups and shifted over planes."""
    tables = subset_sums(anchors, kind)
    index = planes.transpose(1, 2, 0).astype(np.intp)
    total = np.zeros((len(planes), len(anchors)), kind)
    held = np.empty_like(total)
    for p in range(len(index) - 1, -1, -1):
        total += total
        for g in range(len(tables)):
            np.take(tables[g], index[p, g], axis=0, out=held, mode="clip")
            if p == len(index) - 1:
                total -= held
            else:
                total += held
    return np.ascontiguousarray(total.T)


def _best(score: np.ndarray, most: int, none: int):
    """(anchor, candidate) of the best scores of each row of ``score``, which is used up; of equal ones the first."""
    line = np.arange(len(score))
    for _ in range(most):
        j = score.argmax(axis=1)
        ok = score[line, j] != none
        if not ok.any():
            return
        yield line[ok], j[ok]
        score[line, j] = none


class Blocks:
    """Scores of one block of rows against one block of anchors, as tables of results."""

    def __init__(self, bits: int, groups: int, kind: type, positives: int, negatives: int, low: int, high: int):
        self.bits, self.groups, self.kind = bits, groups, kind
        self.positives, self.negatives, self.low, self.high = positives, negatives, low, high
        self.none = np.iinfo(kind).min

    def _planes(self, packed: pa.ChunkedArray) -> np.ndarray:
        raw = b"".join(x.as_buffer().to_pybytes() for x in packed)
        return np.frombuffer(raw, np.uint8).reshape(-1, self.bits, self.groups)

    def _each(self, rows: pa.Table, anchors: pa.Table):
        """Rows in the order of their ids, so that of equal scores the smallest id comes first; some anchors at a time."""
        rows = rows.sort_by("id")
        planes, whole = self._planes(rows["planes"]), whole_of(self._planes(anchors["planes"]))
        for lo in range(0, len(whole), ANCHORS_AT_ONCE):
            part = slice(lo, lo + ANCHORS_AT_ONCE)
            yield rows, part, scores(planes, whole[part], self.kind)

    def same(self, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [np.zeros((3, 0), np.int64)]
        ids = anchors["id"].to_numpy()
        for table, part, score in self._each(rows, anchors):
            own = table["id"].to_numpy()
            score[ids[part][:, None] == own[None, :]] = self.none
            values = score.copy()
            for i, j in _best(score, self.positives, self.none):
                out.append(np.stack([ids[part][i], own[j], values[i, j].astype(np.int64)]))
        return pa.table(dict(zip(("anchor_id", "id", "score"), np.concatenate(out, axis=1), strict=True)))

    def other(self, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [np.zeros((5, 0), np.int64)]
        ids, labels = anchors["id"].to_numpy(), anchors["label"].to_numpy()
        found = anchors["found"].to_pylist()
        for table, part, score in self._each(rows, anchors):
            own = table["id"].to_numpy()
            score[labels[part][:, None] == table["label"].to_numpy()[None, :]] = self.none
            for k in range(self.positives):
                has = np.array([len(f) > k for f in found[part]])
                at = np.flatnonzero(has)
                if not len(at):
                    continue
                p_id = np.array([found[part][a][k]["id"] for a in at])
                p = np.array([found[part][a][k]["score"] for a in at])
                least, most = -((-self.low * p) // 100), self.high * p // 100
                inside = score[at]
                inside = np.where((inside >= least[:, None]) & (inside <= most[:, None]), inside, self.none)
                for i, j in _best(inside, self.negatives, self.none):
                    out.append(np.stack([ids[part][at[i]], p_id[i], p[i], own[j], score[at[i], j].astype(np.int64)]))
        return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"),
                                 np.concatenate(out, axis=1), strict=True)))


def _block(seed: int, parts: Column) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(seed)), parts)


def _meet(rows: DataFrame, anchors: DataFrame, keys: list[str], blocks, schema: str) -> DataFrame:
    """``blocks`` of every block of rows and block of anchors with equal ``keys``; both have ``row_parts`` and ``anchor_parts``."""
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # Both sides may come from one table: new names for the columns of the second.
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    left = rows.withColumn("r", _block(1, F.col("row_parts"))).withColumn("a", each("anchor_parts")).drop("row_parts", "anchor_parts")
    right = anchors.withColumn("a", _block(2, F.col("anchor_parts"))).withColumn("r", each("row_parts")).drop("row_parts", "anchor_parts")
    return left.groupBy(*keys, "r", "a").cogroup(right.groupBy(*keys, "r", "a")).applyInArrow(
        lambda x, y: blocks(x, y) if x.num_rows and y.num_rows else blocks(x.slice(0, 0), y.slice(0, 0)), schema)


def _parts(n: Column | str, held: int) -> Column:
    return F.ceil(n / F.lit(held)).cast("long")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = SCALE,
) -> DataFrame:
    """Per anchor, positive and rank: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``, ``positive_rank``.

    A score is the inner product of ``floor(scale * x)`` of the components. An anchor's positives are its first
    ``positives`` other rows of its label; a positive's negatives are the first ``negatives`` rows of other labels with
    ``low / 100 * positive_score <= negative_score <= high / 100 * positive_score``. Higher scores come first, of equal
    ones smaller ids. ``is_anchor`` is a condition on the column ``id``.

    Rows without an id, label or vector, or with a component that is null, NaN or infinite, take no part. Of the rows
    of one id the smallest (by label, then components) counts, so repeated rows count once. A shorter vector goes on
    in zeros; an empty one scores 0. Ids and labels are whole numbers. Scores are 64-bit numbers; sums beyond wrap
    around. Fewer rows than asked for give what there is, an anchor without a positive gives no row, an empty table
    none; other columns are not read.
    """
    clean = written(_clean(rows, id_col, vector_col, label_col, scale), "vectors")
    about = clean.agg(
        F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.coalesce(F.max(F.array_max("v")), F.lit(0)).alias("top"),
        F.coalesce(F.min(F.array_min("v")), F.lit(0)).alias("bottom")).first()
    dims = max(1, about["dims"] or 0)
    bits = max(about["top"].bit_length(), (~about["bottom"]).bit_length() if about["bottom"] < 0 else 0) + 1
    largest = max(about["top"], -about["bottom"])
    kind = np.int32 if dims * largest * largest < 1 << 31 else np.int64
    run = Blocks(bits, -(-dims // 8), kind, positives, negatives, low, high)

    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                piece = batch.slice(lo, 2048)
                v = piece.column("v")
                size = np.diff(v.offsets.to_numpy())
                wide = np.zeros((piece.num_rows, dims), np.int64)
                wide[np.arange(dims)[None, :] < size[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
                packed = [x.tobytes() for x in planes_of(wide, bits)]
                yield pa.record_batch([piece.column("id"), piece.column("label"), pa.array(packed, pa.binary())], names=["id", "label", "planes"])

    packed = written(clean.mapInArrow(pack, "id long, label long, planes binary"), "planes")
    asked = packed.where(is_anchor)
    labels = packed.groupBy("label").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("m")).where("m > 0").select(
        "label", _parts(F.col("n"), ROWS_HELD).alias("row_parts"), _parts(F.col("m"), ANCHORS_HELD).alias("anchor_parts"))
    labels = small(labels)
    near = _meet(packed.join(labels, "label"), asked.join(labels, "label"), ["label"], run.same, "anchor_id long, id long, score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    found = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    ready = written(asked.join(found.withColumnRenamed("anchor_id", "id"), "id"), "anchors")
    parts = [F.lit(max(1, -(-n // held))).cast("long").alias(c) for n, held, c in (
        (about["n"], ROWS_HELD, "row_parts"), (ready.count(), ANCHORS_HELD, "anchor_parts"))]
    far = _meet(packed.select("*", *parts), ready.select("*", *parts), [], run.other,
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
