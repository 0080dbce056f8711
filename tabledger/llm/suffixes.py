"""Removal of text that also stands in an earlier document, by sorted suffixes.

Suffixes are taken in stretches. Of the 35 grams of 16 bytes in a window of 50
bytes the one with the smallest hash (the leftmost of equal ones) is the
window's anchor; consecutive windows of one anchor are a stretch. Equal windows
have equal anchors, so a stretch can only matter where the gram at its anchor
stands in another document as well: a first pass keeps those.

Sampled splitters then range-partition the stretches by the leading bytes at
their anchors. Each bucket sorts its suffixes (windows) by multikey quicksort,
eight bytes at a time, and gives every suffix the earliest document among its
equals. Leading bytes that are too common for one bucket go on in the next: their
suffixes are compared across the boundaries as well.

Texts travel in compressed slices of about 256 KB. Equal stretches of one
slice are sent once, for the earliest document, so that a group of copies sends
one stretch per slice and not one per copy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, slices, utf8, written

WIDTH, GRAM = 50, 16
SLICE_BYTES = 256 << 10
PART_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
SAMPLE_SLICES = 64
WINDOWS_AT_ONCE = 1 << 18
LAST = np.iinfo(np.int64).max
COLUMNS = (0, 8, 16, 24, 32, 40, 42)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def eights(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes at every place of ``data``, as numbers (a view)."""
    return np.ndarray((max(0, len(data) - 7),), kind, data.data if len(data) else b"", strides=(1,))


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor, hash of the gram there) of every stretch; windows are named by their first byte and stay inside one text."""
    n = len(data)
    if n < WIDTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    eight = eights(data)
    grams = _mixed(eight[: n - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15) + _mixed(eight[8:]))
    low = np.uint64(0xFFFFFFFF)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= WIDTH - GRAM + 1:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = WIDTH - GRAM + 1 - span
    least = np.minimum(least[: len(least) - rest], least[rest:])
    anchor = (least & low).astype(np.int64)
    window = np.arange(len(anchor))
    inside = window + WIDTH <= np.repeat(offsets[1:], np.diff(offsets))[: len(anchor)]
    joined = inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~joined
    ends[:-1] &= ~joined
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(ends), anchor[first], grams[anchor[first]]


def taken(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
    """The given spans of ``data`` as a column of bytes."""
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    picked = data[np.arange(at[-1]) + np.repeat(begin - at[:-1], size)] if at[-1] else np.zeros(0, np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(picked))])


def earliest(spans: pa.Array, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each span, equal for equal bytes only, and the smallest document that has these bytes."""
    code = spans.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    least = np.full(int(code.max()) + 1 if len(code) else 0, LAST, np.int64)
    np.minimum.at(least, code, doc)
    return code, least[code]


def multikey_sort(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the 50-byte strings of ``data`` at ``at``, and for each place in it the number of its class of equals.

    Classes are sorted and split by eight bytes after eight bytes; a string alone in its class is done.
    """
    eight = eights(data, ">u8")
    order, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    for column in COLUMNS:
        if not len(open_):
            break
        key = eight[at[order[open_]] + column].astype(np.uint64)
        by = np.lexsort((key, group[open_]))
        key, own = key[by], group[open_]  # classes keep their places, so their numbers stay sorted
        order[open_] = order[open_[by]]
        new = np.zeros(len(open_), bool)
        new[1:] = (key[1:] != key[:-1]) & (own[1:] == own[:-1])
        heads = np.zeros(len(at), bool)
        heads[1:] = group[1:] != group[:-1]
        heads[open_[new]] = True
        group = np.cumsum(heads)
        open_ = open_[(np.bincount(group) > 1)[group[open_]]]
    return order, group


def _sliced(rows: DataFrame) -> DataFrame:
    """``slice``, and of its texts ``ids``, ``sizes`` and ``data`` (their bytes end to end, compressed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        room = SLICE_BYTES

        def one() -> pa.RecordBatch:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            data, offsets = utf8(columns_of(batch, "text"))
            packed = pa.Codec("zstd", compression_level=3).compress(data.tobytes(), asbytes=True)
            many = pa.array([0, batch.num_rows], pa.int32())
            return pa.record_batch(
                [pa.array([number]), pa.ListArray.from_arrays(many, columns_of(batch, "doc_id")),
                 pa.ListArray.from_arrays(many, pa.array(np.diff(offsets))), pa.array([packed], pa.binary()), pa.array([len(data)])],
                names=["slice", "ids", "sizes", "data", "n_bytes"])

        for batch in slices(batches, most=SLICE_BYTES):
            held.append(batch)
            room -= columns_of(batch, "text").nbytes + batch.num_rows
            if room <= 0:
                yield one()
                number, held, room = number + 1, [], SLICE_BYTES
        if sum(b.num_rows for b in held):
            yield one()

    return rows.mapInArrow(run, "slice long, ids array<long>, sizes array<long>, data binary, n_bytes long")


def _opened(batch: pa.RecordBatch, r: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Bytes, offsets and ids of the texts of row ``r``."""
    sizes = columns_of(batch, "sizes")[r].values.to_numpy()
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    raw = pa.decompress(columns_of(batch, "data")[r].as_py(), int(offsets[-1]), codec="zstd") if offsets[-1] else b""
    return np.frombuffer(raw, np.uint8), offsets, columns_of(batch, "ids")[r].values


# Of the hash of a gram 40 bits are sent, and the part it falls into. Unequal grams of one code only mean some stretches more to compare.
_CODE = np.uint64((1 << 40) - 1)


def _codes(gram: np.ndarray, parts: int) -> np.ndarray:
    """The code of each: the part (equal ranges of the upper half of the hash) above 40 bits of the hash."""
    part = ((gram >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return (part << np.uint64(40)) | (gram & _CODE)


def _packed(code: np.ndarray) -> bytes:
    return np.ascontiguousarray(code.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpacked(raw, part: int) -> np.ndarray:
    five = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    wide = np.zeros((len(five), 8), np.uint8)
    wide[:, :5] = five
    return wide.view("<u8").ravel() | np.uint64(part << 40)


def _shared(sliced: DataFrame, parts: int) -> DataFrame:
    """``slice``, ``part`` and ``grams``: codes of its anchors that another slice has too, as a list of bytes."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offsets, _ = _opened(batch, r)
                code = np.unique(_codes(stretches(data, offsets)[3], parts))
                part = (code >> np.uint64(40)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                lists = [_packed(x) for x in np.split(code, cuts[1:])] if len(code) else []
                yield pa.record_batch([pa.array(part[cuts]), pa.array(np.full(len(cuts), batch.column(0)[r].as_py(), np.int64)),
                                       pa.array(lists, pa.binary())], names=["part", "slice", "grams"])

    def again(table: pa.Table) -> pa.Table:
        lists = [_unpacked(x.as_buffer(), 0) for x in table["grams"]]
        value = np.sort(np.concatenate(lists))
        value = np.unique(value[1:][value[1:] == value[:-1]])
        kept = [_packed(x[_among(x, value)]) for x in lists]
        return pa.table({"slice": table["slice"], "part": table["part"], "grams": pa.array(kept, pa.binary())})

    found = sliced.select("slice", "ids", "sizes", "data").mapInArrow(hashes, "part long, slice long, grams binary")
    return found.groupBy("part").applyInArrow(again, "slice long, part long, grams binary").where(F.octet_length("grams") > 0)


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _pairs(first: np.ndarray, last: np.ndarray) -> bytes:
    """Big-endian, as :func:`_across` writes them in SQL."""
    return np.stack([first, last], axis=1).astype(">i8").tobytes()


def _stretches_of(batch: pa.RecordBatch, r: int, parts: int):
    """Of row ``r``: its bytes, and (first and last window, anchor, document) of the stretches whose gram another document has."""
    data, offsets, ids = _opened(batch, r)
    first, last, anchor, gram = stretches(data, offsets)
    lists = [_unpacked(x["grams"], x["part"]) for x in columns_of(batch, "grams")[r].as_py() or []]
    keep = _among(_codes(gram, parts), np.sort(np.concatenate(lists or [np.zeros(0, np.uint64)])))
    own = ids.fill_null(LAST).to_numpy()[np.searchsorted(offsets, first, "right") - 1]
    order = np.lexsort((own, gram))
    g, d = gram[order], own[order]
    run_of = np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]).astype(np.int64)])) if len(g) else np.zeros(0, np.int64)
    mixed = np.zeros(int(run_of[-1]) + 1 if len(g) else 0, bool)
    mixed[run_of[1:][(g[1:] == g[:-1]) & (d[1:] != d[:-1])]] = True
    keep[order] |= mixed[run_of]
    return data, first[keep], last[keep], anchor[keep], own[keep]


def _leads(data: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """The eight bytes at each anchor as a number; numbers are in the order of the bytes."""
    return (eights(data, ">u8")[anchor].astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def _splitters(asked: DataFrame, n: int, parts: int) -> np.ndarray:
    """Leads that cut the stretches into buckets of about ``BUCKET_BYTES``, from a sample of about ``SAMPLE_SLICES`` of ``n`` slices.
    A lead that would fill several buckets is there several times. The sample sets the sizes of buckets, never results."""
    picked = asked.where(F.pmod(F.xxhash64("slice"), F.lit(max(1, n // SAMPLE_SLICES))) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, first, last, anchor, _ = _stretches_of(batch, r, parts)
                yield pa.record_batch([pa.array([int((last - first).sum()) + len(first) * (WIDTH + 16)]), pa.array([_leads(data, anchor).tobytes()], pa.binary())],
                                      names=["volume", "leads"])

    got = picked.mapInArrow(run, "volume long, leads binary").collect()
    leads = np.sort(np.concatenate([np.frombuffer(r.leads, np.int64) for r in got] or [np.zeros(0, np.int64)]))
    volume = sum(r.volume for r in got) * n // max(1, len(got))
    buckets = max(1, -(-volume // BUCKET_BYTES))
    return leads[(np.arange(1, buckets) * len(leads)) // buckets] if len(leads) else leads


def _entries(asked: DataFrame, parts: int, splitters: np.ndarray) -> DataFrame:
    """Per slice and bucket the stretches to compare: ``doc``, ``at`` (first window), ``size`` and bytes end to end, compressed
    together as ``packed``; and, as ``marks``, pairs of windows that an earlier document of the slice itself has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            for r in range(batch.num_rows):
                number = columns_of(batch, "slice")[r].as_py()
                data, first, last, anchor, own = _stretches_of(batch, r, parts)
                spans = taken(data, first, last - first + WIDTH)
                _, least = earliest(spans, own)
                late = own > least
                marks = _pairs(first[late], last[late])
                first, last, anchor, own = first[~late], last[~late], anchor[~late], own[~late]
                lead = _leads(data, anchor)
                low, high = np.searchsorted(splitters, lead, "left"), np.searchsorted(splitters, lead, "right")
                # A lead on several splitters fills buckets: its stretches are spread over all between them.
                spread = (_mixed(first.astype(np.uint64) + np.uint64(number)) >> np.uint64(8)).astype(np.int64) % (high - low + 1)
                bucket = np.where(high - low > 1, low + spread, high)
                order = np.lexsort((lead, bucket))
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                names, packed, sizes = [], [], []
                for part in np.split(order, cuts[1:]) if len(order) else []:
                    size = last[part] - first[part] + WIDTH
                    raw = np.stack([own[part], first[part], size, lead[part]]).astype("<i8").T.tobytes() + taken(data, first[part], size).buffers()[2].to_pybytes()
                    names.append(int(bucket[part[0]]))
                    packed.append(codec.compress(raw, asbytes=True))
                    sizes.append([len(part), len(raw)])
                if marks:
                    names, packed, sizes = [*names, number % (len(splitters) + 1)], [*packed, marks], [*sizes, [0, len(marks)]]
                yield pa.record_batch([pa.array(names, pa.int64()), pa.array([number] * len(names), pa.int64()),
                                       *(pa.array([x[k] for x in sizes], pa.int64()) for k in (0, 1)), pa.array(packed, pa.binary())],
                                      names=["bucket", "slice", "n", "n_raw", "packed"])

    return asked.mapInArrow(run, "bucket long, slice long, n long, n_raw long, packed binary")


def _compared(entries: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``slice``, ``marks`` (pairs of windows that an earlier document has), and for suffixes of leads that reach over the boundary of
    a bucket, in place of marks, ``window``, ``doc`` and ``at``."""
    wide = np.unique(splitters[1:][splitters[1:] == splitters[:-1]])

    def bucket(table: pa.Table) -> pa.Table:
        heads, texts, numbers, own_marks = [], [], [], []
        for number, n, size, packed in zip(*(table[c].to_pylist() for c in ("slice", "n", "n_raw", "packed")), strict=True):
            if not n:
                own_marks.append((number, packed))
                continue
            raw = np.frombuffer(pa.decompress(packed, size, codec="zstd"), np.uint8)
            heads.append(raw[: 32 * n].view("<i8").reshape(n, 4))
            texts.append(raw[32 * n :])
            numbers.append(np.full(n, number))
        found = [_FOUND.empty_table(), pa.table({"slice": pa.array([k for k, _ in own_marks], pa.int64()), "marks": pa.array([m for _, m in own_marks], pa.binary())})]
        if heads:
            (doc, at, size, lead), data, number = np.concatenate(heads).T.copy(), np.concatenate(texts), np.concatenate(numbers)
            found += _bucket(number, doc, at, size, lead, data, wide)
        return pa.concat_tables(found, promote_options="default").select(_FOUND.names).cast(_FOUND)

    return entries.groupBy("bucket").applyInArrow(bucket, "slice long, marks binary, window binary, doc long, at long")


_FOUND = pa.schema([("slice", pa.int64()), ("marks", pa.binary()), ("window", pa.binary()), ("doc", pa.int64()), ("at", pa.int64())])


def _bucket(number, doc, at, size, lead, data, wide) -> list[pa.Table]:
    """Marks of a bucket, and the suffixes without a mark of leads that other buckets have too (``wide``). Stretches have a
    slice, a document, a first window, a size in bytes, a lead, and their bytes end to end."""
    cuts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    windows = size - WIDTH + 1
    _, least = earliest(spans, doc)
    late = doc > least
    marked = [(number[late], at[late], at[late] + windows[late] - 1)]
    # Leads that hold more than one document are worth sorting, and those that go on in other buckets.
    _, group = np.unique(lead, return_inverse=True)
    low, high = np.full(group.max() + 1, LAST), np.full(group.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, group[~late], doc[~late])
    np.maximum.at(high, group[~late], doc[~late])
    end = np.isin(lead, wide)
    chosen = np.flatnonzero(~late & ((low < high)[group] | end))
    chosen = chosen[np.argsort(group[chosen], kind="stable")]
    before = np.cumsum(windows[chosen]) - windows[chosen]
    # Whole leads, some at a time, so that the arrays of a sort stay small.
    opens = np.flatnonzero(np.diff(group[chosen], prepend=-1))
    cuts_at = opens[np.diff(before[opens] // WINDOWS_AT_ONCE, prepend=0) > 0] if len(opens) else opens
    edges = []
    for part in np.split(chosen, cuts_at):
        step = np.arange(int(windows[part].sum())) - np.repeat(np.cumsum(windows[part]) - windows[part], windows[part])
        which = np.repeat(part, windows[part])
        order, equal = multikey_sort(data, cuts[which] + step)
        which, step = which[order], step[order]
        first_doc = np.full(int(equal[-1]) + 1 if len(equal) else 0, LAST)
        np.minimum.at(first_doc, equal, doc[which])
        later = doc[which] > first_doc[equal]
        marked.append((number[which[later]],) + (at[which[later]] + step[later],) * 2)
        edge = ~later & end[which]
        edges.append((which[edge], step[edge]))
    slice_, first, last = (np.concatenate(x) for x in zip(*marked, strict=True))
    by = np.argsort(slice_, kind="stable")
    names, starts = np.unique(slice_[by], return_index=True)
    lists = [_pairs(first[g], last[g]) for g in np.split(by, starts[1:])] if len(by) else []
    which, step = (np.concatenate(x) for x in zip(*edges, strict=True))
    texts = taken(data, cuts[which] + step, np.full(len(which), WIDTH)).cast(pa.binary())
    return [pa.table({"slice": names, "marks": pa.array(lists, pa.binary())}),
            pa.table({"slice": number[which], "window": texts, "doc": doc[which], "at": at[which] + step})]


def _across(compared: DataFrame) -> DataFrame:
    """Marks of suffixes near a boundary that another bucket has from an earlier document."""
    edges = compared.where("window IS NOT NULL")
    first = edges.groupBy("window").agg(F.min("doc").alias("least"))
    late = edges.join(first, "window").where("doc > least")
    place = F.concat(*[F.to_binary(F.lpad(F.hex("at"), 16, "0"), F.lit("hex"))] * 2)
    return late.select("slice", place.alias("marks"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """Per row: ``doc_id`` (long), ``n_bytes``, ``spans`` (start and end, exclusive, of the removed bytes; runs that touch are
    one), ``kept_sha256`` of the bytes that stay and, with ``with_kept``, these bytes as ``kept`` (binary: a cut may split a
    character).

    A byte goes if it is covered by a string of 50 bytes that also starts in a document of a smaller id; strings are
    judged on the texts as given, and what repeats only within a document stays. Null and empty texts, and those under
    50 bytes, lose nothing. Rows of one id are one document and are not held against each other; rows without an id
    come after all others and not against each other. Ids are whole numbers below 2^63 - 1. Repeated rows come back as
    often as they stand there, an empty table gives no row, other columns are not read. A text of any length is one
    slice, of a size that follows the text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sliced = written(_sliced(rows), "slices")
    about = sliced.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("total")).first()
    parts = max(1, -(-about["total"] // PART_BYTES))
    shared = written(_shared(sliced, parts), "shared").groupBy("slice").agg(F.collect_list(F.struct("part", "grams")).alias("grams"))
    asked = sliced.join(shared, "slice", "left").select("slice", "ids", "sizes", "data", "grams")
    splitters = _splitters(asked, about["n"], parts)
    compared = written(_compared(_entries(asked, parts, splitters), splitters), "compared")
    marks = compared.where("marks IS NOT NULL").select("slice", "marks").unionByName(_across(compared))
    marks = marks.where(F.octet_length("marks") > 0).groupBy("slice").agg(F.collect_list("marks").alias("marks"))
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offsets, ids = _opened(batch, r)
                pairs = np.concatenate([np.frombuffer(x, ">i8") for x in columns_of(batch, "marks")[r].as_py() or []] or [np.zeros(0, np.int64)])
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, pairs[::2], 1)
                np.add.at(depth, pairs[1::2] + WIDTH, -1)
                gone = np.cumsum(depth[:-1]) > 0
                edge = np.diff(gone.astype(np.int8), prepend=np.int8(0))
                starts = (edge == 1) | (gone & _is_first(offsets, len(data)))
                begin = np.flatnonzero(starts)
                doc = np.searchsorted(offsets, begin, "right") - 1
                stay = np.concatenate([[0], np.cumsum(~gone)])
                ends = np.minimum(offsets[doc + 1], _next_kept(gone)[begin] if len(begin) else begin)
                cuts = np.searchsorted(doc, np.arange(len(ids) + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                    [pa.array(begin - offsets[doc]), pa.array(ends - offsets[doc])], fields=list(kind)))
                kept = memoryview(np.ascontiguousarray(data[~gone]))
                texts = [kept[a:b] for a, b in zip(stay[offsets[:-1]], stay[offsets[1:]], strict=True)]
                out = [ids, pa.array(np.diff(offsets)), listed, pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())]
                names = ["doc_id", "n_bytes", "spans", "kept_sha256"]
                if with_kept:
                    out, names = [*out, pa.array([bytes(x) for x in texts], pa.binary())], [*names, "kept"]
                yield pa.record_batch(out, names=names)

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string" + (", kept binary" if with_kept else "")
    return sliced.join(marks, "slice", "left").select("slice", "ids", "sizes", "data", "marks").mapInArrow(finish, schema)


def _is_first(offsets: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[offsets[:-1][offsets[:-1] < n]] = True
    return out


def _next_kept(gone: np.ndarray) -> np.ndarray:
    """For each place the first place from there on that is not ``gone``."""
    where = np.where(gone, len(gone), np.arange(len(gone)))
    return np.minimum.accumulate(where[::-1])[::-1]
