"""Self-join of documents on the Jaccard similarity of their word n-grams, by set relations.

Equal sets are one class, represented once. Classes meet in an index: each enters
the lists of its rarest shingles, as many as two similar sets cannot avoid to
share. Every entry carries its position in that order, its size and a bitmap;
lists are walked block by block, and a pair of blocks is skipped where sizes and
positions exclude an answer.

Answers are derived from those of similar sets: first every list is compared
with one of its members only, and the components of these links are the answers
known so far. Long lists are then compared with further members, one after the
other, and only by sets that are still in other components; last, what is left of
pairs of different components is compared. So a group of n copies costs a few
times n comparisons, and not n * n, as long as one of these members is near
enough to most. Candidates are verified on their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SOLID_MASK, SpanHasher, columns_of, mixed, slices, small, utf8, word_bounds, written
from .graph import components

GRAM = 4
NUM, DEN = 85, 100
BITS = 512
BUCKET_BITS = 20
LIST_BLOCK = 2048
# Members that a list is compared with, as shares of its length in the order of sizes; all but the first for lists of more than LONG_LIST.
LEADS = (0.5, 0.25, 0.75, 0.125, 0.625)
LONG_LIST = 64
FAMILY_TASKS = 8
STEP = 256
PAIRS_HELD = 1 << 20
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def overlap(a, b, num: int = NUM, den: int = DEN):
    """The least intersection of sets of these sizes that makes them similar."""
    return -(-num * (a + b) // (num + den))


def shingle_sets(texts: pa.Array, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every distinct shingle, sorted; a text of fewer words than ``gram`` has its whole sequence."""
    data, offsets = utf8(texts)
    starts, ends, first = word_bounds(data, offsets, SOLID_MASK)
    words = SpanHasher(data, FOLD)(starts, ends)
    count = np.diff(first)
    doc = np.repeat(np.arange(len(texts)), count)
    rng = np.random.default_rng(97)
    weights = rng.integers(1, 2**63, (gram + 1, gram), dtype=np.uint64) | np.uint64(1)
    docs, hashes = [], []
    for k in range(1, gram + 1):
        n = len(words) - k + 1
        if n <= 0:
            continue
        at = np.flatnonzero((doc[:n] == doc[k - 1 :]) & ((count[doc[:n]] == k) if k < gram else True))
        h = np.zeros(len(at), np.uint64)
        for j in range(k):
            h += words[at + j] * weights[k, j]
        docs.append(doc[at])
        hashes.append(mixed(h + np.uint64(k)))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    d, h = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]


def set_keys(d: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of each set in the arrays, its size, and a key that depends on its members alone."""
    bounds = np.searchsorted(d, np.arange(rows + 1))
    sizes = np.diff(bounds)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mixed(h ^ np.uint64(0xA0761D6478BD642F)), out=sums[1:])
    return bounds, sizes, mixed(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64)).view(np.int64)


def bucket_counts(docs: DataFrame, gram: int = GRAM) -> np.ndarray:
    """In how many documents the shingles of each of 2^20 buckets of hashes stand, summed over its shingles, from every
    row of ``docs``. The counts only set the order of the index; links do not depend on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in slices(batches, most=2 << 20):
            _, h = shingle_sets(columns_of(batch, "text"), gram)
            np.add.at(sums, bucket_of(h), 1)
        at = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["bucket", "n"])

    got = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return counts


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def marked(docs: DataFrame, counts: np.ndarray, gram: int = GRAM, num: int = NUM, den: int = DEN) -> DataFrame:
    """Per document: ``doc_id``, ``n``, ``sig`` (the key of its set), ``bitmap`` and ``prefix`` (its rarest shingles by
    ``counts`` of buckets, those of one count by hash; as many as a similarity of ``num`` / ``den`` asks for)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # 2^20 entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in slices(batches, most=2 << 20):
            rows = batch.num_rows
            d, h = shingle_sets(columns_of(batch, "text"), gram)
            bounds, sizes, sig = set_keys(d, h, rows)
            bits = np.bincount(d * BITS + (h % np.uint64(BITS)).astype(np.int64), minlength=rows * BITS) & 1
            bitmap = np.packbits(bits.astype(np.uint8).reshape(rows, BITS), axis=1)
            by = np.lexsort((common[bucket_of(h)], d))  # stable: by hash where counts are equal
            most = np.where(sizes > 0, sizes - -(-num * sizes // den) + 1, 0)
            keep = np.arange(len(h)) - bounds[d] < most[d]
            prefix = h[by][keep].view(np.int64)
            cuts = np.concatenate([[0], np.cumsum(most)]).astype(np.int32)
            yield pa.record_batch(
                [columns_of(batch, "doc_id"), pa.array(sizes.astype(np.int64)), pa.array(sig),
                 pa.array([b.tobytes() for b in bitmap], pa.binary()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(prefix))],
                names=["doc_id", "n", "sig", "bitmap", "prefix"])

    return docs.mapInArrow(run, "doc_id long, n long, sig long, bitmap binary, prefix array<long>")


def index_lists(classes: DataFrame) -> DataFrame:
    """Entries of the lists that have more than one: ``token``, ``lead`` (the least key in the list: lists of one family of
    copies mostly share it), ``part`` (a list of over 2048 entries is cut into blocks, and there is a part for each two
    of them), ``sig``, ``id``, ``n``, ``pos``, ``bitmap``."""
    entries = classes.select("sig", F.posexplode("prefix").alias("pos", "token"))
    lengths = entries.groupBy("token").agg(F.count("*").alias("many"), F.min("sig").alias("lead")).where("many > 1")
    met = entries.join(lengths, "token").join(classes.select("sig", "id", "n", "bitmap"), "sig")
    blocks = F.ceil(F.col("many") / LIST_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sig", F.lit(3)), blocks.cast("long")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.concat_ws("-", F.least(o, own), F.greatest(o, own)))
    # The short lists of one family go to a few tasks, not to one.
    family = F.pmod(F.xxhash64("token", F.lit(4)), F.lit(FAMILY_TASKS)).cast("string")
    part = F.when(F.col("many") <= LIST_BLOCK, F.array(family)).otherwise(pairs)
    return met.select("token", "lead", F.explode(part).alias("part"), "many", "sig", "id", "n", "pos", "bitmap")


def _possible(n, pos, words, comp, i, j, num: int, den: int) -> np.ndarray:
    """Whether sizes, positions, components and bitmaps leave a link between entries ``i`` and ``j`` possible."""
    a, b = n[i], n[j]
    need = overlap(a, b, num, den)
    ok = (np.minimum(a, b) * den >= num * np.maximum(a, b)) & (np.minimum(a - pos[i], b - pos[j]) >= need) & (comp[i] != comp[j])
    k = np.flatnonzero(ok)
    if len(k):
        differ = np.bitwise_count(words[i[k]] ^ words[j[k]]).sum(axis=1)
        ok[k] = differ <= (a + b - 2 * need)[k]
    return ok


def _pairs(run: np.ndarray, n, pos, words, comp, star: float | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates among entries sorted by list (``run`` numbers the lists) and, within a list, by size."""
    left, right = [], []
    total = len(run)
    first = np.searchsorted(run, run)
    length = np.searchsorted(run, run, "right") - first
    at = np.arange(total)
    if star is not None:  # with one of each list
        lead = first + (length * star).astype(np.int64)
        i, j = at[at != lead], lead[at != lead]
        ok = _possible(n, pos, words, comp, i, j, num, den)
        return i[ok], j[ok]
    short = length <= 64
    for gap in range(1, 64):
        i = np.flatnonzero(short & (at - first + gap < length))
        if not len(i):
            break
        ok = _possible(n, pos, words, comp, i, i + gap, num, den)
        left.append(i[ok])
        right.append(i[ok] + gap)
    for lo in np.unique(first[~short]):
        hi = lo + length[lo]
        blocks = [slice(b, min(b + STEP, hi)) for b in range(lo, hi, STEP)]
        info = [(n[b].min(), n[b].max(), (n[b] - pos[b]).max(), comp[b].min(), comp[b].max()) for b in blocks]
        for x, (s_min, s_max, s_rest, c_min, c_max) in zip(blocks, info, strict=True):
            for y, (t_min, _, t_rest, d_min, d_max) in zip(blocks, info, strict=True):
                if y.start < x.start:
                    continue
                if t_min * num > s_max * den or min(s_rest, t_rest) < overlap(s_min, t_min, num, den):
                    continue  # no entry of the one can answer any of the other
                if c_min == c_max == d_min == d_max:
                    continue  # all of them have one answer already
                i, j = (g.ravel() for g in np.meshgrid(at[x], at[y], indexing="ij"))
                up = i < j
                i, j = i[up], j[up]
                ok = _possible(n, pos, words, comp, i, j, num, den)
                left.append(i[ok])
                right.append(j[ok])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left + none), np.concatenate(right + none)


def candidates(lists: DataFrame, star: float | None = None, num: int = NUM, den: int = DEN) -> DataFrame:
    """Distinct pairs of classes (``a`` below ``b``, with their ids) that share a list and may be similar. ``lists`` has
    a column ``comp``, of which no pair has the same. With ``star`` one of each pair is the member of its list at this
    share of its length."""

    def found(table: pa.Table) -> np.ndarray:
        col = {c: table.column(c).to_numpy() for c in ("run", "sig", "id", "n", "pos", "comp")}
        raw = b"".join(x.as_py() for x in table.column("bitmap"))
        words = np.frombuffer(raw, np.uint64).reshape(-1, BITS // 64)
        i, j = _pairs(col["run"], col["n"], col["pos"], words, col["comp"], star, num, den)
        flip = col["sig"][i] > col["sig"][j]
        i, j = np.where(flip, j, i), np.where(flip, i, j)
        both = [col[c][k] for c in ("sig", "id", "comp") for k in (i, j)]
        return np.unique(np.stack(both, axis=1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A list may go on in the next batch: the last one waits for it. Lists of one family follow each other, so
        # that a pair they share leaves the task once.
        held, lists_so_far, last_key = None, 0, None
        pairs: list[np.ndarray] = []

        def out(rows: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(rows[:, k]) for k in range(6)], names=["a", "b", "a_id", "b_id", "a_comp", "b_comp"])

        for batch in batches:
            keys = list(zip(columns_of(batch, "token").to_pylist(), columns_of(batch, "part").to_pylist(), strict=True))
            numbers = np.empty(len(keys), np.int64)
            for k, key in enumerate(keys):
                if key != last_key:
                    lists_so_far, last_key = lists_so_far + 1, key
                numbers[k] = lists_so_far
            table = pa.Table.from_batches([batch]).append_column("run", pa.array(numbers))
            table = pa.concat_tables([held, table]) if held is not None else table
            run_ids = table.column("run").to_numpy()
            cut = int(np.searchsorted(run_ids, run_ids[-1])) if len(run_ids) else 0
            if cut:
                pairs.append(found(table.slice(0, cut)))
            held = table.slice(cut)
            if sum(map(len, pairs)) > PAIRS_HELD:
                pairs = [np.unique(np.concatenate(pairs), axis=0)]
                if len(pairs[0]) > PAIRS_HELD // 2:
                    yield out(pairs.pop())
        if held is not None and held.num_rows:
            pairs.append(found(held))
        if pairs:
            yield out(np.unique(np.concatenate(pairs), axis=0))

    dealt = lists.repartition("lead", "part").sortWithinPartitions("lead", "part", "token", "n", "pos", "sig")
    return dealt.mapInArrow(run, "a long, b long, a_id long, b_id long, a_comp long, b_comp long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, ends: tuple[str, str], gram: int = GRAM, num: int = NUM, den: int = DEN) -> DataFrame:
    """The columns ``ends`` of the pairs whose whole sets are similar, once each; sets are made again from the texts of the
    documents that are in a pair."""
    wanted = pairs.select(F.col("a_id").alias("doc_id")).unionByName(pairs.select(F.col("b_id").alias("doc_id"))).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            d, h = shingle_sets(columns_of(batch, "text"), gram)
            bounds, _, sig = set_keys(d, h, batch.num_rows)
            raw = [h[bounds[k] : bounds[k + 1]].tobytes() for k in range(batch.num_rows)]
            yield pa.record_batch([pa.array(sig), pa.array(raw, pa.binary())], names=["sig", "set"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(columns_of(batch, "x"), columns_of(batch, "y"), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(den * both >= num * (len(p) + len(q) - both))
            yield batch.select(list(ends)).filter(pa.array(ok, pa.bool_()))

    whole = docs.join(small(wanted), "doc_id", "left_semi").mapInArrow(sets, "sig long, set binary")
    left, right = whole.select(F.col("sig").alias("a"), F.col("set").alias("x")), whole.select(F.col("sig").alias("b"), F.col("set").alias("y"))
    met = pairs.join(left, "a").join(right, "b").select(*ends, "x", "y")
    return met.mapInArrow(check, ", ".join(f"{e} long" for e in ends)).distinct()


def _labelled(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Lists with the component of each class; a class without a link is its own."""
    return lists.join(groups.select(F.col("node").alias("id"), "component"), "id", "left").withColumn(
        "comp", F.coalesce("component", "id")).drop("component")


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``node`` and ``component`` after links (``a_comp``, ``b_comp``) between components."""
    wider = components(links, "a_comp", "b_comp").select(F.col("node").alias("component"), F.col("component").alias("group"))
    # A node without a link of its own round is its own component.
    inner = groups.join(wider, "component", "left").select("node", F.coalesce("group", "component").alias("component"))
    outer = wider.join(groups, wider["component"] == groups["node"], "left_anti").select(
        F.col("component").alias("node"), F.col("group").alias("component"))
    return inner.unionByName(outer)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, num: int = NUM,
                den: int = DEN) -> DataFrame:
    """Per row: ``doc_id`` (long), ``n_shingles`` and ``component_id``, the smallest id that links lead to.

    Two documents link when ``den`` (100) times the intersection of their sets of ``gram``-word shingles is at least
    ``num`` (85) times the union. Words are what white space separates, A-Z in lower case. Null, empty and blank texts have an empty set
    and link with nothing; fewer words than ``gram`` are one shingle. Repeated rows come back as often as they stand
    there; rows of one id are one document; a row without an id keeps a null component. Ids are whole numbers. An
    empty table gives no row; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = written(marked(rows, bucket_counts(rows, gram), gram, num, den), "sets")
    real = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("sig").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), F.first("prefix").alias("prefix"))
    lists = written(index_lists(classes), "lists")
    limits = {"num": num, "den": den}
    stars = written(candidates(lists.withColumn("comp", F.col("sig")), LEADS[0], **limits), "stars")
    groups = written(components(verified(stars, rows, ("a_id", "b_id"), gram, num, den), "a_id", "b_id"), "known")
    tried = stars.select("a", "b")
    for lead in LEADS[1:]:
        more = written(candidates(_labelled(lists.where(F.col("many") > LONG_LIST), groups), lead, **limits).join(tried, ["a", "b"], "left_anti"), "more")
        if more.isEmpty():
            break
        groups = written(_joined(groups, verified(more, rows, ("a_comp", "b_comp"), gram, num, den)), "known")
        tried = tried.unionByName(more.select("a", "b"))
    rest = candidates(_labelled(lists, groups), **limits).join(tried, ["a", "b"], "left_anti")
    # What is left are links between components, each taken once, whatever the number of links behind it.
    groups = _joined(groups, verified(written(rest, "pairs"), rows, ("a_comp", "b_comp"), gram, num, den))
    # Every class has its smallest id, and a linked one the smallest of its component.
    least = real.groupBy("sig").agg(F.min("doc_id").alias("id")).join(groups, F.col("id") == F.col("node"), "left").select(
        "sig", F.coalesce("component", "id").alias("of"))
    out = sets.select("doc_id", "n", "sig").join(least, "sig", "left")
    # Rows of one id are one document: it belongs where its smallest class belongs.
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("of"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.cast("long").alias("component_id"))
