"""Periodic runs of words, by seeds on diagonals.

A run is a stretch of consecutive words with smallest period q that is at least
max(6, 4q) words long and that no neighbour extends. Words q apart agree on its
first length - q places, so a run of period q in 2^j .. 2^(j+1)-1 guarantees
that a k-gram of k = 3 * 2^j words (5 words for q = 1) meets its copy q places
on. k is at least q, hence inside the run that copy is the next one in the
document: pairs of neighbouring occurrences are all the pairs that are needed,
n at most for each of the log n levels.

Each pair is a seed at a place and a lag. A table of the furthest covered place
per document and lag passes over seeds inside a stretch that is known; the
others are extended in both directions on the words themselves.

The index names k-grams exactly: the name of a 2k-gram is the rank of the pair
of names of its halves, and a gram whose half occurs once in its document takes
no further part, so little is left after the first levels.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SOLID_MASK, columns_of, slices, utf8, word_bounds

LEAST_WORDS, LEAST_POWERS = 6, 4
NONE = -1


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of a column: a number that is equal for equal words only, their bytes end to end, where each begins in
    them (one more at the end), and the first word of each text (one more at the end)."""
    data, offsets = utf8(texts)
    starts, ends, first = word_bounds(data, offsets, SOLID_MASK)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    solid = np.ascontiguousarray(data[SOLID_MASK[data]]) if len(data) else data
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(solid)])
    return whole.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), solid, at, first


def _paired(places: np.ndarray, left: np.ndarray, right: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``places`` whose pair of names occurs more than once, and the name of the pair at every place (else -1).
    Equal pairs get equal names; names of a place are -1 where it has none."""
    name = np.full(total, NONE, np.int64)
    have = (left >= 0) & (right >= 0)
    places, key = places[have], (left[have] << 32) | right[have]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.cumsum(new) - 1
    again = np.bincount(rank)[rank] > 1 if len(rank) else np.zeros(0, bool)
    kept = order[again]
    name[places[kept]] = rank[again]
    return np.sort(places[kept]), name


def _shifted(name: np.ndarray, places: np.ndarray, by: int) -> np.ndarray:
    to = places + by
    inside = to < len(name)
    out = np.full(len(places), NONE, np.int64)
    out[inside] = name[to[inside]]
    return out


def _neighbours(places: np.ndarray, name: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram occurs again ``low`` to ``high`` words on, with no occurrence in between, and that distance."""
    order = np.argsort(name[places], kind="stable")
    a = places[order]
    same = name[a[1:]] == name[a[:-1]]
    i, lag = a[:-1][same], (a[1:] - a[:-1])[same]
    ok = (lag >= low) & (lag <= high)
    return i[ok], lag[ok]


def seeds(word: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, lags) of every level, over words of many documents laid end to end (``doc`` numbers them)."""
    total = len(word)
    every = np.arange(total)
    places, one = _paired(every, doc, word, total)  # a word of another document has another name
    places, two = _paired(places, one[places], _shifted(one, places, 1), total)
    places, four = _paired(places, two[places], _shifted(two, places, 2), total)
    five_at, five = _paired(places, four[places], _shifted(one, places, 4), total)
    yield 5, *_neighbours(five_at, five, 1, 1)
    places, name = _paired(places, four[places], _shifted(two, places, 4), total)
    k, low = 6, 2
    while len(places):
        yield k, *_neighbours(places, name, low, 2 * low - 1)
        places, name = _paired(places, name[places], _shifted(name, places, k), total)
        k, low = 2 * k, 2 * low


def _extended(word: np.ndarray, lag: int, start: int, end: int, low: int, high: int) -> tuple[int, int]:
    """The widest stretch of places x around start .. end - 1, in low .. high - 1, with the words at x and x + lag equal."""
    step = 64
    while start > low:
        back = min(step, start - low)
        same = word[start - back : start] == word[start - back + lag : start + lag]
        if same.all():
            start -= back
            step *= 2
        else:
            start -= int(np.argmin(same[::-1]))
            break
    step = 64
    while end + lag < high:
        on = min(step, high - lag - end)
        same = word[end : end + on] == word[end + lag : end + lag + on]
        if same.all():
            end += on
            step *= 2
        else:
            end += int(np.argmin(same))
            break
    return start, end


def runs_of(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of every run, by document, start and period; starts count from the document's own first word."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found = []
    for k, places, lags in seeds(word, doc):
        if not len(places):
            continue
        order = np.lexsort((places, lags, doc[places]))
        p, q, d = places[order], lags[order], doc[places[order]]
        # Seeds of one document and lag that touch: the later ones lie in what the first ones cover.
        opens = np.ones(len(p), bool)
        opens[1:] = (d[1:] != d[:-1]) | (q[1:] != q[:-1]) | (p[1:] > p[:-1] + k)
        begin = np.flatnonzero(opens)
        stop = np.append(begin[1:], len(p)) - 1
        covered: dict[tuple[int, int], int] = {}
        for b, e in zip(begin, stop, strict=True):
            one, lag, start, end = int(d[b]), int(q[b]), int(p[b]), int(p[e]) + k
            if start < covered.get((one, lag), -1):
                continue
            start, end = _extended(word, lag, start, end, int(first[one]), int(first[one + 1]))
            covered[one, lag] = end
            length = end - start + lag
            if length >= max(LEAST_WORDS, LEAST_POWERS * lag):
                found.append((one, start - int(first[one]), length, lag))
    out = np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)
    return tuple(out[:, c] for c in range(4))


def repeated_tail(n: int, checksum: int) -> np.ndarray:
    """Which word each of n words becomes where the text ends in copies of a period; ``checksum`` sets the place and the period."""
    g = checksum // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % period])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` (start, length, period; by start, then period), ``collapsed_sha256`` of the
    text with one period left of each run, and ``n_kept`` (words).

    Words are what ASCII white space separates; case counts. The collapsed text is its kept words joined by one space; a
    word goes if any run holds it after that run's first period. A null, empty or blank text has no word and no run,
    and its digest is that of the empty text. Repeated rows come back as often as they stand there, a null id stays
    null, other columns are not read, an empty table gives no row. A text of any length is one piece of work in one
    task, of a size that follows the text. ``planted`` first gives each tenth document (by the checksum of its id) a
    periodic tail (:func:`repeated_tail`); a row without an id stays as it is.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            word, solid, begin, first = words_of(columns_of(batch, "text"))
            source = np.arange(len(word))
            if planted:
                for r, one in enumerate(columns_of(batch, "doc_id").to_pylist()):
                    n = int(first[r + 1] - first[r])
                    if one is not None and n and (checksum := zlib.crc32(str(one).encode())) % 10 == 0:
                        source[first[r] : first[r + 1]] = first[r] + repeated_tail(n, checksum)
                word = word[source]
            doc, start, length, period = runs_of(word, first)
            at = first[doc] + start
            gone = np.zeros(len(word) + 1, np.int64)
            np.add.at(gone, at + period, 1)
            np.add.at(gone, at + length, -1)
            stays = np.cumsum(gone)[:-1] == 0
            kept = np.concatenate([[0], np.cumsum(stays)])[first]
            digests = _joined_digests(solid, begin[:-1], np.diff(begin), source[stays], kept)
            cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(kind)))
            yield pa.record_batch([columns_of(batch, "doc_id"), pa.array(np.diff(first)), listed, pa.array(digests, pa.string()), pa.array(np.diff(kept))],
                                  names=["doc_id", "n_words", "runs", "collapsed_sha256", "n_kept"])

    return rows.mapInArrow(run, f"doc_id {key}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_sha256 string, n_kept long")


def _joined_digests(data: np.ndarray, begin: np.ndarray, size: np.ndarray, picked: np.ndarray, first: np.ndarray) -> list[str]:
    """SHA-256 of the picked words of each text, joined by one space."""
    n = size[picked]
    ends = np.cumsum(n + 1)  # each word and a space
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    if len(picked):
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(ends - n - 1, n) + inside] = data[np.repeat(begin[picked], n) + inside]
    at = np.concatenate([[0], ends])
    text = memoryview(out)
    return [hashlib.sha256(text[at[a] : max(at[a], at[b] - 1)]).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]


def longest(runs) -> "F.Column":
    """The run of the greatest length (ties: smallest start, then period); null without a run."""
    order = lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))
    best = F.array_min(F.transform(runs, order))
    return F.when(F.size(runs) > 0, F.struct(best["start"].alias("start"), (-best["less"]).alias("length"), best["period"].alias("period")))
