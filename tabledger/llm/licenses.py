"""Licence scan: phrases, and templates compiled into automata over words.

A template is mandatory wording with regions that may be left out and regions
that may be replaced. It becomes an automaton whose steps are whole words; a
place in a text is accepted if some path through the automaton reads exactly the
words that stand there. Words of a whole batch are hashed at once, and an
automaton only starts where two neighbouring words can open it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, WORD_MASK, SpanHasher, columns_of, mixed, slices, utf8, word_bounds
from .license_texts import PHRASES, TEMPLATES


@dataclass
class Automaton:
    """``step[s]`` maps a word to the next state, ``free[s]`` is where any word leads, ``skip[s]`` are the states that
    are reached without a word. The last state accepts. ``depth[s]``: mandatory words read on the shortest way there."""

    step: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    free: list[int | None] = field(default_factory=lambda: [None])
    skip: list[list[int]] = field(default_factory=lambda: [[]])
    depth: list[int] = field(default_factory=lambda: [0])
    closed: list[frozenset[int]] = field(default_factory=list)

    def _state(self, depth: int) -> int:
        self.step.append({})
        self.free.append(None)
        self.skip.append([])
        self.depth.append(depth)
        return len(self.step) - 1

    @property
    def last(self) -> int:
        return len(self.step) - 1

    def close(self) -> "Automaton":
        for s in range(len(self.step)):
            seen, todo = {s}, [s]
            while todo:
                for t in self.skip[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            self.closed.append(frozenset(seen))
        return self

    def after(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        out: set[int] = set()
        for s in states:
            t = self.step[s].get(word)
            if t is not None:
                out |= self.closed[t]
            if self.free[s] is not None:
                out |= self.closed[self.free[s]]
        return frozenset(out)

    def openings(self) -> set[tuple[bytes, bytes | None]]:
        """The first two words by which a text can enter; None where any word may follow."""
        out = set()
        for s in self.closed[0]:
            for a, t in self.step[s].items():
                for u in self.closed[t]:
                    out |= {(a, b) for b in self.step[u]}
                    if self.free[u] is not None or u == self.last:
                        out.add((a, None))
        return out

    def read(self, words, start: int) -> tuple[int, int]:
        """The longest accepted stretch from ``start`` (its end, or -1), and the mandatory words read at best."""
        states, end, deep, at = self.closed[0], -1, 0, start
        while at < len(words):
            states = self.after(states, words[at])
            if not states:
                break
            at += 1
            deep = max(deep, max(self.depth[s] for s in states))
            if self.last in states:
                end = at
        return end, deep


def compiled(markup: str) -> Automaton:
    """The automaton of a template in the markup of ``license_texts``. Only words outside optional regions count as
    mandatory; optional regions may be nested."""
    a = Automaton()
    here, depth, opened = 0, 0, []
    for token in re.findall(r"<<[a-z]+(?::\d+)?>>|\S+", markup):
        if token == "<<optional>>":
            opened.append(here)
        elif token == "<<end>>":
            door = a._state(depth)
            a.skip[here].append(door)
            a.skip[opened.pop()].append(door)
            here = door
        elif token.startswith("<<any:"):
            ways = [here]
            for _ in range(int(token[6:-2])):
                nxt = a._state(depth)
                a.free[ways[-1]] = nxt
                ways.append(nxt)
            door = a._state(depth)
            for w in ways:
                a.skip[w].append(door)
            here = door
        else:
            depth += not opened
            nxt = a._state(depth)
            a.step[here][token.encode()] = nxt
            here = nxt
    return a.close()


def word_hash(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return SpanHasher(data, WORD_BYTES)(ends - [len(w) for w in words], ends)


class Scanner:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases = [([w.encode() for w in p.split()], label) for p, label in phrases]
        self.phrase_hashes = [word_hash(w) for w, _ in self.phrases]
        self.templates = [(label, name, compiled(t)) for label, name, t in templates]
        pairs, singles = {}, {}
        for k, (_, _, a) in enumerate(self.templates):
            for x, y in a.openings():
                if y is None:
                    singles.setdefault(int(word_hash([x])[0]), set()).add(k)
                else:
                    h = word_hash([x, y])
                    pairs.setdefault(int(mixed(h[:1] * np.uint64(3) + h[1:])[0]), set()).add(k)
        self.pairs, self.singles = pairs, singles
        self.pair_keys = np.array(sorted(pairs), np.uint64)
        self.single_keys = np.array(sorted(singles), np.uint64)

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple]], list[list[tuple]], np.ndarray]:
        """For each text: number of words; (label, first word) of phrases; (label, template, first word, end) of
        templates, per template leftmost and longest without overlap; share of a template's wording that was read."""
        data, offsets = utf8(texts)
        starts, ends, first = word_bounds(data, offsets, WORD_MASK)
        hashes = SpanHasher(data, WORD_BYTES)(starts, ends)
        n = len(hashes)
        count = np.diff(first)
        doc = np.repeat(np.arange(len(texts)), count)
        base: list[list[tuple]] = [[] for _ in range(len(texts))]
        found: list[list[tuple]] = [[] for _ in range(len(texts))]
        share = np.zeros(len(texts))
        word = lambda i: WORD_BYTES[data[starts[i] : ends[i]]].tobytes()
        for (words, label), want in zip(self.phrases, self.phrase_hashes, strict=True):
            k = len(want)
            if n < k:
                continue
            hit = np.ones(n - k + 1, bool)
            for j in range(k):
                hit &= hashes[j : n - k + 1 + j] == want[j]
            for i in np.flatnonzero(hit & (doc[: n - k + 1] == doc[k - 1 :])):
                if all(word(i + j) == w for j, w in enumerate(words)):
                    base[doc[i]].append((label, int(i - first[doc[i]])))
        if not n:
            return count, base, found, share
        paired = np.zeros(n, np.uint64)
        paired[:-1] = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
        one, two = np.isin(hashes, self.single_keys), np.isin(paired, self.pair_keys)
        read, free = {}, {}
        for i in np.flatnonzero(one | two):
            d = int(doc[i])
            if d not in read:
                read = {d: [word(j) for j in range(first[d], first[d + 1])]}
                free = {}
            at = int(i - first[d])
            which = (self.singles[int(hashes[i])] if one[i] else set()) | (self.pairs[int(paired[i])] if two[i] else set())
            for k in sorted(which):
                if at < free.get(k, 0):
                    continue
                label, name, automaton = self.templates[k]
                end, deep = automaton.read(read[d], at)
                share[d] = max(share[d], deep / max(1, automaton.depth[automaton.last]) if deep > 1 else 0)
                if end >= 0:
                    found[d].append((label, name, at, end))
                    free[k] = end
        return count, base, found, share


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``phrases`` (label, start), ``templates`` (label, name, start, end; in words,
    end exclusive) and ``share``, how much of some template's mandatory wording was read at best (0 to 1).

    A null or empty text has no words. Rows are independent of each other: repeated rows and null ids come back as they
    are, an empty table gives no row; other columns are not read. One pass, no shuffle.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    phrase = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    template = pa.list_(pa.struct([("label", pa.string()), ("name", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in slices(batches):
            count, base, found, share = scanner.scan(columns_of(batch, "text"))
            base = [[{"label": a, "start": s} for a, s in x] for x in base]
            found = [[{"label": a, "name": b, "start": s, "end": e} for a, b, s, e in x] for x in found]
            yield pa.record_batch(
                [columns_of(batch, "doc_id"), pa.array(count, pa.int64()), pa.array(base, phrase), pa.array(found, template),
                 pa.array(share)], names=["doc_id", "n_words", "phrases", "templates", "share"])

    return rows.mapInArrow(
        run, f"doc_id {key}, n_words long, phrases array<struct<label:string,start:long>>,"
        " templates array<struct<label:string,name:string,start:long,end:long>>, share double")
