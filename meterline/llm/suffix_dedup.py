"""Suffix-array dedup: byte strings of 100 that occur earlier are cut from every text.

A suffix array over all bytes would have to shuffle the start of each suffix, a hundred times the input. Windows are
therefore dealt by the least hash of the 32-byte strings in them, which equal windows share: Spark sorts blocks of text
under one such label together (repeats.py), and each run of a label gets an enhanced suffix array of its own. Its
suffixes start where a string of `window` bytes occurs twice and its left extensions differ (or a block begins), and in
steps after that while strings occur twice, so that together they hold all repeats. Sorted suffixes with the lengths of their common prefixes are scanned with a stack, which
builds the tree of common-prefix intervals bottom up: each interval of at least `window` bytes is a maximal repeat within
its blocks with all its occurrences. All but the first occurrence of an interval are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrays import joined, sliding, sliding_min
from .common import documents, keyed
from .repeats import Blocks, Unit, blocks_of, remove_repeats, sha256, shipped_contexts

WINDOW = 100
GRAM = 32
BATCH = 1 << 18
ROWS = 1 << 16
"""Bytes of contexts whose suffixes are sorted at once; one label is never split."""

Interval = tuple[int, list[int]]
"""length of the common prefix, suffixes"""


def suffix_starts(contexts: list[bytes], labels: np.ndarray, unit: "Bytes", step: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, start) of windows that occur twice under their label and whose left extensions differ, or begin a
    context in one of their places; and of every step-th window after one of those, up to the next of them or to a
    window that occurs once. All places of a shared passage have the same starts, as it begins with one."""
    which, one, two = unit.digests(contexts)
    if not len(which):
        return which, which
    begin = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    start = np.arange(len(which)) - np.repeat(begin, np.diff(np.r_[begin, len(which)]))
    buf, at = joined(contexts)
    before = np.where(start > 0, buf[np.maximum(at[which] + start - 1, 0)].astype(np.int16), -1)
    order = np.lexsort((two, one, labels[which]))
    new = np.r_[True, (labels[which[order]][1:] != labels[which[order]][:-1]) | (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])]
    head = np.flatnonzero(new)
    size = np.diff(np.r_[head, len(order)])
    low, high = np.minimum.reduceat(before[order], head), np.maximum.reduceat(before[order], head)
    twice, diverse = np.zeros(len(order), bool), np.zeros(len(order), bool)
    twice[order] = np.repeat(size > 1, size)
    diverse[order] = np.repeat((size > 1) & ((low != high) | (low < 0)), size)
    # A stretch of windows that occur twice begins with a diverse one.
    at = np.arange(len(order))
    use = twice & ((at - np.maximum.accumulate(np.where(diverse, at, 0))) % step == 0)
    return which[use], start[use]


def common_prefixes(suffixes: list[bytes], fresh: np.ndarray) -> np.ndarray:
    """How many first bytes each sorted suffix shares with the one before it; 0 where `fresh` says so."""
    size = np.fromiter(map(len, suffixes), np.int64, len(suffixes))
    out = np.zeros(len(suffixes), np.int64)
    buf = np.frombuffer(b"".join(suffixes), np.uint8)
    at = np.cumsum(size) - size
    width = min(int(np.median(size)) * 2, 1 << 12) + 1
    column, step = np.arange(width), max(1, (1 << 20) // width)
    for a in range(1, len(suffixes), step):
        b = min(a + step, len(suffixes))
        least = np.minimum(size[a:b], size[a - 1 : b - 1])
        inside = column < least[:, None]
        x = buf[np.minimum(at[a:b, None] + column, len(buf) - 1)]
        y = buf[np.minimum(at[a - 1 : b - 1, None] + column, len(buf) - 1)]
        same = np.cumprod((x == y) & inside, 1, dtype=np.uint8).sum(1, dtype=np.int64)
        for i in np.flatnonzero((same == width) & (least > width)).tolist():
            p, q = suffixes[a + i], suffixes[a + i - 1]
            n = int(least[i])
            differ = np.flatnonzero(np.frombuffer(p[:n], np.uint8) != np.frombuffer(q[:n], np.uint8))
            same[i] = differ[0] if len(differ) else n
        out[a:b] = same
    out[fresh] = 0
    return out


def interval_scan(prefixes: list[int], rank: list[int], least: int) -> list[tuple[int, int]]:
    """(suffix, length) for each suffix that is not the first occurrence of some common-prefix interval of at least
    `least`, with the longest such interval. prefixes[i]: what sorted suffixes i - 1 and i share; rank: order of
    occurrence. On the stack lie open intervals by their first occurrence and what they share with the one below; an
    interval closes when a shorter common prefix comes. Of two that close into one, the later first occurrence loses; all
    others of its interval have lost with a longer prefix before."""
    out = []
    stack: list[tuple[int, int]] = []

    def close(limit: int) -> None:
        while len(stack) > 1 and stack[-1][1] >= limit:
            top, shared = stack.pop()
            below, rest = stack[-1]
            first, later = (below, top) if rank[below] < rank[top] else (top, below)
            out.append((later, shared))
            stack[-1] = (first, rest)

    for i, shared in enumerate(prefixes):
        if shared < least:
            close(least)
            stack = [(i, 0)]
        else:
            close(shared)
            stack.append((i, shared))
    close(least)
    return out


def interval_tree(prefixes: list[int], least: int) -> list[Interval]:
    """All common-prefix intervals of at least `least`, each with all its suffixes, by the same scan."""
    out: list[Interval] = []
    stack: list[tuple[int, int]] = []
    for i, shared in enumerate([*prefixes, 0]):
        left = i - 1
        while stack and stack[-1][0] > shared:
            length, left = stack.pop()
            out.append((length, list(range(left, i))))
        if shared >= least and (not stack or stack[-1][0] < shared):
            stack.append((shared, left))
    return out


class Group:
    """Different contexts of whole labels, with the place where each occurs first."""

    def __init__(self) -> None:
        self.contexts: list[bytes] = []
        self.labels: list[int] = []
        self.places: list[tuple[int, int]] = []
        self.bytes = 0

    def suffixes(self, unit: "Bytes") -> tuple[list[list[tuple[int, int]]], list[int], np.ndarray]:
        """The enhanced suffix array: sorted different suffixes, each as its places (context, start), first one first;
        their sizes; and common prefixes. Equal suffixes are held once, so near copies cost little."""
        step = 2 * (unit.window - unit.gram + 1)
        which, start = suffix_starts(self.contexts, np.asarray(self.labels), unit, step)
        # Any window of a repeat begins less than a step after one of its suffixes, which so need no more bytes than this.
        reach = unit.window + step
        places: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
        for c, s in zip(which.tolist(), start.tolist(), strict=True):
            places.setdefault((self.labels[c], self.contexts[c][s : s + reach]), []).append((c, s))
        parts = sorted(places)
        fresh = np.r_[True, np.diff(np.array([p[0] for p in parts])) != 0] if parts else np.zeros(0, bool)
        prefixes = common_prefixes([p[1] for p in parts], fresh) if parts else np.zeros(0, np.int64)
        return [sorted(places[p], key=self.place) for p in parts], [len(p[1]) for p in parts], prefixes

    def place(self, at: tuple[int, int]) -> tuple[int, int]:
        """Key and position of (context, start) where the context occurs first."""
        key, first = self.places[at[0]]
        return key, first + at[1]


def grouped(batches: Iterator[pa.RecordBatch], unit: "Bytes", repeat, apart: bool = False) -> Iterator[tuple[Group, list]]:
    """Groups of whole labels of about BATCH bytes. Rows that repeat a context of their label are no new suffixes; they
    are passed to `repeat` and come out beside the group; with apart, beside an empty one once they are ROWS."""
    group, seen, label, rows = Group(), {}, None, []
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("label", "key", "first", "last", "context")]
        for name, key, first, last, context in zip(*columns, strict=True):
            if name != label:
                if group.bytes >= BATCH:
                    yield group, rows
                    group, rows = Group(), []
                label, seen = name, {}
            if context is None or context in seen:
                repeat(rows, key, first, last, seen.get(context))
                if apart and len(rows) >= ROWS:
                    yield Group(), rows
                    rows = []
                continue
            seen[context] = len(group.contexts)
            group.contexts.append(context)
            group.labels.append(name)
            group.places.append((key, first))
            group.bytes += len(context)
    yield group, rows


def _mark(unit: "Bytes"):
    def repeat(rows: list, key: int, first: int, last: int, _: int | None) -> None:
        rows.append((key, first, last + unit.window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in grouped(batches, unit, repeat, True):
            suffixes, sizes, prefixes = group.suffixes(unit)
            first = [group.place(own[0]) for own in suffixes]
            rank = np.empty(len(first), np.int64)
            rank[sorted(range(len(first)), key=first.__getitem__)] = np.arange(len(first))
            for i, length in interval_scan(prefixes.tolist(), rank.tolist(), unit.window):
                rows.append((*first[i], first[i][1] + length))
            for own, size in zip(suffixes, sizes, strict=True):
                rows += [(key, at, at + size) for key, at in map(group.place, own[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32())], names=["key", "s", "e"])

    return run


def _report(unit: "Bytes"):
    """(label, length, key, start) of each occurrence in each interval."""

    def repeat(rows: list, key: int, first: int, last: int, context: int | None) -> None:
        rows.append((context, key, first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in grouped(batches, unit, repeat):
            copies: dict[int, list[tuple[int, int]]] = {}
            for context, key, first in rows:
                copies.setdefault(context, []).append((key, first))
            suffixes, sizes, prefixes = group.suffixes(unit)
            found = [*interval_tree(prefixes.tolist(), unit.window), *((n, [i]) for i, n in enumerate(sizes) if len(suffixes[i]) > 1)]
            out: list[tuple[bytes, int, int, int]] = []
            for length, members in found:
                c, s = suffixes[members[0]][0]
                name = bytes.fromhex(sha256(group.contexts[c][s : s + length]))
                for c, s in (x for m in members for x in suffixes[m]):
                    for key, first in [group.places[c], *copies.get(c, [])]:
                        out.append((name, length, key, first + s))
            for c, more in copies.items():
                if c is not None:
                    text = group.contexts[c]
                    name = bytes.fromhex(sha256(text))
                    out += [(name, len(text), key, first) for key, first in [group.places[c], *more]]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=["repeat", "length", "key", "start"])

    return run


class Bytes(Unit):
    hot = 20_000

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, min(gram, window)

    def marker(self):
        return _mark(self)

    def size(self, text: bytes) -> int:
        return len(text)

    def blocks(self, texts: list[bytes]) -> Blocks:
        buf, at = joined(texts)
        grams = sliding(buf, self.gram)
        label = sliding_min(grams, self.window - self.gram + 1)
        length = np.diff(at) - 1
        keep = np.flatnonzero(length >= self.window)
        edge = np.zeros(len(buf) + 1, np.int32)
        np.add.at(edge, at[keep], 1)
        np.add.at(edge, at[keep] + length[keep] - self.window + 1, -1)
        valid = np.cumsum(edge[:-1])[: len(label)] > 0
        text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(at))[: len(label)]
        first, last = blocks_of(label, valid, text)
        which = text[first]
        left = np.r_[0, np.cumsum(grams[: len(label)] == label)]
        return which, label[first], first - at[which], last - at[which], left[last] > left[first]

    def context(self, text: bytes, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        return [text[a:b] for a, b in zip(first.tolist(), (last + self.window).tolist(), strict=True)]

    def digests(self, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        buf, at = joined(contexts)
        count = np.maximum(np.diff(at) - self.window, 0)
        which = np.repeat(np.arange(len(contexts)), count)
        start = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + at[which]
        return which, *(sliding(buf, self.window, seed)[start] for seed in (0, 1))

    def finish(self, text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
        kept, at = [], 0
        for a, b in spans.tolist():
            kept.append(text[at:a])
            at = b
        kept.append(text[at:])
        return len(text), int((spans[:, 1] - spans[:, 0]).sum()) if len(spans) else 0, len(spans), sha256(b"".join(kept))


def suffix_dedup(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; see repeats.remove_repeats for nulls, ties and repeated rows."""
    return remove_repeats(docs, Bytes(window), text).withColumnRenamed("size", "n_bytes")


def maximal_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """repeat (SHA-256 of its bytes), length, doc_id, start: maximal repeats of at least `window` bytes within blocks, each
    with all its occurrences. A repeat longer than a block or a suffix comes in parts. Exact copies of documents are included.

    A null text is empty; texts shorter than the window have no repeats; each row is a document of its own, so repeated rows
    repeat each other, and rows of one doc_id (or of none) stand under it; a table without repeats gives no rows; other
    columns are ignored."""
    rows, ids = keyed(docs, text)
    unit = Bytes(window)
    found = shipped_contexts(rows, unit, shrink=False).mapInArrow(_report(unit), "repeat binary, length long, key long, start long").distinct()
    if ids is None:
        return found.withColumnRenamed("key", "doc_id")
    return found.join(ids, "key").select("repeat", "length", "doc_id", "start")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))
