"""Substring dedup by recompression: words of 20-word windows that occur earlier are cut from every text.

Words get names (two 64-bit hashes). First maximal runs of one name become one symbol; then, round by round, the alphabet
is dealt into a left and a right half by one bit of each name, and each left symbol followed by a right one becomes a
pair. A name depends on the symbol's words alone, so it is the same in every document and every task: the rounds are
global with no table of names to build, ship or join, and run inside one Spark stage. Every symbol also keeps which words
its forming looked at; inside that range equal texts have equal symbols.

Symbols reveal repeats: a window is labelled by its longest symbol whose range the window holds (then the least name; a
single word where none fits), equal windows share labels, and Spark counts labels. Symbols also verify them: read from
the left, the highest symbols that fit cover a window, and equal windows, and no others, have equal covers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .arrays import U64, both, joined, mix, names, word_limits
from .common import documents
from .repeats import Blocks, Unit, blocks_of, remove_repeats, sha256

WINDOW = 20
ROUNDS = 5
LEVELS = (3, 5)
"""Levels whose symbols may label a window."""


@dataclass(frozen=True)
class Symbols:
    """One level of all texts: two names of each symbol (or one and None), first word, end, the words that its forming
    looked at (low to high), and the text."""

    one: np.ndarray
    two: np.ndarray | None
    first: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray


def words_of(buf: np.ndarray, at: np.ndarray, verify: bool) -> Symbols:
    """Each word as a symbol of its own."""
    start, end = word_limits(buf)
    place = np.arange(len(start))
    return Symbols(names(buf, start, end), names(buf, start, end, 1) if verify else None, place, place + 1, place, place + 1, np.searchsorted(at, start, "right") - 1)


def run_round(s: Symbols) -> Symbols:
    """One symbol for each maximal run of a name within a text."""
    n = len(s.one)
    new = (s.one[1:] != s.one[:-1]) | (s.doc[1:] != s.doc[:-1])
    if s.two is not None:
        new |= s.two[1:] != s.two[:-1]
    first = np.flatnonzero(np.r_[True, new]) if n else np.zeros(0, np.int64)
    end = np.r_[first[1:], n] if n else first
    size = mix((end - first).astype(U64))

    def named(name: np.ndarray, seed: int) -> np.ndarray:
        return np.where(end - first > 1, both(name[first], size, seed), name[first])

    return Symbols(named(s.one, 0), None if s.two is None else named(s.two, 1), first, end, first - 1, end + 1, s.doc[first])


def pair_round(s: Symbols, bit: int) -> Symbols:
    """Each left symbol followed by a right one becomes a pair; one that stays has looked at the neighbour it lacks."""
    n = len(s.one)
    if n < 2:
        return s
    right = ((mix(s.one + U64(bit)) >> U64(17)) & U64(1)).astype(bool)
    same = s.doc[1:] == s.doc[:-1]
    pair = np.r_[~right[:-1] & right[1:] & same, False]
    keep = np.flatnonzero(~np.r_[False, pair[:-1]])
    other = np.minimum(keep + 1, n - 1)
    is_pair = pair[keep]
    before = np.maximum(keep - 1, 0)

    def named(name: np.ndarray, seed: int) -> np.ndarray:
        return np.where(is_pair, both(name[keep], name[other], seed), name[keep])

    look_right = np.where(np.r_[same, False][keep], s.high[other], s.end[keep] + 1)
    look_left = np.where(np.r_[False, same][keep], s.low[before], s.first[keep] - 1)
    low = np.where(is_pair | ~right[keep], s.low[keep], np.minimum(s.low[keep], look_left))
    high = np.where(is_pair, np.maximum(s.high[keep], s.high[other]), np.where(right[keep], s.high[keep], np.maximum(s.high[keep], look_right)))
    return Symbols(named(s.one, 0), None if s.two is None else named(s.two, 1), s.first[keep], np.where(is_pair, s.end[other], s.end[keep]), low, high, s.doc[keep])


def levels_of(words: Symbols) -> list[Symbols]:
    """Words, runs, and the pairs of each round."""
    out = [words, run_round(words)]
    for bit in range(1, ROUNDS + 1):
        out.append(pair_round(out[-1], bit))
    return out


def cover(levels: list[Symbols], first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two names of the cover of each window that starts at one of `first`. From the left, the highest symbol that
    starts there and whose range the window holds is taken; a word's range is the word, so one always fits."""
    n = len(levels[0].one)
    at = [np.full(n + 1, -1) for _ in levels]
    for own, s in zip(at, levels, strict=True):
        own[s.first] = np.arange(len(s.first))
    one, two = np.zeros(len(first), U64), np.zeros(len(first), U64)
    open_, here = np.arange(len(first)), first.copy()
    while len(open_):
        begin = first[open_]
        left = np.arange(len(open_))
        follow = np.empty(len(open_), np.int64)
        for own, s in zip(reversed(at), reversed(levels), strict=True):
            k = own[here[left]]
            fits = (k >= 0) & (s.low[k] >= begin[left]) & (s.high[k] <= begin[left] + window)
            take, k = left[fits], k[fits]
            one[open_[take]] = both(one[open_[take]], s.one[k])
            two[open_[take]] = both(two[open_[take]], s.two[k], 1)
            follow[take] = s.end[k]
            left = left[~fits]
            if not len(left):
                break
        on = follow < begin + window
        open_, here = open_[on], follow[on]
    return one, two


class Words(Unit):
    hot = 200_000

    def __init__(self, window: int = WINDOW):
        self.window = window

    def size(self, text: bytes) -> int:
        return len(text.split())

    def blocks(self, texts: list[bytes]) -> Blocks:
        levels = levels_of(words_of(*joined(texts), verify=False))
        name, doc = levels[0].one, levels[0].doc
        n, w = len(name), self.window
        if not n:
            none = np.zeros(0, np.int64)
            return none, none.astype(U64), none, none, none.astype(bool)
        label = np.full(n, ~U64(0))
        valid = np.zeros(n, bool)
        if n >= w:
            valid[: n - w + 1] = doc[w - 1 :] == doc[: n - w + 1]
        single = mix(name) >> U64(6) | U64(63) << U64(58)
        offers = []
        for level in LEVELS:
            s = levels[level + 1]
            fits = s.high - s.low <= w
            length = np.minimum(s.end - s.first, 62)[fits]
            offers.append((s.one[fits] >> U64(6) | (62 - length).astype(U64) << U64(58), s.low[fits], s.high[fits]))
        for key, low, high in offers:
            lead = np.maximum(high - w, 0)
            for step in range(w):
                p = lead + step
                ok = (p <= low) & (low >= 0)
                if not ok.any():
                    break
                np.minimum.at(label, p[ok], key[ok])
        bare = np.flatnonzero((label == ~U64(0)) & valid)
        for step in range(w if len(bare) else 0):
            label[bare] = np.minimum(label[bare], single[bare + step])
        ends = label == single
        for key, low, _ in offers:
            ok = low >= 0
            ends[low[ok][label[low[ok]] == key[ok]]] = True
        left = np.r_[0, np.cumsum(ends)]
        first, last = blocks_of(label, valid, doc)
        which = doc[first]
        begin = np.searchsorted(doc, np.arange(len(texts)))
        return which, label[first], first - begin[which], last - begin[which], left[last] > left[first]

    def context(self, text: bytes, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        words = text.split()
        return [b" ".join(words[a:b]) for a, b in zip(first.tolist(), (last + self.window).tolist(), strict=True)]

    def digests(self, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        levels = levels_of(words_of(*joined(contexts), verify=True))
        doc = levels[0].doc
        count = np.maximum(np.bincount(doc, minlength=len(contexts)) - self.window + 1, 0)
        which = np.repeat(np.arange(len(contexts)), count)
        begin = np.searchsorted(doc, np.arange(len(contexts)))
        first = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + begin[which]
        return which, *cover(levels, first, self.window)

    def finish(self, text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
        words = text.split()
        kept, at = [], 0
        for a, b in spans.tolist():
            kept += words[at:a]
            at = b
        kept += words[at:]
        return len(words), len(words) - len(kept), len(spans), sha256(b" ".join(kept))


def substring_dedup(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256; see repeats.remove_repeats for nulls, ties and repeated rows."""
    return remove_repeats(docs, Words(window), text).withColumnRenamed("size", "n_words")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))
