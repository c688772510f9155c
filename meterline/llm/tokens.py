"""Byte-level BPE over many texts at once.

Texts are cut into pieces by array operations over code points, each different piece is encoded once per worker (a
bounded store), and ids are gathered from the store. Texts with code points whose class may differ between Unicode
versions go to the tokenizer as they are.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from .arrays import BLOCK, chunks, names

SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
"""Fixed values: Unicode white space."""
KNOWN = 0x2E80
LETTER, NUMBER, SPACE, OTHER, UNSURE = range(5)
STORE = 1_000_000
"""Pieces that a worker keeps, at most; about 40 bytes each."""


def _classes() -> np.ndarray:
    out = np.full(KNOWN + 1, UNSURE, np.uint8)
    for c in range(KNOWN):
        kind = unicodedata.category(chr(c))
        out[c] = LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else UNSURE if kind == "Cn" else OTHER
    out[[c for c in SPACES if c < KNOWN]] = SPACE
    return out


def _characters() -> dict[int, str]:
    """The vocabulary writes each byte as one printable character: itself, or the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """ids of texts, as the tokenizer gives them with add_special_tokens=False; strings of special tokens in a text are
    ordinary text, as the vocabulary's notes call it."""

    def __init__(self, path: str):
        # Each task is one process; the tokenizer's own threads would compete with Spark's.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        self.classes = _classes()
        self.characters = _characters()
        self._clear()

    def _clear(self) -> None:
        self.names = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, name: np.ndarray, pieces: list[str]) -> None:
        """Adds pieces to the store, which is sorted by name. A piece is one word to the model."""
        tokenize = self.slow.model.tokenize
        new = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(self.characters))] for p in pieces]
        size = np.fromiter(map(len, new), np.int64, len(new))
        at = np.cumsum(size) - size + len(self.ids)
        self.ids = np.concatenate([self.ids, np.fromiter((i for p in new for i in p), np.uint32, int(size.sum()))])
        place = np.searchsorted(self.names, name)
        self.names, self.at, self.size = (np.insert(old, place, new) for old, new in ((self.names, name), (self.at, at), (self.size, size)))

    def limits(self, points: np.ndarray, kind: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where pieces start; begin holds the place of each (non-empty) text. A piece is an English contraction's end, or
        a run of letters, of digits or of other signs with one space before it, or white space up to such a space. The
        tokenizer cuts no piece further and none across two."""
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[begin] = edge[n] = True
        text_edge = edge.copy()
        edge[1:n] |= kind[1:] != kind[:-1]
        run = np.flatnonzero(edge)
        a, b = run[:-1], run[1:]
        gap = (kind[a] == SPACE) & ~text_edge[b]
        a, b = a[gap], b[gap]
        edge[b - 1] = True
        edge[b[points[b - 1] == 0x20]] = False
        tick = np.flatnonzero((points == 0x27) & edge[:n])
        tick = tick[tick + 1 < n]
        tick = tick[(kind[tick + 1] == LETTER) & ~text_edge[tick + 1]]
        for i in tick.tolist():
            tail = "".join(map(chr, points[i + 1 : i + 3].tolist()))
            k = 1 if tail[0] in "stmd" else 2 if tail in ("re", "ve", "ll") and not text_edge[i + 2] else 0
            if k:
                edge[i + 1] = False
                edge[i + 1 + k] = True
        return np.flatnonzero(edge)

    def __call__(self, texts: list[str]):
        """Yields the ids (uint32) of each text."""
        for a, b in chunks([len(t) for t in texts], BLOCK):
            yield from self._chunk(texts[a:b])

    def _chunk(self, texts: list[str]):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points):
            yield from (np.zeros(0, np.uint32) for _ in texts)
            return
        kind = self.classes[np.minimum(points, KNOWN)]
        begin = np.cumsum(size) - size
        odd = set(np.searchsorted(begin + size, np.flatnonzero(kind == UNSURE), "right").tolist())
        limit = self.limits(points, kind, begin[size > 0])
        start, end = limit[:-1], limit[1:]
        name, where, back = np.unique(names(points, start, end), return_index=True, return_inverse=True)
        if len(self.names) > STORE:
            self._clear()
        slot = np.searchsorted(self.names, name)
        fresh = np.flatnonzero(np.append(self.names, np.uint64(0))[slot] != name) if len(self.names) else np.arange(len(name))
        if len(fresh):
            self._learn(name[fresh], [whole[start[w] : end[w]] for w in where[fresh].tolist()])
            slot = np.searchsorted(self.names, name)
        slot = slot[back]
        length = self.size[slot]
        total = np.cumsum(length)
        out = self.ids[np.repeat(self.at[slot] - (total - length), length) + np.arange(total[-1])]
        cut = np.r_[0, total][np.searchsorted(start, np.r_[begin, len(points)])]
        for i in range(len(texts)):
            yield np.asarray(self.slow.encode(texts[i], add_special_tokens=False).ids, np.uint32) if i in odd else out[cut[i] : cut[i + 1]]
