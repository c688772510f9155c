"""Vectorised helpers that run inside tasks: slicing Arrow batches, word limits, names of ranges.

A name is a 64-bit hash of what a range of an array holds. Up to 8 bytes are taken exactly; longer ranges are named by
two overlapping halves, each named by its halves in turn, and every step is mixed. Equal ranges always have equal names,
and there is no algebra between symbols that structured texts could cancel. Two seeds give independent names.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SEEDS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
CHUNK = 1 << 21
"""Bytes of text that are worked on at once; a longer document is one chunk of its own."""
BLOCK = 1 << 18
"""The same where chunks needn't know of each other: what is computed on the way takes about 50 bytes for each."""

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of a uint64 array (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def both(left: np.ndarray, right: np.ndarray, seed: int = 0) -> np.ndarray:
    """The name of two names in a row."""
    x = left * U64(SEEDS[seed])
    x += right
    return mix(x)


def _packed(values: np.ndarray) -> tuple[np.ndarray, int]:
    """At each place the next 8 bytes of values as one number (zeros after the end), and how many values those are."""
    width = 8 // values.itemsize
    if width == 1:
        return values.astype(U64, copy=False), 1
    buf = np.concatenate([values, np.zeros(width, values.dtype)])
    return np.ndarray((len(values),), "<u8", buf.data, 0, (values.itemsize,)).copy(), width


def names(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Names of values[start:end] for arrays of limits; values are unsigned integers of 1 to 8 bytes."""
    length = end - start
    out = np.zeros(len(start), U64)
    if not len(start):
        return out
    level, width = _packed(values)
    key = U64(SEEDS[1 - seed])
    short = np.flatnonzero((length > 0) & (length <= width))
    mask = U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - length[short].astype(U64) * U64(64 // width))
    out[short] = mix((level[start[short]] & mask) + key)
    rest = np.flatnonzero(length > width)
    if len(rest):
        s, n = start[rest], length[rest]
        if int(n.sum()) * 2 < len(level):
            # Few ranges are long: only what they hold is worked on.
            at = np.cumsum(n) - n
            level = level[np.repeat(s - at, n) + np.arange(int(n.sum()))]
            s = at
        level = mix(level + key)
        while len(rest):
            own = n <= 2 * width
            out[rest[own]] = both(level[s[own]], level[s[own] + n[own] - width], seed)
            rest, s, n = rest[~own], s[~own], n[~own]
            if len(rest):
                level = both(level[:-width], level[width:], seed)
                width *= 2
    return mix(out + length.astype(U64) * U64(0xA0761D6478BD642F))


def _sliding(values: np.ndarray, n: int, length: int, seed: int) -> np.ndarray:
    level, width = _packed(values)
    key = U64(SEEDS[1 - seed])
    if length <= width:
        level = mix((level[:n] & (U64(0xFFFFFFFFFFFFFFFF) >> U64(64 - length * (64 // width)))) + key)
    else:
        level = mix(level + key)
        while 2 * width < length:
            level = both(level[:-width], level[width:], seed)
            width *= 2
        level = both(level[:n], level[length - width : length - width + n], seed)
    return mix(level + U64(length * 0xA0761D6478BD642F % (1 << 64)))


def sliding(values: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Names of all ranges of one length, in steps that stay in the processor's cache."""
    n = max(len(values) - length + 1, 0)
    out = np.empty(n, U64)
    for a in range(0, n, 1 << 14):
        b = min(a + (1 << 14), n)
        out[a:b] = _sliding(values[a : b + length - 1], b - a, length, seed)
    return out


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    have = 1
    while have * 2 <= width and len(a) > have:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    rest = width - have
    return np.minimum(a[:-rest], a[rest:]) if rest and len(a) > rest else (a if not rest else a[:0])


def word_limits(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that are not white space."""
    solid = np.zeros(len(buf) + 2, np.int8)
    solid[1:-1] = ~SPACE[buf]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, a line feed after each, and each text's place (n + 1 limits)."""
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.zeros(0, np.uint8), at


def chunks(sizes: list[int], most: int = CHUNK):
    """Slices of neighbours whose sizes sum to about `most`."""
    at = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null becomes the empty text."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def text_parts(batch, times: str | None = None, text: str = "text", most: int = BLOCK):
    """Neighbouring rows of a batch as batches of about `most` bytes of text, each with its texts' UTF-8 bytes, so that
    beside the batch only one part's texts are held. times: a column of lists; a text counts as often as its list is long."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = batch.column(text).cast(pa.binary())
    size = pc.fill_null(pc.binary_length(column), 0)
    if times:
        size = pc.multiply(size.cast(pa.int64()), pc.list_value_length(batch.column(times)).cast(pa.int64()))
    for a, b in chunks(size.to_pylist(), most):
        yield batch.slice(a, b - a), as_bytes(column.slice(a, b - a))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x) -> np.ndarray:
    return np.asarray(x, np.int64).view(U64)
