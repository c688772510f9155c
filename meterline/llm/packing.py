"""Pattern packing: documents' token pieces fill sequences of fixed length.

A histogram of piece lengths (as many rows as the sequence has tokens, at most) goes to the driver. There, patterns of a
few lengths that fill a sequence exactly get repeat counts by non-negative least squares against the histogram; counts
are rounded down, and what remains is packed pattern by pattern, longest piece first, each time with the largest pieces
that fit. Spark then numbers the pieces of each length, and a piece's number tells its pattern, repeat and place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import text_parts
from .common import cut, documents
from .tokens import Encoder

LENGTH = 1024
END = 2
SALTS = 256
Pattern = tuple[tuple[int, ...], int]
"""lengths, repeats"""


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids, `end` last; longer ones in whole pieces from the
    back, so that only the first piece may be shorter. A null text is empty and has the one id `end`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        for part, texts in (x for batch in batches for x in text_parts(batch)):
            ids = part.column("doc_id").to_pylist()
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, own in zip(ids, encode([t.decode() for t in texts]), strict=True):
                own = np.append(own, np.uint32(end)).astype("<u4")
                first = len(own) % length or length
                for k, a in enumerate([0, *range(first, len(own), length)]):
                    piece = own[a : first if not k else a + length]
                    for o, v in zip(rows, (doc_id, k, a, len(piece), zlib.crc32(piece.tobytes())), strict=True):
                        o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, t) for r, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def nnls(index: np.ndarray, target: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 for least |A x - target|, by accelerated projected gradients; column j of A counts the entries of
    index[j] (-1: none)."""
    used = index >= 0
    rows, cols = index[used], np.nonzero(used)[0]
    ahead = lambda x: np.bincount(rows, x[cols], len(target))
    back = lambda y: np.bincount(cols, y[rows], len(index))
    v = np.ones(len(index))
    for _ in range(20):
        v = back(ahead(v))
        bound = np.linalg.norm(v)
        v /= bound or 1
    x = z = np.zeros(len(index))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(z - back(ahead(z) - target) / (bound or 1), 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def candidates(counts: np.ndarray, length: int, most: int = 6000) -> list[tuple[int, ...]]:
    """Patterns of up to four lengths that fill a sequence exactly: all pairs, and triples and quadruples over an even
    grid of the lengths present."""
    here = np.flatnonzero(counts)
    out = {(int(length - a), int(a)) for a in here if a <= length - a and counts[length - a]}
    grid = here[:: max(1, len(here) // 110)].tolist()
    for i, a in enumerate(grid):
        for b in grid[i:]:
            c = length - a - b
            if c >= b and counts[c]:
                out.add((c, b, a))
    grid = here[:: max(1, len(here) // 24)].tolist()
    for i, a in enumerate(grid):
        for j, b in enumerate(grid[i:], i):
            for c in grid[j:]:
                d = length - a - b - c
                if d >= c and counts[d]:
                    out.add((d, c, b, a))
    return sorted(out)[:: max(1, len(out) // most)] if len(out) > 2 * most else sorted(out)


def fit_patterns(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    """Patterns and repeats that use each length as often as the histogram has it."""
    counts = np.zeros(length + 1, np.int64)
    for k, n in histogram.items():
        counts[k] = n
    out: list[Pattern] = [((length,), int(counts[length]))] if counts[length] else []
    counts[length] = 0
    options = candidates(counts, length)
    if options:
        index = np.full((len(options), 4), -1)
        for i, p in enumerate(options):
            index[i, : len(p)] = p
        times = nnls(index, counts.astype(float))
        for i in np.argsort(-times, kind="stable"):
            size, n = np.unique(options[i], return_counts=True)
            r = min(int(times[i]), int((counts[size] // n).min()))
            if r > 0:
                out.append((options[i], r))
                counts[size] -= n * r
    while counts.any():
        free, used, left = length, [], counts.copy()
        while free and (fit := np.flatnonzero(left[: free + 1])).size:
            used.append(int(fit[-1]))
            left[fit[-1]] -= 1
            free -= int(fit[-1])
        size, n = np.unique(used, return_counts=True)
        r = int((counts[size] // n).min())
        out.append((tuple(used), r))
        counts[size] -= n * r
    return out


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length rows (first number, sequence of that number, offset), by first number."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for lengths, repeats in patterns:
        offset = 0
        for n in lengths:
            out.setdefault(n, []).append((used.get(n, 0), base, offset))
            used[n] = used.get(n, 0) + repeats
            offset += n
        base += repeats
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def numbered(df: DataFrame, keys: list[str], order: list, name: str = "number", salts: int = SALTS, more: DataFrame | None = None) -> DataFrame:
    """A number from 0 for each row among those that share keys. Rows are dealt into salts and only numbered within
    one, so that no task holds a hot key's rows; counts of the salts give where each starts. more: a table with one row
    for each value of keys, whose other columns are added on the way (rows without one go), so that df is shuffled once."""
    df = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    seen = df.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    seen = seen.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_salt").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if more is not None:
        more = more.withColumnsRenamed({k: f"__{k}" for k in keys})
        on = F.lit(True)
        for k in keys:
            on &= F.col(f"_{k}").eqNullSafe(F.col(f"__{k}"))
        seen = seen.join(more, on).drop(*[f"__{k}" for k in keys])
    same = F.col("_salt") == F.col("_of")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    own = Window.partitionBy(*keys, "_salt").orderBy(*order)
    return df.join(seen, same).withColumn(name, F.col("_before") + F.row_number().over(own) - 1).drop("_salt", "_of", "_before", *[f"_{k}" for k in keys])


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each row of docs.

    Null doc_ids and repeated rows are documents of their own; an empty table gives an empty table; other columns are
    ignored. Equal pieces are interchangeable, so ties need no order."""
    parts = cut(pieces(docs, path or default_tokenizer(), length, end, text))
    histogram = {int(r["length"]): int(r["n"]) for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = slots(fit_patterns(histogram, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size).tolist():
                own = np.flatnonzero(size == n)
                rows = place[n][np.searchsorted(place[n][:, 0], number[own], "right") - 1]
                sequence[own] = rows[:, 1] + number[own] - rows[:, 0]
                offset[own] = rows[:, 2]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered(parts, ["length"], ["doc_id", "piece", "start", "ids_crc32"]).select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
