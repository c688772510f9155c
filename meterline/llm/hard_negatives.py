"""Hard negatives by rotated one-bit codes.

A vector is coded in levels. Each level rotates what is left (a fixed orthogonal matrix for each level and dimension), keeps
one sign bit a component, and stores the alignment (the rest's inner product with its unit code) and the length of the
residual. An anchor is rotated the same way and cut into bit planes, so that its inner product with a code is a sum of
popcounts. Levels add up to an estimate; what is left of the true product is an inner product with a residual that is
orthogonal to the last code, so Cauchy-Schwarz bounds it without any chance: rounding to planes, and both remainders. One
level of 64 bits leaves an interval of 0.6 of the product of the lengths, each further level 0.6 of that.

Rows whose interval cannot reach the best bounds known are dropped level by level, and the survivors are scored in whole
numbers, so results are exact.

Rows and anchors meet in blocks of bounded size: a first time within a label, for positives, a second time over all rows,
once each positive's score, and so the band of its negatives, is known. Each block returns its first few rows only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, with_group

LEVELS = 6
PLANES = 6
ROWS, ANCHORS = 16384, 1024
"""Rows and anchors of one block, about."""
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SCALE = 256
EXACT = 2.0**53
LAST = np.iinfo(np.int64).max


@cache
def rotation(dim: int, level: int) -> np.ndarray:
    q, _ = np.linalg.qr(np.random.default_rng([dim, level]).standard_normal((dim, dim)))
    return q


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def encode(x: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, level, word), alignments and residual lengths (row, level) of the rows of x."""
    n, dim = x.shape
    if not dim:
        return np.zeros((n, 0, 0), np.uint64), np.zeros((n, 0)), np.zeros((n, 0))
    code, align, rest = [], [], []
    for level in range(levels):
        x = x @ rotation(dim, level).T
        up = x >= 0
        a = np.abs(x).sum(1) / dim**0.5
        x = x - np.where(up, a[:, None], -a[:, None]) / dim**0.5
        code.append(_words(up))
        align.append(a)
        rest.append(np.linalg.norm(x, axis=1))
    return np.stack(code, 1), np.stack(align, 1), np.stack(rest, 1)


class Block:
    """Rows that anchors are compared with."""

    def __init__(self, table: pa.Table):
        self.key = table.column("key").to_numpy()
        self.id = pc.fill_null(table.column("vec_id"), LAST).to_numpy()
        self.label = table.column("label").to_numpy()
        bodies, codes = table.column("body").to_pylist(), table.column("code").to_pylist()
        self.dim = table.column("dim")[0].as_py()
        self.x = np.stack([_body(b, self.dim) for b in bodies])
        words = -(-self.dim // 64)
        levels = len(codes[0]) // (8 * words + 16) if words else 0
        raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
        cut_at = 8 * words * levels
        self.code = np.ascontiguousarray(raw[:, :cut_at]).view(np.uint64).reshape(len(codes), levels, words) if words else np.zeros((len(codes), 0, 0), np.uint64)
        self.align, self.rest = (np.ascontiguousarray(raw[:, a : a + 8 * levels]).view(np.float64) if words else np.zeros((len(codes), 0)) for a in (cut_at, cut_at + 8 * levels))
        self.norm = np.linalg.norm(self.x, axis=1) if len(codes) else np.zeros(0)
        self.largest = float(np.abs(self.x).max(initial=0))

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whole inner products of q with rows; by Python's numbers where floats would round."""
        if self.largest * float(np.abs(q).max(initial=0)) * max(self.dim, 1) < EXACT:
            return (self.x[at] @ q).astype(np.int64)
        whole = [int(v) for v in q]
        return np.array([sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in self.x[at]] + [None], object)[:-1]


def _body(data: bytes, dim: int) -> np.ndarray:
    """Components, stored in four bytes each where they fit."""
    return np.frombuffer(data, "<f8" if len(data) == 8 * dim else "<i4").astype(np.float64)


def intervals(q: np.ndarray, block: Block, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Level by level, bounds of the inner products of q with the rows `at`; send() takes the places within `at` to go on
    with."""
    dim, length = len(q), float(np.linalg.norm(q))
    root = dim**0.5
    estimate, error = np.zeros(len(at)), np.zeros(len(at))
    low, high = np.full(len(at), -np.inf), np.full(len(at), np.inf)
    for level in range(block.code.shape[1]):
        q = rotation(dim, level) @ q
        floor, step = q.min(), (q.max() - q.min()) / (2**PLANES - 1) or 1.0
        unit = np.rint((q - floor) / step).astype(np.int64)
        lost = float(np.abs(q - floor - step * unit).sum()) / root
        code = block.code[at, level]
        count = np.zeros(len(at), np.int64)
        for j in range(PLANES):
            plane = _words((unit[None, :] >> j & 1).astype(bool))
            count += np.bitwise_count(code & plane).sum(1, dtype=np.int64) << j
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        along = (floor * (2 * ones - dim) + step * (2 * count - int(unit.sum()))) / root
        estimate = estimate + block.align[at, level] * along
        error = error + block.align[at, level] * lost
        beside = np.sqrt(np.maximum(length**2 - np.maximum(np.abs(along) - lost, 0) ** 2, 0))
        slack = error + block.rest[at, level] * beside + 1e-9 * length * block.norm[at] + 1e-6
        low, high = np.maximum(low, estimate - slack), np.minimum(high, estimate + slack)
        keep = yield low, high
        at, estimate, error, low, high = at[keep], estimate[keep], error[keep], low[keep], high[keep]


def survivors(q: np.ndarray, block: Block, at: np.ndarray, test: Callable[[np.ndarray, np.ndarray], np.ndarray], enough: int) -> np.ndarray:
    """Rows of `at` that pass the test of their bounds at each level, or are few."""
    levels = intervals(q, block, at)
    bounds = next(levels, None)
    while bounds is not None and len(at) > enough:
        keep = np.flatnonzero(test(*bounds))
        at = at[keep]
        try:
            bounds = levels.send(keep)
        except StopIteration:
            bounds = None
    return at


def _highest(values: np.ndarray, k: int) -> float:
    """The k-th largest."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def nearest(q: np.ndarray, block: Block, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k rows of `at` and their scores."""
    at = survivors(q, block, at, lambda low, high: high >= _highest(low, k), 4 * k)
    return _first(block, at, block.scores(q, at), k)


def in_bands(q: np.ndarray, block: Block, at: np.ndarray, bands: list[int], k: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each positive score its first k rows of `at` with low * it <= 100 * score <= high * it, and their scores."""
    limits = [(low * p / 100, high * p / 100) for p in bands]

    def test(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(least), bool)
        for a, b in limits:
            sure = least[(least >= a + 1e-6) & (most <= b - 1e-6)]
            keep |= (most >= max(a - 1e-6, _highest(sure, k))) & (least <= b + 1e-6)
        return keep

    at = survivors(q, block, at, test, 4 * k)
    scores = block.scores(q, at)
    for p in bands:
        own = np.flatnonzero((low * p <= 100 * scores) & (100 * scores <= high * p))
        yield p, *_first(block, at[own], scores[own], k)


def _first(block: Block, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = sorted(range(len(at)), key=lambda i: (-scores[i], block.id[at[i]], block.key[at[i]])) if scores.dtype == object else np.lexsort((block.key[at], block.id[at], -scores))
    order = np.asarray(order[:k], np.int64)
    return at[order], scores[order]


FOUND = "anchor_key long, band long, other_key long, other_id long, score long"


def _found(rows: list[tuple[int, int, Block, np.ndarray, np.ndarray]]) -> pa.Table:
    """Columns of FOUND from (anchor's key, band, block, places, scores)."""
    size = [len(r[3]) for r in rows]
    other = np.concatenate([np.zeros(0, np.int64), *[r[2].id[r[3]] for r in rows]])
    return pa.table(
        {
            "anchor_key": pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), size)),
            "band": pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), size)),
            "other_key": pa.array(np.concatenate([np.zeros(0, np.int64), *[r[2].key[r[3]] for r in rows]])),
            "other_id": pa.array(other, mask=other == LAST),
            "score": pa.array([max(-LAST, min(LAST, int(s))) for r in rows for s in r[4]], pa.int64()),
        }
    )


def _positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            block = Block(left)
            for key, label, body in zip(*(right.column(c).to_pylist() for c in ("key", "label", "body")), strict=True):
                at = np.flatnonzero((block.label == label) & (block.key != key))
                rows.append((key, 0, block, *nearest(_body(body, block.dim), block, at, k)))
        return _found(rows)

    return run


def _negatives(k: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            block = Block(left)
            for key, label, body, bands in zip(*(right.column(c).to_pylist() for c in ("key", "label", "body", "bands")), strict=True):
                at = np.flatnonzero(block.label != label)
                rows += [(key, p, block, found, scores) for p, found, scores in in_bands(_body(body, block.dim), block, at, bands, k, low, high)]
        return _found(rows)

    return run


def coded(vectors: DataFrame, vec_id: str, vec: str, label: str, scale: int = SCALE) -> DataFrame:
    """key (of each row), vec_id, label, dim, body (whole components), code; rows that take no part are left out."""
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            column = batch.column("vec")
            values, offset = column.values.to_numpy(), column.offsets.to_numpy()
            body: list[bytes] = [b""] * len(dims)
            code: list[bytes] = [b""] * len(dims)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                x = np.floor(scale * values[offset[own][:, None] + np.arange(dim)])
                narrow = (np.abs(x) < 2.0**31).all(1)
                parts = encode(x)
                for i, row, small, *each in zip(own.tolist(), x, narrow.tolist(), *parts, strict=True):
                    body[i] = row.astype("<i4" if small else "<f8").tobytes()
                    code[i] = b"".join(p.tobytes() for p in each)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "vec_id", "label", "dim")), pa.array(body, pa.binary()), pa.array(code, pa.binary())], names=["key", "vec_id", "label", "dim", "body", "code"])

    rows = vectors.where(F.col(label).isNotNull() & F.col(vec).isNotNull()).where(whole)
    rows = rows.select(F.monotonically_increasing_id().alias("key"), F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.size(vec).alias("dim"), F.col(vec).cast("array<double>").alias("vec"))
    return rows.mapInArrow(run, "key long, vec_id long, label long, dim int, body binary, code binary")


def meet(rows: DataFrame, anchors: DataFrame, group: Column, run: Callable[[pa.Table, pa.Table], pa.Table], n_rows: int = ROWS, n_anchors: int = ANCHORS) -> DataFrame:
    """run over each block of rows and each block of anchors of one group."""
    rows, anchors = rows.withColumn("group", group), anchors.withColumn("group", group)
    size = lambda df, most, name: df.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / most).cast("long").alias(name))
    sizes = size(rows, n_rows, "row_blocks").join(size(anchors, n_anchors, "anchor_blocks").drop("n"), "group")
    dealt = lambda name: F.pmod(F.xxhash64("key"), F.col(name)).alias(name[:-1])
    every = lambda name: F.explode(F.sequence(F.lit(0).cast("long"), F.col(name) - 1)).alias(name[:-1])
    left = with_group(rows, sizes, "group", "key").select(*rows.columns, dealt("row_blocks"), every("anchor_blocks"))
    right = with_group(anchors, sizes, "group", "key").select(*[F.col(c).alias(c) for c in anchors.columns], every("row_blocks"), dealt("anchor_blocks"))
    by = ["group", "row_block", "anchor_block"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, FOUND)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label", scale: int = SCALE, n_rows: int = ROWS, n_anchors: int = ANCHORS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    is_anchor: a condition on vec_id. Rows with a null label, a null vector, or any null or non-finite component take no
    part. A score is the inner product of components floor(scale * x); rows of other dimensions than the anchor's are not
    compared with it. Higher scores come first, then smaller vec_id (null last), then the row's place in the table. A
    repeated row is a row of its own, as an anchor too. A score that 64 bits can't hold is shown as the nearest that they
    can, and bands follow what is shown. An empty table gives an empty one; other columns are ignored."""
    rows = cut(coded(vectors, vec_id, vec, label, scale))
    anchors = rows.where(is_anchor).drop("code")
    near = meet(rows, anchors, F.xxhash64("label", "dim"), _positives(positives), n_rows, n_anchors)
    order = [F.desc("score"), F.col("other_id").asc_nulls_last(), "other_key"]
    first = lambda df, by, k: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    near = cut(first(near, ["anchor_key"], positives).select("anchor_key", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")))
    bands = near.groupBy("anchor_key").agg(F.sort_array(F.collect_set("positive_score")).alias("bands"))
    with_bands = anchors.join(bands, F.col("key") == F.col("anchor_key")).drop("anchor_key")
    hard = first(meet(rows, with_bands, F.col("dim").cast("long"), _negatives(negatives, low, high), n_rows, n_anchors), ["anchor_key", "band"], negatives)
    named = anchors.select(F.col("key").alias("anchor_key"), F.col("vec_id").alias("anchor_id"))
    pairs = near.join(named, "anchor_key").withColumnRenamed("positive_score", "band")
    return pairs.join(hard, ["anchor_key", "band"]).select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), F.col("band").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
