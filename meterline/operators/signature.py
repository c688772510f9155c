"""The appliance signature: how well a three-state model of a heater's cycle fits the steps of a meter's load.

Each window of reads gets its own variances by expectation maximisation; states' means, moves and equal starts stay as they
are. Windows are rows that don't depend on each other, so they are fitted where they lie, many at once in arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType


@dataclass(frozen=True)
class Signature:
    """Means and moves of the states, the variances that a fit starts from, and what counts as a heater.

    steps and tolerance end a fit; prior is added to the squares that a variance is made of, and least is the smallest weight
    that they are divided by."""

    means: tuple[float, ...] = (0.0, 600.0, 1800.0)
    variances: tuple[float, ...] = (1.0, 100.0, 200.0)
    moves: tuple[tuple[float, ...], ...] = ((0.8, 0.17, 0.03), (0.92, 0.07, 0.01), (0.95, 0.04, 0.01))
    window: int = 72
    steps: int = 1000
    tolerance: float = 1e-4
    prior: float = 0.01
    least: float = 1e-5
    score: tuple[float, float] = (300.0, 400.0)
    scaled: tuple[float, float] = (0.0, 10.0)
    spread: tuple[float, float] = (0.0, 10.0)
    low_score: float = 200.0
    high_scaled: float = 1000.0


BATCH = 1024
"""Windows that are fitted at once."""


def _emissions(x: np.ndarray, variances: np.ndarray, c: Signature) -> tuple[np.ndarray, np.ndarray]:
    """Densities (window, time, state), each time's largest being 1, and the logarithms of what they were divided by."""
    far = (x[:, :, None] - np.asarray(c.means)) ** 2
    log = -0.5 * (np.log(2 * np.pi * variances)[:, None, :] + far / variances[:, None, :])
    top = log.max(2)
    return np.exp(log - top[:, :, None]), top


def _forward(b: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward probabilities and the scales."""
    alpha, scale = np.empty_like(b), np.empty(b.shape[:2])
    now = np.full((len(b), b.shape[2]), 1 / b.shape[2])
    for t in range(b.shape[1]):
        now = (now if not t else now @ moves) * b[:, t]
        scale[:, t] = now.sum(1)
        now = now / scale[:, t, None]
        alpha[:, t] = now
    return alpha, scale


def log_likelihood(x: np.ndarray, variances: np.ndarray, c: Signature) -> np.ndarray:
    """Of each row of x under its row of variances."""
    b, top = _emissions(x, variances, c)
    _, scale = _forward(b, np.asarray(c.moves))
    return top.sum(1) + np.log(scale).sum(1)


def fit_variances(x: np.ndarray, c: Signature) -> np.ndarray:
    """The variances (window, state) that expectation maximisation finds for each row of x: until a step adds less than the
    tolerance to the row's log-likelihood, or all steps are used."""
    out = np.tile(np.asarray(c.variances, float), (len(x), 1))
    if not x.shape[1]:
        return out
    moves = np.asarray(c.moves)
    active, before = np.arange(len(x)), np.full(len(x), -np.inf)
    for step in range(c.steps):
        own = x[active]
        b, top = _emissions(own, out[active], c)
        alpha, scale = _forward(b, moves)
        beta = np.ones((len(active), len(moves)))
        weight = np.empty_like(alpha)
        for t in range(own.shape[1] - 1, -1, -1):
            weight[:, t] = alpha[:, t] * beta
            beta = (b[:, t] * beta) @ moves.T / scale[:, t, None]
        weight /= weight.sum(2, keepdims=True)
        squares = (weight * (own[:, :, None] - np.asarray(c.means)) ** 2).sum(1)
        out[active] = (c.prior + squares) / np.maximum(weight.sum(1), c.least)
        now = top.sum(1) + np.log(scale).sum(1)
        go_on = ~(now - before[active] < c.tolerance) if step else np.ones(len(active), bool)
        before[active] = now
        active = active[go_on]
        if not len(active):
            break
    return out


def difference_windows(df: DataFrame, keys: Sequence[str], ts: str, value: str, c: Signature) -> DataFrame:
    """keys, window, xs: a read's step to the next one (of 1,000 times the value; falling ones count as 1) for all reads of a
    window but its last. A window that isn't full goes. Values that are no numbers count as 0."""
    w = Window.partitionBy(*keys).orderBy(ts)
    y = F.coalesce(F.col(value).try_cast("double"), F.lit(0.0)) * 1000
    d = df.withColumn("_y", y).withColumn("_d", F.lead("_y").over(w) - F.col("_y")).withColumn("_i", F.row_number().over(w) - 1).where("_d is not null")
    d = d.withColumns({"_d": F.when(F.col("_d") < 0, 1.0).otherwise(F.col("_d")), "window": F.floor(F.col("_i") / c.window), "_p": F.col("_i") % c.window}).where(F.col("_p") < c.window - 1)
    return d.groupBy(*keys, "window").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_d"))), lambda x: x["_d"]).alias("xs")).where(F.size("xs") == c.window - 1)


def fit_windows(windows: DataFrame, c: Signature) -> DataFrame:
    """windows (with a column xs of equal lengths) with `variances` and `log_likelihood` of each window's own fit; both are
    null where xs holds something that isn't finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                x = np.array(batch.column("xs").to_pylist(), float).reshape(batch.num_rows, -1)
                good = np.isfinite(x).all(1)
                variances, ll = np.full((len(x), len(c.means)), np.nan), np.full(len(x), np.nan)
                variances[good] = fit_variances(x[good], c)
                ll[good] = log_likelihood(x[good], variances[good], c)
                shown = [v if ok else None for v, ok in zip(variances.tolist(), good.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shown, pa.list_(pa.float64())), pa.array(ll, mask=~good)], names=[*batch.schema.names, "variances", "log_likelihood"])

    schema = StructType([*windows.schema.fields, StructField("variances", ArrayType(DoubleType())), StructField("log_likelihood", DoubleType())])
    return windows.mapInArrow(run, schema)


def signature_score(df: DataFrame, keys: Sequence[str], ts: str, value: str, c: Signature = Signature()) -> DataFrame:
    """Per key: windows, avg_score (of absolute log-likelihoods), mean and deviation of the scores scaled by use, and
    is_heater. A window with a low score and next to no use is left out, and so is one without a fit; keys without windows
    have zeros and are no heaters."""
    s = fit_windows(difference_windows(df, keys, ts, value, c), c).where("log_likelihood is not null")
    mean = F.aggregate("xs", F.lit(0.0), lambda a, x: a + x) / F.size("xs")
    s = s.withColumns({"score": F.abs("log_likelihood"), "_m": mean})
    s = s.withColumn("scaled", F.when(F.col("_m") == 0, F.lit(float("inf"))).otherwise(F.col("score") / F.col("_m") / F.col("_m") * 1000))
    s = s.where(~((F.col("score") < c.low_score) & (F.col("scaled") > c.high_scaled)))
    per = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("windows"), F.avg("score").alias("avg_score"), F.avg("scaled").alias("avg_scaled"), F.stddev_pop("scaled").alias("sd_scaled"))
    out = df.select(*keys).distinct().join(per, [*keys], "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in ("windows", "avg_score", "avg_scaled", "sd_scaled")})
    inside = lambda col, lim: (F.col(col) > lim[0]) & (F.col(col) < lim[1])
    return out.withColumn("is_heater", (inside("avg_score", c.score) & inside("avg_scaled", c.scaled) & inside("sd_scaled", c.spread)).cast("int"))


def heaters_by_location(scored: DataFrame, channels: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Whether any channel of a location looks like a heater, and the mean of its channels' scores. channels: key, by."""
    return scored.join(channels, key).groupBy(*by).agg(F.max("is_heater").alias("is_heater"), F.avg("avg_score").alias("avg_score"))
