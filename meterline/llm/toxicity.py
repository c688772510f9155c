"""Toxicity by a linear-chain conditional random field.

Tokens are runs of letters, lower case. From one part of a bounded sample of labelled documents Spark counts in how many
toxic and clean documents each token and token prefix occurs; log-odds become evidence levels of tokens. On the other
part tokens get labels (a token with evidence in a toxic document is toxic, every other token is not), the field's level
weights and transitions are fitted to them, and a logistic curve turns a document's marginals into a score. Scoring runs
forward-backward over every whole text: stretches without evidence are powers of one 2 x 2 matrix, so only tokens with
evidence cost anything. Labels, lang, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import BLOCK, LOWER, U64, as_bytes, chunks, joined, names, signed, text_parts
from .common import cut, documents

TRAIN_MOST = 6000
"""Labelled documents that the model is fitted on, at most."""
LEXICON_MOST = 20_000
"""Features with evidence that are kept, at most: those of the greatest sum of log-odds over toxic documents."""
SEGMENTS_MOST = 20_000
"""Different stretches of SEGMENT tokens that the field is fitted to, at most, chosen by a seeded hash."""
SEGMENT = 32
PREFIXES = (4, 5, 6, 7, 8)
STEPS = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0)
"""Log-odds from which each evidence level counts."""
CUT = 0.3
SEED = 11

LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined lower-case buffer, token starts and ends, and each text's place."""
    buf, at = joined(texts)
    buf = LOWER[buf]
    solid = np.zeros(len(buf) + 2, np.int8)
    solid[1:-1] = LETTER[buf]
    step = np.diff(solid)
    return buf, np.flatnonzero(step == 1), np.flatnonzero(step == -1), at


def features(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(which tokens, hashes) of whole tokens and of their prefixes. A prefix hashes unlike a whole token."""
    yield np.arange(len(start)), names(buf, start, end)
    for n in PREFIXES:
        own = np.flatnonzero(end - start > n)
        yield own, names(buf, start[own], start[own] + n) ^ U64(n)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_parts(batch):
            toxic = part.column("toxic").to_numpy()
            buf, start, end, at = tokens(texts)
            doc = np.searchsorted(at, start, "right") - 1
            found = [(h, doc[own]) for own, h in features(buf, start, end)]
            h, d = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            once = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.zeros(0, bool)
            name, back = np.unique(h[once], return_inverse=True)
            bad = np.bincount(back, toxic[d[once]], len(name)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(name)), pa.array(bad), pa.array(np.bincount(back, minlength=len(name)) - bad)], names=["feature", "bad", "good"])


@dataclass(frozen=True)
class Lexicon:
    hashes: np.ndarray
    levels: np.ndarray

    def of(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The highest evidence level of each token, 0 without any."""
        out = np.zeros(len(start), np.uint8)
        if not len(self.hashes):
            return out
        filter_ = np.zeros(1 << 20, bool)
        filter_[(self.hashes & U64((1 << 20) - 1)).astype(np.int64)] = True
        for own, h in features(buf, start, end):
            maybe = np.flatnonzero(filter_[(h & U64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            hit = self.hashes[at] == h[maybe]
            np.maximum.at(out, own[maybe[hit]], self.levels[at[hit]])
        return out


@dataclass(frozen=True)
class Field:
    """weights[level] of the toxic state (the clean state has 0), transitions[from, to] and the scores' logistic curve."""

    weights: np.ndarray
    transitions: np.ndarray
    curve: np.ndarray

    def marginals(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of tokens with evidence and their probability of the toxic state, by forward-backward."""
        at = np.flatnonzero(level)
        if not len(at):
            return at, np.zeros(0)
        (s00, s01), (s10, s11) = np.exp(self.transitions).tolist()
        emit = np.exp(self.weights).tolist()
        powers = [(s00, s01 * emit[0], s10, s11 * emit[0])]

        def skip(x: float, y: float, n: int, back: bool) -> tuple[float, float]:
            """The state n tokens without evidence further."""
            k = 0
            while n:
                if k == len(powers):
                    a, b, c, d = powers[-1]
                    a, b, c, d = a * a + b * c, a * b + b * d, c * a + d * c, c * b + d * d
                    z = max(a, b, c, d)
                    powers.append((a / z, b / z, c / z, d / z))
                if n & 1:
                    a, b, c, d = powers[k]
                    x, y = (a * x + b * y, c * x + d * y) if back else (x * a + y * c, x * b + y * d)
                    z = x + y
                    x, y = x / z, y / z
                n >>= 1
                k += 1
            return x, y

        places, own = at.tolist(), level[at].tolist()
        ahead = []
        x, y = 1.0, emit[0]
        for i, p in enumerate(places):
            # The first token has no move before it; x, y stand at the token before p, or are those of a first one.
            if p:
                x, y = skip(x, y, p - places[i - 1] - 1 if i else p - 1, False)
                x, y = x * s00 + y * s10, (x * s01 + y * s11) * emit[own[i]]
            else:
                x, y = 1.0, emit[own[i]]
            z = x + y
            x, y = x / z, y / z
            ahead.append((x, y))
        x, y = skip(1.0, 1.0, len(level) - 1 - places[-1], True)
        out = [0.0] * len(places)
        for i in range(len(places) - 1, -1, -1):
            clean, toxic = ahead[i][0] * x, ahead[i][1] * y
            out[i] = toxic / (clean + toxic)
            if i:
                y *= emit[own[i]]
                x, y = s00 * x + s01 * y, s10 * x + s11 * y
                z = x + y
                x, y = skip(x / z, y / z, places[i] - places[i - 1] - 1, True)
        return at, np.array(out)

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(summary(p) @ self.curve))))


def summary(p: np.ndarray) -> np.ndarray:
    """What a document's marginals tell: a constant, the log of expected toxic tokens, the strongest one."""
    return np.array([1.0, np.log1p(p.sum()), p.max() if len(p) else 0.0])


def fit_field(segments: np.ndarray, labels: np.ndarray, weight: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Level weights and transitions that maximise the likelihood of token labels; segments: (n, SEGMENT) levels."""
    k = len(STEPS) + 1
    theta, m, v = np.zeros(k + 4), np.zeros(k + 4), np.zeros(k + 4)
    theta[:k] = np.linspace(-3, 3, k)
    n, length = segments.shape
    seen = np.bincount(segments[labels == 1], np.repeat(weight, length).reshape(n, length)[labels == 1], k)
    moves = np.bincount((labels[:, :-1] * 2 + labels[:, 1:]).ravel(), np.repeat(weight, length - 1), 4)
    total = weight.sum() * length
    level = np.ascontiguousarray(segments.T)
    spread = np.broadcast_to(weight, level.shape).ravel()
    a0, a1, b0, b1 = (np.empty((length, n)) for _ in range(4))
    for t in range(1, steps + 1):
        emit = np.exp(theta[level])
        s00, s01, s10, s11 = np.exp(theta[k:])
        x, y = np.ones(n), emit[0]
        for i in range(length):
            if i:
                x, y = x * s00 + y * s10, (x * s01 + y * s11) * emit[i]
            z = x + y
            x, y = x / z, y / z
            a0[i], a1[i] = x, y
        x, y = np.ones(n), np.ones(n)
        for i in range(length - 1, -1, -1):
            b0[i], b1[i] = x, y
            y = y * emit[i]
            x, y = s00 * x + s01 * y, s10 * x + s11 * y
            z = x + y
            x, y = x / z, y / z
        toxic = a1 * b1
        toxic /= toxic + a0 * b0
        ahead = b1[1:] * emit[1:]
        pairs = [a0[:-1] * s00 * b0[1:], a0[:-1] * s01 * ahead, a1[:-1] * s10 * b0[1:], a1[:-1] * s11 * ahead]
        z = sum(pairs)
        expected = np.array([float(((p / z) @ weight).sum()) for p in pairs])
        grad = np.r_[seen - np.bincount(level.ravel(), toxic.ravel() * spread, k), moves - expected] / total * 100 - 1e-3 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta[:k], theta[k:].reshape(2, 2)


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w)), x.T @ (y - p) - 0.5 * w)
    return w


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_MOST, seed: int = SEED) -> tuple[Lexicon, Field]:
    """Fits on at most `most` labelled documents (none held out), chosen by a seeded hash of doc_id."""
    none = Lexicon(np.zeros(0, U64), np.zeros(0, np.uint8)), Field(np.zeros(len(STEPS) + 1), np.zeros((2, 2)), np.array([-20.0, 0, 0]))
    order = F.xxhash64("_id", F.lit(seed))
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("long").alias("toxic")).orderBy(order, "_id").limit(most)
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    first = F.pmod(F.xxhash64("_id", F.lit(seed + 1)), F.lit(5)) < 3
    learn, tune = rows.where(first).select("toxic", "text"), rows.where(~first).select("_id", "toxic", "text")
    n = learn.groupBy("toxic").count().collect()
    n_bad, n_good = (sum(r["count"] for r in n if (r["toxic"] == 1) == bad) for bad in (True, False))
    if not n_bad or not n_good:
        return none
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    found = (
        learn.mapInArrow(_count, "feature long, bad long, good long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .withColumn("odds", odds)
        .where((F.col("bad") >= 3) & (F.col("odds") >= STEPS[0]))
        .orderBy(F.desc(F.col("bad") * F.col("odds")), "feature")
        .limit(LEXICON_MOST)
        .toPandas()
        .sort_values("feature")
    )
    hashes = found["feature"].to_numpy(np.int64).view(U64)
    by = np.argsort(hashes)
    lexicon = Lexicon(hashes[by], np.searchsorted(STEPS, found["odds"].to_numpy()[by], "right").astype(np.uint8))

    def levels(texts: list[bytes]) -> Iterator[np.ndarray]:
        for a, b in chunks([len(t) for t in texts], BLOCK):
            buf, start, end, at = tokens(texts[a:b])
            level, limit = lexicon.of(buf, start, end), np.searchsorted(start, at)
            yield from (level[limit[i] : limit[i + 1]] for i in range(b - a))

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for level, toxic in zip(levels(as_bytes(batch.column("text"))), batch.column("toxic").to_pylist(), strict=True):
                part = np.r_[level, np.zeros(-len(level) % SEGMENT, np.uint8)].reshape(-1, SEGMENT)
                found.append(np.c_[part, (part.any(1) & (toxic == 1)).astype(np.uint8)])
            rows, n = np.unique(np.concatenate(found), axis=0, return_counts=True) if found else (np.zeros((0, SEGMENT + 1), np.uint8), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in rows], pa.binary()), pa.array(n, pa.int64())], names=["stretch", "n"])

    counted = cut(tune.mapInArrow(stretches, "stretch binary, n long").groupBy("stretch").agg(F.sum("n").alias("n")))
    blank = bytes(SEGMENT + 1)
    marked = counted.where(F.col("stretch") != blank)
    kept = marked.orderBy(F.xxhash64("stretch", F.lit(seed)), "stretch").limit(SEGMENTS_MOST).collect()
    sums = counted.agg(F.sum(F.when(F.col("stretch") == blank, F.col("n"))), F.sum(F.when(F.col("stretch") != blank, F.col("n")))).first()
    if sums[0] is None and sums[1] is None:
        return none
    share = sum(r["n"] for r in kept) / sums[1] if sums[1] else 1.0
    rows = np.frombuffer(b"".join([*(bytes(r["stretch"]) for r in kept), blank]), np.uint8).reshape(-1, SEGMENT + 1).astype(np.int64)
    segments, toxic = rows[:, :-1], rows[:, -1:]
    weight = np.array([*(float(r["n"]) for r in kept), share * float(sums[0] or 0)])
    weights, transitions = fit_field(segments, ((segments > 0) & (toxic == 1)).astype(np.int64), weight)
    field = Field(weights, transitions, np.zeros(3))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([summary(field.marginals(level)[1]) for level in levels(as_bytes(batch.column("text")))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("toxic"), pa.array(x[:, 1]), pa.array(x[:, 2])], names=["_id", "toxic", "sum", "most"])

    known = sorted(tuple(r) for r in tune.mapInArrow(summaries, "_id long, toxic long, sum double, most double").collect())
    x = np.array([(1.0, a, b) for _, _, a, b in known])
    return lexicon, Field(weights, transitions, fit_curve(x, np.array([float(y == 1) for _, y, _, _ in known])))


def score(docs: DataFrame, lexicon: Lexicon, field: Field, text: str = "text") -> DataFrame:
    """docs with score, predicted, n_spans and spans (start:end in code points, comma-joined) of toxic tokens.

    A null or empty text has the score of a document without evidence and no spans; each row is scored alone, so repeated
    rows agree and doc_id may be null; an empty table gives an empty table. Columns of docs named like the new ones are
    replaced."""
    keep = [c for c in docs.columns if c not in ("score", "predicted", "n_spans", "spans")]
    docs = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in text_parts(batch, text=text)):
            scores, spans = [], []
            buf, start, end, at = tokens(texts)
            level = lexicon.of(buf, start, end)
            limit = np.searchsorted(start, at)
            none = field.score(np.zeros(0))
            marked = np.add.reduceat(np.r_[level > 0, False], np.minimum(limit[:-1], len(level))) if len(level) else np.zeros(len(texts), int)
            for i in range(len(texts)):
                lo, hi = limit[i], limit[i + 1]
                if lo == hi or not marked[i]:
                    scores.append(none)
                    spans.append("")
                    continue
                where, p = field.marginals(level[lo:hi])
                scores.append(field.score(p))
                bad = where[p >= 0.5] + lo
                if len(bad):
                    lead = np.cumsum((buf[at[i] : at[i + 1]] & 0xC0) != 0x80)
                    spans.append(",".join(f"{lead[s - at[i]] - 1}:{lead[e - at[i] - 1]}" for s, e in zip(start[bad], end[bad], strict=True)))
                else:
                    spans.append("")
            points = np.array(scores, float)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(points), pa.array((points >= CUT).astype(np.int32)), pa.array([s.count(":") for s in spans], pa.int32()), pa.array(spans, pa.string())],
                names=[*keep, "score", "predicted", "n_spans", "spans"],
            )

    return docs.mapInArrow(run, f"{schema}, score double, predicted int, n_spans int, spans string")


def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, *fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_spans", "spans")
