"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets whole passes over its documents and a remaining budget below its size. Documents of the source are
counted by exact length. All of the budget but its last words (FITTED) is shared out by length: going from long to short,
each length brings what has been taken as close below its due as whole documents can. A bounded knapsack over the counts
that are left then fits the rest exactly, where sums of lengths can. Which documents of a length are taken again is decided
by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents
from .packing import numbered

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20
FITTED = 1 << 16
"""Words of a budget that are left to the knapsack, besides what sharing out leaves, which is less than the longest document."""
SPACES = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return (F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> with target. Weights go round the sources in code point order, null last. A target stops
    at `most` times its source's size; what is over goes to the others by weight until none is above, which is one level
    L with target = min(most * size, L * weight): sources are sorted by the level at which they are full."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    full_first = Window.orderBy("full", "weight", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
        .withColumn("full", most * F.col("source_size") / F.col("weight"))
        .withColumn("room", F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(full_first), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full_first), F.lit(0)))
        .withColumn("level", F.col("room") / F.col("rest"))
    )
    # Filling a source that is below the level raises the level of the rest, filling one above lowers it.
    level = F.max("level").over(everything)
    return t.withColumn("target", F.when(F.col("full") < F.col("level"), F.col("source_size") * F.lit(float(most))).otherwise(level * F.col("weight"))).select("source", "source_size", "target")


def knapsack(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How often to take each size, at most counts, for the largest sum up to budget. Sums are bits of one number, and each
    sum remembers the item that reached it first: 33 bits for each word of the budget in all."""
    items = []
    for i, (size, n) in enumerate(zip(sizes, counts, strict=True)):
        n, k = min(n, budget // size if size else 0), 1
        while n > 0:
            items.append((i, min(k, n)))
            n -= k
            k *= 2
    mask, reach = (1 << budget + 1) - 1, 1
    by = np.full(budget + 1, -1, np.int32)
    for j, (i, k) in enumerate(items):
        if reach >> budget & 1:
            break
        new = (reach << sizes[i] * k & mask) & ~reach
        if new:
            by[np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little"))] = j
            reach |= new
    taken, at = [0] * len(sizes), reach.bit_length() - 1
    while at:
        i, k = items[by[at]]
        taken[i] += k
        at -= sizes[i] * k
    return taken


def shared_out(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each size (from long to short) to take, so that all sizes give alike. What is taken stays below what is
    due, by less than the longest size."""
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    out, seen, taken = [], 0, 0
    for size, n in zip(sizes, counts, strict=True):
        seen += size * n
        k = min(n, (budget * seen // total - taken) // size) if size else 0
        out.append(k)
        taken += k * size
    return out


def fit(histogram: pd.DataFrame, fitted: int = FITTED) -> pd.DataFrame:
    """For one source: (size, n) -> passes over all and how many of each size are taken once more."""
    total, target = int(histogram["source_size"].iloc[0]), float(histogram["target"].iloc[0])
    out = histogram.sort_values("size", ascending=False).reset_index(drop=True)
    passes = int(target // total) if total else 0
    budget = round(target) - passes * total if total else 0
    if budget >= total > 0:
        passes, budget = passes + 1, 0
    size, n = (out[c].astype("int64").tolist() for c in ("size", "n"))
    more = shared_out(size, n, max(budget - fitted, 0)) if budget else [0] * len(size)
    left = budget - sum(k * s for k, s in zip(more, size, strict=True))
    use = [i for i in range(len(size)) if n[i] > more[i] and 0 < size[i] <= left]
    for i, k in zip(use, knapsack([size[i] for i in use], [n[i] - more[i] for i in use], left), strict=True):
        more[i] += k
    return pd.DataFrame({"source": out["source"], "size": size, "passes": passes, "more": more, "source_size": total, "target": target})


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, size: Column | None = None, source: str = "source") -> DataFrame:
    """docs with size, source_size, target and copies: how often the mix takes each row (0 to `most`). size: a document's
    size, by default the words of text.

    Null texts have size 0 and are never taken, null is a source of its own, repeated rows are rows of their own, and an
    empty table gives an empty table. Columns of docs named like the new ones are replaced.

    A source's histogram of lengths (a row for each different length) is fitted in one task, with about four bytes for each
    of FITTED words and of the words of its longest document."""
    measure = n_words(F.col("text")) if size is None else size
    columns = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    # A struct keeps the caller's columns apart from the ones computed here.
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("doc_id"), F.col(source).alias("source"), measure.alias("size"))
    lengths = cut(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    shares = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most).withColumnRenamed("source", "_from")
    takes = cut(
        lengths.join(shares, F.col("source").eqNullSafe(F.col("_from")))
        .select("source", "size", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(lambda histogram: fit(histogram), "source string, size long, passes long, more long, source_size long, target double")
    )
    found = numbered(rows, ["source", "size"], [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id")], "number", more=takes)
    extra = F.col("passes") + (F.col("number") < F.col("more")).cast("long")
    return found.select("row.*", "size", "source_size", "target", F.when(F.col("size") == 0, 0).otherwise(extra).cast("int").alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix: each row of docs as often as it is taken, with the columns of docs, whatever their names.

    Rows whose text is null or has no words are never taken; repeated rows are rows of their own; null is a source; an
    empty table gives an empty table."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("whole"))
    return mix(packed).where("copies > 0").select("whole", F.explode(F.sequence(F.lit(1), "copies"))).select("whole.*")


def op4_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = cut(documents(spark, sf_dir).select("doc_id", "source", n_words(F.col("text")).alias("words")))
    out = mix(sized, size=F.col("words"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
