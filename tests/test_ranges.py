"""Ranks, curves and digests whose tasks keep their size whatever the number of rows or groups."""

import hashlib

import pytest
from pyspark.sql import functions as F

from meterline.operators import rollup, sample, windows
from meterline.sources import staging


def scores(spark, n, groups):
    u = F.pmod(F.xxhash64("id"), F.lit(1000)) / 7
    group = F.when(F.col("id") % 2 == 0, 0).otherwise(F.pmod(F.xxhash64(F.col("id") + 1), F.lit(groups))).cast("long")
    return spark.range(n).select("id", F.when(group == 3, None).otherwise(group).alias("g"), F.when(F.col("id") % 11 > 0, u).alias("s"), (F.col("id") % 13 == 0).alias("owner"), (F.pmod(F.xxhash64(F.col("id") * 3), F.lit(5)) == 0).cast("int").alias("y"))


@pytest.mark.parametrize("groups", [1, 400])
@pytest.mark.parametrize("n", [3000, 30_000])
def test_ranges_keep_their_size(spark, n, groups):
    df = staging.ranged(scores(spark, n, groups).where("s is not null"), [F.col("g"), F.col("s").desc(), F.col("id")], 500)
    sizes = [r["count"] for r in df.groupBy("_part").count().collect()]
    assert len(sizes) == -(-sum(sizes) // 500) and max(sizes) < 1500
    hashed = sample.first_by_hash(scores(spark, n, groups), ["g"], "id", F.lit(n), 7, 500)
    assert hashed.count() == n


@pytest.mark.parametrize("rows", [100, 10**6])
@pytest.mark.parametrize("groups", [1, 50])
def test_buckets_by_plain_ranks(spark, rows, groups):
    df = scores(spark, 3000, groups)
    got = {r["id"]: r["bucket"] for r in windows.bucketize(df, "g", "id", "s", "owner", rows=rows).collect()}
    want, ranked = {}, {}
    for r in df.collect():
        if r["owner"]:
            want[r["id"]] = 0
        elif r["s"] is None:
            want[r["id"]] = -1
        else:
            ranked.setdefault(r["g"], []).append((-r["s"], r["id"]))
    for own in ranked.values():
        for i, (_, k) in enumerate(sorted(own), 1):
            want[k] = -(-i * 5 // len(own))
    assert got == want


@pytest.mark.parametrize("by", [None, ["g"]])
def test_curves_by_plain_sums(spark, by):
    df = scores(spark, 4000, 6)
    got = {(tuple(r[c] for c in by or []), r["s"]): (r["tp"], r["fp"], r["tpr"], r["fpr"]) for r in windows.roc_curve(df, "y", "s", by, rows=60).collect()}
    groups = {}
    for r in df.collect():
        if r["s"] is not None:
            groups.setdefault(tuple(r[c] for c in by or []), []).append((r["s"], r["y"]))
    want = {}
    for g, points in groups.items():
        pos = sum(y for _, y in points)
        for s in {s for s, _ in points}:
            tp = sum(y for v, y in points if v >= s)
            fp = sum(1 - y for v, y in points if v >= s)
            want[g, s] = (tp, fp, tp / pos, fp / (len(points) - pos))
    assert got == want


def test_first_by_hash_is_the_same_in_any_ranges(spark):
    df = scores(spark, 2000, 5)
    picks = [{r["id"] for r in sample.first_by_hash(df, ["g"], "id", F.lit(37), 7, rows).collect()} for rows in (50, 10**6)]
    assert picks[0] == picks[1]
    assert {r["count"] for r in df.where(F.col("id").isin(list(picks[0]))).groupBy("g").count().collect()} == {37}


def test_digest_streams(spark):
    rows = [(g, i % 3 if g else None, hashlib.md5(f"{g}{i % 400}".encode()).hexdigest() if i % 50 else None) for g in range(4) for i in range(25_000 if g == 1 else 30)]
    df = spark.createDataFrame(rows, "g int, h int, c string").repartition(5)
    for keys in (["g"], ["g", "h"], []):
        want = {}
        for r in rows:
            want.setdefault(tuple(r["gh".index(k)] for k in keys), []).append(r[2])
        got = {tuple(r[k] for k in keys): (r["digest"], r["n"]) for r in rollup.digest(df, "c", keys).collect()}
        assert got == {k: (hashlib.md5("".join(sorted(c for c in v if c)).encode()).hexdigest(), len(v)) for k, v in want.items()}
    assert rollup.digest(df.limit(0), "c", ["g"]).collect() == []
