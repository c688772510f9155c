"""Seeded, repeatable choices of rows. A row's place is the hash of its key and a seed, never rand()."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import ROWS_A_RANGE


def digest(key: Column, seed: int) -> Column:
    """MD5 of key:seed, in hex, which other engines compute alike."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def number(key: Column, seed: int) -> Column:
    """A whole number below 2**52 that depends on the key and the seed alone."""
    return F.conv(F.substring(digest(key, seed), 1, 13), 16, 10).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the key and the seed alone."""
    return number(key, seed) / float(1 << 52)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def pick_audit_slice(df: DataFrame, slot: list[str], key: str, complete: Column, most: int = 1000, seed: int = 7, pick_fullest: bool = False) -> DataFrame:
    """Complete keys of one slot (an hour or a day): a seeded one of those with more than `most` of them, else the
    fullest; then at most `most` keys in seeded order. The slot meets the rows in a join, not on the driver."""
    good = df.where(complete)
    sizes = good.groupBy(*slot).agg(F.count_distinct(key).alias("_n"))
    large = F.lit(False) if pick_fullest else F.col("_n") > most
    chosen = sizes.orderBy(large.desc(), F.when(large, number(F.concat_ws("|", *slot), seed)), F.col("_n").desc(), *slot).limit(1).drop("_n")
    keys = good.join(F.broadcast(chosen), slot, "left_semi").select(*slot, key).distinct()
    return keys.orderBy(F.col(key) if pick_fullest else number(F.col(key), seed), key).limit(most)


def _shares(df: DataFrame, by: list[str], label: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"), F.count_if(F.col(label).isNull()).alias("_none"))


def balance_classes(df: DataFrame, label: str, key: str, ratio: float = 1.0, seed: int = 7) -> DataFrame:
    """Keeps the rarer class and `ratio` times as many of the other, by seeded rank dealt into ranges of the hash."""
    counts = df.agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")).withColumn("_one", F.lit(1))
    df = df.where(F.col(label).isin(0, 1)).withColumn("_one", F.lit(1)).join(F.broadcast(counts), "_one")
    small = F.when(F.col("_pos") <= F.col("_neg"), 1).otherwise(0)
    room = F.when(F.col(label) == small, F.greatest("_pos", "_neg")).otherwise(F.ceil(ratio * F.least("_pos", "_neg")))
    df = df.withColumn("_room", room)
    return first_by_hash(df, [label], key, F.col("_room"), seed).drop("_one", "_pos", "_neg", "_room")


def first_by_hash(df: DataFrame, by: list[str], key: str, most: Column, seed: int, rows: int = ROWS_A_RANGE) -> DataFrame:
    """The first `most` rows of each group in seeded hash order. Hashes are dealt into ranges, as many as the group's size
    asks for (about `rows` in each), so that a group is sorted by many tasks; counts of the ranges say where each starts."""
    names = [f"_of_{i}" for i in range(len(by))]
    same = F.lit(True)
    for c, n in zip(by, names, strict=True):
        same &= F.col(c).eqNullSafe(F.col(n))
    sizes = df.groupBy(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)]).agg(F.ceil(F.count(F.lit(1)) / rows).alias("_parts"))
    dealt = df.join(sizes, same).withColumn("_u", uniform(F.col(key), seed)).withColumn("_part", F.floor(F.col("_u") * F.col("_parts")).cast("long"))
    before = Window.partitionBy(*names).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*names, F.col("_part").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select(*names, "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy(*names, "_part").orderBy("_u", key)
    placed = dealt.alias("d").join(starts.alias("s"), [F.col(f"d.{n}").eqNullSafe(F.col(f"s.{n}")) for n in names] + [F.col("_part") == F.col("_at")])
    return placed.select("d.*", "_before").withColumn("_row", F.col("_before") + F.row_number().over(own)).where(F.col("_row") <= most).select(*df.columns)


def fill_negatives(df: DataFrame, by: str, label: str, key: str, seed: int = 7) -> DataFrame:
    """Where positives of a group exceed its negatives, unlabelled rows become negatives with the probability that makes
    up for it; groups without positives go, and so do rows that stay unlabelled."""
    df = df.join(_shares(df, [by], label), by).where("_pos > 0")
    chance = F.try_divide(F.greatest(F.col("_pos") - F.col("_neg"), F.lit(0)), F.col("_none"))
    filled = F.coalesce(F.col(label), F.when(uniform(F.col(key), seed) < chance, 0))
    return df.withColumn(label, filled).where(F.col(label).isNotNull()).drop("_pos", "_neg", "_none")


def sample_limit(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    return df.orderBy(digest(F.col(key), seed), key).limit(n)


def assign_folds(df: DataFrame, key: str, k: int, seed: int = 7, name: str = "fold") -> DataFrame:
    """A stable fold from 0 to k - 1."""
    return df.withColumn(name, (number(F.col(key), seed) % k).cast("int"))
