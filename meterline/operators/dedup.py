"""De-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which should leave no ties. Spark keeps only one row of a key while
    it sorts (a window group limit), before and after the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


dedupe_keys = latest_wins


def newest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The row with the greatest `by` of each key, as one aggregate with partial results."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*by))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*").select(*df.columns)


def distinct_ids(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()
