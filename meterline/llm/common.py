"""What the operators of this folder share on the Spark side."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = r"[^\x20\x09-\x0D]+"
"""Fixed value: the pattern of a word."""

_own_folder: list[str] = []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, else the context's checkpoint folder; a temporary one
    where neither is set and all runs on this machine, as in tests."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder and sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc._jsc.sc().getCheckpointDir().get()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="meterline-"))
    return _own_folder[0]


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and reads it back, so that a lost executor costs no more than a
    re-read."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


LARGEST = 1000


def with_group(rows: DataFrame, groups: DataFrame, on: str, spread: str) -> DataFrame:
    """rows with the other columns of groups, which has one row for each value of `on` and their number of rows `n`; rows
    without a group go.

    The LARGEST groups, by n, are broadcast, and their rows are dealt evenly by the column `spread`; any other group has
    at most one row in LARGEST, so no task gets more than that of one value."""
    values = [c for c in groups.columns if c != on]
    top = groups.orderBy(F.desc("n"), on).limit(LARGEST).select(F.col(on).alias("_top"), F.struct(*values).alias("_big"))
    # n is never below 0. A literal would be folded away, and with it the dealing.
    rest = groups.select(F.col(on).alias("_on"), (F.col("n") < 0).cast("long").alias("_none"), F.struct(*values).alias("_small"))
    part = F.when(F.col("_top").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(1 << 20)) + 1).otherwise(0)
    dealt = rows.join(F.broadcast(top), F.col(on) == F.col("_top"), "left").withColumn("_part", part)
    found = dealt.join(rest, (F.col(on) == F.col("_on")) & (F.col("_part") == F.col("_none")), "left").withColumn("_group", F.coalesce("_big", "_small"))
    return found.where("_group is not null").select(*rows.columns, *[F.col(f"_group.{c}").alias(c) for c in values])


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def with_key(docs: DataFrame, text: str = "text") -> tuple[DataFrame, bool]:
    """docs with a column `key` that is unique, not null, and sorted as doc_id is; and whether it is doc_id itself.

    Where doc_id is unique and never null it is the key. Otherwise rows are ranked by (doc_id, null first; md5 of text),
    and the ranks, written out once, are the keys: each row is then a document of its own, and rows that are equal in
    both columns are consecutive documents."""
    n, known, distinct = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if n == known == distinct:
        return docs.withColumn("key", F.col("doc_id").cast("long")), True
    order = [F.col("doc_id").asc_nulls_first(), F.md5(text).asc_nulls_first()]
    return cut(docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("key", F.monotonically_increasing_id())), False


def keyed(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """(key, text), and how keys map to doc_id: None where they are the same; see with_key."""
    rows, same = with_key(docs.select("doc_id", F.col(text).alias("text")))
    return rows.select("key", "text"), None if same else rows.select("key", "doc_id")


def unkeyed(df: DataFrame, ids: DataFrame | None) -> DataFrame:
    """doc_id in place of key."""
    if ids is None:
        return df.withColumnRenamed("key", "doc_id")
    return df.join(ids, "key").select("doc_id", *[c for c in df.columns if c != "key"])
